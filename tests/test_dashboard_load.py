"""FX7 (dashboard datasets) and FX8 (keyed loads, idempotence)."""

import pytest
from pyspark.sql import functions as F

from tallyframe import schema as SC
from tallyframe.operators import load as L
from tallyframe.plans import dashboard as D


def fx7(spark):
    data = [(2012, "75", "Paris", "B", None, None, None, 10, 0.5, 0.7),
            (2012, "75", "Paris", "A", None, None, None, None, 0.5, 0.7),
            (2017, "75", "Paris", "B", None, None, None, 6, 0.6, 0.6),
            (2017, "92", "HdS", "C", None, None, None, 4, None, 0.5)]
    return spark.createDataFrame(data, SC.RESULTS)


def test_fx7_leaders_matrix(spark):
    r = fx7(spark)
    lead = {(x.year, x.dept_code): (x.candidate_name, x.votes) for x in D.leaders(r).collect()}
    assert lead == {(2012, "75"): ("A", None), (2017, "75"): ("B", 6)}
    m = {x.dept_code: (x["2012"], x["2017"]) for x in D.leader_matrix(r, [2012, 2017]).collect()}
    assert m == {"75": (50.0, 60.0), "92": (None, None)}


def test_fx7_snapshot(spark):
    vals = spark.createDataFrame(
        [("poverty_rate", "75000", 2017, 15.0, "s"), ("poverty_rate", "75000", 2022, 16.0, "s"),
         ("poverty_rate", "92000", 2017, 12.0, "s"), ("unemployment_rate", "92000", 2030, 1.0, "s")],
        SC.INDICATOR_VALUES)
    order = spark.createDataFrame([("75",), ("92",)], "dept_code string")
    out = [(x.dept_code, x.year, x.value) for x in D.latest_indicator(vals, "poverty_rate", order).collect()]
    assert out == [("75", 2022, 16.0)]


def _set(df):
    return sorted(tuple(r) for r in df.collect())


def test_fx8_loads_and_idempotence(spark):
    cur = spark.createDataFrame([("75", "Paris")], "dept_code string, dept_name string")
    inc = spark.createDataFrame([("75", "PARIS"), ("92", "Hauts-de-Seine")], "dept_code string, dept_name string")
    once = L.insert_ignore(cur, inc, ["dept_code"])
    assert _set(once) == [("75", "Paris"), ("92", "Hauts-de-Seine")]
    assert _set(L.insert_ignore(once, inc, ["dept_code"])) == _set(once)

    iv = spark.createDataFrame([(1, "75000", 2012, 8.0), (1, "92000", 2012, 7.0)], "id long, insee string, y int, v double")
    new = spark.createDataFrame([(1, "75000", 2012, 9.0)], "id long, insee string, y int, v double")
    up = L.upsert(iv, new, ["id", "insee", "y"])
    assert _set(up) == [(1, "75000", 2012, 9.0), (1, "92000", 2012, 7.0)]
    assert _set(L.upsert(up, new, ["id", "insee", "y"])) == _set(up)

    res = spark.createDataFrame([("e1", "75000", "c1", 10), ("e1", "75000", "c2", 5), ("e1", "13000", "c1", 3),
                                 ("e2", "75000", "c1", 1)], "e string, insee string, c string, v long")
    inc_r = spark.createDataFrame([("e1", "75000", "c1", 11)], "e string, insee string, c string, v long")
    sl = spark.createDataFrame([("e1", "75000")], "e string, insee string")
    rep = L.replace_slice(res, inc_r, sl)
    assert _set(rep) == [("e1", "13000", "c1", 3), ("e1", "75000", "c1", 11), ("e2", "75000", "c1", 1)]
    assert _set(L.replace_slice(rep, inc_r, sl)) == _set(rep)

    cand = spark.createDataFrame([(1, "A", None)], "candidate_id long, candidate_name string, party_code string")
    inc_c = spark.createDataFrame([("A", None), ("B", None), ("B", None)], "candidate_name string, party_code string")
    nxt = L.assign_keys(cand, inc_c, ["candidate_name", "party_code"], "candidate_id")
    assert _set(nxt) == [(1, "A", None), (2, "B", None)]
    assert _set(L.assign_keys(nxt, inc_c, ["candidate_name", "party_code"], "candidate_id")) == _set(nxt)


def test_dense_ids_are_consecutive(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("k"))
    out = L.dense_ids(df, ["k"], "id", offset=10, partitions=7).collect()
    pairs = sorted((r.k, r.id) for r in out)
    assert [i for _, i in pairs] == list(range(11, 5011))


def test_dense_ids_with_other_columns_and_without_exchange_reuse(spark):
    """Range bounds are sampled: rows and counts must come from one evaluation."""
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        df = spark.range(1_000_000).select(F.xxhash64("id").alias("k"), F.concat(F.lit("name "), F.col("id")).alias("n"))
        out = L.dense_ids(df, ["k"], "id", partitions=8)
        n, distinct, lo, hi = out.agg(F.count("id"), F.count_distinct("id"), F.min("id"), F.max("id")).first()
        assert (n, distinct, lo, hi) == (1_000_000, 1_000_000, 1, 1_000_000)
        cur = L.assign_keys(df.where("false").select("k", F.lit(1).cast("bigint").alias("id")), df, ["k"], "id")
        assert cur.agg(F.count_distinct("id"), F.max("id")).first() == (1_000_000, 1_000_000)
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_matrix_with_a_cell_twice_is_an_error(spark):
    from tallyframe.operators import reshape as R

    df = spark.createDataFrame([("75", 2012, 1), ("75", 2012, 2)], "d string, y int, v int")
    with pytest.raises(Exception, match="more than one row"):
        R.pivot_matrix(df, "d", "y", "v", [2012]).collect()


def test_bucketed_lags_equal_the_plain_window(spark):
    from tallyframe.operators import rank as W

    rows = [(k, t, t * 10) for k in ("a", None) for t in (0, 1, 2, 4, 9, 10, 30, 31, 32, 33)]
    df = spark.createDataFrame(rows, "k string, t int, v int")
    for n in (1, 2, 3):
        want = sorted(map(str, W.with_history(df, ["k"], "t", ["v"], n=n).collect()))
        got = W.with_history(df, ["k"], "t", ["v"], n=n, bucket=F.floor(F.col("t") / 3))
        assert sorted(map(str, got.collect())) == want


def test_constraints(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k long, v string")
    assert [tuple(r) for r in L.pk_violations(df, ["k"]).collect()] == [(1, 2)]
    assert L.null_violations(df, ["v"]).collect()[0][0] == 1
    dim = spark.createDataFrame([(1,)], "k long")
    assert [r.k for r in L.fk_violations(df, dim, ["k"]).collect()] == [2]
