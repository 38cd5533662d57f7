"""Invariants and property tests."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from tallyframe.functions import scalars as S
from tallyframe.operators import reshape as R
from tallyframe.plans import proxy as P

SF = "/root/testdata/sf0.001"


def written(value, rng):
    """A decimal number (as an integer count of 1/100) the way French files write it."""
    sign, whole, cents = "-" if value < 0 else "", abs(value) // 100, abs(value) % 100
    digits = str(whole)
    if rng.random() < 0.5:  # groups of three, split by some kind of space
        space = rng.choice(["\u00a0", "\u202f", " "])
        digits = space.join([digits[max(0, i - 3):i] for i in range(len(digits), 0, -3)][::-1])
    tail = "" if not cents and rng.random() < 0.5 else rng.choice([",", "."]) + f"{cents:02d}"
    return rng.choice(["", " ", "\t"]) + sign + digits + tail + rng.choice(["", " %", "%", "  "])


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(-10 ** 11, 10 ** 11), min_size=20, max_size=60), st.randoms())
def test_localized_numbers_read_back(spark, numbers, rng):
    texts = [written(n, rng) for n in numbers]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, v string")
    got = df.orderBy("i").select(S.parse_float_fr("v"), S.parse_int_fr("v"), S.parse_ratio_fr("v")).collect()
    for n, t, (f, i, r) in zip(numbers, texts, got):
        assert f == pytest.approx(n / 100, rel=1e-15, abs=0), t
        floor, rest = divmod(n, 100)  # half to even
        assert i == floor + (rest > 50 or (rest == 50 and floor % 2 == 1)), t
        assert r == pytest.approx(n / 10_000, abs=1e-9), t


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 999), min_size=10, max_size=40), st.randoms())
def test_area_codes_read_back(spark, codes, rng):
    shapes = [lambda c: str(c), lambda c: f" {c} ", lambda c: f"{c}.0", lambda c: f"00{c}", lambda c: f"{c}.9\t"]
    texts = [rng.choice(shapes)(c) for c in codes]
    df = spark.createDataFrame(list(enumerate([*texts, "2a", " z ", "", "  "])), "i int, v string")
    got = [r[0] for r in df.orderBy("i").select(S.normalize_area_code("v")).collect()]
    assert got == [f"{c:02d}" for c in codes] + ["2A", "0Z", None, None]


@pytest.mark.parametrize("text", ["n/a", "1d", "nan", "inf", "1.2.3", "--1", "e5", ""])
def test_other_texts_are_no_numbers(spark, text):
    assert spark.createDataFrame([(text,)], "v string").select(S.parse_float_fr("v"), S.parse_int_fr("v")).first() == (None, None)


def test_shares_sum_to_one(spark):
    r = E.queries()["leader_per_group"](spark, SF)  # warm
    rc = P.results_micro(spark, SF)
    sums = rc.groupBy("yr", "geo").agg(F.sum("micro_share").alias("s"), F.count(F.lit(1)).alias("n")).collect()
    assert r.count() == len(sums)
    for row in sums:
        assert abs(row.s - 1_000_000) <= row.n  # each share is rounded to the nearest millionth


def test_unpivot_of_pivot_is_identity(spark):
    t = P.totals(spark, SF).select(S.code2("geo").alias("dept_code"), F.col("yr").cast("int").alias("yr"), "valid")
    m = R.pivot_matrix(t, "dept_code", "yr", "valid", P.years(spark, SF))
    long = R.melt_measures(m, ["dept_code"], [str(y) for y in P.years(spark, SF)], "yr", "valid") \
        .where(F.col("valid").isNotNull()) \
        .select("dept_code", F.col("yr").cast("int").alias("yr"), F.col("valid").cast("bigint").alias("valid"))
    assert sorted(map(tuple, long.collect())) == sorted(map(tuple, t.collect()))


def test_sparse_matrix_of_fifty_thousand_columns(spark):
    import pytest
    from pyspark.sql import functions as F

    cells = spark.range(50_000).select((F.col("id") % 20).alias("r"), (F.col("id") * 7 % 50_000).alias("c"), F.col("id").alias("v"))
    order = spark.range(21).withColumnRenamed("id", "r")
    m = R.sparse_matrix(cells, "r", "c", "v", order)
    rows = {x.r: x.cells for x in m.collect()}
    assert len(rows) == 21 and rows[20] == []
    assert all([k.column for k in r] == sorted({k.column for k in r}) for r in rows.values())
    assert sorted(map(tuple, R.sparse_cells(m, "r", "c", "v").collect())) == sorted(map(tuple, cells.collect()))
    every = R.sparse_cells(m, "r", "c", "v", R.matrix_columns(cells, "c"))
    assert every.count() == 21 * 50_000 and every.where("v is not null").count() == 50_000
    with pytest.raises(Exception, match="more than one row for a cell"):
        R.sparse_matrix(cells.unionByName(cells.limit(1)), "r", "c", "v").collect()
