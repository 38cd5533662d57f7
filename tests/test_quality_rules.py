"""Rules as data: every kind, nulls, empty input, one scan."""

import pytest

from tallyframe.operators import quality as Q

RULES = [Q.unique("u", "k"), Q.not_null("m", "a"), Q.bounds("b", "a", 0, 10), Q.bounds("low", "a", low=1), Q.complete("c", "a", 0.5),
         Q.ordered("o", "a", "b"), Q.adds_up("s", ["g"], "a", "w"), Q.traced("t", "src")]
ROWS = [("x", "g1", 1, 2, 6, "file"), ("x", "g1", 5, 4, 6, " "), ("y", "g2", None, 1, 3, None), (None, "g2", 3, None, 3, "f"),
        (None, None, 11, 12, 12, "f"), ("z", None, 0, 0, 12, "f")]
SCHEMA = "k string, g string, a long, b long, w long, src string"


def test_report_and_violations(spark):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(3)
    got = {r.rule: (r.kind, r.n_checked, r.n_violations, r.passed) for r in Q.quality_report(df, RULES).collect()}
    assert got == {"u": ("duplicates", 6, 4, False), "m": ("missing", 6, 1, False), "b": ("bounds", 6, 1, False), "low": ("bounds", 6, 1, False),
                   "c": ("completeness", 6, 1, True), "o": ("coherence", 6, 1, False), "s": ("coherence", 3, 1, False),
                   "t": ("traceability", 6, 2, False)}
    rows = sorted((r.rule, tuple(r.key), r.n) for r in Q.violations(df, RULES, ["k", "g"]).collect())
    assert rows == sorted([("u", ("x",), 2), ("u", ("",), 2), ("m", ("y", "g2"), 1), ("b", ("", ""), 1), ("low", ("z", ""), 1),
                           ("c", ("y", "g2"), 1), ("o", ("x", "g1"), 1), ("s", ("",), 2), ("t", ("x", "g1"), 1), ("t", ("y", "g2"), 1)])


def test_empty_input_and_repeated_names(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert all(r.passed and r.n_checked == r.n_violations == 0 for r in Q.quality_report(df, RULES).collect())
    assert Q.violations(df, RULES, ["k"]).collect() == []
    with pytest.raises(ValueError):
        Q.quality_report(df, [Q.not_null("m", "a"), Q.not_null("m", "b")])


def test_one_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    rules = [Q.unique("key", "l_orderkey", "l_linenumber"), Q.bounds("qty", "l_quantity", 1, 50), Q.not_null("part", "l_partkey"),
             Q.adds_up("sum", ["l_orderkey"], "l_quantity", "l_quantity")]
    for out in (Q.quality_report(df, rules), Q.violations(df, rules, ["l_orderkey"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("FileScan parquet") == 1 and "Join" not in plan and "SortAggregate" not in plan
