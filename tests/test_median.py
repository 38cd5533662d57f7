"""Exact median by counting: hot groups, ties, nulls, against the statistics module."""

import random
import statistics

import pytest

from tallyframe.operators import aggregate as A


def check(spark, rows, largest, kind="double"):
    df = spark.createDataFrame(rows, f"k string, j int, v {kind}").repartition(6)
    got = {(r.k, r.j): r for r in A.describe_by(df, ["k", "j"], "v", largest).collect()}
    groups = {}
    for k, j, v in rows:
        groups.setdefault((k, j), []).append(v)
    assert set(got) == set(groups)
    for g, values in groups.items():
        values = [v for v in values if v is not None and v == v]
        assert got[g].n == len(values)
        assert got[g].median == (pytest.approx(statistics.median(values)) if values else None), g
        assert (got[g].min, got[g].max) == ((min(values), max(values)) if values else (None, None))


@pytest.mark.parametrize("largest", [5, 50, None])
def test_hot_ties_nulls_and_tails(spark, largest):
    rnd = random.Random(4)
    rows = [("hot", 1, rnd.gauss(0, 1) * 10 ** rnd.randint(-9, 9)) for _ in range(3000)]
    rows += [("ties", 1, float(rnd.choice([1, 1, 1, 2, 3]))) for _ in range(1500)]
    rows += [("same", None, 7.5)] * 400 + [(None, 2, float(i)) for i in range(401)] + [(None, None, float(i)) for i in range(400)]
    rows += [("few", 1, 1.0), ("few", 1, None), ("none", 3, None), ("nan", 1, float("nan")), ("nan", 1, 4.0)]
    check(spark, rows, largest)


def test_middle_between_two_far_values(spark):
    check(spark, [("a", 1, v) for v in [0] * 500 + [10 ** 9] * 500], 10, "long")
    check(spark, [("a", 1, v) for v in [0] * 501 + [10 ** 9] * 500], 10, "long")


def test_no_window_over_values_and_small_work_for_a_hot_group(spark):
    df = spark.range(200_000).selectExpr("if(id % 3 = 0, id % 50, -1) as k", "(id * 7919) % 100003 as v")
    out = A.describe_by(df, ["k"], "v", 500)
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.k: r.median for r in out.collect()}
    want = {r.k: r.m for r in df.groupBy("k").agg({"v": "median"}).withColumnRenamed("median(v)", "m").collect()}
    assert got == want
