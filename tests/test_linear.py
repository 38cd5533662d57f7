"""Gram aggregate: fits, windows, correlations, model choice, classes and scenarios against numpy and plain Python."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyframe.operators import linear as LIN
from tallyframe.operators import model as M

COLS = ["a", "b", "c", "y"]


def rows_of(n=300, seed=3, holes=True):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        a, b, c = rnd.randint(0, 1000), rnd.randint(-500, 500) / 4, float(rnd.randint(0, 50))
        y = 3 * a - 2 * b + 0.5 * c + rnd.randint(-9, 9) + 7
        b, c = (None if holes and rnd.random() < 0.1 else b), (None if holes and rnd.random() < 0.2 else c)
        out.append((rnd.choice(["p", "q", "hot", "hot", "hot"]), 1990 + i % 8, a, b, c, y))
    return out


def frame(spark, rows, parts=4):
    return spark.createDataFrame(rows, "g string, t int, a long, b double, c double, y double").repartition(parts)


def reference(rows, used=(2, 3, 4)):
    """numpy least squares with the mean in place of nulls."""
    x = np.array([[np.nan if r[i] is None else r[i] for i in used] for r in rows], float)
    mean = np.nanmean(x, axis=0)
    x = np.where(np.isnan(x), mean, x)
    y = np.array([r[5] for r in rows], float)
    beta, *_ = np.linalg.lstsq(np.c_[np.ones(len(x)), x], y, rcond=None)
    resid = y - np.c_[np.ones(len(x)), x] @ beta
    return beta, mean, float(resid @ resid)


def test_fit_equals_numpy_with_missing_cells(spark):
    rows = rows_of()
    got = LIN.fit(LIN.gram(frame(spark, rows), COLS, scale=2), COLS).first()
    beta, mean, rss = reference(rows)
    assert [got.intercept, *got.coef] == pytest.approx(list(beta)) and list(got.mean) == pytest.approx(list(mean))
    assert got.rss == pytest.approx(rss) and got.n == len(rows) and got.n_coef == 3


def test_groups_subsets_and_windows_from_one_gram(spark):
    rows = rows_of()
    df = frame(spark, rows)
    models = {"all": COLS[:3], "one": ["a"]}
    by_group = {(r.g, r.model): r for r in LIN.fit(LIN.gram(df, COLS, ["g"], 2), COLS, ["g"], models).collect()}
    assert len(by_group) == 6
    for g in ("p", "q", "hot"):
        mine = [r for r in rows if r[0] == g]
        assert [by_group[g, "all"].intercept, *by_group[g, "all"].coef] == pytest.approx(list(reference(mine)[0]))
        beta = reference(mine, (2,))[0]
        assert [by_group[g, "one"].intercept, *by_group[g, "one"].coef] == pytest.approx([*beta, 0.0, 0.0])
    windows = LIN.fit(LIN.expanding(LIN.gram(df, COLS, ["t"], 2), "t"), COLS, ["t"]).collect()
    assert sorted(w.t for w in windows) == list(range(1992, 1998))
    for w in windows:
        assert [w.intercept, *w.coef] == pytest.approx(list(reference([r for r in rows if r[1] < w.t])[0]))


def test_columns_without_variation_or_news_are_left_out(spark):
    rows = [(*r[:2], r[2], 5.0, float(2 * r[2] + 1), r[5]) for r in rows_of(holes=False)]
    got = LIN.fit(LIN.gram(frame(spark, rows), COLS, scale=2), COLS).first()
    assert got.coef[1] == 0 and got.coef[2] == 0 and got.n_coef == 1
    assert [got.intercept, got.coef[0]] == pytest.approx(list(reference(rows, (2,))[0]))
    empty = LIN.fit(LIN.gram(frame(spark, rows).where("a < 0"), COLS, scale=2), COLS)
    assert empty.collect() == []
    nothing = [(*r[:3], None, None, r[5]) for r in rows]
    assert LIN.fit(LIN.gram(frame(spark, nothing), COLS, scale=2), COLS).first().coef[1:] == [0, 0]


def test_exact_sums_do_not_depend_on_partitions(spark):
    rows = rows_of(400)
    seen = {str(sorted(map(tuple, LIN.gram(frame(spark, rows, p), COLS, ["g"], 2).collect()))) for p in (1, 3, 7)}
    assert len(seen) == 1


def test_correlations(spark):
    rows = rows_of()
    got = {(r.x, r.y): r for r in LIN.correlations(LIN.gram(frame(spark, rows), COLS, scale=2), COLS).collect()}
    assert len(got) == 6
    both = [(r[3], r[4]) for r in rows if r[3] is not None and r[4] is not None]
    assert got["b", "c"].n == len(both) and got["b", "c"].corr == pytest.approx(np.corrcoef(np.array(both).T)[0, 1])
    flat = [(*r[:3], 2.5, None, r[5]) for r in rows]
    got = {(r.x, r.y): r.corr for r in LIN.correlations(LIN.gram(frame(spark, flat), COLS, scale=2), COLS).collect()}
    assert got["b", "y"] is None and got["c", "y"] is None and got["a", "y"] is not None


def test_plan_has_one_scan_and_no_python(spark):
    plan = LIN.fit(LIN.gram(spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet"), ["l_quantity", "l_tax", "l_extendedprice"]),
                   ["l_quantity", "l_tax", "l_extendedprice"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Python" not in plan and "SortAggregate" not in plan


def test_window_predictions_and_persistence(spark):
    rows = rows_of()
    pred = M.window_predictions(frame(spark, rows), COLS[:3], "y", "t", {"one": ["a"]}, {"same": {"a": 1.0}}, 2)
    out = pred.collect()
    assert len(out) == 2 * sum(r[1] >= 1992 for r in rows)
    for r in out[:50]:
        beta = reference([x for x in rows if x[1] < r.t], (2,))[0]
        assert r.prediction == pytest.approx(r.a if r.model == "same" else beta[0] + beta[1] * r.a)
    metrics = {(m.model, m.period): m for m in M.compare_models(pred, "y", "t").collect()}
    errors = [r.y - r.prediction for r in out if r.model == "one" and r.t == 1995]
    assert metrics["one", 1995].mae == pytest.approx(np.mean(np.abs(errors))) and metrics["one", 1995].n == len(errors)


def test_choose_model_prefers_the_plain_one_among_equals(spark):
    rmse = {"simple": [10.0, 10.2, 10.1], "rich": [9.9, 10.0, 10.1], "wild": [5.0, 25.0, 9.0]}
    df = spark.createDataFrame([(m, i, v) for m, vs in rmse.items() for i, v in enumerate(vs)], "model string, period int, rmse double")
    got = [(r.model, r.chosen) for r in M.choose_model(df, ["simple", "rich", "wild"]).orderBy("rank").collect()]
    assert got == [("simple", True), ("rich", False), ("wild", False)]
    got = [r.model for r in M.choose_model(df, ["simple", "rich"], tolerance=0.0).orderBy("rank").collect()]
    assert got[0] == "rich"


def test_winners_and_confusion(spark):
    rows = [(1, "A", 5, 9), (1, "B", 5, 1), (2, "A", 1, 7), (2, "B", 2, 7), (3, "B", 4, 4), (3, "C", 1, 5)]
    pairs = M.winners(spark.createDataFrame(rows, "k int, o string, v long, p long"), ["k"], "o", "v", "p")
    assert sorted(map(tuple, pairs.collect())) == [(1, "A", "A"), (2, "B", "A"), (3, "B", "C")]
    got = {(r.actual, r.predicted): (r.n, r.n_actual, r.micro_recall) for r in M.confusion(pairs).collect()}
    assert got == {("A", "A"): (1, 1, 1_000_000), ("B", "A"): (1, 2, 0), ("B", "C"): (1, 2, 0)}


def test_scenario_recursion_and_bands(spark):
    start = spark.createDataFrame([("x", "o1", 2000, 0.30), ("x", "o2", 2000, 0.05), ("z", "o1", 2000, 0.95)],
                                  "area string, opt string, yr long, s double")
    ind = spark.createDataFrame([("x", "u", 1998, 4.0), ("x", "u", 2000, 6.0), ("x", "w", 1999, 3.0)], "area string, code string, yr long, v double")
    model = {"coef": [0.5, 0.01, 0.02], "mean": [0.0, 5.0, 2.0], "intercept": 0.1, "rss": 0.9, "n": 103, "n_coef": 3}
    out = M.scenario_shares(start, ind, model, ["lag", "u", "w"], ["area", "opt"], "area", "s", "yr", "code", "v")
    got = {(r.area, r.opt, r.horizon, r.band): (r.period, r.s) for r in out.collect()}
    assert len(got) == 27
    s, s2 = 0.30, 0.9 / 99
    for h in (1, 2, 3):
        s = 0.1 + 0.5 * s + 0.01 * (6.0 + h) + 0.02 * 3.0  # one value: its mean
        width = 1.2816 * (s2 * sum(0.25 ** i for i in range(h))) ** 0.5
        assert got["x", "o1", h, "central"] == (2000 + h, pytest.approx(s))
        assert got["x", "o1", h, "low"][1] == pytest.approx(max(0.0, s - width))
        assert got["x", "o1", h, "high"][1] == pytest.approx(min(1.0, s + width))
    assert got["z", "o1", 1, "central"][1] == pytest.approx(0.1 + 0.475 + 0.05 + 0.04)  # no series: the training means
