import numpy as np

from tallyframe.llm import vector_dedup as X

SCHEMA = "vec_id long, embedding array<float>, label int, n_links string"


def brute(rows):
    """vec_id -> (n_links, component_id) by comparing all pairs."""
    ok, n = [], {}
    for i, e, lab, _ in rows:
        n[i] = 0
        if lab is not None and e and all(x is not None and np.isfinite(x) for x in e) and any(e):
            v = np.array(e, dtype="float32").astype("float64")
            ok.append((i, v / np.linalg.norm(v), lab))
    root = {i: i for i in n}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, v, a) in enumerate(ok):
        for j, w, b in ok[:k]:
            if a == b and len(v) == len(w) and v @ w >= 0.93:
                n[i] += 1
                n[j] += 1
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i: (n[i], find(i)) for i in n}


def check(spark, rows):
    got = {r.vec_id: (r.n_links, r.component_id) for r in X.op9(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    want = brute(rows)
    return got, want


def test_random_groups_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(1500):
        if i % 3 == 0 and i:  # a third of all rows are near copies of one vector
            e = rows[0][1] + rng.normal(0, 0.02, 32)
        elif i % 11 == 0 and i > 6:
            e = rows[max(0, len(rows) - 7)][1] + rng.normal(0, 0.04, 32)
        else:
            e = rng.normal(0, 1, 32)
            e /= np.linalg.norm(e)
        rows.append((i, np.asarray(e), 0 if i % 3 == 0 else i % 2, "x"))
    rows = [(i, [float(x) for x in e.astype("float32")], lab, x) for i, e, lab, x in rows]
    got, want = check(spark, rows)
    found, true = sum(n for n, _ in got.values()), sum(n for n, _ in want.values())
    assert 0.99 * true <= found <= true and true > 100_000
    assert np.mean([got[i][1] == want[i][1] for i in want]) > 0.99


def test_edges(spark):
    a, nan, inf = [1.0, 0.0, 0.5], float("nan"), float("inf")
    rows = [(1, a, 1, ""), (2, a, 1, ""), (3, [2.0, 0.0, 1.0], 1, ""), (4, a, 2, ""), (5, a, None, ""), (6, None, 1, ""),
            (7, [0.0, 0.0, 0.0], 1, ""), (8, [nan, 0.0, 0.5], 1, ""), (9, [inf, 0.0, 0.0], 1, ""), (10, [], 1, ""),
            (11, [1.0, None, 0.5], 1, ""), (12, [1.0, 0.0], 1, "")]
    got, want = check(spark, rows)
    assert got == want and got[1] == (2, 1) and got[3] == (2, 1) and got[4] == (0, 4)
    df = spark.createDataFrame(rows[:3] + rows[:1] + [(None, None, 1, "")], SCHEMA)
    out = sorted(((r.vec_id or -1), r.n_links, r.kept) for r in X.op9(df).collect())
    assert out == [(-1, 0, True), (1, 3, True), (1, 3, True), (2, 3, False), (3, 3, False)]
    assert X.op9(df.limit(0)).count() == 0


def test_table_recall(spark):
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    found = X.materialize(X.op9(e), "test")
    assert X.audit_recall(e, found) >= 0.99 and found.count() == e.count()


def test_isolated_pairs_in_hundreds_of_shards(spark, monkeypatch):
    monkeypatch.setattr(X, "SHARD", 16)  # about 375 centres in one label
    rng = np.random.default_rng(9)
    a, b = rng.normal(0, 1, (2, 3000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    b -= (a * b).sum(axis=1)[:, None] * a
    b /= np.linalg.norm(b, axis=1)[:, None]
    both = np.stack([a, 0.935 * a + np.sqrt(1 - 0.935 ** 2) * b], axis=1).reshape(-1, 64)
    df = spark.createDataFrame([(i, [float(x) for x in e], 1, "") for i, e in enumerate(both)], SCHEMA).repartition(4)
    got = {r.vec_id: r.n_links for r in X.op9(df).collect()}
    assert sum(got.values()) >= 0.98 * len(both) and max(got.values()) == 1
    assert sum(got[i] != got[i + 1] for i in range(0, len(both), 2)) <= 0.005 * len(both)  # a link counts for both ends
