import hashlib
import math
import random

import duckdb
import numpy as np
import pytest

from tallyframe.llm import vector_codes as vc
from tallyframe.llm.common import table

COLS = ("vec_id", "code", "error", "label_error", "codebooks_sha256")


def brute(rows, dims, entries=64, rounds=2):
    """op13 in plain Python: rows of (vec_id, vector, label)."""
    kept = [(i, [math.floor(256 * x) for x in v], lab) for i, v, lab in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = dims // 16
    cut = [[v[p * w:(p + 1) * w] for p in range(16)] for _, v, _ in kept]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(16)]

    def nearest(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(16):
            own = {}
            for c in cut:
                own.setdefault(nearest(c[p], books[p])[1], []).append(c[p])
            books[p] = [[sum(col) // len(own[e]) for col in zip(*own[e])] if e in own else books[p][e] for e in range(len(books[p]))]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out, totals = [], {}
    for (i, _, lab), c in zip(kept, cut):
        best = [nearest(c[p], books[p]) for p in range(16)]
        err = sum(d for d, _ in best)
        totals[lab] = totals.get(lab, 0) + err
        out.append((i, "".join(f"{e:02x}" for _, e in best), err, lab))
    return [(i, code, err, totals[lab], digest) for i, code, err, lab in out]


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    return [tuple(r[c] for c in COLS) for r in vc.op13(df.repartition(3)).collect()]


def test_whole_table_equals_sql_and_brute_force(spark):
    d = "/root/testdata/sf0.01"
    duckdb.sql(f"create or replace view embeddings as select * from '{d}/embeddings.parquet'")
    want = sorted(duckdb.sql(vc.oracle()).fetchall())
    got = sorted(tuple(r[c] for c in COLS) for r in vc.op13(table(spark, d, "embeddings")).collect())
    assert got == want
    rows = duckdb.sql("select vec_id, embedding, label from embeddings").fetchall()
    assert got == sorted(brute(rows, len(rows[0][1])))


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_copies_and_bad_rows(spark, seed):
    rnd = random.Random(seed)
    centres = [[rnd.gauss(0, 1) for _ in range(32)] for _ in range(7)]
    rows = [(i, [x + rnd.gauss(0, 0.02) for x in rnd.choice(centres)], rnd.choice([None, 1, 2])) for i in range(400)]
    rows += [(i, list(centres[0]), 1) for i in range(1000, 1100)]  # ties
    rows += [(2000, None, 1), (2001, [], 1), (2002, [None] * 32, 1), (2003, [math.nan] + [0.0] * 31, 2), (2004, [math.inf] + [0.0] * 31, 2),
             (2005, [0.0] * 16, 1), (None, [0.5] * 32, None), (7, [0.25] * 32, 3), (7, [0.25] * 32, 3), (3000, [200.0, -300.5] * 16, 9)]
    assert sorted(run(spark, rows), key=str) == sorted(brute(rows, 32), key=str)


def test_few_rows_and_none(spark):
    rows = [(5, [float(i) for i in range(16)], 1), (3, [-0.001] * 16, None)]
    assert sorted(run(spark, rows)) == sorted(brute(rows, 16))
    assert run(spark, []) == [] and run(spark, [(1, None, 2)]) == []
    with pytest.raises(ValueError, match="16 equal parts"):
        run(spark, [(1, [0.0] * 17, 1)])


def test_bounds_give_the_exact_entry_and_save_work():
    rng = np.random.default_rng(5)
    centres = rng.integers(-200, 200, (64, 4))
    x = centres[rng.integers(0, 64, 3000)] + rng.integers(-6, 7, (3000, 4))
    old = x[:64].copy()
    state, _ = vc.fresh(x, old, 4)
    saved = []
    for step in range(6):
        new = old + rng.integers(-3, 4, old.shape) if step else old + rng.integers(-40, 41, old.shape)
        state = vc.State(state.near, vc._down16(state.lower).astype(float), vc._down16(state.outer).astype(float))  # as persisted
        state, d, need = vc.moved(x, state, old, new)
        full = vc.distances(x, new)
        assert (state.near[:, 0] == full.argmin(axis=1)).all() and (d == full.min(axis=1)).all()
        true = np.sqrt(np.take_along_axis(full, state.near.astype(int), axis=1))
        assert (state.lower <= true + 1e-9).all()
        others = full.copy()
        np.put_along_axis(others, state.near.astype(int), 2 ** 40, axis=1)
        assert (state.outer <= np.sqrt(others.min(axis=1)) + 1e-9).all()
        saved.append((need == 1).mean())
        old = new
        if step == 3:
            state = vc.narrow(state, 2)
    assert saved[-1] > 0.5


def test_large_integers_stay_exact():
    rng = np.random.default_rng(1)
    x, e = rng.integers(-2 ** 25, 2 ** 25, (50, 4)), rng.integers(-2 ** 25, 2 ** 25, (64, 4))
    want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(r, c)) for c in e] for r in x]
    assert vc.distances(x, e).tolist() == want


def test_downward_rounding():
    x = np.concatenate([np.random.default_rng(2).uniform(-70_000, 70_000, 5000), [0.0, 1e-9, 65504.0, 65519.0, -1e9, 1e9]])
    assert (vc._down16(x).astype(float) <= np.maximum(x, -65504)).all()
