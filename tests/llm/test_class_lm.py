import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd

from tallyframe.llm import class_lm as X

SCHEMA = "doc_id long, text string, h string"


def toks(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall("[^\x20\x09-\x0d]+", low), None]


def fold(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 5


def brute(rows):
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score) by the formula."""
    c = Counter(t for i, x, _ in rows if fold(i) != 1 for t in toks(x))
    n, v = c.total(), len(c)
    out = []
    for i, x, _ in rows:
        ts = toks(x)
        out.append((i, fold(i) == 1, len(ts), sum(t in c for t in ts), n,
                    sum(math.log10((c[t] + 0.5) / (n + 0.5 * (v + 1))) for t in ts)))
    return out


def compare(spark, rows):
    got = X.op8(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(brute(rows), key=key), strict=True):
        assert g[:5] == w[:5] and abs(g[5] - w[5]) < 1e-6 * max(1, abs(w[5]))
        assert math.isfinite(g[6])
    return got


def corpus(n=400):
    rng = np.random.default_rng(5)
    langs = [[f"{a}{i}" for i in range(300)] for a in "xyz"]
    p = 1 / np.arange(1, 301)
    rows = []
    for i in range(n):
        lang = langs[i % 3]
        rows.append((i, " ".join(rng.choice(lang, size=rng.integers(5, 80), p=p / p.sum())), ""))
    return rows


def test_base_numbers_and_better_score(spark):
    got = compare(spark, corpus())
    held = [r for r in got if r.held_out]
    assert len(held) > 40 and sum(r.score for r in held) > sum(r.base_score for r in held)
    # knowing the language alone is worth log10(3) a word; classes must find most of it
    known = sum(r.n_known for r in held)
    assert sum(r.score - r.base_score for r in held) > 0.3 * known


def test_edges(spark):
    rows = [(1, None, ""), (2, "", ""), (3, " \t\n", ""), (4, "A a É é  b", ""), (4, "A a É é  b", ""), (None, "x y", ""),
            (7, "w " * 30_000, ""), (8, "nb sp \x0bv\x1cw", ""), (9, "\x00 q", "")]
    compare(spark, rows)
    assert X.op8(spark.createDataFrame(rows[:0], SCHEMA)).count() == 0


def test_no_training_rows(spark):
    held = [i for i in range(60) if fold(i) == 1][:3]
    got = compare(spark, [(i, "a b", "") for i in held])
    assert all(r.n_known == 0 and r.train_tokens == 0 for r in got)


def test_probabilities_sum_to_one():
    rng = np.random.default_rng(0)
    p = X.transitions(rng.integers(0, 5, (6, 6)).astype(float))
    assert np.allclose(p.sum(axis=1), 1) and (p > 0).all()


def test_exchange_finds_planted_classes():
    rng = np.random.default_rng(1)
    n = np.zeros((24, 24))
    for a in range(24):
        for b in range(24):
            n[a, b] = rng.poisson(40 if (a % 4 + 1) % 4 == b % 4 else 1)
    cls = X.exchange(n, classes=4)
    assert all(len({cls[w] for w in range(24) if w % 4 == r}) == 1 for r in range(4)) and len(set(cls)) == 4


def test_class_of_a_word_comes_from_all_blocks():
    """One block with three contexts of one kind, three with two of another kind each."""
    trans = np.full((X.CLASSES, X.CLASSES), 0.01)
    trans[0, 1] = trans[1, 0] = trans[2, 3] = trans[3, 2] = 0.7
    words = [b"a", b"b", b"c", b"d", X.END]
    seeds, cls = np.array([X.hash_of(w) for w in words]), np.array([0, 1, 2, 3, 4])
    texts = [(0, "a new a new a new a")] + [(i, "c new c new c") for i in (1, 2, 3)]
    docs = pd.DataFrame([(b, t, False) for b, t in texts], columns=["block", "text", "held_out"])
    found = pd.concat(X._evidence(seeds, cls)(iter([docs]))).sort_values(["h", "block"])
    for size in (1, 2, 100):
        parts = [found.iloc[i:i + size][["h", "c", "e"]] for i in range(0, len(found), size)]
        got = {r.h: (r.c, r.k) for r in pd.concat(X._decide(trans)(iter(parts))).itertuples()}
        assert got[X.hash_of(b"new")] == (9, 3) and got[X.hash_of(b"c")] == (9, 2) and len(got) == 4
    many = pd.DataFrame([(0, "a new " * 500 + "a", False), (1, "c new " * 20 + "c", False)], columns=docs.columns)
    got = pd.concat(X._decide(trans)(iter([pd.concat(X._evidence(seeds, cls)(iter([many]))).sort_values("h")])))
    assert got.set_index("h")["k"][X.hash_of(b"new")] == 1 and got.set_index("h")["c"][X.hash_of(b"new")] == 520


def test_every_frequent_word_is_clustered_however_documents_are_batched(spark, monkeypatch):
    """A word that just misses a share of 1/1000 in a large batch, exceeds it in a small one, and exceeds it in all."""
    ids = [i for i in range(60) if fold(i) != 1]
    texts = [" ".join(["often"] * 19 + [f"a{i}" for i in range(19_980)]), " ".join(["often"] * 3 + [f"b{i}" for i in range(996)])]
    rows = [(i, t, "") for i, t in zip(ids, texts)]
    c = Counter(X.hash_of(w) for t in texts for w in X.tokens(t))
    seen, bigrams = [], X._bigrams
    monkeypatch.setattr(X, "_bigrams", lambda seeds: seen.append(seeds) or bigrams(seeds))
    key, found = "spark.sql.execution.arrow.maxRecordsPerBatch", []
    for batch in ("1", "10000"):
        old = spark.conf.get(key)
        spark.conf.set(key, batch)
        try:
            found.append({r.doc_id: r.score for r in X.op8(spark.createDataFrame(rows, SCHEMA).coalesce(1)).collect()})
        finally:
            spark.conf.set(key, old)
    for seeds in seen:
        assert {h for h, n in c.items() if n * X.SEED_SHARE >= c.total()} <= set(seeds.tolist())
        assert set(seeds.tolist()) == {h for h, n in c.items() if n * 2 * X.SEED_SHARE >= c.total()} | {X.hash_of(X.END)}
    assert all(abs(f[i] - found[0][i]) < 1e-6 * abs(f[i]) for f in found for i in f)
