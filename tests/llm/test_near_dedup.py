import random
from difflib import SequenceMatcher

import numpy as np

from tallyframe.llm import near_dedup as X

SCHEMA = "doc_id long, text string, _key string, v string"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        old = 0
        for j, y in enumerate(b):
            old, row[j + 1] = row[j + 1], old + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_banded_alignment_equals_full_alignment():
    rng, cache = random.Random(2), X.WordHash()
    for _ in range(150):
        a = [rng.choice("abcdefghij") + rng.choice("xyz") for _ in range(rng.randrange(1, 60))]
        b = list(a)
        for _ in range(rng.randrange(4)):
            k = rng.randrange(len(b))
            b[k:k + rng.randrange(2)] = [rng.choice("qrs")] * rng.randrange(2)
            b = b or ["q"]
        if rng.random() < 0.2:
            b = b[len(b) // 2:] + b[:len(b) // 2]
        s, t = X.symbols(a, cache), X.symbols(b, cache)
        m = lcs(s.tolist(), t.tolist())
        assert len(set(s.tolist())) == len(s)
        assert X.similarity_at_least(s, t) == (m / (len(s) + len(t) - m) >= X.THRESHOLD - 1e-12)


def corpus():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    base = " ".join(rng.choice(words) for _ in range(60))
    passage = " ".join(rng.choice(words) for _ in range(55))
    rows = []
    for i in range(90):  # a third: near copies of one text, each with its own word
        ws = base.split()
        ws[rng.randrange(4) * (len(ws) - 1) // 3] = f"own{i}"
        rows.append(" ".join(ws))
    rows += [base] * 20 + [base.upper().replace(" ", "\n")]
    rows += [" ".join(rng.choice(words) for _ in range(30)) + " " + passage + f" t{i}" for i in range(60)]  # a shared passage
    rows += [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 120))) for _ in range(60)]
    chain = [rng.choice(words) for _ in range(100)]
    for i in range(6):  # a chain: neighbours link, ends don't
        rows.append(" ".join(chain))
        chain = chain[3:] + [rng.choice(words) for _ in range(3)]
    rows += [" ".join(base.split()[30:] + base.split()[:30])]  # same words, other order
    return rows


def brute(rows):
    """Smallest index of each row's class, from all pairs."""
    cache, root = X.WordHash(), list(range(len(rows)))
    syms = [X.symbols(X.words(t), cache).tolist() for t in rows]

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = syms[i], syms[j]
            if not a and not b:
                link = (rows[i] or "") == (rows[j] or "")
            else:
                both = len(set(a) & set(b))
                link = bool(both) and both / (len(a) + len(b) - both) >= X.THRESHOLD and (
                    lambda m: m / (len(a) + len(b) - m) >= X.THRESHOLD)(lcs(a, b))
            if link:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(rows))]


def test_classes_equal_brute_force(spark):
    rows = corpus() + [None, "", "", "one two", "One, two!", "%%%", "%%%", "long " * 20_000]
    want = brute(rows)
    df = spark.createDataFrame([(i, t, "k", None) for i, t in enumerate(rows)], SCHEMA).repartition(4)
    got = {r.doc_id: r for r in X.op4(df).collect()}
    assert [got[i].class_id for i in range(len(rows))] == want
    assert all(got[i].kept == (i == want[i]) for i in range(len(rows)))


def test_rows_null_ids_and_other_columns(spark):
    t = "a b c d e f g h i j"
    df = spark.createDataFrame([(None, t, "k1", "p"), (None, t, "k2", "q"), (5, t, "k3", "r"), (5, t, "k3", "r"), (None, "other text", None, None)], SCHEMA)
    out = X.classes(df)
    kept = out.where("_kept").select("_row.*").collect()
    assert len(kept) == 2 and {r.doc_id for r in kept} == {5, None}
    assert out.select("_row.*").columns == df.columns and out.count() == 5
    assert X.op4(df.limit(0)).count() == 0


def test_order_counts():
    """Order MinHash tells apart texts with equal shingle sets in another order."""
    cache = X.WordHash()
    a = [f"w{i}" for i in range(200)]
    b = a[100:] + a[:100]
    s, t = X.symbols(a, cache), X.symbols(b, cache)
    assert len(set(s.tolist()) & set(t.tolist())) / len(set(s.tolist()) | set(t.tolist())) > 0.9
    same = sum(x == y for x, y in zip(X.sketches(s), X.sketches(t)))
    assert same < X.SKETCHES / 2 and not X.similarity_at_least(s, t)
    assert SequenceMatcher(None, a, b).ratio() < 0.6
    assert np.array_equal(X.symbols([], cache), np.empty(0, "uint64")) and X.sketches(X.symbols([], cache)) == []


def test_no_link_of_short_texts_is_lost():
    """Every pair at the threshold whose shorter text has up to 20 shingles shares a bucket."""
    rng = random.Random(6)
    cache = X.WordHash()

    def keys(ws):
        values = X.sketches(X.symbols(ws, cache))
        return {(min(i, X.SKETCHES), v) for i, v in enumerate(values)}

    for i in range(6000):
        n = rng.randrange(4, 21) if i % 2 else 4
        more = n // 4  # n of n + more shingles are shared
        ws = [f"w{rng.randrange(10 ** 6)}" for _ in range(n + 4)]
        longer = ws + [f"w{rng.randrange(10 ** 6)}" for _ in range(more)]
        assert X.similarity_at_least(X.symbols(ws, cache), X.symbols(longer, cache))
        assert keys(ws) & keys(longer)


def test_texts_go_only_to_blocks_that_they_meet(spark, monkeypatch):
    """A long chain of texts that meet but don't link: a text is copied for the blocks of its neighbours, not for all blocks of the chain."""
    rng = random.Random(8)
    words = [f"w{rng.randrange(10 ** 9)}" for _ in range(16 * 300 + 100)]
    rows = [" ".join(words[16 * i:16 * i + 100]) for i in range(300)]  # neighbours share 80 of 112 shingles; those 7 apart share none
    df = spark.createDataFrame([(i, t, "k", None) for i, t in enumerate(rows)], SCHEMA).repartition(4)
    sent, write = [], X.materialize

    def sizes(key, pdf):
        return pdf.assign(a=len(pdf), b=pdf["v"]).loc[:, ["a", "b"]].head(1)

    def kept(d, tag):
        out = write(d, tag)
        if tag == "omh-rest":
            sent.append(out.agg({"a": "sum"}).first()[0])
        return out

    monkeypatch.setattr(X, "BLOCK", 4)
    assert all(r.kept for r in X.op4(df).collect())
    monkeypatch.setattr(X, "materialize", kept)
    monkeypatch.setattr(X, "_compare", sizes)
    X.op4(df)
    assert 300 <= sent[0] <= 300 * 13  # up to 6 neighbours on each side, and its own block


def test_classes_in_small_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(X, "BLOCK", 4)
    rows = corpus()
    df = spark.createDataFrame([(i, t, "k", None) for i, t in enumerate(rows)], SCHEMA).repartition(4)
    got = {r.doc_id: r.class_id for r in X.op4(df).collect()}
    assert [got[i] for i in range(len(rows))] == brute(rows)


def test_lengths_of_linked_texts_are_in_neighbouring_classes():
    for n in [*range(1, 5000), 10 ** 6, 10 ** 9]:
        longest = int(n / X.THRESHOLD + 1e-9)
        assert X.length_class(longest) - X.length_class(n) in (0, 1)
