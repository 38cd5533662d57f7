import random

import numpy as np
import pytest

from tallyframe.llm import decontaminate as X

ITEMS = "item_id long, text string, extra string"
DOCS = "doc_id long, text string, _items string"


def distance(item, text):
    """Fewest word edits between the item and any stretch of the text."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for t in text:
        new = [0]
        for i, x in enumerate(item):
            new.append(min(row[i] + (x != t), row[i + 1] + 1, new[i] + 1))
        row = new
        best = min(best, row[-1])
    return best


def test_exact_check_equals_plain_dynamic_programming():
    rng = random.Random(0)
    for _ in range(300):
        a = [rng.randrange(4) for _ in range(rng.randrange(1, 9))]
        b = [rng.randrange(4) for _ in range(rng.randrange(0, 12))]
        for k in range(4):
            assert X.within(np.array(a), np.array(b), k) == (min(distance(a, b), len(a)) <= k) or not b


def make(seed=1):
    rng = random.Random(seed)
    common, rare = [f"f{i}" for i in range(12)], [f"r{i}" for i in range(4000)]
    word = lambda: rng.choice(common) if rng.random() < 0.5 else rng.choice(rare)
    items = [[word() for _ in range(rng.randrange(15, 60))] for _ in range(60)]
    docs = []
    for i in range(240):
        ws = list(items[rng.randrange(60)]) if i % 2 else []
        for _ in range(int(len(ws) * 0.2 * (i % 7) / 6)):
            k = rng.randrange(len(ws))
            ws[k:k + rng.randrange(2)] = [rng.choice(rare)] * rng.randrange(2)
        docs.append([word() for _ in range(rng.randrange(0, 150))] + ws + [word() for _ in range(rng.randrange(0, 150))])
    return items, docs


def test_recall_and_precision_against_brute_force(spark):
    items, docs = make()
    want = {(i, k) for i, d in enumerate(docs) for k, it in enumerate(items) if distance(it, d) <= X.limit_of(len(it))}
    got = X.op5(spark.createDataFrame([(i, " ".join(d).upper(), "x") for i, d in enumerate(docs)], DOCS).repartition(3),
                spark.createDataFrame([(k, " ".join(it), "") for k, it in enumerate(items)], ITEMS)).collect()
    have = {(r.doc_id, k) for r in got for k in r.item_ids}
    assert have <= want and len(have) >= 0.97 * len(want) and len(want) > 100
    assert all(r.contaminated == bool(r.item_ids) for r in got) and len(got) == len(docs)


def test_blocks_of_items_give_the_same(spark):
    items, docs = make(2)
    d = spark.createDataFrame([(i, " ".join(x), "") for i, x in enumerate(docs)], DOCS)
    b = spark.createDataFrame([(k, " ".join(it), "") for k, it in enumerate(items)], ITEMS)
    one = {r._row.doc_id: r._items for r in X.find_items(d, b).collect()}
    many = {r._row.doc_id: r._items for r in X.find_items(d, b, block=20).collect()}
    assert one == many  # bits are hashes of walk, step and word


def test_edges(spark):
    text = " ".join(f"q{i}" for i in range(30))
    d = spark.createDataFrame([(1, None, ""), (2, "", ""), (3, f"x {text}. y", ""), (3, f"x {text}. y", ""), (None, text, ""), (4, "short", ""),
                               (5, "w " * 50_000 + text, "")], DOCS)
    b = spark.createDataFrame([(1, text, ""), (2, text, ""), (None, "short", ""), (7, None, ""), (8, "", ""), (9, "Short!", "")], ITEMS)
    got = [(r.doc_id, r.contaminated, r.item_ids) for r in X.op5(d, b).collect()]
    assert sorted(got, key=str) == sorted([(1, False, []), (2, False, []), (3, True, [1, 2]), (3, True, [1, 2]), (None, True, [1, 2]),
                                           (4, True, [9]), (5, True, [1, 2])], key=str)
    assert {r.contaminated for r in X.op5(d, b.limit(0)).collect()} == {False} and X.op5(d.limit(0), b).count() == 0
    assert X.find_items(d, b).select("_row.*").columns == d.columns


def test_passages_at_both_ends_and_documents_shorter_than_the_item():
    rng = random.Random(4)
    other = [f"z{i}" for i in range(70)]
    for n in (20, 40):
        items = [[f"w{rng.randrange(9000)}" for _ in range(n)] for _ in range(100)]
        index = X.Index(list(enumerate(items)))
        for deleted in (int(0.12 * n), X.limit_of(n)):
            cut = [[w for k, w in enumerate(it) if k not in gone] for it in items for gone in [set(rng.sample(range(n), deleted))]]
            for place in ([ws for ws in cut], [other + ws for ws in cut], [ws + other for ws in cut]):
                found = index.find(*index.look_up(place))
                assert sum(i in f for i, f in enumerate(found)) >= 95
    # one word too few is no match
    assert index.find(*index.look_up([it[X.limit_of(40) + 1:] for it in items])) == [[] for _ in items]


@pytest.mark.parametrize("n", [20, 60, 120, 200, 500])
def test_recall_at_the_limit_for_items_of_any_length(n):
    rng = random.Random(n)
    items = [[f"w{rng.randrange(9000)}" for _ in range(n)] for _ in range(40)]
    index, other = X.Index(list(enumerate(items))), [f"z{i}" for i in range(70)]
    for substitute in (False, True):
        docs = []
        for it in items:
            gone = set(rng.sample(range(n), X.limit_of(n)))
            docs.append(other + [f"q{rng.randrange(10 ** 6)}" if k in gone else w for k, w in enumerate(it) if substitute or k not in gone] + other)
        found = index.find(*index.look_up(docs))
        assert sum(i in f for i, f in enumerate(found)) >= 0.95 * len(items)
        assert all(set(f) <= {i} for i, f in enumerate(found))


def test_answers_do_not_depend_on_the_other_items():
    rng = random.Random(9)
    items = [[f"w{rng.randrange(3000)}" for _ in range(59)] for _ in range(80)]
    docs = [[w for k, w in enumerate(it) if k not in gone] for it in items for gone in [set(rng.sample(range(59), 11))]]
    one = X.Index(list(enumerate(items)))
    together = one.find(*one.look_up(docs))
    apart: list[set] = [set() for _ in docs]
    for b in range(8):
        part = X.Index([(i, it) for i, it in enumerate(items) if i % 8 == b])
        for d, f in enumerate(part.find(*part.look_up(docs))):
            apart[d] |= set(f)
    assert [set(f) for f in together] == apart


def test_pieces_cover_the_item():
    for n in range(1, 200):
        parts = X.cut(n)
        assert parts[0][0] == 0 and parts[-1][1] == n and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
        assert all(b - a < 2 * X.PIECE and (len(parts) == 1 or b - a >= X.PIECE) for a, b in parts)


def test_very_long_item():
    rng = random.Random(2)
    item = [f"w{rng.randrange(5000)}" for _ in range(10_000)]
    index = X.Index([(7, item)])
    gone = set(rng.sample(range(10_000), 1_500))
    assert index.find(*index.look_up([["z"] * 50 + [w for k, w in enumerate(item) if k not in gone], item[:7_000]])) == [[7], []]
