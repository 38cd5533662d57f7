import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline as P

from tallyframe.llm import decontaminate, near_dedup
from tallyframe.llm.common import table

SF = "/root/testdata/sf0.001"


def test_stages_take_effect_in_order(spark):
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_dedup", "decontaminate", "mix"]
    docs = start = table(spark, SF, "documents")
    left = [docs.count()]
    for name, stage in P.STAGES[:-1]:
        docs = P.materialize(stage(spark, docs, SF), name)
        assert docs.columns == start.columns
        left.append(docs.count())
    assert left[0] > left[1] >= left[2] >= left[3] > 0
    kept = docs.collect()
    cache = near_dedup.WordHash()
    syms = [near_dedup.symbols(near_dedup.words(r.text), cache) for r in kept]
    assert not any(near_dedup.similarity_at_least(a, b) for i, a in enumerate(syms) for b in syms[:i] if len(a) and len(b))
    items = [(r.item_id, near_dedup.words(r.text)) for r in table(spark, SF, "benchmark").collect()]
    whole = [" ".join(near_dedup.words(r.text)) for r in kept]
    assert not any(" ".join(ws) in t for _, ws in items for t in whole)
    assert decontaminate.op5(docs, table(spark, SF, "benchmark")).where("contaminated").count() == 0


def test_run_gives_the_mix(spark):
    rows = P.run(spark, SF).collect()
    assert rows and {"doc_id", "epoch", "take_tokens"} <= set(rows[0].asDict())


def test_edge_rows_in_every_stage(spark):
    """Nulls in any column, empty and very long texts, repeated rows, columns with the operators' own names, an empty table."""
    from pyspark.sql import functions as F

    docs = table(spark, SF, "documents")
    more = ["_score string", "_row int", "text_ string", "_kept string", "_items string", "_class long"]
    types = {f.name: f.dataType.simpleString() for f in docs.schema.fields}
    schema = ", ".join(f"{c} {t}" for c, t in types.items()) + ", " + ", ".join(more)
    extra = ("s", 1, "t", "k", "i", 5)
    rows = [dict(doc_id=None, text=None), dict(doc_id=10 ** 9, text=""), dict(doc_id=10 ** 9 + 1, text=None), dict(doc_id=10 ** 9 + 2, text="lone clean words " * 40_000),
            dict(doc_id=10 ** 9 + 3, text="a repeated row of a few words only"), dict(doc_id=10 ** 9 + 3, text="a repeated row of a few words only")]
    odd = spark.createDataFrame([tuple(r.get(c) for c in types) + extra for r in rows], schema)
    names = [x.split()[0] for x in more]
    both = docs.limit(60).select("*", *[F.lit(None).cast(odd.schema[n].dataType).alias(n) for n in names]).unionByName(odd)
    got = both
    for name, stage in P.STAGES[:-1]:
        got = P.materialize(stage(spark, got, SF), name)
        assert got.columns == both.columns
    kept = [(r.doc_id, r.text, r._row) for r in got.where("_row = 1").collect()]
    assert sum(not t for _, t, _ in kept) <= 1  # one of all texts without words, here or among the others
    assert [i for i, t, _ in kept if t and "lone" in t] == [10 ** 9 + 2] and [i for i, t, _ in kept if t and "repeated" in t] == [10 ** 9 + 3]
    assert P.STAGES[-1][1](spark, got, SF).count() > 0
    empty = both.limit(0)
    for _, stage in P.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_near_dedup_stage_holds_no_shuffle_files_of_its_steps(spark):
    """What the steps of the second stage have shuffled is gone when the stage's result is about to be written."""
    import time

    def files():
        names = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
        return {f for f in names if "/shuffle_" in f}

    docs = table(spark, SF, "documents")
    before = files()
    kept = P.drop_near_duplicates(spark, docs, SF)
    until = time.time() + 20
    while files() - before and time.time() < until:
        time.sleep(0.2)
    assert not files() - before
    assert 0 < kept.count() < docs.count()
