"""Corpus pipeline: toxicity, near-duplicates, benchmark passages, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result to the shared folder and reads it again for the next one.
The first three stages return the columns of ``documents``; the last returns
the mix: one row per document and epoch with the tokens to take.

Edge cases, the same in every stage: null and empty texts are clean and kept (all of them are one near-duplicate class, of
which one row stays); rows with a null id are rows like others; repeated rows are judged alike, and one of them
stays behind the near-duplicates; very long texts are judged whole; other columns of ``docs`` are carried through the first
three stages, whatever their names; an empty table gives an empty result; without toxic labels nothing is rejected, without
benchmark items nothing is a leak.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyframe.llm import decontaminate, mixing, near_dedup, toxicity
from tallyframe.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents with a toxicity score under 0.5 (trained on ``labels``)."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("_score < 0.5").select("_row.*")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate class, that with the smallest id."""
    return near_dedup.classes(docs).where("_kept").select("_row.*")


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents without a passage of ``benchmark``."""
    found = decontaminate.find_items(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("_items") == 0).select("_row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows of the target mix over what the stages before have kept."""
    return mixing.select(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("decontaminate", drop_benchmark_leaks),
    ("mix", mix_sources),
]

#: Scores, alignments and LSH can't be written in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
