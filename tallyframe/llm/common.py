"""Helpers shared by the training-data operators.

Intermediate tables go to the folder in ``spark.checkpoint.dir`` (shared by the
driver and all executors); a folder of our own is used only where that setting
is empty, and only on a local master.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The shared folder of this session, without a trailing slash."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = "file://" + tempfile.mkdtemp(prefix="tallyframe-llm-")
    return _LOCAL["dir"]


def scratch_path(spark: SparkSession, tag: str) -> str:
    return f"{shared_dir(spark)}/llm-{tag}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of the actions inside go when the action ends, not when the driver happens to collect its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (cuts lineage; survives lost executors)."""
    path = scratch_path(df.sparkSession, tag)
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold_of(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 5 (null ids count as the empty text)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")) % 5


def connected_components(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(v, component) with the smallest vertex of each component.

    ``vertices``: column v (distinct); ``edges``: columns a, b.  Each round takes
    the smallest label among the neighbours and then jumps to the label's own
    label, so that long chains halve; stops when no label changes.  All state
    stays in tables in the shared folder.
    """
    both = materialize(
        edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        .where("a <> b").distinct(), "edges")
    labels = materialize(
        both.groupBy(F.col("a").alias("v")).agg(F.min("b").alias("m"))
        .select("v", F.least("v", "m").alias("component")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("v", "b"), "b")
                .groupBy(F.col("a").alias("v")).agg(F.min("component").alias("m")))
        step = (labels.join(near, "v", "left")
                .select("v", F.col("component").alias("old"),
                        F.least("component", "m").alias("component")))
        up = labels.select(F.col("v").alias("component"), F.col("component").alias("up"))
        new = materialize(
            step.join(up, "component", "left")
            .select("v", "old", F.least("component", "up").alias("component")), "labels")
        with shuffles_dropped(new.sparkSession):
            if new.where("old <> component").limit(1).count() == 0:
                break
        labels = new.drop("old")
    return (vertices.join(labels, "v", "left")
            .select("v", F.coalesce("component", "v").alias("component")))
