"""Incremental results load: the periodic re-run as a Structured Streaming job with keyed replace.

New order files are picked up by a file stream (``trigger(availableNow=True)``: process what is there, then
stop; no catch-up loop).  An order that comes again, or comes corrected, replaces what it counted before: the last
version of every order is kept as state, in buckets of order keys.

Layout under ``target``: ``orders/batch_id=N/bucket=B`` holds all orders of bucket B after batch N with their counts by
option, ``counts/batch_id=N/bucket=B`` the bucket's sums by (year, area, option), ``commits/batch_id=N`` the buckets that batch N replaced.
A batch reads the latest versions before its own of the buckets that it touches, puts its orders in place of the old ones,
and writes these buckets anew; others are neither read nor written.  The commit is written last: without it, nothing of a batch is seen.

Replay: batch N reads only versions below N and overwrites only its own folders, so running it again gives the same
table.  ``compact`` runs at the start of batch N and deletes versions that another version below N supersedes; those are
what neither batch N, nor a replay of it, nor a reader of the state needs.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Order keys of a bucket: what one task rewrites.
BUCKET_KEYS = 1 << 20
_COUNTS = ("eligible", "cast_n", "votes")


def _bucket(key: str):
    return F.floor(F.col(key) / BUCKET_KEYS).cast("bigint")


def _last_versions(batch: DataFrame) -> DataFrame:
    """One row per order: the one of the newest file (then the last path)."""
    w = Window.partitionBy("o_orderkey").orderBy(F.col("__time").desc(), F.col("__path").desc(), *[F.col(c).desc() for c in batch.columns])
    return batch.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", "__time", "__path")


def _order_counts(orders: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    """(o_orderkey, bucket, yr, geo, opt, counts) of the given orders, one row per option; one with null counts
    for an order without line items, so that it still replaces an older version."""
    from ..plans import proxy as P

    li = P.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    part = P.table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    cust = P.table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    o = orders.select("o_orderkey", "o_custkey", "o_orderstatus", F.year("o_orderdate").cast("bigint").alias("yr"))
    # the batch's key range reaches the scan: row groups of other orders are not read
    lo, hi = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    lines = li.where(F.col("l_orderkey").between(lo, hi)).join(part, F.col("l_partkey") == F.col("p_partkey"))
    rows = (o.join(cust, o.o_custkey == cust.c_custkey, "left").join(lines, o.o_orderkey == lines.l_orderkey, "left"))
    q = F.col("l_quantity").cast("bigint")
    return rows.groupBy("o_orderkey", _bucket("o_orderkey").alias("bucket"), "yr", F.col("c_nationkey").cast("bigint").alias("geo"),
                        F.col("p_brand").alias("opt")).agg(
        F.sum(q).alias("eligible"),
        F.sum(F.when(F.col("o_orderstatus") != "P", q).otherwise(0)).alias("cast_n"),
        F.sum(F.when(F.col("o_orderstatus") == "F", q).otherwise(0)).alias("votes"))


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def _versions(spark: SparkSession, target: str, before: int | None = None) -> list[tuple[int, int]]:
    """(bucket, batch_id) of every committed version (below `before`); a few numbers per bucket."""
    if not _exists(spark, f"{target}/commits"):
        return []
    rows = spark.read.schema("bucket long, batch_id long").parquet(f"{target}/commits")
    if before is not None:
        rows = rows.where(F.col("batch_id") < before)
    return [(r.bucket, r.batch_id) for r in rows.collect()]


def _latest(versions: Sequence[tuple[int, int]]) -> dict[int, int]:
    return {b: max(n for x, n in versions if x == b) for b in {x for x, _ in versions}}


def _read(spark: SparkSession, target: str, table: str, latest: dict[int, int]) -> DataFrame | None:
    paths = [f"{target}/{table}/batch_id={n}/bucket={b}" for b, n in sorted(latest.items())]
    return spark.read.option("basePath", f"{target}/{table}").parquet(*paths) if paths else None


def compact(spark: SparkSession, target: str, before: int) -> int:
    """Delete the versions that a committed version below `before` supersedes; returns how many."""
    versions = _versions(spark, target, before)
    latest, gone = _latest(versions), 0
    for bucket, n in versions:
        if n < latest[bucket]:
            for table in ("orders", "counts"):
                p = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/{table}/batch_id={n}/bucket={bucket}")
                gone += bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))
    return gone


def replace_batch(batch: DataFrame, batch_id: int, sf_dir: str, target: str) -> None:
    """Put a batch of orders (with __time and __path of their files) in place of their older versions."""
    spark = batch.sparkSession
    if batch.isEmpty():
        return
    compact(spark, target, batch_id)
    fresh = _order_counts(_last_versions(batch), spark, sf_dir)
    touched = {r.bucket for r in batch.select(_bucket("o_orderkey").alias("bucket")).distinct().collect()}  # bounded by the buckets
    latest = {b: n for b, n in _latest(_versions(spark, target, batch_id)).items() if b in touched}
    old = _read(spark, target, "orders", latest)
    state = fresh
    if old is not None:
        kept = old.drop("batch_id").join(batch.select("o_orderkey").distinct(), "o_orderkey", "left_anti")
        state = kept.withColumn("bucket", F.col("bucket").cast("bigint")).unionByName(fresh)
    folder = f"batch_id={batch_id}"
    state.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/orders/{folder}")
    written = _read(spark, target, "orders", {b: batch_id for b in touched})
    sums = written.groupBy("bucket", "yr", "geo", "opt").agg(*[F.sum(c).alias(c) for c in _COUNTS])
    sums.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/counts/{folder}")
    spark.createDataFrame([(b,) for b in sorted(touched)], "bucket long").coalesce(1) \
        .write.mode("overwrite").parquet(f"{target}/commits/{folder}")


def run_incremental(spark: SparkSession, source_dir: str, sf_dir: str, target: str, checkpoint: str,
                    file_glob: str = "orders*.parquet", max_files_per_trigger: int | None = None) -> None:
    """Process every new file under `source_dir` once, then stop."""
    schema = spark.read.parquet(f"{sf_dir}/orders.parquet").schema
    reader = (spark.readStream.format("parquet").schema(schema).option("pathGlobFilter", file_glob).option("recursiveFileLookup", True))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(source_dir).select(
        "*", F.col("_metadata.file_modification_time").alias("__time"), F.col("_metadata.file_path").alias("__path"))
    q = (stream.writeStream.foreachBatch(lambda batch, batch_id: replace_batch(batch, batch_id, sf_dir, target))
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()


def current_state(spark: SparkSession, target: str) -> DataFrame:
    """Per-(year, area, option) counts summed over the latest version of every bucket."""
    counts = _read(spark, target, "counts", _latest(_versions(spark, target)))
    if counts is None:
        return spark.createDataFrame([], "yr long, geo long, opt string, eligible long, cast_n long, votes long")
    return (counts.where(F.col("eligible").isNotNull() & F.col("geo").isNotNull()).groupBy("yr", "geo", "opt")
            .agg(*[F.sum(c).cast("bigint").alias(c) for c in _COUNTS]))


def _root(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/incremental-{uuid.uuid4().hex}"


def incremental_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run the incremental load over the orders files of `sf_dir` into a fresh folder under
    the shared checkpoint directory and return the resulting state."""
    root = _root(spark)
    run_incremental(spark, f"{sf_dir}/orders.parquet", sf_dir, f"{root}/table", f"{root}/checkpoint", file_glob="*.parquet")
    return current_state(spark, f"{root}/table")


def landed_counts(spark: SparkSession, sf_dir: str, deliveries: Sequence[DataFrame]) -> DataFrame:
    """Land each delivery as a folder of order files, run the load after each, and return the resulting state."""
    root = _root(spark)
    for i, orders in enumerate(deliveries):
        orders.write.parquet(f"{root}/landing/delivery-{i:03}")
        run_incremental(spark, f"{root}/landing", sf_dir, f"{root}/table", f"{root}/checkpoint", file_glob="*.parquet")
    return current_state(spark, f"{root}/table")
