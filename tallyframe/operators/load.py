"""Keyed loads (L1-L9) as pure functions next_state = f(current, incoming).

Parquet tables have no MERGE, so each load is an anti-join + union; the
``Warehouse`` sink materializes the next state (reliable checkpoint into the
shared checkpoint folder) before it overwrites the table it was read from.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from . import joins


def _nk_cond(a: DataFrame, b: DataFrame, keys: Sequence[str]):
    cond = None
    for k in keys:
        e = a[k].eqNullSafe(b[k])
        cond = e if cond is None else cond & e
    return cond


def dense_ids(df: DataFrame, order: Sequence[str], id_col: str, offset=0,
              partitions: int | None = None) -> DataFrame:
    """Consecutive ids offset+1.. in `order`, computed without a single-task window.

    The rows are range-partitioned and sorted by `order` once and written as a reliable
    checkpoint (range bounds are sampled: a second evaluation could place rows differently).
    Both the rows and the row counts of the partitions are read from it; a row's position in its
    partition is `monotonically_increasing_id()` minus the partition's base, and the
    counts of all earlier partitions (one row per partition) are added as offsets.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fixed = cut_lineage(df.repartitionByRange(n, *order).sortWithinPartitions(*order))
    local = (fixed.withColumn("__pid", F.spark_partition_id())
             .withColumn("__rn", F.monotonically_increasing_id()
                         - F.shiftleft(F.col("__pid").cast("bigint"), 33) + F.lit(1)))
    counts = fixed.groupBy(F.spark_partition_id().alias("__pid")).agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn(
        "__off", F.coalesce(F.sum("__n").over(
            Window.orderBy("__pid").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    base = offset if not isinstance(offset, int) else F.lit(offset)
    return (local.join(F.broadcast(offsets.select("__pid", "__off")), "__pid")  # one row per partition
            .withColumn(id_col, (base + F.col("__off") + F.col("__rn")).cast("bigint"))
            .drop("__pid", "__rn", "__off"))


def assign_keys(current: DataFrame, incoming: DataFrame, nk: Sequence[str], id_col: str) -> DataFrame:
    """L1 get-or-create: new natural keys (null-safe) get ids after max(current id).

    Returns the next state of the dimension (current rows + new members); other columns of
    the dimension that `incoming` has come along.  The current state is evaluated once, as a checkpoint.
    """
    current = cut_lineage(current)
    more = [c for c in current.columns if c in incoming.columns and c not in nk and c != id_col]
    inc = incoming.select(*nk).distinct() if not more else incoming.select(*nk, *more).dropDuplicates(list(nk))
    new = inc.join(current, _nk_cond(inc, current, nk), "left_anti")
    max_id = current.agg(F.coalesce(F.max(id_col), F.lit(0))).first()[0]
    new_ids = dense_ids(new, nk, id_col, offset=int(max_id))
    cols = current.columns
    return current.unionByName(new_ids.select(*[c if c in new_ids.columns else F.lit(None).cast(
        current.schema[c].dataType).alias(c) for c in cols]))


def insert_ignore(current: DataFrame, incoming: DataFrame, pk: Sequence[str]) -> DataFrame:
    """L2: first write wins; incoming keys already present are ignored."""
    return current.unionByName(incoming.join(current.select(*pk), list(pk), "left_anti"))


def upsert(current: DataFrame, incoming: DataFrame, pk: Sequence[str]) -> DataFrame:
    """L3: last write wins; `incoming` must be unique on pk (see check_constraints)."""
    return current.join(incoming.select(*pk), list(pk), "left_anti").unionByName(incoming)


def replace_slice(current: DataFrame, incoming: DataFrame, slice_keys: DataFrame) -> DataFrame:
    """L4: delete every current row inside the slice (e.g. election x target geos), insert incoming."""
    keys = slice_keys.columns
    return current.join(slice_keys.distinct(), keys, "left_anti").unionByName(incoming)


def pk_violations(df: DataFrame, pk: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def unique_violations(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Natural keys (null equals null) that occur more than once."""
    return pk_violations(df, key)


def null_violations(df: DataFrame, not_null: Sequence[str]) -> DataFrame:
    """One row with the null count of every NOT NULL column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null])


def fk_violations(fact: DataFrame, dim: DataFrame, fk: Sequence[str], pk: Sequence[str] | None = None):
    return joins.check_fk(fact, dim, fk, pk)


def require_rows(df: DataFrame, what: str, fatal: bool = True) -> bool:
    """Empty-input policy (error for a whole job, warning for a sub-load)."""
    if df.isEmpty():
        if fatal:
            raise RuntimeError(f"no rows extracted for {what}")
        print(f"[warn] no rows for {what}")
        return False
    return True
