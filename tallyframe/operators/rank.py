"""Window / ranking / de-duplication operators.

Top-1-per-group is written as ``row_number() = 1`` so Spark plans a
*partial* WindowGroupLimit before the shuffle: a hot group is cut down to one
row per map partition before it is exchanged, which keeps skewed keys cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OrderSpec = Sequence[Column | str]


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def top_n(df: DataFrame, keys: Sequence[str], order: OrderSpec, n: int = 1,
          rank_col: str | None = None) -> DataFrame:
    """Rows ranked 1..n per key by `order` (order must end in a unique tie-breaker)."""
    w = Window.partitionBy(*keys).orderBy(*_cols(order))
    name = rank_col or "__rn"
    out = df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)
    return out if rank_col else out.drop(name)


def top1(df: DataFrame, keys: Sequence[str], order: OrderSpec, drop_null: str | None = None) -> DataFrame:
    """The whole leading row per group (optionally ignoring null `drop_null`)."""
    if drop_null:
        df = df.where(F.col(drop_null).isNotNull())
    return top_n(df, keys, order, 1)


def first_per_key(df: DataFrame, keys: Sequence[str], value: str, order: OrderSpec) -> DataFrame:
    """First row with a non-null `value` per key, by an explicit order."""
    return top_n(df.where(F.col(value).isNotNull()), keys, order, 1)


def dedupe_last(df: DataFrame, keys: Sequence[str], ordinal: OrderSpec) -> DataFrame:
    """Keep the last row per key by source ordinal (never bare dropDuplicates)."""
    order = [(F.col(c) if isinstance(c, str) else c).desc() for c in ordinal]
    return top_n(df, keys, order, 1)


def latest_snapshot(df: DataFrame, time_col: str, where: Column | None = None) -> DataFrame:
    """Rows at the global maximum period (not per geo).

    The max is a scalar subquery over a partially aggregated one-row
    aggregate; no single-partition window, no join.
    """
    if where is not None:
        df = df.where(where)
    return df.where(F.col(time_col) == df.agg(F.max(time_col)).scalar())


def with_history(df: DataFrame, keys: Sequence[str], time_col: str, cols: Sequence[str],
                 n: int = 1, bucket: Column | None = None) -> DataFrame:
    """Previous values (lag 1..n) and change vs previous per key.  Times must be unique per key.

    With `bucket` (a monotone function of the time, e.g. the decade) a hot key is
    split: a window per (key, bucket) gives the lags inside the bucket, and a
    window per key over the edges alone (the first and last n rows of each bucket) gives the
    lags of the first n rows of each bucket.  Keys match null-safely.
    """
    keys = list(keys)
    lags = [(c, k) for c in cols for k in range(1, n + 1)]

    def add(frame: DataFrame, w, prefix: str) -> DataFrame:
        return frame.select("*", *[F.lag(c, k).over(w).alias(f"{prefix}{c}_lag{k}") for c, k in lags])

    if bucket is None:
        out = add(df, Window.partitionBy(*keys).orderBy(time_col), "")
    else:
        b = df.withColumn("__b", bucket)
        part = Window.partitionBy(*keys, "__b")
        inb = add(b.select("*", F.row_number().over(part.orderBy(time_col)).alias("__rn"),
                           F.count(F.lit(1)).over(part).alias("__size")), part.orderBy(time_col), "__in_")
        edge = inb.where(F.col("__rn") <= n).select(*keys, "__b", "__rn", time_col, *cols).union(
            inb.where((F.col("__rn") > n) & (F.col("__rn") > F.col("__size") - n)).select(*keys, "__b", "__rn", time_col, *cols))
        edge = add(edge, Window.partitionBy(*keys).orderBy(time_col), "__e_").where(F.col("__rn") <= n)
        on = [*keys, "__b", "__rn"]
        edge = edge.select(*[F.col(k).alias(f"__k_{k}") for k in on], *[f"__e_{c}_lag{k}" for c, k in lags])
        match = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in on]
        out = inb.join(edge, match, "left").select(
            *df.columns, *[F.when(F.col("__rn") <= n, F.col(f"__e_{c}_lag{k}")).otherwise(F.col(f"__in_{c}_lag{k}"))
                           .alias(f"{c}_lag{k}") for c, k in lags])
    return out.withColumns({f"{c}_change": F.col(c) - F.col(f"{c}_lag1") for c in cols})
