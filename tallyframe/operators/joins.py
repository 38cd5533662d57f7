"""Join operators (J1-J8), including the two backward as-of forms.

Broadcast hints are used only for sides built from driver-side constants
(spec tables, target lists); every data-derived side is left to Spark's
size statistics and AQE, which broadcast it only below the configured
threshold.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def lookup_code_by_name(df: DataFrame, name_col: str, lookup: DataFrame, out_col: str = "code",
                        lookup_key: str = "name_key", lookup_code: str = "dept_code") -> DataFrame:
    """Left join on the normalized name; unmatched -> null code."""
    lk = lookup.select(F.col(lookup_key).alias("__nk"), F.col(lookup_code).alias(out_col))
    return (df.withColumn("__nk", S.normalize_key(name_col))
            .join(lk, "__nk", "left").drop("__nk"))


def asof_align(values: DataFrame, keys: Sequence[str], time_col: str, targets: Sequence[int],
               target_col: str = "target", span: int = 16) -> DataFrame:
    """Backward as-of onto a target list, per key.

    For each (key, target): the row at the latest `time_col` <= target (exact
    wins); no earlier row -> no output row.  `values` must be unique on
    (keys, time_col) (apply ``rank.dedupe_last`` first); times are integers.

    Every row serves the targets from its own time up to the next row's, so the rows are
    exploded onto these: output-sized work, no join of values, one form whatever the length of the
    list.  The next row's time comes from a window per (key, `span` time steps), and for the
    last row of a span from a window over one row per span, so that a hot key is split.
    """
    keys = list(keys)
    tgt = F.array(*[F.lit(t) for t in sorted({int(t) for t in targets})])
    b = values.withColumn("__b", F.floor(F.col(time_col) / span))
    part = Window.partitionBy(*keys, "__b").orderBy(time_col)
    inside = b.withColumn("__in", F.lead(time_col).over(part))
    firsts = b.groupBy(*keys, "__b").agg(F.min(time_col).alias("__first"))
    firsts = firsts.withColumn("__after", F.lead("__first").over(Window.partitionBy(*keys).orderBy("__b")))
    on = [*keys, "__b"]
    firsts = firsts.select(*[F.col(k).alias(f"__k_{k}") for k in on], "__after")
    nxt = inside.join(firsts, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in on], "left") \
        .withColumn("__next", F.coalesce("__in", "__after"))
    t, u = F.col(time_col), F.col("__next")
    return nxt.select(*values.columns, F.explode(
        F.filter(tgt, lambda x: (x >= t) & (u.isNull() | (x < u)))).alias(target_col))


def asof_join(left: DataFrame, right: DataFrame, key: Sequence[str], left_time: str, right_time: str,
              right_cols: Sequence[str], bucket: Column | None = None,
              right_bucket: Column | None = None, matched_time: str = "matched_time") -> DataFrame:
    """Backward as-of join of two large tables: each left row gets the right row with
    the latest `right_time` <= `left_time` for the same key (left join).

    `right` must be unique on (key, right_time).  Exact and skew-resistant:
    rows are split by (key, time bucket), so one hot key spreads over its
    buckets.  Phase 1 finds the in-bucket predecessor with a window per
    (key, bucket); phase 2 carries in the latest right time of earlier buckets
    from a per-(key, bucket) max (one row per bucket); the right columns are
    then fetched by an equi-join on (key, time).  `bucket`/`right_bucket` are
    monotone functions of the times (default: one bucket per key).
    """
    key = list(key)
    lb = bucket if bucket is not None else F.lit(0)
    rb = right_bucket if right_bucket is not None else F.lit(0)
    lt = left.withColumn("__b", lb).withColumn("__t", F.col(left_time)).withColumn("__side", F.lit(1))
    rt = (right.select(*key, F.col(right_time).alias("__t"), rb.alias("__b"))
          .withColumn("__side", F.lit(0)))
    left_cols = [c for c in lt.columns if c not in ("__b", "__t", "__side")]
    u = lt.unionByName(rt, allowMissingColumns=True)
    w1 = (Window.partitionBy(*key, "__b").orderBy("__t", "__side")
          .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rtime = F.when(F.col("__side") == 0, F.col("__t"))
    phase1 = (u.withColumn("__in", F.last(rtime, ignorenulls=True).over(w1))
              .where(F.col("__side") == 1))
    # phase 2: latest right time in buckets strictly before each probe bucket
    per_bucket = right.select(*key, F.col(right_time).alias("__t"), rb.alias("__b")) \
        .groupBy(*key, "__b").agg(F.max("__t").alias("__m"), F.lit(1).alias("__o"))
    probe_buckets = lt.select(*key, "__b").distinct() \
        .withColumn("__m", F.lit(None).cast(per_bucket.schema["__m"].dataType)).withColumn("__o", F.lit(0))
    w2 = (Window.partitionBy(*key).orderBy("__b", "__o")
          .rowsBetween(Window.unboundedPreceding, -1))
    carry = (probe_buckets.unionByName(per_bucket)
             .withColumn("__carry", F.last("__m", ignorenulls=True).over(w2))
             .where(F.col("__o") == 0).select(*key, "__b", "__carry"))
    matched = (phase1.join(carry, [*key, "__b"], "left")
               .withColumn(matched_time, F.coalesce("__in", "__carry")))
    fetch = right.select(*key, F.col(right_time).alias(matched_time), *right_cols)
    return (matched.select(*left_cols, matched_time)
            .join(fetch, [*key, matched_time], "left"))


def resolve_keys(fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str,
                 dim_id: str) -> tuple[DataFrame, DataFrame]:
    """Attach a dimension id by natural key; unmatched rows are returned separately."""
    d = dim.select(F.col(dim_col).alias(fact_col), dim_id)
    return fact.join(d, fact_col, "inner"), fact.join(d, fact_col, "left_anti")


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Natural-key match where NULL equals NULL (still a hash-joinable equi-join)."""
    r = right.select(*[F.col(c).alias(f"__r_{c}") for c in right.columns])
    cond = None
    for c in on:
        e = left[c].eqNullSafe(r[f"__r_{c}"])
        cond = e if cond is None else cond & e
    out = left.join(r, cond, how)
    keep = [F.col(f"__r_{c}").alias(c) for c in right.columns if c not in on]
    return out.select(*[left[c] for c in left.columns], *keep)


def reindex(order: DataFrame, df: DataFrame, key: str, drop_missing: Sequence[str] = ()) -> DataFrame:
    """Rows in the driving list's keys (missing -> null row), optionally dropped."""
    out = order.select(key).join(df, key, "left")
    return out.na.drop(subset=list(drop_missing)) if drop_missing else out


def check_fk(fact: DataFrame, dim: DataFrame, fk: Sequence[str], pk: Sequence[str] | None = None) -> DataFrame:
    """Fact rows whose foreign key has no dimension row."""
    pk = list(pk or fk)
    d = dim.select(*[F.col(p).alias(f) for p, f in zip(pk, fk)]).distinct()
    return fact.join(d, list(fk), "left_anti")
