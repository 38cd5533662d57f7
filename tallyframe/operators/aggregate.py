"""Aggregations.

Every aggregate here is decomposable (sum/max/min/count/min_by/corr/regr_*),
so Spark combines map-side before the shuffle: a key holding a third of the
rows costs one partial row per map task, not a hot reducer.  The exact median is found
by counting ranges of values, so no task sorts a large group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from ..functions import scalars as S
from ..session import cut_lineage


def rollup_headers(df: DataFrame, unit_key: Sequence[str], geo: str, ordinal: str,
                   counts: Sequence[str], name: str | None = None) -> DataFrame:
    """A1: header totals counted once per unit (first row by ordinal), null -> 0, summed per geo.

    The geo name is the name on the earliest row of the geo.  `geo` is one of the unit's keys.  Every row gives a record of
    its unit and one of its geo's name, so that two decomposable aggregations and a window over their few results do both in
    one pass; with an ordinal of fixed width (integer, decimal) all are hash aggregates, as no string is ever an aggregate's value.
    """
    keys = [k for k in unit_key if k != geo]
    nothing = [F.lit(None).cast(df.schema[k].dataType).alias(k) for k in keys]
    label = F.col(name).cast("string") if name else F.lit(None).cast("string")
    records = [F.struct(F.lit(False).alias("__named"), *[F.col(k).alias(k) for k in keys], F.lit(None).cast("string").alias("__name"))]
    if name:
        records.append(F.struct(F.lit(True).alias("__named"), *nothing, label.alias("__name")))
    recs = df.select(geo, F.col(ordinal).alias("__at"), *[F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(f"__c_{c}") for c in counts],
                     F.inline(F.array(*records)))
    per_unit = recs.groupBy(geo, "__named", *keys, "__name").agg(
        F.min("__at").alias("__at"), *[F.min_by(f"__c_{c}", "__at").alias(f"__c_{c}") for c in counts])
    per_geo = per_unit.groupBy(geo, "__named", "__name").agg(
        F.min("__at").alias("__at"), *[F.sum(f"__c_{c}").cast("bigint").alias(c) for c in counts])
    if not name:
        return per_geo.select(geo, *counts)
    w = Window.partitionBy(geo)
    named = per_geo.withColumn("__first", F.min(F.when(F.col("__named"), F.col("__at"))).over(w))
    named = named.withColumn(name, F.max(F.when(F.col("__named") & (F.col("__at") == F.col("__first")), F.col("__name"))).over(w))
    return named.where(~F.col("__named")).select(geo, *counts, name)


def collapse_results(df: DataFrame, keys: Sequence[str] = ("year", "dept_code", "candidate_name"),
                     name: str = "dept_name") -> DataFrame:
    """A3: one row per key: max of counts/ratios, votes = sum (null if all null), name = min.

    NaN is turned into null first (Spark's max ranks NaN highest).
    """
    def clean(c):
        return S.nan_to_null(c)

    return df.groupBy(*keys).agg(
        F.min(name).alias(name),
        F.max("registered").alias("registered"),
        F.max("votes_cast").alias("votes_cast"),
        F.max("votes_valid").alias("votes_valid"),
        F.sum("votes").cast("bigint").alias("votes"),
        F.max(clean("vote_share")).alias("vote_share"),
        F.max(clean("turnout_rate")).alias("turnout_rate"),
    )


def recompute_share(df: DataFrame, votes: str = "votes", valid: str = "votes_valid",
                    share: str = "vote_share") -> DataFrame:
    """A4: share = votes/valid (6 dp) wherever both exist and valid != 0."""
    ok = F.col(votes).isNotNull() & F.col(valid).isNotNull() & (F.col(valid) != 0)
    return df.withColumn(share, F.when(ok, S.safe_ratio(votes, valid)).otherwise(F.col(share)))


def run_stats(df: DataFrame, key: str, time_col: str, exact_distinct: bool = True) -> DataFrame:
    """Count, distinct keys, min/max period and the sorted list of periods (bounded)."""
    distinct = F.count_distinct(key) if exact_distinct else F.approx_count_distinct(key)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), distinct.alias("n_keys"),
                  F.min(time_col).alias("min_period"), F.max(time_col).alias("max_period"),
                  F.count_distinct(time_col).alias("n_periods"))


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Sorted distinct values (range-partitioned sort, no single task)."""
    return df.select(col).distinct().orderBy(col)


#: Groups of up to this many values are sorted as they are; of larger ones only a range of about this many is.
SORTED_VALUES = 10_000
#: Value ranges that a round of the selection counts, per group.
RANGES = 32


def _same_group(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).eqNullSafe(F.col(f"__g_{k}"))
    return cond


def _as_groups(groups: DataFrame, keys: Sequence[str], *more: str) -> DataFrame:
    return groups.select(*[F.col(k).alias(f"__g_{k}") for k in keys], *more)


def _narrowed(rows: DataFrame, targets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One round: targets (keys, __rank, __lo, __hi, __below, __inside) with a smaller range around their rank.

    A sketch cuts each target's range at RANGES - 1 quantiles; the values at a cut and those between two cuts are counted
    exactly, and the range that holds the rank is kept.  Windows run over the counted ranges, never over values.
    """
    target = [*keys, "__rank"]
    own = [f"__g_{k}" for k in keys]
    inside = rows.join(_as_groups(targets, keys, "__rank", "__lo", "__hi"), _same_group(keys)) \
        .where(F.col("__v").between(F.col("__lo"), F.col("__hi"))).drop(*own, "__lo", "__hi")
    cuts = inside.groupBy(*target).agg(F.percentile_approx("__v", [i / RANGES for i in range(1, RANGES)], 50 * RANGES).alias("__cuts"))
    place = 2 * F.size(F.filter("__cuts", lambda c: c < F.col("__v"))) + F.array_contains("__cuts", F.col("__v")).cast("int")
    counted = (inside.join(_as_groups(cuts, target, "__cuts"), _same_group(target))
               .groupBy(*target, place.alias("__at"))
               .agg(F.count(F.lit(1)).alias("__inside"), F.min("__v").alias("__lo"), F.max("__v").alias("__hi")))
    before = Window.partitionBy(*target).orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    ranges = counted.withColumn("__before", F.coalesce(F.sum("__inside").over(before), F.lit(0)))
    ranges = ranges.join(_as_groups(targets, target, "__below"), _same_group(target)).withColumn("__below", F.col("__below") + F.col("__before"))
    held = (F.col("__below") <= F.col("__rank")) & (F.col("__rank") < F.col("__below") + F.col("__inside"))
    return ranges.where(held).select(*target, "__lo", "__hi", "__below", "__inside")


def medians(rows: DataFrame, sizes: DataFrame, keys: Sequence[str], largest: int | None = None) -> DataFrame:
    """Exact median per group of `rows` (keys, __v without nulls), by counting.

    `sizes` has keys, n, min and max per group.  Only groups with more than `largest` values go through rounds, one target for
    each of their middle ranks; a round shrinks a target's range about RANGES times, until it holds few values or a
    single one.  The values of what is left are counted, and only these counts (at most `largest` per target) are sorted together.
    """
    keys, largest = list(keys), largest or SORTED_VALUES
    low, high = F.floor((F.col("n") - 1) / 2), F.ceil((F.col("n") - 1) / 2)
    todo = cut_lineage(sizes.where(F.col("n") > largest).select(
        *keys, F.explode(F.array_distinct(F.array(low, high))).alias("__rank"), F.col("min").alias("__lo"), F.col("max").alias("__hi"),
        F.lit(0).cast("bigint").alias("__below"), F.col("n").alias("__inside")))
    wide = (F.col("__inside") > largest) & (F.col("__lo") < F.col("__hi"))
    targets = None
    while not todo.isEmpty():
        done = todo.where(~wide)
        targets = done if targets is None else targets.unionByName(done)
        todo = cut_lineage(_narrowed(rows, todo.where(wide), keys).select(*todo.columns))
    if targets is None:
        left = rows.withColumn("__rank", F.lit(None).cast("bigint")).withColumn("__below", F.lit(0).cast("bigint"))
    else:
        left = rows.join(_as_groups(cut_lineage(targets), keys, "__rank", "__lo", "__hi", "__below"), _same_group(keys), "left") \
            .where(F.col("__lo").isNull() | F.col("__v").between(F.col("__lo"), F.col("__hi")))
    target = [*keys, "__rank"]
    counts = left.groupBy(*target, "__v").agg(F.count(F.lit(1)).alias("__n"), F.max("__below").alias("__below"))
    kept = counts.groupBy(*target).agg(F.array_sort(F.collect_list(F.struct("__v", "__n"))).alias("__values"),
                                       F.coalesce(F.max("__below"), F.lit(0)).alias("__below"))
    at = kept.join(_as_groups(sizes, keys, low.alias("__mid_low"), high.alias("__mid_high")), _same_group(keys))
    wanted = (F.coalesce("__rank", "__mid_low"), F.coalesce("__rank", "__mid_high"))
    nothing = F.lit(None).cast(rows.schema["__v"].dataType)

    def step(acc, x):
        upto = acc["upto"] + x["__n"]
        return F.struct(upto.alias("upto"), F.coalesce(acc["low"], F.when(upto > wanted[0], x["__v"])).alias("low"),
                        F.coalesce(acc["high"], F.when(upto > wanted[1], x["__v"])).alias("high"))

    start = F.struct(F.col("__below").alias("upto"), nothing.alias("low"), nothing.alias("high"))
    found = at.select(*keys, F.aggregate("__values", start, step).alias("__m"))
    return found.groupBy(*keys).agg(F.avg((F.col("__m")["low"] + F.col("__m")["high"]) / 2.0).alias("median"))


def describe_by(df: DataFrame, keys: Sequence[str], value: str, largest: int | None = None) -> DataFrame:
    """Descriptive statistics per group, with the exact median (see ``medians``); NaN counts as missing.

    The rows are evaluated once (a checkpoint of keys and value); groups without a value have null statistics.
    """
    keys = list(keys)
    v = F.col(value)
    if isinstance(df.schema[value].dataType, (FloatType, DoubleType)):
        v = S.nan_to_null(value)
    rows = cut_lineage(df.select(*keys, v.alias("__v")))
    stats = cut_lineage(rows.groupBy(*keys).agg(
        F.count("__v").alias("n"), F.avg("__v").alias("mean"), F.stddev_samp("__v").alias("stddev"),
        F.min("__v").alias("min"), F.max("__v").alias("max")))
    middle = medians(rows.where(F.col("__v").isNotNull()), stats.where(F.col("n") > 0), keys, largest)
    return stats.join(_as_groups(middle, keys, "median"), _same_group(keys), "left") \
        .select(*keys, "n", "mean", "stddev", "min", "median", "max")


def histogram(df: DataFrame, value: str, bins: int, lo: float, hi: float,
              keys: Sequence[str] = ()) -> DataFrame:
    """A10: equal-width histogram; values at `hi` fall in the last bin, outside -> 0 / bins+1."""
    v = F.col(value)
    width = (hi - lo) / bins
    b = (F.when(v < lo, F.lit(0))
         .when(v >= hi, F.when(v == hi, F.lit(bins)).otherwise(F.lit(bins + 1)))
         .otherwise(F.floor((v - F.lit(lo)) / F.lit(width)).cast("int") + 1))
    return df.where(v.isNotNull()).groupBy(*keys, b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def correlate(df: DataFrame, xs: Sequence[str], y: str, by: Sequence[str] = ()) -> DataFrame:
    """Pearson correlation of each x with y per group (one pass, decomposable)."""
    aggs = [F.corr(F.col(x).cast("double"), F.col(y).cast("double")).alias(f"corr_{x}") for x in xs]
    return df.groupBy(*by).agg(*aggs, F.count(F.lit(1)).alias("n"))
