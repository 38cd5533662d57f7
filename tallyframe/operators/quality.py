"""Data-quality operators (Q1, Q2): one aggregation pass per report.

``quality_report(df, rules)`` takes rules as data and reads its input once, whatever the rules: each row emits one
record for every row rule that it breaks and one for every group that a group rule puts it into, and a single two-level
aggregation counts them.  ``violations`` lists the same records.  The functions below them are single reports.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S


@dataclass(frozen=True)
class Rule:
    """One rule: its name, kind, columns and parameters (see the functions below)."""

    name: str
    kind: str
    columns: tuple[str, ...]
    low: float | None = None
    high: float | None = None
    group: tuple[str, ...] = ()

    @property
    def of_groups(self) -> bool:
        return bool(self.group)


def unique(name: str, *key: str) -> Rule:
    """Duplicates: no two rows with the same key (null equals null)."""
    return Rule(name, "duplicates", (), group=tuple(key))


def not_null(name: str, column: str) -> Rule:
    """Missing values: the column is never null."""
    return Rule(name, "missing", (column,))


def bounds(name: str, column: str, low: float | None = None, high: float | None = None) -> Rule:
    """Bounds: low <= value <= high; null values are not checked."""
    return Rule(name, "bounds", (column,), low, high)


def complete(name: str, column: str, share: float) -> Rule:
    """Completeness: at least this share of the column's cells is filled."""
    return Rule(name, "completeness", (column,), low=share)


def ordered(name: str, *columns: str) -> Rule:
    """Coherence: each column is no larger than the next (nulls are not compared)."""
    return Rule(name, "coherence", tuple(columns))


def adds_up(name: str, unit: Sequence[str], part: str, whole: str) -> Rule:
    """Coherence: the parts of a unit's rows add up to its whole (the largest one on its rows)."""
    return Rule(name, "coherence", (part, whole), group=tuple(unit))


def traced(name: str, lineage: str) -> Rule:
    """Traceability: the lineage label is neither null nor blank."""
    return Rule(name, "traceability", (lineage,))


def _broken(rule: Rule) -> Column:
    """Whether a row breaks a row rule (never null)."""
    cols = [F.col(c) for c in rule.columns]
    if rule.kind in ("missing", "completeness"):
        return cols[0].isNull()
    if rule.kind == "traceability":
        return S.blank_to_null(cols[0]).isNull()
    bad = F.lit(False)
    if rule.kind == "bounds":
        for limit, breaks in ((rule.low, lambda c: c < rule.low), (rule.high, lambda c: c > rule.high)):
            if limit is not None:
                bad = bad | F.coalesce(breaks(cols[0]), F.lit(False))
        return bad
    for a, b in zip(cols, cols[1:]):
        bad = bad | F.coalesce(a > b, F.lit(False))
    return bad


def _key(columns: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("string") for c in columns]).cast("array<string>")


def _records(df: DataFrame, rules: Sequence[Rule], identity: Sequence[str]) -> DataFrame:
    """(rule, key, n, part, whole): broken row rules by the row's identity, and all groups of group rules."""
    if len({r.name for r in rules}) != len(rules):
        raise ValueError("rules need names of their own")
    none = F.lit(None).cast("decimal(38,6)")

    def record(i, key, part=none, whole=none):
        return F.struct(F.lit(i).alias("__rule"), key.alias("__key"), part.alias("__part"), whole.alias("__whole"))

    records = [record(-1, F.lit(None).cast("array<string>"))]  # every row
    for i, rule in enumerate(rules):
        if not rule.of_groups:
            records.append(F.when(_broken(rule), record(i, _key(identity))))
        elif rule.columns:
            records.append(record(i, _key(rule.group), *[F.col(c).cast("decimal(38,6)") for c in rule.columns]))
        else:
            records.append(record(i, _key(rule.group)))
    rows = df.select(F.inline(F.filter(F.array(*records), lambda r: r.isNotNull())))
    return rows.groupBy("__rule", "__key").agg(F.count(F.lit(1)).alias("__n"), F.sum("__part").alias("__part"), F.max("__whole").alias("__whole"))


def _violates(rules: Sequence[Rule]) -> Column:
    """Whether a record of ``_records`` is a violation."""
    bad = F.lit(False)
    for i, rule in enumerate(rules):
        own = F.lit(True) if not rule.of_groups else F.col("__part") != F.col("__whole") if rule.columns else F.col("__n") > 1
        bad = F.when(F.col("__rule") == i, F.coalesce(own, F.lit(False))).otherwise(bad)
    return bad


def quality_report(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Q1: (rule, kind, n_checked, n_violations, passed), one row per rule, from one scan.

    Row rules count rows; duplicates count the rows that share their key; units that don't add up count once.  Completeness passes
    while the share of filled cells is not below its limit, the others without violations.
    """
    n, bad = F.col("__n"), _violates(rules)
    total = F.coalesce(F.sum(F.when(F.col("__rule") == -1, n)), F.lit(0))
    sums = [total.alias("__rows")]
    for i, rule in enumerate(rules):
        own = F.col("__rule") == i
        counted = F.lit(1) if rule.of_groups and rule.columns else n
        sums.append(F.coalesce(F.sum(F.when(own & bad, counted)), F.lit(0)).alias(f"__bad{i}"))
        sums.append((F.count_if(own) if rule.of_groups and rule.columns else total).alias(f"__all{i}"))
    one = _records(df, rules, ()).agg(*sums)

    def row(i, rule):
        broken, checked = F.col(f"__bad{i}"), F.col(f"__all{i}")
        passed = broken == 0 if rule.kind != "completeness" else (checked - broken) >= F.lit(rule.low) * checked
        return F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.kind).alias("kind"), checked.cast("bigint").alias("n_checked"),
                        broken.cast("bigint").alias("n_violations"), passed.alias("passed"))

    return one.select(F.inline(F.array(*[row(i, r) for i, r in enumerate(rules)])))


def violations(df: DataFrame, rules: Sequence[Rule], identity: Sequence[str]) -> DataFrame:
    """Q1: (rule, kind, key, n), from one scan: for row rules the identity of each row that breaks them (a missing cell
    breaks completeness), for group rules the group; n is the number of rows behind it."""
    names = F.array(*[F.lit(r.name) for r in rules])
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    found = _records(df, rules, identity).where((F.col("__rule") >= 0) & _violates(rules))
    return found.select(names[F.col("__rule")].alias("rule"), kinds[F.col("__rule")].alias("kind"),
                        F.transform("__key", lambda k: F.coalesce(k, F.lit(""))).alias("key"), F.col("__n").alias("n"))


def quality_counts(df: DataFrame, key: Sequence[str], not_null: Sequence[str],
                   bounds: Mapping[str, tuple[float | None, float | None]] | None = None) -> DataFrame:
    """Q1: one row: rows, duplicate-key rows, null counts and out-of-bounds counts.

    Duplicates come from one group-by on the key (partial aggregation);
    everything else is a single `agg` of `count_if`s over the same scan.
    """
    bounds = bounds or {}
    per_key = df.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    dup = per_key.agg(F.struct(
        F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0)).cast("bigint").alias("dup_rows"),
        F.count_if(F.col("__n") > 1).alias("dup_keys")))
    checks = [F.count(F.lit(1)).alias("n_rows")]
    checks += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null]
    for c, (lo, hi) in bounds.items():
        cond = F.lit(False)
        if lo is not None:
            cond = cond | (F.col(c) < lo)
        if hi is not None:
            cond = cond | (F.col(c) > hi)
        checks.append(F.count_if(cond).alias(f"out_of_bounds_{c}"))
    return df.agg(*checks).select("*", dup.scalar().alias("__dup")) \
        .select("*", "__dup.dup_rows", "__dup.dup_keys").drop("__dup")


def completeness(df: DataFrame, cols: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Q1: share of non-null cells per column, as integer millionths (null without rows)."""
    return df.groupBy(*by).agg(*[S.micro_ratio(F.count(F.col(c)), F.count(F.lit(1))).alias(f"micro_filled_{c}") for c in cols])


def coherence(df: DataFrame, unit: Sequence[str], votes: str, chain: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Q1: rows that break votes <= chain[0] <= chain[1] ..., and units whose votes don't add up to chain[0].

    ``unit`` identifies the rows that share their counts (an area's election); one aggregation per
    unit feeds both, so the input is read once.
    """
    ordered = [votes, *chain]
    broken = [F.count_if(F.col(a) > F.col(b)).alias(f"{a}_over_{b}") for a, b in zip(ordered, ordered[1:])]
    names = [f"{a}_over_{b}" for a, b in zip(ordered, ordered[1:])]
    units = df.groupBy(*unit).agg(*broken, F.count(F.lit(1)).alias("n_rows"), F.sum(votes).alias("__sum"),
                                  F.max(chain[0]).alias("__whole"))
    return units.groupBy(*by).agg(
        F.sum("n_rows").cast("bigint").alias("n_rows"), *[F.sum(n).cast("bigint").alias(n) for n in names],
        F.count_if(F.col("__sum") != F.col("__whole")).alias("sum_mismatch"))


def traceability(df: DataFrame, lineage: str, by: Sequence[str] = ()) -> DataFrame:
    """Q1: rows without a lineage label (null or blank)."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n_rows"),
                               F.count_if(S.blank_to_null(lineage).isNull()).alias("n_untraced"))


def coverage(df: DataFrame, row_key: str, period: str, expected_periods: Sequence[int],
             rows: DataFrame | None = None) -> DataFrame:
    """Q2: expected (row, period) cells that have no data.

    The grid is the distinct rows x a fixed period list (exploded, no cross
    join); the gaps are a left-anti join against the distinct present cells.
    """
    rows = (rows if rows is not None else df).select(row_key).distinct()
    grid = rows.select(row_key, F.explode(F.array(*[F.lit(p) for p in expected_periods])).alias(period))
    present = df.select(row_key, period).distinct()
    return grid.join(present, [row_key, period], "left_anti")
