"""Election results: landed sheets / station files -> canonical results frame.

``extract_wide_sheet``   layout A (x_VOIX / x_EXP pairs) or layout B (share-only columns)
``extract_station_file`` ragged station rows -> per-area totals and candidate votes
``collect_results``      union of all sources + duplicate collapse + share recompute
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from .. import schema as SC
from ..config import JobConfig
from ..functions import scalars as S
from ..operators import aggregate as A
from ..operators import joins as J
from ..operators import reshape as R
from ..sources import readers
from ..sources.schema import canonical_header, discover_measures, discover_pairs, resolve_roles, to_canonical


def _department_names(spark: SparkSession, departments: DataFrame | None = None) -> DataFrame:
    """(dept_code, __ref_name) lookup; the fixed spec table is broadcast, a given one is sized by Spark."""
    if departments is None:
        departments = F.broadcast(readers.spec_tables(spark)["departments"])
    return departments.select("dept_code", F.col("dept_name").alias("__ref_name"))


def _year(year) -> Column:
    return (F.col(year) if isinstance(year, str) else year if isinstance(year, Column) else F.lit(year)).cast("int")


def extract_wide_sheet(spark: SparkSession, sheet: DataFrame, year, cfg: JobConfig = JobConfig(),
                       aliases: DataFrame | None = None, departments: DataFrame | None = None,
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """One year's wide sheet -> canonical results rows (before collapse).

    `year` is the year of the file (int) or a column of the sheet; `keep` lists
    extra sheet columns carried through (e.g. a year column).
    """
    cols = [c for c in sheet.columns if c not in keep and not (isinstance(year, str) and c == year)]
    sheet = sheet.withColumn("__year", _year(year))
    roles = resolve_roles(cols, C.ROLE_ALIASES)
    code_c, name_c = roles["dept_code"], roles["dept_name"]
    if code_c is None and name_c is None:
        raise ValueError(f"could not find department columns for year {year}")
    df = sheet
    if name_c is not None:
        df = df.withColumn("__name", S.blank_to_null(name_c))
    else:
        df = df.withColumn("__name", F.lit(None).cast("string"))
    if code_c is not None:
        df = df.withColumn("__code", S.normalize_area_code(code_c))
    else:
        lk = aliases if aliases is not None else F.broadcast(readers.spec_tables(spark)["aliases"])
        df = J.lookup_code_by_name(df, "__name", lk, out_col="__code")
    df = df.where(cfg.in_scope(F.col("__code")))
    df = df.join(_department_names(spark, departments), df["__code"] == F.col("dept_code"), "left") \
        .drop("dept_code")
    df = df.withColumn("__name", S.coalesce_name("__name", "__ref_name", "__code"))

    def as_int(role):
        return S.parse_int_fr(roles[role]) if roles[role] else F.lit(None).cast("bigint")

    df = (df.withColumn("__registered", as_int("registered"))
          .withColumn("__cast", as_int("votes_cast"))
          .withColumn("__valid", as_int("votes_valid")))
    part_c = roles["participation"]
    turnout = S.parse_ratio_fr(part_c) if part_c else S.safe_ratio("__cast", "__registered")
    df = df.withColumn("__turnout", turnout)
    ids = ["__year", *keep, "__code", "__name", "__registered", "__cast", "__valid", "__turnout"]
    pairs = discover_pairs(cols)
    if pairs:
        long = R.melt_pairs(df, ids, [(canonical_header(v), v, s) for v, s in pairs])
        votes0 = S.parse_int_fr("votes_raw")
        share0 = S.parse_ratio_fr("share_raw")
        long = long.withColumn("votes", votes0).withColumn("vote_share", share0)
        long = long.withColumn("vote_share", S.backfill_share("votes", "__valid", "vote_share"))
        long = long.withColumn("votes", S.backfill_votes("votes", "__valid", "vote_share"))
    else:
        used = {c for c in (code_c, name_c) if c}
        measures = discover_measures(cols, C.METADATA_COLUMNS, exclude=used)
        long = R.melt_measures(df, ids, measures, "label", "raw", [canonical_header(m) for m in measures])
        long = long.withColumn("vote_share", S.parse_ratio_fr("raw"))
        long = long.withColumn("votes", F.when(
            F.col("__valid").isNotNull() & F.col("vote_share").isNotNull(),
            S.try_cast(F.bround(F.col("__valid") * F.col("vote_share"), 0), "bigint")))
    long = long.where(F.col("vote_share").isNotNull())
    return long.select(
        F.col("__year").alias("year"), *keep, F.col("__code").alias("dept_code"),
        F.col("__name").alias("dept_name"), F.col("label").alias("candidate_name"),
        F.col("__registered").alias("registered"), F.col("__cast").alias("votes_cast"),
        F.col("__valid").alias("votes_valid"), F.col("votes").cast("bigint").alias("votes"),
        F.col("vote_share").cast("double").alias("vote_share"),
        F.col("__turnout").cast("double").alias("turnout_rate"))


def extract_station_rows(spark: SparkSession, parsed: DataFrame, year: int, cfg: JobConfig = JobConfig(),
                         departments: DataFrame | None = None) -> DataFrame:
    """Parsed station rows (see ``readers.parse_station_lines``) -> canonical results rows.

    Totals count each (dept, commune, bureau) once (first row by ordinal) and
    candidate votes are summed over every row (duplicates included, unless
    ``cfg.dedupe_measures``).

    One pass: every row emits a header record plus one record per kept
    candidate group, and a single aggregation per (unit, kind, candidate)
    (partial, map-side) feeds both the area totals and the candidate votes;
    the two branches share that exchange, so the input is parsed once.
    """
    unit = ["dept_code", "commune", "bureau"]
    df = (parsed.withColumn("dept_code", S.normalize_area_code("dept_raw"))
          .where(cfg.in_scope(F.col("dept_code"))))
    df = df.join(_department_names(spark, departments), "dept_code", "left").select(
        "dept_code", S.coalesce_name("name_raw", "__ref_name", "dept_code").alias("dept_name"),
        S.ustrip("commune_raw").alias("commune"), S.ustrip("bureau_raw").alias("bureau"), "ordinal",
        F.coalesce(S.parse_int_fr("registered_raw"), F.lit(0)).alias("registered"),
        F.coalesce(S.parse_int_fr("cast_raw"), F.lit(0)).alias("votes_cast"),
        F.coalesce(S.parse_int_fr("valid_raw"), F.lit(0)).alias("votes_valid"),
        "tokens", "group_start")
    # kinds of records: 0 the row's header, 1 a candidate group, 2 the area's name on the row; a generated number
    # (-2 the name, -1 the header, else the group) and plain element access, so that all of it is compiled code
    fields = (C.STATION_NAME_OFFSET, C.STATION_VOTES_OFFSET, C.STATION_PANEL_OFFSET)
    n_groups = R.group_count("tokens", F.col("group_start"), C.STATION_GROUP_STRIDE, max(fields))
    recs = df.select("*", F.explode(F.sequence(F.lit(-2), (n_groups - 1).cast("int"))).alias("__i"))
    is_group = F.col("__i") >= 0

    def field(offset):
        at = (F.col("group_start") + F.col("__i") * C.STATION_GROUP_STRIDE + offset).cast("int")
        return F.when(is_group, F.get("tokens", at))

    recs = recs.where(~is_group | (S.ustrip(field(C.STATION_PANEL_OFFSET)) != "")).select(
        *unit, "ordinal", "registered", "votes_cast", "votes_valid",
        F.when(is_group, 1).when(F.col("__i") == -2, 2).otherwise(0).alias("kind"),
        F.when(F.col("__i") == -2, F.coalesce("dept_name", F.lit(""))).otherwise(field(C.STATION_NAME_OFFSET)).alias("written"),
        F.when(is_group, F.coalesce(S.parse_int_fr(field(C.STATION_VOTES_OFFSET)), F.lit(0))).alias("votes"))
    if cfg.dedupe_measures:
        # candidate groups only from the first row of each station, like the totals
        firsts = df.groupBy(*unit).agg(F.min("ordinal").alias("ordinal"))
        recs = recs.where(F.col("kind") != 1).unionByName(
            recs.where(F.col("kind") == 1).join(firsts, [*unit, "ordinal"], "left_semi"))
    # only header records count once per unit; the others drop it, so that they shrink map-side to one record per (area,
    # name as written).  Level 1 per (unit, name as written): header records keep the first row's counts, group
    # records sum their votes; level 2 per (area, name as written); the names are canonicalized
    # there, on the few distinct ones, and level 3 sums what has become one name; windows
    # over the aggregated rows of each area attach the totals and the area's earliest name (no join, no branch, so
    # the input is parsed once; no string is an aggregate's value, so a fixed-width ordinal keeps hash aggregates)
    counts = ("registered", "votes_cast", "votes_valid")
    recs = recs.select("dept_code", *[F.when(F.col("kind") == 0, F.col(c)).alias(c) for c in unit[1:]],
                       "ordinal", "kind", *counts, "written", "votes")
    per_unit = recs.groupBy(*unit, "kind", "written").agg(
        F.sum("votes").alias("votes"), F.min("ordinal").alias("first"), *[F.min_by(c, "ordinal").alias(c) for c in counts])
    per_name = per_unit.groupBy("dept_code", "kind", "written").agg(
        F.sum("votes").alias("votes"), F.min("first").alias("first"), *[F.sum(c).alias(c) for c in counts])
    named = per_name.withColumn("candidate_name", F.when(F.col("kind") == 1, S.canonical_label(S.ustrip("written")))
                                .when(F.col("kind") == 2, F.col("written")))
    per_area = named.groupBy("dept_code", "kind", "candidate_name").agg(
        F.sum("votes").cast("bigint").alias("votes"), F.min("first").alias("first"),
        *[F.sum(c).cast("bigint").alias(c) for c in counts])
    area = Window.partitionBy("dept_code")
    per_area = per_area.withColumn("earliest", F.min(F.when(F.col("kind") == 2, F.col("first"))).over(area))
    area_name = F.when((F.col("kind") == 2) & (F.col("first") == F.col("earliest")), F.col("candidate_name"))
    out = per_area.select(
        "dept_code", "candidate_name", "votes", "kind", F.nullif(F.max(area_name).over(area), F.lit("")).alias("dept_name"),
        *[F.max(F.when(F.col("kind") == 0, F.col(c))).over(area).alias(c) for c in counts]
    ).where(F.col("kind") == 1)
    return out.select(
        F.lit(year).cast("int").alias("year"), "dept_code", "dept_name", "candidate_name",
        "registered", "votes_cast", "votes_valid", F.col("votes").cast("bigint").alias("votes"),
        S.safe_ratio("votes", "votes_valid").alias("vote_share"),
        S.safe_ratio("votes_cast", "registered").alias("turnout_rate"))


def finalize_results(rows: DataFrame) -> DataFrame:
    """Collapse duplicates (A3) then recompute shares from counts (A4)."""
    collapsed = A.collapse_results(rows)
    return to_canonical(A.recompute_share(collapsed), SC.RESULTS)


def collect_results(spark: SparkSession, sheets: Mapping[int, DataFrame],
                    stations: Mapping[int, DataFrame] | None = None, cfg: JobConfig = JobConfig()) -> DataFrame:
    """All sources (ascending year) -> one canonical, collapsed results frame."""
    parts = [extract_wide_sheet(spark, sheets[y], y, cfg) for y in sorted(sheets)]
    for y in sorted(stations or {}):
        parts.append(extract_station_rows(spark, stations[y], y, cfg))
    if not parts:
        return spark.createDataFrame([], SC.RESULTS)
    return finalize_results(R.union_sources(parts))
