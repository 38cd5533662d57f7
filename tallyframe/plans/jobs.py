"""The jobs, run in order as plain functions (no scheduler of our own):

1. ``load_election_results``  results frame -> dims (get-or-create) -> fact slice replace -> turnout indicator
2. ``load_indicator_values``  indicator frame -> catalogue lookup -> upsert
3. ``dashboard_tables``       D1-D4 datasets from the same lineage

``run_warehouse`` and ``run_dashboard`` take them from file paths to the warehouse and the
dashboard folders and report how many rows each load wrote.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from ..config import JobConfig
from ..functions import scalars as S
from ..operators import joins as J
from ..operators import load as L
from ..session import cut_lineage
from ..sources import readers
from ..sources.sinks import Warehouse, write_dashboard_tables
from . import dashboard as D
from . import election as EL
from . import indicators as IN


def _geo_rows(spark: SparkSession, cfg: JobConfig):
    codes = [c for c in C.DEPARTMENTS if cfg.target_codes is None or c in cfg.target_codes]
    depts = spark.createDataFrame([(c, C.DEPARTMENTS[c]) for c in codes], "dept_code string, dept_name string")
    communes = spark.createDataFrame(
        [(c + "000", f"{C.DEPARTMENTS[c]} (departement)", c) for c in codes],
        "insee_code string, commune_name string, dept_code string")
    return depts, communes


def ensure_reference_rows(spark: SparkSession, wh: Warehouse, cfg: JobConfig) -> dict[str, int]:
    """L2/L3: departments (first write wins), communes (last write wins), indicator catalogue."""
    depts, communes = _geo_rows(spark, cfg)
    counts = {"geo_department": wh.insert_ignore("geo_department", depts), "geo_commune": wh.upsert("geo_commune", communes)}
    specs = [(s[0], s[1], s[2], C.INDICATOR_SOURCE_LABEL) for s in C.INDICATOR_SPECS] + [C.TURNOUT_INDICATOR]
    inc = spark.createDataFrame(specs, "indicator_code string, indicator_name string, unit string, source string")
    counts["indicator"] = wh.get_or_create("indicator", inc, ["indicator_code"]).count()
    return counts


def election_dates(spark: SparkSession, results: DataFrame) -> DataFrame:
    """(year, election_date) of the result years; years without a date are an error, before any write."""
    known = spark.createDataFrame(sorted(C.ELECTION_DATE_BY_YEAR.items()), "year int, d string")
    years = results.select("year").distinct()
    unknown = sorted(r[0] for r in years.join(known, "year", "left_anti").limit(100).collect())
    if unknown:
        raise ValueError(f"no election date for the years {unknown}")
    return years.join(known, "year").select("year", F.to_date("d").alias("election_date"))


def load_election_results(spark: SparkSession, results: DataFrame, wh: Warehouse,
                          cfg: JobConfig = JobConfig()) -> dict[str, int]:
    """Rows that each table holds (dimensions) or got (facts)."""
    results = cut_lineage(results)  # read by every step below
    L.require_rows(results, "election results")
    dates = cut_lineage(election_dates(spark, results))
    counts = ensure_reference_rows(spark, wh, cfg)
    elections_in = dates.select(F.lit(C.ELECTION_TYPE).alias("election_type"), "election_date",
                                F.lit(C.ELECTION_ROUND).cast("smallint").alias("round"),
                                F.lit(C.ELECTION_SCOPE).alias("scope"))
    elections = wh.get_or_create("election", elections_in, ["election_type", "election_date", "round", "scope"])
    cands_in = results.select("candidate_name", F.lit(None).cast("string").alias("party_code"))
    candidates = wh.get_or_create("candidate", cands_in, ["candidate_name", "party_code"])
    scope = (F.col("election_type") == C.ELECTION_TYPE) & (F.col("round") == C.ELECTION_ROUND) & (F.col("scope") == C.ELECTION_SCOPE)
    facts = (results.join(dates, "year")
             .join(elections.where(scope).select("election_id", "election_date"), "election_date")
             .withColumn("party_code", F.lit(None).cast("string")))
    facts = J.null_safe_join(facts, candidates.select("candidate_name", "party_code", "candidate_id"),
                             ["candidate_name", "party_code"], "inner")
    rows = cut_lineage(facts.select(
        "election_id", S.geo_key("dept_code").alias("insee_code"), "candidate_id", "registered", "votes_cast",
        "votes_valid", "votes", S.to_storage_share("vote_share").alias("vote_share")))
    # every target area of the loaded elections is replaced, whether it has rows now or not
    inside = F.lit(True) if cfg.target_codes is None else F.col("insee_code").isin([c + "000" for c in cfg.target_codes])
    counts["candidate"], counts["election"] = candidates.count(), elections.count()
    counts["election_result"] = wh.replace_slice("election_result", rows, inside)
    turnout = D.turnout_rows(results)
    ind = wh.read("indicator").select("indicator_id", "indicator_code")
    values = turnout.select(S.geo_key("dept_code").alias("insee_code"), "year",
                            F.col("turnout_rate").alias("value"), F.lit(C.TURNOUT_SOURCE_FILE).alias("source_file"),
                            F.lit(C.TURNOUT_INDICATOR[0]).alias("indicator_code")).join(ind, "indicator_code")
    counts["turnout_value"] = values.count()
    wh.upsert("indicator_value", values)
    return counts


def load_indicator_values(spark: SparkSession, values: DataFrame, wh: Warehouse,
                          cfg: JobConfig = JobConfig()) -> DataFrame:
    """J4 + L3: resolve indicator ids (unmatched rows skipped and returned), upsert values."""
    values = cut_lineage(values)
    L.require_rows(values, "indicator values")
    ensure_reference_rows(spark, wh, cfg)
    matched, unmatched = J.resolve_keys(values, wh.read("indicator"), "indicator_code", "indicator_code",
                                        "indicator_id")
    wh.upsert("indicator_value", matched)
    return unmatched


def read_results(spark: SparkSession, sheets: Mapping[int, str], stations: Mapping[int, str] | None = None,
                 cfg: JobConfig = JobConfig(), **options) -> DataFrame:
    """Landed sheet and station files, one of each a year, -> canonical results."""
    parsed = {y: readers.read_station_file(spark, p) for y, p in (stations or {}).items()}
    return EL.collect_results(spark, readers.read_wide_results(spark, sheets, **options), parsed, cfg)


def read_indicators(spark: SparkSession, path: str, cfg: JobConfig = JobConfig()) -> DataFrame:
    return IN.collect_indicator_values(spark, readers.read_indicator_file(spark, path), "ordinal", cfg)


def run_warehouse(spark: SparkSession, root: str, sheets: Mapping[int, str], stations: Mapping[int, str] | None = None,
                  indicators: str | None = None, cfg: JobConfig = JobConfig(), **options) -> dict[str, int]:
    """From file paths to the warehouse under ``root``; returns the load counts."""
    wh = Warehouse(spark, root)
    counts = load_election_results(spark, read_results(spark, sheets, stations, cfg, **options), wh, cfg)
    if indicators is not None:
        values = cut_lineage(read_indicators(spark, indicators, cfg))
        counts["indicator_value"] = values.count()
        counts["indicator_unmatched"] = load_indicator_values(spark, values, wh, cfg).count()
    return counts


def dashboard_tables(results: DataFrame, values: DataFrame, years) -> dict[str, DataFrame]:
    order = D.dept_order(results)
    return {
        "turnout_trend": D.turnout_trend(results, order),
        "leader_matrix": D.leader_matrix(results, years, order),
        "unemployment_trend": D.indicator_trend(values, "unemployment_rate", order),
        "latest_poverty": D.latest_indicator(values, "poverty_rate", order),
    }


def run_dashboard(spark: SparkSession, root: str, sheets: Mapping[int, str], indicators: str,
                  stations: Mapping[int, str] | None = None, cfg: JobConfig = JobConfig(), **options) -> dict[str, int]:
    """From file paths to one sorted folder per dashboard dataset; returns their row counts."""
    results = cut_lineage(read_results(spark, sheets, stations, cfg, **options))
    values = cut_lineage(read_indicators(spark, indicators, cfg))
    years = sorted({*sheets, *(stations or {})})
    tables = {k: cut_lineage(df) for k, df in dashboard_tables(results, values, years).items()}
    write_dashboard_tables(tables, root, sort_by={k: df.columns[:2] for k, df in tables.items()})
    return {k: df.count() for k, df in tables.items()}
