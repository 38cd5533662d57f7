"""Indicator series: wide indicator file -> selected long series -> as-of aligned values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import config as C
from .. import schema as SC
from ..config import JobConfig
from ..functions import scalars as S
from ..operators import joins as J
from ..operators import rank as W
from ..operators import reshape as R
from ..sources import readers
from ..sources.schema import discover_periods, to_canonical


def scope_indicator_rows(wide: DataFrame, cfg: JobConfig = JobConfig(), geo_col: str = "codgeo") -> DataFrame:
    """S3 + P1: normalize the area code and keep the target scope."""
    return (wide.withColumn(geo_col, S.normalize_area_code(geo_col))
            .where(cfg.in_scope(F.col(geo_col))))


def select_series(rows: DataFrame, specs: DataFrame) -> DataFrame:
    """One equi-join on `variable` against the spec table (Spark broadcasts it by its size).

    A spec with a null sub-field matches rows whose sub-field is null; otherwise
    the stripped sub-field must equal it.
    """
    sp = specs.select("indicator_code", F.col("variable").alias("__sv"), F.col("sous_champ").alias("__ssc"),
                      F.col("__spec_order"))
    sc = F.col("sous_champ")
    cond = (F.col("variable") == F.col("__sv")) & (
        (F.col("__ssc").isNull() & sc.isNull())
        | (F.col("__ssc").isNotNull() & (S.ustrip(F.coalesce(sc, F.lit(""))) == F.col("__ssc"))))
    return rows.join(sp, cond, "inner")


def empty_specs(selected: DataFrame, specs: DataFrame) -> DataFrame:
    """Specs that matched no row (the job warns and continues)."""
    return specs.join(selected.select("indicator_code").distinct(), "indicator_code", "left_anti")


def with_spec_order(specs: DataFrame) -> DataFrame:
    """Specs need an explicit position column (`__spec_order`); the fixed table has one."""
    if "__spec_order" not in specs.columns:
        raise ValueError("indicator specs need a __spec_order column")
    return specs


def extract_values(wide: DataFrame, specs: DataFrame, ordinal: str, cfg: JobConfig = JobConfig(),
                   source_label: str = C.INDICATOR_SOURCE_LABEL) -> DataFrame:
    """Wide rows (with a source `ordinal`) -> (indicator_code, insee_code, year, value, source_file).

    Keep-last on (indicator, geo, year) by (spec order, source ordinal).
    """
    periods = discover_periods(wide.columns)
    rows = scope_indicator_rows(wide, cfg)
    sel = select_series(rows, specs)
    long = R.melt_periods(sel, ["indicator_code", "codgeo", "__sv", "__ssc", "__spec_order", ordinal],
                          periods, "year", "raw")
    long = long.withColumn("value", S.parse_float_fr("raw")).where(F.col("value").isNotNull())
    long = long.select(
        "indicator_code", S.geo_key("codgeo").alias("insee_code"), "year", "value",
        S.lineage_label(source_label, "__sv", "__ssc").alias("source_file"), "__spec_order", ordinal)
    last = W.dedupe_last(long, ["indicator_code", "insee_code", "year"], ["__spec_order", ordinal])
    return to_canonical(last, SC.INDICATOR_VALUES)


def align_values(values: DataFrame, targets, keys=("indicator_code", "insee_code")) -> DataFrame:
    """J3 + F15: backward as-of onto the target years, carried rows tagged with their source year."""
    aligned = J.asof_align(values, list(keys), "year", targets, target_col="__target")
    return aligned.select(
        *keys, F.col("__target").cast("int").alias("year"), "value",
        S.aligned_from("source_file", "year", "__target").alias("source_file"))


def collect_indicator_values(spark: SparkSession, wide: DataFrame, ordinal: str,
                             cfg: JobConfig = JobConfig()) -> DataFrame:
    specs = with_spec_order(readers.spec_tables(spark)["indicator_specs"])
    values = extract_values(wide, specs, ordinal, cfg)
    if cfg.align_to_election_years:
        values = align_values(values, cfg.target_years)
    return values
