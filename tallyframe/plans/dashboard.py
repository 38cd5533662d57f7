"""Dashboard datasets D1-D5 (data only; rendering is out of scope).

All datasets share the lineage of one results frame and one indicator frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import joins as J
from ..operators import rank as W
from ..operators import reshape as R


def turnout_rows(results: DataFrame) -> DataFrame:
    """First non-null turnout per (year, dept) in (name, candidate) order."""
    first = W.first_per_key(results, ["year", "dept_code"], "turnout_rate", ["dept_name", "candidate_name"])
    return first.select("year", "dept_code", "dept_name", "turnout_rate")


def turnout_trend(results: DataFrame, order: DataFrame | None = None) -> DataFrame:
    """Turnout % per dept over years, labelled `code - name`, for the driving areas."""
    t = J.reindex(order if order is not None else dept_order(results), turnout_rows(results), "dept_code",
                  drop_missing=["year"])
    return t.select("dept_code", "year", S.to_pct("turnout_rate").alias("turnout_pct"),
                    F.concat_ws(" - ", "dept_code", "dept_name").alias("label"))


def dept_order(results: DataFrame) -> DataFrame:
    """Sorted departments having a turnout value (drives D1-D4)."""
    return results.where(F.col("turnout_rate").isNotNull()).select("dept_code").distinct()


def leaders(results: DataFrame) -> DataFrame:
    """The whole leading row per (year, dept): share desc, candidate asc; null shares ignored."""
    return W.top1(results, ["year", "dept_code"], [F.col("vote_share").desc(), F.col("candidate_name").asc()],
                  drop_null="vote_share")


def leader_matrix(results: DataFrame, years: Sequence[int], order: DataFrame | None = None) -> DataFrame:
    """Leader share % matrix, dept x year (explicit year columns)."""
    lead = leaders(results).withColumn("winner_share_pct", S.to_pct("vote_share"))
    return R.pivot_matrix(lead, "dept_code", "year", "winner_share_pct", years,
                          row_order=order if order is not None else dept_order(results))


def leader_cells(results: DataFrame, order: DataFrame | None = None) -> DataFrame:
    """D2 without a column per year: every (dept, year) cell of the matrix, empty ones too."""
    lead = leaders(results).withColumn("winner_share_pct", S.to_pct("vote_share"))
    m = R.sparse_matrix(lead, "dept_code", "year", "winner_share_pct", order if order is not None else dept_order(results))
    return R.sparse_cells(m, "dept_code", "year", "winner_share_pct", R.matrix_columns(lead, "year"))


def indicator_trend(values: DataFrame, code: str, order: DataFrame) -> DataFrame:
    """D3: one indicator over years for the driving areas (areas without turnout don't appear)."""
    rows = (values.where(F.col("indicator_code") == code)
            .select(S.geo_code("insee_code").alias("dept_code"), "year", "value"))
    return J.reindex(order, rows, "dept_code", drop_missing=["year"])


def latest_indicator(values: DataFrame, code: str, order: DataFrame) -> DataFrame:
    """The indicator at its latest year (global), reindexed on the dept order, missing dropped."""
    latest = W.latest_snapshot(values, "year", F.col("indicator_code") == code) \
        .select(S.geo_code("insee_code").alias("dept_code"), "year", "value")
    return J.reindex(order, latest, "dept_code", drop_missing=["value"])
