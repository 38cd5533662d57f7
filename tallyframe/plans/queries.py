"""Query keys: one callable (spark, sf_dir) -> DataFrame per operator of SURVEY §2.

Each query runs a library operator over proxy tables derived from the
given parquet tables (see ``proxy``), over whole tables and whole texts.
Computed columns carry the same names as in ``oracle.ORACLE``; shares are
compared as exact integer millionths.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import config as C
from ..config import JobConfig
from ..functions import scalars as S
from ..operators import aggregate as A
from ..operators import joins as J
from ..operators import linear as LIN
from ..operators import load as L
from ..operators import model as M
from ..operators import quality as Q
from ..operators import rank as W
from ..operators import reshape as R
from ..sources import readers
from ..sources.schema import discover_periods
from ..session import checkpoint_dir, cut_lineage
from . import dashboard as D
from . import election as EL
from . import indicators as IN
from . import proxy as P

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


ALL = JobConfig(target_codes=None)
SCOPED = JobConfig(target_codes=P.PROXY_TARGET_CODES)


def _key_cols():
    return ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


def _lineitem(spark, d):
    return P.table(spark, d, "lineitem")


def _lineitem_rows(spark, d, *cols):
    """Line items for row-wise scalar work."""
    return _lineitem(spark, d).select(*_key_cols(), *cols)


def _micro_results(spark, d):
    return P.results_micro(spark, d)


def _canonical_results(spark, d):
    return P.results(spark, d)


# ---------------------------------------------------------------- flagship
@query("leader_per_group")
def leader_per_group(spark, d):
    """Leading option per (yr, geo), ties broken by option name."""
    r = _micro_results(spark, d)
    top = W.top1(r, ["yr", "geo"], [F.col("votes").desc(), F.col("opt").asc()])
    return top.select("yr", "geo", "geo_name", "opt", "votes", "micro_share", "micro_turnout")


# ---------------------------------------------------------------- sources
@query("scan_union_by_year")
def scan_union_by_year(spark, d):
    """S1 + R6: orders landed once as one Parquet folder per year (in the shared checkpoint
    folder), then read back file by file with the year taken from the file map, unionByName."""
    root = _landed(spark, "orders")
    (P.table(spark, d, "orders").select(F.year("o_orderdate").alias("yr"), "o_orderkey", "o_totalprice")
     .write.partitionBy("yr").parquet(root))
    sheets = readers.read_wide_results(spark, {y: f"{root}/yr={y}" for y in P.years(spark, d)}, fmt="parquet")
    u = R.union_sources([df.select(F.lit(y).cast("bigint").alias("yr"), "o_orderkey", "o_totalprice")
                         for y, df in sheets.items()])
    return u.groupBy("yr").agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("decimal(18,2)").alias("total_price"))


def _landed(spark, what):
    return f"{checkpoint_dir(spark).rstrip('/')}/landed-{what}-{uuid.uuid4().hex}"


def _stations(spark, d):
    lines = P.station_lines(spark, d)
    return readers.parse_station_lines(lines, P.STATION_HEADER)


@query("scan_station_rows")
def scan_station_rows(spark, d):
    """Station files, landed once in the shared folder, read back -> prefix fields + token count."""
    path = _landed(spark, "stations")
    (P.station_lines(spark, d).select(F.col("line").alias(";".join(P.STATION_HEADER)))
     .write.option("header", True).option("sep", "\u0001").option("quote", "").option("encoding", "ISO-8859-1").csv(path))
    s = readers.read_station_file(spark, path)
    return s.select(S.normalize_area_code("dept_raw").alias("dept_code"),
                    S.ustrip("commune_raw").alias("commune"), S.ustrip("bureau_raw").alias("bureau"),
                    S.parse_int_fr("registered_raw").alias("registered"),
                    S.parse_int_fr("cast_raw").alias("votes_cast"),
                    S.parse_int_fr("valid_raw").alias("votes_valid"),
                    F.size("tokens").cast("bigint").alias("n_tokens"))


@query("explode_groups")
def explode_groups(spark, d):
    """R3 + P4: repeated 7-field groups -> rows; blank panels skipped."""
    s = _stations(spark, d)
    g = R.explode_groups(s, "tokens", F.col("group_start"), C.STATION_GROUP_STRIDE,
                         {"panel": 0, "last_name": 2, "votes_raw": 4}, ids=["bureau_raw"],
                         keep=lambda x: S.ustrip(x["panel"]) != "")
    return g.select(F.col("bureau_raw").alias("bureau"), F.col("panel"),
                    S.canonical_label("last_name").alias("candidate_name"),
                    S.parse_int_fr("votes_raw").alias("votes"))


def _station_results(spark, d):
    return EL.extract_station_rows(spark, _stations(spark, d), 2017, ALL, departments=P.departments(spark, d))


@query("rollup_station_totals")
def rollup_station_totals(spark, d):
    """A1: header totals once per (dept, commune, bureau), summed per dept; first-seen name."""
    s = _stations(spark, d)
    df = (s.withColumn("dept_code", S.normalize_area_code("dept_raw"))
          .join(P.departments(spark, d).withColumnRenamed("dept_name", "ref_name"), "dept_code", "left")
          .withColumn("dept_name", S.coalesce_name("name_raw", "ref_name", "dept_code"))
          .withColumn("registered", F.coalesce(S.parse_int_fr("registered_raw"), F.lit(0)))
          .withColumn("votes_cast", F.coalesce(S.parse_int_fr("cast_raw"), F.lit(0)))
          .withColumn("votes_valid", F.coalesce(S.parse_int_fr("valid_raw"), F.lit(0))))
    return A.rollup_headers(df, ["dept_code", "commune_raw", "bureau_raw"], "dept_code", "ordinal",
                            ["registered", "votes_cast", "votes_valid"], name="dept_name")


@query("rollup_candidate_votes")
def rollup_candidate_votes(spark, d):
    """A2: candidate votes summed over all station rows (duplicates included)."""
    r = _station_results(spark, d)
    return r.select("dept_code", "candidate_name", "votes")


@query("share_of_total")
def share_of_total(spark, d):
    """J2 + F9: candidate votes joined to de-duplicated totals, guarded ratios."""
    r = _station_results(spark, d)
    return r.select("dept_code", "candidate_name", "votes", "votes_valid",
                    S.to_micro("vote_share").alias("micro_share"),
                    S.to_micro("turnout_rate").alias("micro_turnout"))


@query("scan_indicator_filter")
def scan_indicator_filter(spark, d):
    """S3 + F2 + P1: indicator file, landed once, read back, area code normalized, target scope kept."""
    path = _landed(spark, "indicators")
    (P.indicator_sheet(spark, d).drop("ordinal").write.option("header", True).option("sep", ";")
     .option("encoding", "ISO-8859-1").option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    w = IN.scope_indicator_rows(readers.read_indicator_file(spark, path), SCOPED)
    return _cells(w.drop("ordinal"), ["codgeo", "variable", "sous_champ"], "period", "raw")


@query("scope_filter")
def scope_filter(spark, d):
    """Results restricted to the target area codes."""
    r = _canonical_results(spark, d)
    return r.where(F.col("dept_code").isin(list(P.PROXY_TARGET_CODES))) \
        .select(F.col("year").cast("bigint").alias("yr"), "dept_code", "candidate_name", "votes")


def _cells(matrix, ids, column, value):
    """Every cell of a matrix whose columns come from the data, empty cells included."""
    return matrix.unpivot(ids, [c for c in matrix.columns if c not in ids], column, value)


def _specs(spark):
    return IN.with_spec_order(readers.spec_tables(spark)["indicator_specs"])


@query("series_select")
def series_select(spark, d):
    """Spec rows (null-safe sub-field, stripped) selected by one broadcast join."""
    rows = P.indicator_sheet(spark, d).withColumn("codgeo", S.normalize_area_code("codgeo"))
    sel = IN.select_series(rows, _specs(spark))
    ids = ["indicator_code", "codgeo", "sous_champ"]
    return _cells(sel.select(*ids, *discover_periods(sel.columns)), ids, "period", "raw")


@query("empty_specs")
def empty_specs(spark, d):
    """P2 warning path: specs that select no row."""
    rows = P.indicator_sheet(spark, d).withColumn("codgeo", S.normalize_area_code("codgeo"))
    specs = _specs(spark)
    return IN.empty_specs(IN.select_series(rows, specs), specs).select("indicator_code", "variable")


@query("unpivot_periods")
def unpivot_periods(spark, d):
    """R4 + F18 + F4: A<yyyy> columns -> (year, value), empty cells dropped."""
    w = P.indicator_sheet(spark, d)
    long = R.melt_periods(w, ["codgeo", "variable", "sous_champ"], discover_periods(w.columns))
    long = long.withColumn("value", S.parse_float_fr("raw")).where(F.col("value").isNotNull())
    return long.select("codgeo", "variable", "sous_champ", F.col("year").cast("bigint").alias("year"),
                       F.col("value").cast("decimal(18,2)").alias("value"))


def _indicator_values(spark, d, cfg=ALL):
    return IN.extract_values(P.indicator_sheet(spark, d), _specs(spark), "ordinal", cfg)


@query("dedupe_indicator_values")
def dedupe_indicator_values(spark, d):
    """W3 on the indicator frame: keep-last per (indicator, geo, year) by (spec, row) order."""
    v = _indicator_values(spark, d)
    return v.select("indicator_code", "insee_code", F.col("year").cast("bigint").alias("year"),
                    F.col("value").cast("decimal(18,2)").alias("value"), "source_file")


@query("asof_align")
def asof_align(spark, d):
    """J3 + F15: backward as-of onto the target calendar, carried rows tagged."""
    a = IN.align_values(_indicator_values(spark, d), P.PROXY_CALENDAR)
    return a.select("indicator_code", "insee_code", F.col("year").cast("bigint").alias("year"),
                    F.col("value").cast("decimal(18,2)").alias("value"), "source_file")


@query("asof_join_tables")
def asof_join_tables(spark, d):
    """Backward as-of join of two large tables: each line item's customer, latest order on or
    before the ship date (ties on a date: highest order key)."""
    o = P.table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = _lineitem(spark, d).select(*_key_cols(), "l_shipdate")
    probes = li.join(o.select("o_orderkey", F.col("o_custkey").alias("custkey")),
                     li.l_orderkey == o.o_orderkey).drop("o_orderkey")
    right = W.dedupe_last(o.withColumnRenamed("o_custkey", "custkey"), ["custkey", "o_orderdate"],
                          ["o_orderkey"])
    out = J.asof_join(probes, right, ["custkey"], "l_shipdate", "o_orderdate", ["o_orderkey"],
                      bucket=F.year("l_shipdate"), right_bucket=F.year("o_orderdate"),
                      matched_time="prev_orderdate")
    return out.select(*_key_cols(), F.col("o_orderkey").alias("prev_orderkey"), "prev_orderdate")


# ---------------------------------------------------------------- scalars
@query("normalize_key")
def normalize_key(spark, d):
    """F1 over whole document texts."""
    doc = P.table(spark, d, "documents").select("doc_id", "text")
    return doc.select("doc_id", S.normalize_key("text").alias("norm_key"))


@query("canonical_label")
def canonical_label(spark, d):
    """F6 over whole document texts turned into column labels (_VOIX / _exp suffix)."""
    doc = P.table(spark, d, "documents").select("doc_id", "text")
    label = F.concat(F.translate("text", " ", "_"),
                     F.when(F.col("doc_id") % 2 == 0, F.lit("_VOIX")).otherwise(F.lit("_exp")))
    return doc.select("doc_id", S.canonical_label(label).alias("label"))


def _dirty(spark, d, k):
    li = _lineitem_rows(spark, d, "l_quantity")
    q = F.col("l_quantity").cast("bigint")
    v = F.pmod(q + F.col("l_linenumber"), F.lit(k))
    return li, q, v


@query("normalize_area_code")
def normalize_area_code(spark, d):
    """F2 over generated dirty codes ('7', '7.0', '007', blank, '7a', ' 7.9 ')."""
    li, q, v = _dirty(spark, d, 6)
    qs = q.cast("string")
    raw = (F.when(v == 0, qs).when(v == 1, F.concat(qs, F.lit(".0")))
           .when(v == 2, F.concat(F.lit("0"), qs)).when(v == 3, F.repeat(F.lit(" "), F.col("l_linenumber") % 3))
           .when(v == 4, F.concat(qs, F.lit("a"))).otherwise(F.concat(F.lit(" "), qs, F.lit(".9 "))))
    return li.select(*_key_cols(), S.normalize_area_code(raw).alias("code"))


@query("parse_localized_int")
def parse_localized_int(spark, d):
    """F3 over generated localized integers (',5' halves, no-break spaces, '%', 'n/a')."""
    li, q, v = _dirty(spark, d, 5)
    qs = q.cast("string")
    raw = (F.when(v == 0, F.concat(qs, F.lit(",5")))
           .when(v == 1, F.concat(F.lit("1\u00a0"), F.lpad(qs, 3, "0")))
           .when(v == 2, F.concat(qs, F.lit(" %"))).when(v == 3, F.lit("n/a"))
           .otherwise(F.concat(qs, F.lit("00"))))
    return li.select(*_key_cols(), S.parse_int_fr(raw).alias("value"))


@query("parse_localized_float")
def parse_localized_float(spark, d):
    """F4 over generated localized floats (',25', narrow no-break spaces, '%', exponent)."""
    li, q, v = _dirty(spark, d, 4)
    qs = q.cast("string")
    raw = (F.when(v == 0, F.concat(qs, F.lit(",25")))
           .when(v == 1, F.concat(F.lit("1\u202f"), F.lpad(qs, 3, "0"), F.lit(",5")))
           .when(v == 2, F.concat(qs, F.lit("%"))).otherwise(F.concat(F.lit("-"), qs, F.lit("e1"))))
    return li.select(*_key_cols(), S.parse_float_fr(raw).alias("value"))


@query("parse_ratio")
def parse_ratio(spark, d):
    """French percent text of the extended price -> ratio (always / 100), 6 decimals."""
    li = _lineitem_rows(spark, d, "l_extendedprice")
    txt = F.concat(F.translate(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"), ".", ","),
                   F.lit(" %"))
    return li.select(*_key_cols(), S.parse_ratio_fr(txt).cast("decimal(18,6)").alias("ratio"))


@query("turnout_rate")
def turnout_rate(spark, d):
    """F9 + F10: cast / registered per (yr, geo), guarded, 6 decimals."""
    t = P.totals(spark, d)
    return t.select("yr", "geo", S.to_micro(S.turnout("cast_n", "eligible")).alias("micro_turnout"))


@query("turnout_rate_scaled")
def turnout_rate_scaled(spark, d):
    """F9 on counts a million times as large: exact where doubles and 64-bit products are not."""
    t = P.totals(spark, d)
    big = F.lit(1000000)
    return t.select("yr", "geo", S.micro_ratio(F.col("cast_n") * big + 1, F.col("eligible") * big + 7).alias("micro_turnout"))


@query("abstention_rate")
def abstention_rate(spark, d):
    """1 - turnout."""
    t = P.totals(spark, d)
    return t.select("yr", "geo",
                    S.to_micro(S.abstention(S.turnout("cast_n", "eligible"))).alias("micro_abstention"))


def _holed_results(spark, d):
    """results with votes missing where votes % 3 = 0 and shares missing where votes % 5 = 0."""
    r = _micro_results(spark, d)
    return r.select("yr", "geo", "opt", "valid",
                    F.when(F.col("votes") % 3 != 0, F.col("votes")).alias("votes_in"),
                    F.when(F.col("votes") % 5 != 0, F.col("micro_share") / F.lit(1000000.0)).alias("share_in"))


@query("backfill_votes_share")
def backfill_votes_share(spark, d):
    """F12 + P3: share <- votes/valid, then votes <- round(valid*share), rows without share dropped."""
    h = _holed_results(spark, d)
    h = h.withColumn("share", S.backfill_share("votes_in", "valid", "share_in"))
    h = h.withColumn("votes", S.backfill_votes("votes_in", "valid", "share"))
    return h.where(F.col("share").isNotNull()).select(
        "yr", "geo", "opt", "votes", S.to_micro("share").alias("micro_share"))


@query("name_fallback")
def name_fallback(spark, d):
    """name -> looked-up name -> code."""
    c = P.table(spark, d, "customer")
    name = (F.when(F.col("c_custkey") % 7 == 0, F.lit(" ")).when(F.col("c_custkey") % 11 == 0, F.lit(None))
            .otherwise(F.col("c_name")))
    dims = P.departments(spark, d).where(~F.col("dept_name").endswith("3"))
    x = c.select("c_custkey", name.alias("name"), S.code2("c_nationkey").alias("dept_code"))
    x = x.join(dims, "dept_code", "left")
    return x.select("c_custkey", S.coalesce_name("name", "dept_name", "dept_code").alias("display_name"))


@query("lookup_by_normalized_name")
def lookup_by_normalized_name(spark, d):
    """Area code by normalized (mangled) name; unmatched -> null."""
    c = P.table(spark, d, "customer").select("c_custkey", "c_nationkey")
    n = P.table(spark, d, "nation").select("n_nationkey", "n_name")
    k = F.pmod(F.col("c_custkey"), F.lit(4))
    mangled = (F.when(k == 0, F.lower("n_name")).when(k == 1, F.translate("n_name", "_", " "))
               .when(k == 2, F.concat(F.lit(" "), F.regexp_replace("n_name", "NATION", "Nätion"), F.lit("!")))
               .otherwise(F.concat("n_name", F.lit("_X"))))
    x = c.join(n, c.c_nationkey == n.n_nationkey).select("c_custkey", mangled.alias("mangled"))
    return J.lookup_code_by_name(x, "mangled", P.name_lookup(spark, d), out_col="code")


@query("geo_key_roundtrip")
def geo_key_roundtrip(spark, d):
    """Code -> 5-character geo key -> code."""
    c = P.table(spark, d, "customer")
    g = c.select("c_custkey", S.geo_key(S.code2("c_nationkey")).alias("insee_code"))
    return g.select("c_custkey", "insee_code", S.geo_code("insee_code").alias("dept_code"))


@query("storage_decimal")
def storage_decimal(spark, d):
    """6-decimal share -> decimal(6,5) storage."""
    r = _canonical_results(spark, d)
    return r.select(F.col("year").cast("bigint").alias("yr"), "dept_code", "candidate_name",
                    S.to_storage_share("vote_share").alias("share_5dp"))


def _election_dates(spark, d):
    """Proxy election date per year: the first order date of the year."""
    o = P.table(spark, d, "orders")
    return o.groupBy(F.year("o_orderdate").alias("year")).agg(
        F.min(F.col("o_orderdate").cast("date")).alias("election_date"))


@query("election_dim")
def election_dim(spark, d):
    """F19 + L1: year -> (type, date, round, scope) natural key -> surrogate id."""
    inc = _election_dates(spark, d).select(
        F.lit(C.ELECTION_TYPE).alias("election_type"), "election_date",
        F.lit(C.ELECTION_ROUND).cast("smallint").alias("round"), F.lit(C.ELECTION_SCOPE).alias("scope"))
    empty = inc.where(F.lit(False)).withColumn("election_id", F.lit(None).cast("bigint"))
    nk = ["election_type", "election_date", "round", "scope"]
    dim = L.assign_keys(empty, inc, ["election_date", "election_type", "round", "scope"], "election_id")
    return dim.select("election_id", *nk)


# ---------------------------------------------------------------- reshape
@query("unpivot_pairs")
def unpivot_pairs(spark, d):
    """R1 + H2/H3 + F2/F3/F5 + F9: layout-A sheet (x_VOIX / x_EXP) -> canonical rows."""
    sheet = P.sheet_layout_a(spark, d)
    r = EL.extract_wide_sheet(spark, sheet, "yr", ALL, departments=P.departments(spark, d))
    return r.select(F.col("year").cast("bigint").alias("yr"), "dept_code", "candidate_name", "votes",
                    S.to_micro("vote_share").alias("micro_share"), S.to_micro("turnout_rate").alias("micro_turnout"))


@query("unpivot_measures")
def unpivot_measures(spark, d):
    """R2 + H4 + J1: layout-B sheet (share-only columns, names only) -> rows, votes derived."""
    sheet = P.sheet_layout_b(spark, d)
    r = EL.extract_wide_sheet(spark, sheet, "yr", ALL, aliases=P.name_lookup(spark, d),
                              departments=P.departments(spark, d))
    return r.select(F.col("year").cast("bigint").alias("yr"), "dept_code", "dept_name", "candidate_name",
                    "votes_valid", "votes", S.to_micro("vote_share").alias("micro_share"),
                    S.to_micro("turnout_rate").alias("micro_turnout"))


@query("pivot_matrix")
def pivot_matrix(spark, d):
    """Valid votes matrix, area x year, in sparse rows, as cells (empty ones too)."""
    t = P.totals(spark, d).select(S.code2("geo").alias("dept_code"), F.col("yr").cast("string").alias("yr"), "valid")
    return R.sparse_cells(R.sparse_matrix(t, "dept_code", "yr", "valid"), "dept_code", "yr", "valid", R.matrix_columns(t, "yr"))


@query("pivot_matrix_wide")
def pivot_matrix_wide(spark, d):
    """The same matrix with a column for each year in the data, as cells."""
    t = P.totals(spark, d).select(S.code2("geo").alias("dept_code"), "yr", "valid")
    m = R.pivot_matrix(t, "dept_code", "yr", "valid", P.years(spark, d))
    return _cells(m, ["dept_code"], "yr", "valid")


@query("pivot_matrix_sparse")
def pivot_matrix_sparse(spark, d):
    """R5 with a column for each part: line-item quantity, order year x part, in sparse rows, as filled cells."""
    li = _lineitem(spark, d).select("l_partkey", F.year("l_shipdate").alias("yr"), F.col("l_quantity").cast("bigint").alias("q"))
    t = li.groupBy("yr", "l_partkey").agg(F.sum("q").alias("q"))
    cells = R.sparse_cells(R.sparse_matrix(t, "yr", "l_partkey", "q"), "yr", "l_partkey", "q")
    return cells.select(F.col("yr").cast("bigint").alias("yr"), "l_partkey", "q")


# ---------------------------------------------------------------- aggregations
def _doubled_results(spark, d):
    """Canonical results plus partial duplicates: a second copy of each row with
    votes null and a halved share; votes null in both copies where votes % 7 = 0."""
    r = _canonical_results(spark, d)
    v = F.when(F.col("votes") % 7 != 0, F.col("votes"))
    a = r.withColumn("votes", v)
    b = r.withColumn("votes", F.lit(None).cast("bigint")).withColumn("vote_share", F.col("vote_share") / 2) \
        .withColumn("registered", F.lit(None).cast("bigint"))
    return a.unionByName(b)


@query("collapse_duplicates")
def collapse_duplicates(spark, d):
    """A3 + A4: duplicates collapsed (max/sum), shares recomputed from counts."""
    f = EL.finalize_results(_doubled_results(spark, d))
    return f.select(F.col("year").cast("bigint").alias("yr"), "dept_code", "candidate_name", "registered",
                    "votes_valid", "votes", S.to_micro("vote_share").alias("micro_share"))


@query("sum_min_count")
def sum_min_count(spark, d):
    """A5: sum that stays null when every input is null."""
    c = A.collapse_results(_doubled_results(spark, d))
    return c.select(F.col("year").cast("bigint").alias("yr"), "dept_code", "candidate_name", "votes")


@query("recompute_share")
def recompute_share(spark, d):
    """A4: source share overridden by votes / valid where both exist."""
    r = _canonical_results(spark, d).withColumn(
        "vote_share", F.when(F.col("votes") % 2 == 0, F.lit(0.5)).otherwise(F.col("vote_share")))
    r = r.withColumn("votes", F.when(F.col("votes") % 9 != 0, F.col("votes")))
    out = A.recompute_share(r)
    return out.select(F.col("year").cast("bigint").alias("yr"), "dept_code", "candidate_name",
                      S.to_micro("vote_share").alias("micro_share"))


@query("run_stats")
def run_stats(spark, d):
    """Rows, distinct areas, min/max year, number of years."""
    r = _canonical_results(spark, d)
    s = A.run_stats(r, "dept_code", "year")
    return s.select("n_rows", "n_keys", F.col("min_period").cast("bigint").alias("min_period"),
                    F.col("max_period").cast("bigint").alias("max_period"), "n_periods")


@query("distinct_sorted")
def distinct_sorted(spark, d):
    """Sorted distinct years."""
    r = _canonical_results(spark, d)
    return A.distinct_sorted(r.select(F.col("year").cast("bigint").alias("yr")), "yr")


@query("describe_by_group")
def describe_by_group(spark, d):
    """Descriptive statistics of votes per area (quantized to 1/1000)."""
    r = _canonical_results(spark, d)
    s = A.describe_by(r, ["dept_code"], "votes")

    def milli(c):
        return F.round(F.col(c) * 1000).cast("bigint").alias(f"{c}_milli")

    return s.select("dept_code", "n", milli("mean"), milli("stddev"), F.col("min").alias("min_votes"),
                    milli("median"), F.col("max").alias("max_votes"))


@query("describe_by_area_election")
def describe_by_area_election(spark, d):
    """A9 per department and election."""
    r = _canonical_results(spark, d)
    s = A.describe_by(r, ["dept_code", "year"], "votes")
    return s.select("dept_code", F.col("year").cast("bigint").alias("yr"), "n", F.round(F.col("mean") * 1000).cast("bigint").alias("mean_milli"),
                    F.round(F.col("median") * 1000).cast("bigint").alias("median_milli"),
                    F.col("min").alias("min_votes"), F.col("max").alias("max_votes"))


@query("histogram")
def histogram(spark, d):
    """A10: votes in 10 bins of 50 over [0, 500), overflow bin 11."""
    r = _canonical_results(spark, d)
    return A.histogram(r, "votes", 10, 0.0, 500.0).select(F.col("bin").cast("bigint").alias("bin"), "n")


@query("indicator_correlation")
def indicator_correlation(spark, d):
    """Correlation of turnout with vote share per option (round(corr*1e6))."""
    r = _canonical_results(spark, d)
    c = A.correlate(r, ["turnout_rate"], "vote_share", by=["candidate_name"])
    return c.select("candidate_name", "n",
                    F.round(F.col("corr_turnout_rate") * 1000000).cast("bigint").alias("corr_micro"))


@query("indicator_correlations")
def indicator_correlations(spark, d):
    """Correlation of every indicator with the vote share, per option (round(corr*1e4))."""
    codes = [s[0] for s in C.INDICATOR_SPECS]
    f = _features(spark, d).withColumn("share", F.col("micro_share") / F.lit(1000000.0))
    pairs = f.unpivot(["opt", "share"], [F.col(c).cast("double").alias(c) for c in codes], "indicator_code", "value") \
        .where(F.col("value").isNotNull())
    c = A.correlate(pairs, ["value"], "share", by=["opt", "indicator_code"])
    return c.select("opt", "indicator_code", "n", F.round(F.nanvl("corr_value", F.lit(None)) * 10000).cast("bigint").alias("corr_e4"))


# ---------------------------------------------------------------- windows
@query("dedupe_keep_last")
def dedupe_keep_last(spark, d):
    """Keep-last per (l_orderkey, l_linenumber) by (shipdate, partkey, suppkey)."""
    li = _lineitem(spark, d).select(*_key_cols(), "l_shipdate")
    out = W.dedupe_last(li, ["l_orderkey", "l_linenumber"], ["l_shipdate", "l_partkey", "l_suppkey"])
    return out.select(*_key_cols())


def _holed_turnout(spark, d):
    r = _canonical_results(spark, d)
    return r.withColumn("turnout_rate", F.when(F.col("votes") % 4 != 0, F.col("turnout_rate")))


@query("dropna_subset")
def dropna_subset(spark, d):
    """P5: rows with a null turnout dropped."""
    r = _holed_turnout(spark, d).na.drop(subset=["turnout_rate"])
    return r.select(F.col("year").cast("bigint").alias("yr"), "dept_code", "candidate_name",
                    S.to_micro("turnout_rate").alias("micro_turnout"))


@query("first_non_null_per_key")
def first_non_null_per_key(spark, d):
    """First non-null turnout per (year, area) in (name, candidate) order."""
    first = W.first_per_key(_holed_turnout(spark, d), ["year", "dept_code"], "turnout_rate",
                            ["dept_name", "candidate_name"])
    return first.select(F.col("year").cast("bigint").alias("yr"), "dept_code", "candidate_name",
                        S.to_micro("turnout_rate").alias("micro_turnout"))


@query("lag_features")
def lag_features(spark, d):
    """Previous year's votes and change per (area, option)."""
    r = _micro_results(spark, d)
    h = W.with_history(r.select("yr", "geo", "opt", "votes"), ["geo", "opt"], "yr", ["votes"],
                       bucket=(F.col("yr") / 3).cast("bigint"))
    return h.select("yr", "geo", "opt", "votes", "votes_lag1", "votes_change")


# ---------------------------------------------------------------- joins / keys
@query("resolve_indicator_key")
def resolve_indicator_key(spark, d):
    """Indicator id by code from a catalogue that lacks one code; unmatched rows skipped."""
    specs = [s for s in C.INDICATOR_SPECS if s[0] != "poverty_rate"]
    cat = spark.createDataFrame([(i + 1, s[0]) for i, s in enumerate(specs)], "indicator_id bigint, code string")
    matched, _ = J.resolve_keys(_indicator_values(spark, d), F.broadcast(cat), "indicator_code", "code",
                                "indicator_id")
    return matched.select("indicator_id", "insee_code", F.col("year").cast("bigint").alias("year"),
                          F.col("value").cast("decimal(18,2)").alias("value"))


def _party_rows(spark, d):
    """Party rows, written once: key assignment reads them several times."""
    r = cut_lineage(_micro_results(spark, d).select("yr", "geo", "opt"))
    g3 = (F.col("geo") % 3).cast("string")
    party = (F.when(F.col("geo") % 2 == 0, F.lit(None).cast("string"))
             .when(F.col("yr") >= 2000, F.concat(F.lit("Q"), g3)).otherwise(F.concat(F.lit("P"), g3)))
    return r.select("yr", "geo", F.col("opt").alias("candidate_name"), party.alias("party_code"))


@query("null_safe_join")
def null_safe_join(spark, d):
    """(name, party) natural key matched with NULL = NULL."""
    rows = _party_rows(spark, d)
    empty = rows.select("candidate_name", "party_code").where(F.lit(False)) \
        .withColumn("candidate_id", F.lit(None).cast("bigint"))
    dim = L.assign_keys(empty, rows, ["candidate_name", "party_code"], "candidate_id")
    out = J.null_safe_join(rows, dim, ["candidate_name", "party_code"], "inner")
    return out.select("yr", "geo", "candidate_name", "party_code", "candidate_id")


@query("assign_surrogate_keys")
def assign_surrogate_keys(spark, d):
    """L1: get-or-create candidate ids: current = years <= 1997, incoming = years >= 1997."""
    rows = _party_rows(spark, d)
    nk = ["candidate_name", "party_code"]
    cur_src = rows.where(F.col("yr") <= 1997).select(*nk).distinct()
    empty = cur_src.where(F.lit(False)).withColumn("candidate_id", F.lit(None).cast("bigint"))
    current = L.assign_keys(empty, cur_src, nk, "candidate_id")
    nxt = L.assign_keys(current, rows.where(F.col("yr") >= 1997), nk, "candidate_id")
    return nxt.select("candidate_id", *nk)


def _customers(spark, d):
    return P.table(spark, d, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")


@query("insert_ignore")
def insert_ignore(spark, d):
    """L2: first write wins (current = customers with balance >= 0; incoming = all, renamed)."""
    c = _customers(spark, d)
    cur = c.where(F.col("c_acctbal") >= 0).select("c_custkey", F.col("c_name").alias("name"))
    inc = c.select("c_custkey", F.lower("c_name").alias("name"))
    return L.insert_ignore(cur, inc, ["c_custkey"])


@query("upsert")
def upsert(spark, d):
    """L3: last write wins (incoming = two market segments with new names)."""
    c = _customers(spark, d)
    cur = c.where(F.col("c_acctbal") >= 0).select("c_custkey", F.col("c_name").alias("name"))
    inc = c.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")) \
        .select("c_custkey", F.lower("c_name").alias("name"))
    return L.upsert(cur, inc, ["c_custkey"])


@query("replace_slice")
def replace_slice(spark, d):
    """L4: delete (incoming years x target areas), insert incoming (years >= 1998, votes + 1)."""
    r = _canonical_results(spark, d).select(F.col("year").cast("bigint").alias("yr"), "dept_code",
                                            "candidate_name", "votes")
    cur = r.where(F.col("yr") <= 1999)
    inc = r.where((F.col("yr") >= 1998) & F.col("dept_code").isin(list(P.PROXY_TARGET_CODES))) \
        .withColumn("votes", F.col("votes") + 1)
    slice_keys = inc.select("yr").distinct().select(
        "yr", F.explode(F.array(*[F.lit(c) for c in P.PROXY_TARGET_CODES])).alias("dept_code"))
    return L.replace_slice(cur, inc, slice_keys)


@query("turnout_indicator")
def turnout_indicator(spark, d):
    """First turnout per (year, area) -> indicator_value rows, upserted over stale values."""
    t = D.turnout_rows(_canonical_results(spark, d))
    inc = t.select(S.geo_key("dept_code").alias("insee_code"), F.col("year").cast("bigint").alias("year"),
                   F.col("turnout_rate").alias("value"), F.lit(C.TURNOUT_SOURCE_FILE).alias("source_file"))
    cur = (inc.where(F.col("year") <= 1997).withColumn("year", F.col("year") - 10)
           .unionByName(inc.where(F.col("year") <= 1997))
           .withColumn("value", F.lit(0.0)).withColumn("source_file", F.lit("old")))
    nxt = L.upsert(cur, inc, ["insee_code", "year"])
    return nxt.select("insee_code", "year", S.to_micro("value").alias("micro_value"), "source_file")


@query("reindex_left")
def reindex_left(spark, d):
    """D5 + J6: area order (areas having turnout) drives a left join; missing -> null."""
    order = D.dept_order(_canonical_results(spark, d))
    v = _indicator_values(spark, d, SCOPED).where(
        (F.col("indicator_code") == "unemployment_rate") & (F.col("year") == 2001))
    x = v.select(S.geo_code("insee_code").alias("dept_code"), F.col("value").cast("decimal(18,2)").alias("value"))
    return J.reindex(order, x, "dept_code")


def _suppliers_geo(spark, d):
    s = P.table(spark, d, "supplier").where(F.col("s_acctbal") > 5000)
    return s.select(S.geo_key(S.code2("s_nationkey")).alias("insee_code")).distinct()


@query("fk_violations")
def fk_violations(spark, d):
    """Result rows whose area has no geo row."""
    r = _canonical_results(spark, d).select(F.col("year").cast("bigint").alias("yr"),
                                            S.geo_key("dept_code").alias("insee_code"), "candidate_name")
    return L.fk_violations(r, _suppliers_geo(spark, d), ["insee_code"])


@query("pk_violations")
def pk_violations(spark, d):
    """Duplicated (l_orderkey, l_linenumber) keys."""
    return L.pk_violations(_lineitem(spark, d), ["l_orderkey", "l_linenumber"])


@query("unique_violations")
def unique_violations(spark, d):
    """Natural keys (name, party; null equals null) held by more than one row."""
    return L.unique_violations(_party_rows(spark, d), ["candidate_name", "party_code"])


@query("null_violations")
def null_violations(spark, d):
    """Null counts of NOT NULL columns on a holed results frame."""
    h = _holed_results(spark, d)
    return L.null_violations(h, ["votes_in", "share_in", "opt"])


# ---------------------------------------------------------------- dashboard
@query("turnout_trend")
def turnout_trend(spark, d):
    """Turnout % by area over years, labelled `code - name`."""
    t = D.turnout_trend(_canonical_results(spark, d))
    return t.select("dept_code", F.col("year").cast("bigint").alias("year"),
                    F.round(F.col("turnout_pct") * 10000).cast("bigint").alias("micro_pct_turnout"), "label")


@query("leader_matrix")
def leader_matrix(spark, d):
    """Leader share % matrix, area x year, as cells."""
    cells = D.leader_cells(cut_lineage(_canonical_results(spark, d)))
    return cells.select("dept_code", F.col("year").cast("string").alias("yr"),
                        F.round(F.col("winner_share_pct") * 10000).cast("bigint").alias("micro_share"))


def _aligned_indicators(spark, d):
    return IN.align_values(_indicator_values(spark, d), P.years(spark, d))


@query("indicator_trend")
def indicator_trend(spark, d):
    """D3: one indicator by area over years."""
    t = D.indicator_trend(_aligned_indicators(spark, d), "unemployment_rate", D.dept_order(_canonical_results(spark, d)))
    return t.select("dept_code", F.col("year").cast("bigint").alias("year"),
                    F.col("value").cast("decimal(18,2)").alias("value"))


@query("latest_snapshot")
def latest_snapshot(spark, d):
    """D4 + W4: indicator at its latest year, reindexed on the area order, missing dropped."""
    r = _canonical_results(spark, d)
    s = D.latest_indicator(_indicator_values(spark, d), "poverty_rate", D.dept_order(r))
    return s.select("dept_code", F.col("year").cast("bigint").alias("year"),
                    F.col("value").cast("decimal(18,2)").alias("value"))


# ---------------------------------------------------------------- quality
@query("quality_report")
def quality_report(spark, d):
    """Q1: rows, duplicate keys, nulls and bound violations in one pass."""
    h = _holed_results(spark, d)
    return Q.quality_counts(h, ["yr", "geo"], ["votes_in", "share_in"], {"share_in": (0.0, 0.1)})


QUALITY_RULES = [
    Q.unique("votes_differ", "yr", "geo", "votes"), Q.not_null("share_present", "share"), Q.bounds("share_range", "share", 30_000, 50_000),
    Q.complete("share_filled", "share", 0.85), Q.ordered("counts_ordered", "votes", "valid", "cast_n", "eligible"),
    Q.adds_up("votes_add_up", ["yr", "geo"], "votes", "valid"), Q.traced("has_source", "source"),
]


def _flawed_results(spark, d):
    """Results with holes, too many votes and blank sources."""
    r = _micro_results(spark, d)
    return r.select("yr", "geo", "opt", "valid", "cast_n", "eligible",
                    F.when(F.col("votes") % 11 == 0, F.col("valid") + 1).otherwise(F.col("votes")).alias("votes"),
                    F.when(F.col("votes") % 5 != 0, F.col("micro_share")).alias("share"),
                    F.when(F.col("geo") == 3, F.lit(" ")).when(F.col("geo") != 5, F.col("geo_name")).alias("source"))


@query("quality_rules")
def quality_rules(spark, d):
    """Q1: a report of rules of all six kinds from one scan."""
    return Q.quality_report(_flawed_results(spark, d), QUALITY_RULES)


@query("quality_violations")
def quality_violations(spark, d):
    """Q1: the rows and groups behind the report."""
    v = Q.violations(_flawed_results(spark, d), QUALITY_RULES, ["yr", "geo", "opt"])
    return v.select("rule", "kind", F.array_join("key", "|").alias("key"), "n")


@query("quality_bounds")
def quality_bounds(spark, d):
    """Q1 bounds per year: shares above 10 % and turnouts outside [40 %, 80 %]."""
    r = _canonical_results(spark, d)
    return r.groupBy(F.col("year").cast("bigint").alias("yr")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(F.col("vote_share") > 0.1).alias("share_high"),
        F.count_if((F.col("turnout_rate") < 0.4) | (F.col("turnout_rate") > 0.8)).alias("turnout_out"))


@query("quality_coherence")
def quality_coherence(spark, d):
    """Q1: votes <= valid <= cast <= registered per row, votes summing to valid per area, per year."""
    r = _micro_results(spark, d).withColumn("votes", F.when(F.col("votes") % 11 == 0, F.col("valid") + 1).otherwise(F.col("votes")))
    return Q.coherence(r, ["yr", "geo"], "votes", ["valid", "cast_n", "eligible"], by=["yr"])


@query("completeness")
def completeness(spark, d):
    """Q1: share of filled cells per column and year."""
    return Q.completeness(_holed_results(spark, d), ["votes_in", "share_in", "opt"], by=["yr"])


@query("traceability")
def traceability(spark, d):
    """Q1: indicator values without a lineage label (blanked for two areas), per indicator."""
    v = _indicator_values(spark, d).withColumn(
        "source_file", F.when(F.col("insee_code") == "03000", F.lit(" ")).when(F.col("insee_code") != "05000", F.col("source_file")))
    return Q.traceability(v, "source_file", by=["indicator_code"])


@query("coverage_gaps")
def coverage_gaps(spark, d):
    """Q2: (indicator, area) x order year cells with no value."""
    v = _indicator_values(spark, d).withColumn("key", F.concat_ws("|", "indicator_code", "insee_code"))
    gaps = Q.coverage(v, "key", "year", P.years(spark, d))
    return gaps.select(F.split("key", r"\|")[0].alias("indicator_code"),
                       F.split("key", r"\|")[1].alias("insee_code"), F.col("year").cast("bigint").alias("year"))


# ---------------------------------------------------------------- modelling
def _features(spark, d):
    r = _micro_results(spark, d).withColumn("insee_code", S.geo_key(S.code2("geo"))) \
        .withColumn("year", F.col("yr").cast("int"))
    codes = [s[0] for s in C.INDICATOR_SPECS]
    return M.build_features(r, _aligned_indicators(spark, d), "insee_code", "year", "indicator_code",
                            "value", codes)


@query("feature_join")
def feature_join(spark, d):
    """Results joined with the as-of aligned indicators pivoted per code."""
    f = _features(spark, d)
    return f.select("yr", "geo", "opt", "micro_share",
                    *[F.col(s[0]).cast("decimal(18,2)").alias(s[0]) for s in C.INDICATOR_SPECS])


@query("training_set")
def training_set(spark, d):
    """M1: indicators and the share's own history per (area, option)."""
    f = M.training_set(_features(spark, d).select("yr", "geo", "opt", "micro_share", *[s[0] for s in C.INDICATOR_SPECS]),
                       ["geo", "opt"], "yr", "micro_share", lags=2, bucket=F.floor(F.col("yr") / 4))
    return f.select("yr", "geo", "opt", "micro_share", "micro_share_lag1", "micro_share_lag2", "micro_share_change",
                    *[F.col(s[0]).cast("decimal(18,2)").alias(s[0]) for s in C.INDICATOR_SPECS])


@query("temporal_split")
def temporal_split(spark, d):
    """M2: train = years before the last one, test = the last year."""
    f = _features(spark, d)
    train, test = M.temporal_split(f, "yr", P.years(spark, d)[-1])
    return (train.select("yr", "geo", "opt", F.lit("train").alias("split"))
            .unionByName(test.select("yr", "geo", "opt", F.lit("test").alias("split"))))


def _lag_predictions(spark, d):
    r = _micro_results(spark, d).select("yr", "geo", "opt", "votes")
    return M.naive_lag_prediction(r, ["geo", "opt"], "yr", "votes")


@query("regression_metrics")
def regression_metrics(spark, d):
    """M4: MAE / RMSE / R^2 of the previous-year predictor per year (quantized)."""
    m = M.regression_metrics(_lag_predictions(spark, d), "votes", "prediction", by=["yr"])
    return m.select("yr", "n", F.round(F.col("mae") * 1000).cast("bigint").alias("mae_milli"),
                    F.round(F.col("rmse") * 1000).cast("bigint").alias("rmse_milli"),
                    F.round(F.col("r2") * 1000).cast("bigint").alias("r2_milli"))


@query("class_accuracy")
def class_accuracy(spark, d):
    """M5: accuracy of 'last year's leader wins again' per year."""
    r = _micro_results(spark, d)
    lead = W.top1(r, ["yr", "geo"], [F.col("votes").desc(), F.col("opt").asc()]).select("yr", "geo", "opt")
    pred = lead.withColumn("predicted", F.lag("opt").over(Window.partitionBy("geo").orderBy("yr")))
    acc = M.class_accuracy(pred.where(F.col("predicted").isNotNull()), "opt", "predicted", by=["yr"])
    return acc


@query("score_classes")
def score_classes(spark, d):
    """M5 discretization: share classes (low < 4 %, medium < 6 %, high) counted per year."""
    r = _canonical_results(spark, d).withColumn(
        "cls", M.discretize("vote_share", [0.04, 0.06], ["low", "medium", "high"]))
    return r.groupBy(F.col("year").cast("bigint").alias("yr"), "cls").agg(F.count(F.lit(1)).alias("n"))


@query("scenario_projection")
def scenario_projection(spark, d):
    """M7: per (indicator, area) linear trend projected 1-3 years ahead (rounded)."""
    v = _indicator_values(spark, d)
    p = M.trend_projection(v, ["indicator_code", "insee_code"], "year", "value")
    return p.select("indicator_code", "insee_code", F.col("horizon").cast("bigint").alias("horizon"),
                    F.col("period").cast("bigint").alias("period"),
                    F.round("projection").cast("bigint").alias("projection"))


@query("fit_lag_regressor")
def fit_lag_regressor(spark, d):
    """M3: Spark ML linear regression on lagged votes, fitted before the last year, predictions for it (quantized)."""
    lag = _lag_predictions(spark, d).where(F.col("prediction").isNotNull()) \
        .withColumnRenamed("prediction", "lag_votes")
    train, test = M.temporal_split(lag, "yr", P.years(spark, d)[-1])
    models = M.fit_regressors(train, ["lag_votes"], "votes", kinds=("linear",))
    pred = models["linear"].transform(test.select(F.col("lag_votes").cast("double").alias("lag_votes"),
                                                  F.col("votes").cast("double").alias("votes"),
                                                  "yr", "geo", "opt"))
    return pred.select("yr", "geo", "opt", F.col("votes").cast("bigint").alias("votes"),
                       F.col("lag_votes").cast("bigint").alias("lag_votes"),
                       F.round(F.col("prediction") * 100).cast("bigint").alias("prediction_centi"))


FEATURES = ["micro_share_lag1", *[s[0] for s in C.INDICATOR_SPECS]]
#: Linear models of the share, most interpretable first; persistence has no fitted coefficient.
MODELS = {"history": FEATURES[:1], "indicators": FEATURES[1:], "full": FEATURES}
PERSISTENCE = {"persistence": {"micro_share_lag1": 1.0}}
#: Values are exact to two places (indicators are decimals, shares whole millionths).
PLACES = 2


def _training_rows(spark, d):
    """Training rows that have a share one period before, evaluated once."""
    return cut_lineage(training_set(spark, d).where(F.col("micro_share_lag1").isNotNull()))


def _milli(c):
    return F.round(F.col(c) * 1000).cast("bigint")


@query("fit_regressors")
def fit_regressors(spark, d):
    """M3: least squares on history and all indicators, fitted before the last year, predictions for it (quantized)."""
    rows = _training_rows(spark, d)
    train, test = M.temporal_split(rows, "yr", P.years(spark, d)[-1])
    columns = [*FEATURES, "micro_share"]
    fitted = LIN.fit(LIN.gram(train, columns, scale=PLACES), columns)
    return LIN.predict(test, fitted, columns).select("yr", "geo", "opt", "micro_share", _milli("prediction").alias("prediction_milli"))


@query("fit_regressors_by_area")
def fit_regressors_by_area(spark, d):
    """M3: the same model for each area on its own, all from one Gram aggregate by area."""
    rows = _training_rows(spark, d)
    train, test = M.temporal_split(rows, "yr", P.years(spark, d)[-1])
    columns = [*FEATURES, "micro_share"]
    fitted = LIN.fit(LIN.gram(train, columns, ["geo"], PLACES), columns, ["geo"])
    return LIN.predict(test, fitted, columns, ["geo"]).select(
        "yr", "geo", "opt", "micro_share", _milli("prediction").alias("prediction_milli"))


@query("correlation_matrix")
def correlation_matrix(spark, d):
    """Correlation of every pair of share, history and indicators, over the rows that have both, per area."""
    rows = training_set(spark, d)
    columns = ["micro_share", *FEATURES]
    c = LIN.correlations(LIN.gram(rows, columns, ["geo"], PLACES), columns, ["geo"])
    return c.select("geo", "x", "y", "n", F.round(F.col("corr") * 10000).cast("bigint").alias("corr_e4"))


def _window_predictions(spark, d, models=MODELS, fixed=PERSISTENCE):
    return M.window_predictions(_training_rows(spark, d), FEATURES, "micro_share", "yr", models, fixed, PLACES)


@query("compare_models")
def compare_models(spark, d):
    """M6: expanding-window comparison of three linear models and persistence, for each year with two years before it."""
    m = M.compare_models(_window_predictions(spark, d), "micro_share", "yr")
    return m.select("model", "period", "n", *[_milli(c).alias(f"{c}_milli") for c in ("mae", "rmse", "r2")])


@query("choose_model")
def choose_model(spark, d):
    """M6: the most stable and interpretable of the compared models."""
    m = M.compare_models(_window_predictions(spark, d), "micro_share", "yr")
    c = M.choose_model(m, ["persistence", *MODELS])
    return c.select("model", "n_windows", "mean_rmse_milli", "spread_rmse_milli", "worst_rmse_milli", "score_milli",
                    F.col("rank").cast("bigint").alias("rank"), "chosen")


@query("compare_tree_models")
def compare_tree_models(spark, d):
    """M6 (rows-only): expanding-window scores of Spark ML forests and boosted trees on the same rows."""
    return M.compare_tree_models(_training_rows(spark, d), FEATURES, "micro_share", "yr", P.years(spark, d)[2:])


def _full_predictions(spark, d):
    pred = _window_predictions(spark, d, {"full": FEATURES}, {})
    return pred.select("yr", "geo", "opt", "micro_share", _milli("prediction").alias("predicted"))


@query("winner_accuracy")
def winner_accuracy(spark, d):
    """M5: how often the largest predicted share names the true winner of an area, per year."""
    w = M.winners(_full_predictions(spark, d), ["yr", "geo"], "opt", "micro_share", "predicted")
    return M.class_accuracy(w, "actual", "predicted", by=["yr"])


def _bloc(c):
    """Bloc of an option: the part of a brand before its last digit (the maker)."""
    return F.expr(f"left({c}, length({c}) - 1)")


@query("confusion_matrix")
def confusion_matrix(spark, d):
    """M5: predicted against actual winner, winning bloc (largest sum of shares) and score class, with recalls."""
    pred = cut_lineage(_full_predictions(spark, d))
    blocs = pred.groupBy("yr", "geo", _bloc("opt").alias("bloc")).agg(
        F.sum("micro_share").alias("micro_share"), F.sum("predicted").alias("predicted"))
    edges, names = [40_000.0, 60_000.0], ["low", "medium", "high"]
    classes = pred.withColumn("share", F.col("predicted") / 1000).select(
        M.discretize("micro_share", edges, names).alias("actual"), M.discretize("share", edges, names).alias("predicted"))

    def kind(pairs, name):
        return pairs.select(F.lit(name).alias("kind"), "actual", "predicted")

    pairs = kind(M.winners(pred, ["yr", "geo"], "opt", "micro_share", "predicted"), "winner") \
        .unionByName(kind(M.winners(blocs, ["yr", "geo"], "bloc", "micro_share", "predicted"), "bloc")) \
        .unionByName(kind(classes, "class"))
    return M.confusion(pairs, ["kind"])


@query("scenario_shares")
def scenario_shares(spark, d):
    """M7: every option's share one to three years after the last one, with low, central and high bands (quantized)."""
    rows = _training_rows(spark, d)
    columns = [*FEATURES, "micro_share"]
    model = LIN.fit(LIN.gram(rows, columns, scale=PLACES), columns).first()  # one row of coefficients
    last = _micro_results(spark, d).select("yr", "geo", "opt", "micro_share", S.geo_key(S.code2("geo")).alias("insee_code")) \
        .where(F.col("yr") == P.years(spark, d)[-1])
    values = _indicator_values(spark, d).select("insee_code", "indicator_code", "value", F.col("year").cast("bigint").alias("yr"))
    out = M.scenario_shares(last, values, model, FEATURES, ["geo", "opt"], "insee_code", "micro_share", "yr", "indicator_code",
                            "value", high=1e6)
    return out.select("geo", "opt", F.col("horizon").cast("bigint").alias("horizon"), "period", "band",
                      F.round("micro_share").cast("bigint").alias("micro_share"))


# ---------------------------------------------------------------- streaming
@query("incremental_load")
def incremental_load(spark, d):
    """Incremental re-run: order files streamed with availableNow + foreachBatch into key-range buckets, of which
    each batch replaces the ones it touches; state = sum over the buckets' latest versions."""
    from ..streaming import incremental as INC

    return INC.incremental_counts(spark, d)


@query("incremental_corrections")
def incremental_corrections(spark, d):
    """Incremental re-run with a file that comes again and one that corrects orders: the last version of an order counts."""
    from ..streaming import incremental as INC

    orders = P.table(spark, d, "orders")
    key = F.col("o_orderkey")
    again = orders.where(key % 3 == 0)
    corrected = orders.where(key % 5 == 0).withColumn("o_orderstatus", F.lit("F")) \
        .withColumn("o_orderdate", F.add_months("o_orderdate", 1).cast(orders.schema["o_orderdate"].dataType))
    return INC.landed_counts(spark, d, [orders, again, corrected])
