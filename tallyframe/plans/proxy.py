"""Proxy tables: the election data model played by the driver's test tables.

``base``     one row per line item: (yr, geo, geo_name, opt, station, st, pri, q, ln, ...)
``results``  canonical results frame per (yr, geo, opt)
``totals``   registered / cast / valid per (yr, geo)

All are lazy DataFrames over the given parquet tables, so their work grows
with the data.  Joins are left to Catalyst/AQE: the nation table is fixed-size
and every other side is planned from its measured size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions import scalars as S

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Target scope of the proxy (plays the 8 departments): 2-character geo codes.
PROXY_TARGET_CODES = ("01", "03", "05", "07", "11", "13", "17", "19")
# Target years of the proxy alignment: no-prior, carried, exact, beyond-last.
PROXY_CALENDAR = (1994, 1996, 1998, 2000, 2001, 2003)
# Most columns that a matrix or sheet may get from the data; more is an error, never a cut.
MAX_COLUMNS = 10_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def column_values(df: DataFrame, col: str) -> list:
    """Sorted distinct values of a column that becomes a matrix header (an error beyond MAX_COLUMNS)."""
    rows = df.select(col).where(F.col(col).isNotNull()).distinct().limit(MAX_COLUMNS + 1).collect()
    if len(rows) > MAX_COLUMNS:
        raise ValueError(f"more than {MAX_COLUMNS} distinct values of {col}: too many for columns")
    return sorted(r[0] for r in rows)


def years(spark: SparkSession, sf_dir: str) -> list[int]:
    """The order years in the data."""
    return column_values(table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("yr")), "yr")


def order_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders -> customer -> nation: one row per order with its year and geo."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority", "o_orderdate", "o_totalprice")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(F.year("o_orderdate").cast("bigint").alias("yr"),
                    F.col("n_nationkey").cast("bigint").alias("geo"),
                    F.col("n_name").alias("geo_name"),
                    F.col("o_orderkey").alias("station"),
                    F.col("o_custkey").alias("commune"),
                    F.col("o_orderstatus").alias("st"),
                    F.col("o_orderpriority").alias("pri"),
                    F.col("o_totalprice").alias("price"),
                    F.col("o_orderdate").alias("odate")))


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw 'ballots': one row per line item with order geo/year and part brand."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    lines = li.join(part, li.l_partkey == part.p_partkey)
    of = order_facts(spark, sf_dir)
    return (lines.join(of, lines.l_orderkey == of.station)
            .select("yr", "geo", "geo_name", F.col("p_brand").alias("opt"), "station", "commune",
                    "st", "pri", F.col("l_quantity").cast("bigint").alias("q"),
                    F.col("l_linenumber").cast("bigint").alias("ln"),
                    F.col("l_partkey").alias("partkey"), F.col("l_suppkey").alias("suppkey"),
                    F.col("l_shipdate").alias("shipdate")))


def option_counts(b: DataFrame) -> DataFrame:
    """One pass over base: per (yr, geo, opt) partial counts (partial agg before shuffle)."""
    return (b.groupBy("yr", "geo", "geo_name", "opt")
            .agg(F.sum("q").alias("eligible_o"),
                 F.sum(F.when(F.col("st") != "P", F.col("q")).otherwise(0)).alias("cast_o"),
                 F.sum(F.when(F.col("st") == "F", F.col("q")).otherwise(0)).alias("valid_o"),
                 F.count_if(F.col("st") == "F").alias("n_valid_lines")))


def results_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(yr, geo, geo_name, opt, eligible, cast_n, valid, votes): the canonical counts.

    Group totals come from a window over the *aggregated* per-option rows
    (a few thousand rows at any scale), so base is scanned once.
    """
    oc = option_counts(base(spark, sf_dir))
    w = Window.partitionBy("yr", "geo")
    return (oc.select("yr", "geo", "geo_name", "opt",
                      F.sum("eligible_o").over(w).cast("bigint").alias("eligible"),
                      F.sum("cast_o").over(w).cast("bigint").alias("cast_n"),
                      F.sum("valid_o").over(w).cast("bigint").alias("valid"),
                      F.col("valid_o").cast("bigint").alias("votes"),
                      "n_valid_lines")
            .where(F.col("n_valid_lines") > 0)
            .drop("n_valid_lines"))


def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = base(spark, sf_dir)
    return (b.groupBy("yr", "geo", "geo_name")
            .agg(F.sum("q").cast("bigint").alias("eligible"),
                 F.sum(F.when(F.col("st") != "P", F.col("q")).otherwise(0)).cast("bigint").alias("cast_n"),
                 F.sum(F.when(F.col("st") == "F", F.col("q")).otherwise(0)).cast("bigint").alias("valid")))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical results frame (year, dept_code, ..., vote_share, turnout_rate)."""
    rc = results_counts(spark, sf_dir)
    return rc.select(
        F.col("yr").cast("int").alias("year"),
        S.code2("geo").alias("dept_code"),
        F.col("geo_name").alias("dept_name"),
        F.col("opt").alias("candidate_name"),
        F.col("eligible").alias("registered"),
        F.col("cast_n").alias("votes_cast"),
        F.col("valid").alias("votes_valid"),
        F.col("votes"),
        S.safe_ratio("votes", "valid").alias("vote_share"),
        S.safe_ratio("cast_n", "eligible").alias("turnout_rate"),
    )


# --------------------------------------------------------------------------
# Landed-file shapes built from the tables (so the parsers run on real volume)
# --------------------------------------------------------------------------

# FIXED VALUES: header of the polling-station file format (public file layout)
STATION_HEADER = ["Code du département", "Libellé du département", "Code de la commune",
                  "Code du b.vote", "Inscrits", "Votants", "Exprimés", "N°Panneau", "Sexe", "Nom",
                  "Prénom", "Voix", "% Voix/Ins", "% Voix/Exp"]
GROUPS_PER_ROW = 3
# priority -> indicator variable of the wide indicator file; status -> sub-field
VARIABLE_BY_PRIORITY = {"1-URGENT": "taux_chom_bit", "2-HIGH": "taux_pvt", "3-MEDIUM": "niveau_vie_median",
                        "4-NOT SPECIFIED": "part_pls", "5-LOW": "autre_variable"}


def departments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Area dimension of the proxy: (dept_code, dept_name) from nation."""
    return table(spark, sf_dir, "nation").select(S.code2("n_nationkey").alias("dept_code"),
                                                 F.col("n_name").alias("dept_name"))


def station_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ragged ';' station rows: 7 header fields + up to 3 candidate groups of 7 fields.

    One row per (order, chunk of 3 line items); every row repeats its
    station's header totals; rows of urgent orders appear twice (exact
    duplicates); panel is blank on every 4th line number.  Columns: (line, ordinal); the ordinal packs
    (order, chunk, copy) into 64 bits in that order (orders below 2^43 with under 2^19 chunks).

    One shuffle: windows by station number the lines, look at the lines behind the first one of a chunk and compute the
    station totals, so that a chunk's row comes from its first line without an aggregation.
    """
    b = base(spark, sf_dir)
    ws = Window.partitionBy("station")
    w = ws.orderBy("ln", "partkey", "suppkey")
    grp = F.concat_ws(";", F.when(F.col("ln") % 4 == 0, F.lit("")).otherwise(F.col("ln").cast("string")),
                      F.lit("X"), F.col("opt"), F.lit(""), F.col("q").cast("string"), F.lit("0"), F.lit("0"))
    lines = b.withColumn("g", grp).select(
        "station", "commune", "geo", "geo_name",
        (F.row_number().over(w) - 1).alias("rn"),
        "g", *[F.lead("g", i).over(w).alias(f"g{i}") for i in range(1, GROUPS_PER_ROW)],
        F.sum("q").over(ws).alias("reg"),
        F.sum(F.when(F.col("st") != "P", F.col("q")).otherwise(0)).over(ws).alias("cst"),
        F.sum(F.when(F.col("st") == "F", F.col("q")).otherwise(0)).over(ws).alias("val"),
        (F.col("pri") == "1-URGENT").alias("urgent"))
    rows = lines.where(F.col("rn") % GROUPS_PER_ROW == 0)
    name = F.when(F.col("geo") % 7 == 0, F.lit("")).otherwise(F.col("geo_name"))
    line = F.concat_ws(";", F.col("geo").cast("string"), name, F.col("commune").cast("string"),
                       F.col("station").cast("string"), F.col("reg").cast("string"),
                       F.col("cst").cast("string"), F.col("val").cast("string"),
                       "g", *[f"g{i}" for i in range(1, GROUPS_PER_ROW)])
    chunk = (F.col("rn") / GROUPS_PER_ROW).cast("int")
    # the line is generated, not projected: filters on it then don't build it again
    copies = F.array_repeat(line, F.when(F.col("urgent"), 2).otherwise(1))
    return rows.select("station", chunk.alias("chunk"), F.posexplode(copies).alias("copy", "line")) \
        .select("line", (F.shiftleft(F.col("station").cast("bigint"), 20) + F.col("chunk") * 2 + F.col("copy")).alias("ordinal"))


def indicator_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide indicator file: codgeo, variable, sous_champ, one A<year> per period (comma decimals), ordinal.

    value = order-price sum per (priority, status, geo, two-year period named by its odd
    first year: 1995-96 -> 1995, ...), so the series has gaps; sous_champ
    is 'total' (F), null (O) or ' total ' (P, a padded duplicate of F).
    """
    # biennial survey: every order counts towards the odd year that opens its two-year period
    of = order_facts(spark, sf_dir).withColumn(
        "yr", F.col("yr") - F.pmod(F.col("yr") - F.lit(1), F.lit(2)))
    var = F.coalesce(*[F.when(F.col("pri") == k, F.lit(v)) for k, v in VARIABLE_BY_PRIORITY.items()])
    sc = (F.when(F.col("st") == "F", F.lit("total")).when(F.col("st") == "P", F.lit(" total "))
          .otherwise(F.lit(None).cast("string")))
    pri_rank = F.substring("pri", 1, 1).cast("int")
    st_rank = F.when(F.col("st") == "F", 0).when(F.col("st") == "O", 1).otherwise(2)
    agg = (of.groupBy("geo", "pri", "st", "yr")
           .agg(F.sum(F.col("price").cast("decimal(18,2)")).cast("decimal(18,2)").alias("v")))
    txt = F.translate(F.col("v").cast("string"), ".", ",")
    periods = sorted({y - (y - 1) % 2 for y in years(spark, sf_dir)})
    wide = (agg.withColumn("codgeo", F.col("geo").cast("string")).withColumn("variable", var)
            .withColumn("sous_champ", sc).withColumn("ordinal", F.col("geo") * 100 + pri_rank * 10 + st_rank)
            .groupBy("codgeo", "variable", "sous_champ", "ordinal")
            .pivot("yr", periods).agg(F.max(txt)))
    return wide.toDF("codgeo", "variable", "sous_champ", "ordinal", *[f"A{y}" for y in periods])


def _pct_text(micro) -> Column:
    """Exact millionths -> French percent text with 4 decimals ('51,2821')."""
    m = F.col(micro)
    return F.concat((m / 10000).cast("bigint").cast("string"), F.lit(","),
                    F.lpad(F.pmod(m, F.lit(10000)).cast("string"), 4, "0"))


def results_micro(spark: SparkSession, sf_dir: str) -> DataFrame:
    rc = results_counts(spark, sf_dir)
    return rc.withColumn("micro_share", S.micro_ratio("votes", "valid")) \
             .withColumn("micro_turnout", S.micro_ratio("cast_n", "eligible"))


def _brands(spark: SparkSession, sf_dir: str) -> list[str]:
    """The option (brand) columns of the wide sheets: the part dimension's distinct brands."""
    return column_values(table(spark, sf_dir, "part"), "p_brand")


def sheet_layout_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide results sheet, layout A: Code/Libellé/Inscrits/Votants/Exprimés + <BRAND>_VOIX/_EXP
    for every brand."""
    brands = _brands(spark, sf_dir)
    r = results_micro(spark, sf_dir)
    wide = (r.groupBy("yr", "geo", "geo_name", "eligible", "cast_n", "valid")
            .pivot("opt", brands)
            .agg(F.max(F.col("votes").cast("string")).alias("v"), F.max(_pct_text("micro_share")).alias("s")))
    return wide.select(
        "yr", F.col("geo").cast("string").alias("Code du département"),
        F.col("geo_name").alias("Libellé du département"),
        F.col("eligible").cast("string").alias("Inscrits"), F.col("cast_n").cast("string").alias("Votants"),
        F.col("valid").cast("string").alias("Exprimés"),
        *[c for b in brands for c in (F.col(f"`{b}_v`").alias(f"{b}_VOIX"),
                                      F.col(f"`{b}_s`").alias(f"{b}_EXP"))])


def sheet_layout_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide results sheet, layout B: Département (name) / Participation / Exprimés / Blancs + one
    percent column per brand."""
    brands = _brands(spark, sf_dir)
    r = results_micro(spark, sf_dir)
    wide = (r.groupBy("yr", "geo_name", "valid", "micro_turnout")
            .pivot("opt", brands).agg(F.max(_pct_text("micro_share"))))
    return wide.select(
        "yr", F.col("geo_name").alias("Département"),
        _pct_text("micro_turnout").alias("Participation"),
        F.col("valid").cast("string").alias("Exprimés"), F.lit("0").alias("Blancs"),
        *[F.col(f"`{b}`").alias(b) for b in brands])


def name_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(name_key, dept_code) from the area dimension."""
    return departments(spark, sf_dir).select(S.normalize_key("dept_name").alias("name_key"), "dept_code")
