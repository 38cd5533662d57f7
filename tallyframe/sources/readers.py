"""Sources (S1-S4): landed sheets, ragged station files, indicator files, spec tables.

Everything is read as strings (no schema inference) and typed later with
``try_*`` casts; roles are resolved from header names on the driver.
"""

from __future__ import annotations

import re
import warnings
from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, StringType, StructField, StructType

from .. import config as C
from .schema import normalize_name, require_columns, trim_headers


def landed_headers(names: list[str | None]) -> list[str]:
    """H1: unique column names of a landed header row: stripped; blank ones and repeats become
    ``Unnamed: <position>``, which no role, pair or measure takes (H2: the first one counts)."""
    out: list[str] = []
    for i, name in enumerate(names):
        name = (name or "").strip()
        if name and name in out:
            warnings.warn(f"column {name!r} occurs again at position {i}; the first one is used")
        out.append(f"Unnamed: {i}" if not name or name in out else name)
    return out


#: ``ordinal`` = file rank * FILE + start of the split * SPLIT + position in it, as decimal(38,0).
FILE, SPLIT = Decimal(10) ** 30, Decimal(10) ** 12
#: Scheme and host of a path, which Spark writes in two ways (file:/x, file:///x).
_STORE = r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?/*"


def source_order(df: DataFrame) -> DataFrame:
    """Adds ``ordinal``, the order of rows in the files: file by path, start of the split, position in it.

    (A position number alone follows how splits are packed into tasks, largest files first.)  The three are packed into
    one decimal: a value of fixed width keeps the first row of a group a hash aggregate, a struct doesn't.  File ranks come
    from the listing that the read made anyway.
    """
    listed = sorted({re.sub(_STORE, "/", p) for p in df.inputFiles()})
    paths = df.sparkSession.createDataFrame([(p, i) for i, p in enumerate(listed)], "__path string, __rank int")
    rows = df.select("*", F.regexp_replace(F.col("_metadata.file_path"), _STORE, "/").alias("__file"),
                     F.col("_metadata.file_block_start").alias("__start"),
                     F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("__at"))
    rank = F.coalesce("__rank", F.raise_error(F.concat(F.lit("no such file in the listing: "), "__file")).cast("int"))
    ordinal = (rank.cast("decimal(6,0)") * F.lit(FILE) + F.col("__start").cast("decimal(18,0)") * F.lit(SPLIT)
               + F.col("__at").cast("decimal(10,0)")).cast("decimal(38,0)")
    return (rows.join(F.broadcast(paths), F.col("__file") == F.col("__path"), "left")  # one row per input file
            .withColumn("ordinal", ordinal).drop("__file", "__start", "__at", "__path", "__rank"))


def _csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """A landed CSV file as strings; the header row is read as data, so that Spark renames nothing."""
    reader = spark.read.option("inferSchema", False)
    for k, v in options.items():
        reader = reader.option(k, v)
    first = reader.option("header", False).csv(path).first()
    names = landed_headers(list(first) if first is not None else [])
    schema = StructType([StructField(n, StringType()) for n in names])
    if not names:
        return spark.createDataFrame([], schema)
    return reader.option("header", True).option("enforceSchema", True).schema(schema).csv(path)


def read_wide_results(spark: SparkSession, paths_by_year: Mapping[int, str], fmt: str = "csv",
                      **options) -> dict[int, DataFrame]:
    """One landed sheet per year (ascending); year comes from the map, not the data."""
    def read(path: str) -> DataFrame:
        return trim_headers(spark.read.parquet(path)) if fmt == "parquet" else _csv(spark, path, **options)

    return {year: read(paths_by_year[year]) for year in sorted(paths_by_year)}


def read_lines(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Whole lines of a delimited text file, decoded with `encoding`, splittable, in source order."""
    lines = source_order(spark.read.text(path))
    return lines.select(F.decode(F.col("value").cast("binary"), encoding).alias("line"), "ordinal")


def split_line(line: Column, sep: str = ";") -> Column:
    """Tokens of a delimited line; a token in double quotes may hold the separator and doubled quotes."""
    outside = sep + '(?=(?:[^"]*"[^"]*")*[^"]*$)'  # a separator with an even number of quotes behind it
    quoted = F.transform(F.split(line, outside, -1), lambda t: F.when(
        t.rlike('^\\s*".*"\\s*$'), F.replace(F.regexp_extract(t, '^\\s*"(.*)"\\s*$', 1), F.lit('""'), F.lit('"'))).otherwise(t))
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, sep, -1))


def station_header(lines: DataFrame, sep: str = ";") -> list[str]:
    """Header tokens of a station file: the first line of the first file.

    (Every file of a station dataset carries the same header; header lines are
    dropped from every file by ``parse_station_lines``.)
    """
    heads = lines
    if isinstance(lines.schema["ordinal"].dataType, DecimalType):  # landed files: only the first split of each
        heads = lines.where(F.pmod(F.col("ordinal"), F.lit(FILE)) < F.lit(SPLIT))
    first = heads.agg(F.min_by(split_line(F.col("line"), sep), "ordinal")).first()[0]
    return [t.strip() for t in first or []]


def parse_station_lines(lines: DataFrame, header: list[str], sep: str = ";",
                        stride: int = C.STATION_GROUP_STRIDE) -> DataFrame:
    """Split ragged lines; prefix fields by header role, candidate groups as an array.

    Rows with no more tokens than the prefix are skipped (P4).  Groups are
    parsed by ``operators.reshape.explode_groups`` downstream.
    """
    norm = [normalize_name(h) for h in header]
    require_columns(norm, C.STATION_REQUIRED)
    idx = {}
    for i, n in enumerate(norm):  # the station reader keeps the last duplicate header
        idx[n] = i
    start = idx["npanneau"]
    names = F.array(*[F.lit(h.strip()) for h in header])
    # the first token tells almost every row from a header line; only where it is the header's are all compared
    is_header = (F.trim(F.get("tokens", F.lit(0))) == header[0].strip()) & (F.transform("tokens", lambda t: F.trim(t)) == names)
    parsed = lines.select("ordinal", split_line(F.col("line"), sep).alias("tokens")).where(~is_header)

    def at(name):
        return F.element_at(F.col("tokens"), idx[name] + 1)

    return parsed.where(F.size("tokens") > start).select(
        "ordinal",
        at("codedudepartement").alias("dept_raw"),
        at("libelledudepartement").alias("name_raw"),
        at("codedelacommune").alias("commune_raw"),
        at("codedubvote").alias("bureau_raw"),
        at("inscrits").alias("registered_raw"),
        at("votants").alias("cast_raw"),
        at("exprimes").alias("valid_raw"),
        "tokens",
        F.lit(start).alias("group_start"),
        F.lit(stride).alias("group_stride"),
    )


def read_station_file(spark: SparkSession, path: str, encoding: str = "ISO-8859-1",
                      sep: str = ";") -> DataFrame:
    lines = read_lines(spark, path, encoding)
    return parse_station_lines(lines, station_header(lines, sep), sep)


def read_indicator_file(spark: SparkSession, path: str, sep: str = ";",
                        encoding: str = "ISO-8859-1") -> DataFrame:
    """S3: wide indicator CSV, all strings, plus a source-order `ordinal` (file, then offset)."""
    return source_order(_csv(spark, path, sep=sep, encoding=encoding))


def spec_tables(spark: SparkSession) -> dict[str, DataFrame]:
    """The fixed reference tables as small DataFrames (broadcast-safe by construction)."""
    depts = spark.createDataFrame(list(C.DEPARTMENTS.items()), "dept_code string, dept_name string")
    names = [(normalize_name(n), c) for c, n in C.DEPARTMENTS.items()]
    names += [(normalize_name(a), c) for a, c in C.DEPARTMENT_ALIASES.items()]
    aliases = spark.createDataFrame(sorted(set(names)), "name_key string, dept_code string")
    dates = spark.createDataFrame(
        [(y, d) for y, d in sorted(C.ELECTION_DATE_BY_YEAR.items())], "year int, election_date string"
    ).withColumn("election_date", F.to_date("election_date"))
    specs = spark.createDataFrame(
        [(*spec, i) for i, spec in enumerate(C.INDICATOR_SPECS)],
        "indicator_code string, indicator_name string, unit string, variable string, sous_champ string, "
        "__spec_order int")
    return {"departments": depts, "aliases": aliases, "election_dates": dates, "indicator_specs": specs}
