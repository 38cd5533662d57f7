"""Canonical frames and warehouse table schemas."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import (DateType, DecimalType, DoubleType, IntegerType, LongType,
                               ShortType, StringType, StructField, StructType)

RESULTS = StructType([
    StructField("year", IntegerType()),
    StructField("dept_code", StringType()),
    StructField("dept_name", StringType()),
    StructField("candidate_name", StringType()),
    StructField("registered", LongType()),
    StructField("votes_cast", LongType()),
    StructField("votes_valid", LongType()),
    StructField("votes", LongType()),
    StructField("vote_share", DoubleType()),
    StructField("turnout_rate", DoubleType()),
])

INDICATOR_VALUES = StructType([
    StructField("indicator_code", StringType()),
    StructField("insee_code", StringType()),
    StructField("year", IntegerType()),
    StructField("value", DoubleType()),
    StructField("source_file", StringType()),
])

GEO_DEPARTMENT = StructType([
    StructField("dept_code", StringType(), False),
    StructField("dept_name", StringType(), False),
])

GEO_COMMUNE = StructType([
    StructField("insee_code", StringType(), False),
    StructField("commune_name", StringType(), False),
    StructField("dept_code", StringType(), False),
    StructField("population", LongType()),
    StructField("area_km2", DoubleType()),
    StructField("latitude", DoubleType()),
    StructField("longitude", DoubleType()),
])

ELECTION = StructType([
    StructField("election_id", LongType(), False),
    StructField("election_type", StringType(), False),
    StructField("election_date", DateType(), False),
    StructField("round", ShortType(), False),
    StructField("scope", StringType(), False),
])

CANDIDATE = StructType([
    StructField("candidate_id", LongType(), False),
    StructField("candidate_name", StringType(), False),
    StructField("party_name", StringType()),
    StructField("party_code", StringType()),
])

ELECTION_RESULT = StructType([
    StructField("election_id", LongType(), False),
    StructField("insee_code", StringType(), False),
    StructField("candidate_id", LongType(), False),
    StructField("registered", LongType()),
    StructField("votes_cast", LongType()),
    StructField("votes_valid", LongType()),
    StructField("votes", LongType()),
    StructField("vote_share", DecimalType(6, 5)),
])

INDICATOR = StructType([
    StructField("indicator_id", LongType(), False),
    StructField("indicator_code", StringType(), False),
    StructField("indicator_name", StringType(), False),
    StructField("unit", StringType()),
    StructField("source", StringType()),
])

INDICATOR_VALUE = StructType([
    StructField("indicator_id", LongType(), False),
    StructField("insee_code", StringType(), False),
    StructField("year", IntegerType(), False),
    StructField("value", DoubleType()),
    StructField("source_file", StringType()),
])

@dataclass(frozen=True)
class Table:
    """A warehouse table: its schema, keys and, for facts, the partition column."""

    schema: StructType
    pk: tuple[str, ...]
    unique: tuple[tuple[str, ...], ...] = ()  # natural keys (null equals null)
    fks: tuple[tuple[tuple[str, ...], str, tuple[str, ...]], ...] = ()  # columns -> table, its columns
    partition: str | None = None


WAREHOUSE = {
    "geo_department": Table(GEO_DEPARTMENT, ("dept_code",)),
    "geo_commune": Table(GEO_COMMUNE, ("insee_code",), fks=((("dept_code",), "geo_department", ("dept_code",)),)),
    "election": Table(ELECTION, ("election_id",), unique=(("election_type", "election_date", "round", "scope"),)),
    "candidate": Table(CANDIDATE, ("candidate_id",), unique=(("candidate_name", "party_code"),)),
    "election_result": Table(
        ELECTION_RESULT, ("election_id", "insee_code", "candidate_id"), partition="election_id",
        fks=((("election_id",), "election", ("election_id",)), (("insee_code",), "geo_commune", ("insee_code",)),
             (("candidate_id",), "candidate", ("candidate_id",)))),
    "indicator": Table(INDICATOR, ("indicator_id",), unique=(("indicator_code",),)),
    "indicator_value": Table(
        INDICATOR_VALUE, ("indicator_id", "insee_code", "year"), partition="year",
        fks=((("indicator_id",), "indicator", ("indicator_id",)), (("insee_code",), "geo_commune", ("insee_code",)))),
}
