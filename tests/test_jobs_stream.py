"""Warehouse jobs end to end (FX1 sheet -> 7 tables, idempotent re-run) and the incremental stream."""

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyframe.config import JobConfig
from tallyframe.plans import election as EL
from tallyframe.plans import indicators as IN
from tallyframe.plans import jobs
from tallyframe import schema as SC
from tallyframe.sources.sinks import ConstraintError, Warehouse
from tallyframe.streaming import incremental as INC

from test_election import STATION_TEXT
from test_indicators import FX4, SCHEMA


def _results(spark, tmp_path):
    cols = ["Code du département", "Libellé du département", "Inscrits", "Votants", "Exprimés",
            "DUPONT_VOIX", "DUPONT_EXP", "LE_GALL_VOIX"]
    data = [("75", "Paris ", "1000", "800", "780", "400", "51,28", "380"),
            ("92", "Hauts-de-Seine", "200", "100", "90", "", "50", "")]
    sheet = spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in cols))
    path = tmp_path / "st.txt"
    path.write_bytes(STATION_TEXT.encode("latin-1"))
    from tallyframe.sources import readers
    return EL.collect_results(spark, {2012: sheet}, {2017: readers.read_station_file(spark, str(path))})


def test_warehouse_jobs_idempotent(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    res = _results(spark, tmp_path)
    jobs.load_election_results(spark, res, wh, JobConfig())
    first = {t: sorted(map(tuple, wh.read(t).collect())) for t in
             ("election", "candidate", "election_result", "geo_department", "geo_commune", "indicator_value")}
    jobs.load_election_results(spark, res, wh, JobConfig())
    again = {t: sorted(map(tuple, wh.read(t).collect())) for t in first}
    assert first == again
    assert len(first["election"]) == 2 and len(first["candidate"]) == 2
    assert len(first["election_result"]) == 6
    specs = __import__("tallyframe.sources.readers", fromlist=["x"]).spec_tables(spark)["indicator_specs"]
    vals = IN.extract_values(spark.createDataFrame(FX4, SCHEMA), specs, "ordinal")
    unmatched = jobs.load_indicator_values(spark, vals, wh)
    assert unmatched.count() == 0
    assert wh.read("indicator_value").count() == len(first["indicator_value"]) + 7
    tables = jobs.dashboard_tables(res, vals, [2012, 2017])
    assert tables["leader_matrix"].count() == 3


def test_unknown_year_fails_before_any_write(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    res = _results(spark, tmp_path)
    with pytest.raises(ValueError, match="1965"):
        jobs.load_election_results(spark, res.unionByName(res.withColumn("year", F.lit(1965))), wh)
    assert not (tmp_path / "wh").exists()


def test_slice_replace_leaves_other_partitions_alone(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    res = _results(spark, tmp_path)
    jobs.load_election_results(spark, res, wh)
    files = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "wh" / "election_result").rglob("*.parquet")}
    before, rows = files(), {tuple(r) for r in wh.read("election_result").collect()}
    only = res.where("year = 2017 and dept_code = '75'").withColumn("votes", F.col("votes") + 1)
    counts = jobs.load_election_results(spark, only, wh, JobConfig(target_codes=("75",)))
    after = files()
    ids = {r.election_date.year: r.election_id for r in wh.read("election").collect()}
    same = {f for f in before if f"election_id={ids[2012]}/" in f}
    assert same and all(after.get(f) == before[f] for f in same)
    now = {tuple(r) for r in wh.read("election_result").collect()}
    assert {r for r in rows if r[0] == ids[2012]} <= now and len(now) == len(rows)
    changed = now - rows
    assert {(r[0], r[1]) for r in changed} == {(ids[2017], "75000")} and counts["election_result"] > 0


def test_natural_keys_and_foreign_keys_are_checked(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    jobs.ensure_reference_rows(spark, wh, JobConfig())
    twice = spark.createDataFrame([(90, "x", "a", None, None), (91, "x", "b", None, None)], SC.INDICATOR)
    with pytest.raises(ConstraintError, match="indicator_code"):
        wh.upsert("indicator", twice)
    orphan = spark.createDataFrame([(77, "75000", 2012, 1.0, "f")], SC.INDICATOR_VALUE)
    with pytest.raises(ConstraintError, match="indicator row"):
        wh.upsert("indicator_value", orphan)
    cands = spark.createDataFrame([(1, "A", None, None), (2, "A", None, None)], SC.CANDIDATE)
    with pytest.raises(ConstraintError, match="candidate_name"):
        wh.upsert("candidate", cands)


def test_from_paths_to_warehouse_and_dashboard(spark, tmp_path):
    from test_readers import FX1_CSV, FX4_CSV

    sheet, station, ind = tmp_path / "2012.csv", tmp_path / "2017.txt", tmp_path / "ind.csv"
    sheet.write_bytes(FX1_CSV.encode("latin-1"))
    station.write_bytes(STATION_TEXT.encode("latin-1"))
    ind.write_bytes(FX4_CSV.encode("latin-1"))
    args = dict(sep=";", encoding="ISO-8859-1")
    counts = jobs.run_warehouse(spark, str(tmp_path / "wh"), {2012: str(sheet)}, {2017: str(station)}, str(ind), **args)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    assert counts["election"] == 2 and counts["indicator_unmatched"] == 0
    assert counts["election_result"] == wh.read("election_result").count() and counts["indicator_value"] > 0
    again = jobs.run_warehouse(spark, str(tmp_path / "wh"), {2012: str(sheet)}, {2017: str(station)}, str(ind), **args)
    assert again == counts
    dash = jobs.run_dashboard(spark, str(tmp_path / "dash"), {2012: str(sheet)}, str(ind), {2017: str(station)}, **args)
    assert set(dash) == {"turnout_trend", "leader_matrix", "unemployment_trend", "latest_poverty"} and dash["turnout_trend"] > 0
    assert spark.read.parquet(str(tmp_path / "dash" / "leader_matrix")).count() == dash["leader_matrix"]


def test_incremental_stream_matches_batch(spark):
    sf = "/root/testdata/sf0.001"
    got = {(r.yr, r.geo, r.opt): r.votes for r in INC.incremental_counts(spark, sf).collect()}
    con = duckdb.connect()
    exp = con.sql(f"""
        select cast(year(o_orderdate) as bigint) yr, cast(c_nationkey as bigint) geo, p_brand opt,
               cast(sum(case when o_orderstatus = 'F' then cast(l_quantity as bigint) else 0 end) as bigint) votes
        from read_parquet('{sf}/orders.parquet') o join read_parquet('{sf}/customer.parquet') on o_custkey = c_custkey
        join read_parquet('{sf}/lineitem.parquet') on o_orderkey = l_orderkey
        join read_parquet('{sf}/part.parquet') on l_partkey = p_partkey group by 1, 2, 3""").fetchall()
    assert got == {(a, b, c): d for a, b, c, d in exp}
