"""Plan assertions: JVM-only expressions, no cartesian / nested-loop joins, pushed-down scans."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from tallyframe.config import JobConfig
from tallyframe.plans import election as EL
from tallyframe.plans import proxy as P
from tallyframe.plans.oracle import ORACLE
from tallyframe.plans.queries import QUERIES
from tallyframe.sources import readers

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_any_sql_checked_query(spark):
    for key in ORACLE:
        p = plan(E.queries()[key](spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, key


def test_no_cartesian_or_nested_loop_join(spark):
    for key in QUERIES:
        if key in ("fit_lag_regressor", "compare_tree_models"):
            continue
        p = plan(E.queries()[key](spark, SF))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, key


def test_asof_align_has_no_join_on_inequality(spark):
    p = plan(E.queries()["asof_align"](spark, SF))
    assert "NestedLoop" not in p


def test_scan_pushes_filters_and_prunes_columns(spark):
    df = E.queries()["name_fallback"](spark, SF)
    p = plan(df)
    assert "PushedFilters: [IsNotNull(n_name), Not(StringEndsWith(n_name,3))]" in p
    df = E.queries()["parse_ratio"](spark, SF)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_suppkey:bigint,l_linenumber:int,l_extendedprice:double>" in plan(df)


def test_top1_uses_partial_window_group_limit(spark):
    p = plan(E.queries()["leader_per_group"](spark, SF))
    assert "WindowGroupLimit" in p


def test_station_rollups_have_hash_aggregates_only(spark):
    for key in ("rollup_station_totals", "share_of_total"):
        assert "SortAggregate" not in plan(E.queries()[key](spark, SF)), key


def _station_lines(spark, stations):
    """Two rows per station with three groups each (one of them with a blank panel), the first row's counts differing."""
    rows = []
    for i in range(stations):
        for copy in (0, 1):
            groups = ";".join(f"{'' if g == 2 else g};X;Name {g};;{i % 7 + g};0;0" for g in (1, 2, 3))
            rows.append((f"{i % 2 + 1};;{i % 5};{i};{10 + copy};{8 + copy};{6 + copy};{groups}", 2 * i + copy))
    return readers.parse_station_lines(spark.createDataFrame(rows, "line string, ordinal long"), P.STATION_HEADER)


def _shuffled(df):
    """Rows that each exchange of the plan wrote."""
    df.sparkSession.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.collect()
        todo, out = [df._jdf.queryExecution().executedPlan()], []
        while todo:
            p = todo.pop()
            if p.nodeName() == "Exchange":
                out.append(p.metrics().apply("shuffleRecordsWritten").value())
            todo += [p.children().apply(i) for i in range(p.children().size())]
        return out
    finally:
        df.sparkSession.conf.set("spark.sql.adaptive.enabled", "true")


def test_candidate_groups_shrink_before_any_exchange(spark):
    """Group records are summed map-side; only the header of a station crosses the exchange by station."""
    stations = 400
    parsed = _station_lines(spark, stations)
    departments = F.broadcast(spark.createDataFrame([("01", "One"), ("02", "Two")], "dept_code string, dept_name string"))
    r = EL.extract_station_rows(spark, parsed, 2017, JobConfig(target_codes=None), departments=departments)
    votes = {(x.dept_code, x.candidate_name): (x.votes, x.registered, x.votes_cast, x.votes_valid, x.dept_name) for x in r.collect()}
    want = {(f"0{d + 1}", f"NAME {g}"): (sum(2 * (i % 7 + g) for i in range(d, stations, 2)), 10 * 200, 8 * 200, 6 * 200, ("One", "Two")[d])
            for d in (0, 1) for g in (1, 3)}
    assert votes == want
    for cols, most in ((["dept_code", "candidate_name", "votes"], 100), (r.columns, 2 * stations + 200)):
        assert sum(_shuffled(r.select(*cols))) < most, cols


def test_station_rows_come_from_a_window_not_from_collected_lists(spark, tmp_path):
    """Chunks of three lines, a copy of every row of an urgent order, blank panel on every 4th line number."""
    tables = {
        "nation": ([(1, "N1"), (7, "N7")], "n_nationkey int, n_name string"),
        "customer": ([(10, 1), (11, 7)], "c_custkey long, c_nationkey int"),
        "part": ([(1, "B1"), (2, "B2"), (3, None)], "p_partkey long, p_brand string"),
        "orders": ([(100, 10, "F", "5-LOW"), (101, 11, "P", "1-URGENT")],
                   "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string"),
        "lineitem": ([(100, 1 + i % 2, 5, 7 - i, float(i + 1)) for i in range(7)] + [(101, 3, 5, 1, 9.0)],
                     "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double"),
    }
    for name, (rows, schema) in tables.items():
        df = spark.createDataFrame(rows, schema)
        if name == "orders":
            df = df.selectExpr("*", "date'1995-01-01' as o_orderdate", "1.0D as o_totalprice")
        if name == "lineitem":
            df = df.selectExpr("*", "date'1995-02-01' as l_shipdate")
        df.coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    df = P.station_lines(spark, str(tmp_path))
    assert "collect_list" not in plan(df)
    group = {ln: f"{'' if ln % 4 == 0 else ln};X;B{1 + (7 - ln) % 2};;{8 - ln};0;0" for ln in range(1, 8)}
    head = "1;N1;10;100;28;28;28;"
    want = [(head + ";".join(group[ln] for ln in lns), (100 << 20) + 2 * c) for c, lns in enumerate([(1, 2, 3), (4, 5, 6), (7,)])]
    want += [("7;;11;101;9;0;0;1;X;;9;0;0", (101 << 20) + copy) for copy in (0, 1)]
    assert sorted(map(tuple, df.collect()), key=lambda r: r[1]) == want
