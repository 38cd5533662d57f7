"""Incremental load: redelivered and corrected orders, replayed batches, compaction, untouched buckets."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyframe.plans import proxy as P
from tallyframe.streaming import incremental as INC

SF = "/root/testdata/sf0.001"


def state(spark, target):
    return {(r.yr, r.geo, r.opt): (r.eligible, r.cast_n, r.votes) for r in INC.current_state(spark, target).collect()}


def expected(orders):
    rows = duckdb.sql(f"""
        select year(o_orderdate), c_nationkey, p_brand, sum(l_quantity::bigint)::bigint,
               sum(case when o_orderstatus <> 'P' then l_quantity::bigint else 0 end)::bigint,
               sum(case when o_orderstatus = 'F' then l_quantity::bigint else 0 end)::bigint
        from ({orders}) o join '{SF}/customer.parquet' on o_custkey = c_custkey join '{SF}/lineitem.parquet' on o_orderkey = l_orderkey
        join '{SF}/part.parquet' on l_partkey = p_partkey group by 1, 2, 3""").fetchall()
    return {r[:3]: r[3:] for r in rows}


def stamped(df, time, path="f"):
    return df.withColumn("__time", F.timestamp_seconds(F.lit(time))).withColumn("__path", F.lit(path))


@pytest.fixture
def small_buckets(monkeypatch):
    monkeypatch.setattr(INC, "BUCKET_KEYS", 512)


def test_corrected_and_redelivered_files(spark, small_buckets, tmp_path):
    orders = P.table(spark, SF, "orders")
    land, table, cp = (str(tmp_path / x) for x in ("land", "table", "cp"))
    corrected = orders.where("o_orderkey % 5 = 0").withColumn("o_orderstatus", F.lit("F")).withColumn("o_custkey", F.lit(1).cast("bigint"))
    for i, part in enumerate([orders.where("o_orderkey % 2 = 0"), orders, corrected, orders.where("o_orderkey % 7 = 1")]):
        part.coalesce(1).write.parquet(f"{land}/{i}")
        INC.run_incremental(spark, land, SF, table, cp, "*.parquet")
    want = expected(f"""select o_orderkey, case when o_orderkey % 5 = 0 and o_orderkey % 7 <> 1 then 1 else o_custkey end o_custkey, o_orderdate,
        case when o_orderkey % 5 = 0 and o_orderkey % 7 <> 1 then 'F' else o_orderstatus end o_orderstatus from '{SF}/orders.parquet'""")
    assert state(spark, table) == want
    INC.run_incremental(spark, land, SF, table, cp, "*.parquet")  # nothing new
    assert state(spark, table) == want


def test_replayed_batch_and_compaction(spark, small_buckets, tmp_path):
    orders, table = P.table(spark, SF, "orders"), str(tmp_path / "table")
    INC.replace_batch(stamped(orders, 1), 0, SF, table)
    plain = expected(f"select * from '{SF}/orders.parquet'")
    assert state(spark, table) == plain
    changed = orders.where("o_orderkey < 1000").withColumn("o_orderstatus", F.lit("P"))
    want = expected(f"""select * replace (case when o_orderkey < 1000 then 'P' else o_orderstatus end as o_orderstatus) from '{SF}/orders.parquet'""")
    untouched = os.path.join(table, "orders/batch_id=0/bucket=2")
    files = sorted((f, os.path.getmtime(os.path.join(untouched, f))) for f in os.listdir(untouched))
    for _ in range(2):  # the second time is a replay after the commit
        INC.replace_batch(stamped(changed, 2), 1, SF, table)
        assert state(spark, table) == want
        assert os.path.exists(os.path.join(table, "orders/batch_id=0/bucket=0"))  # a replay of batch 1 needs it
    INC.replace_batch(stamped(orders.where("o_orderkey < 100"), 3), 2, SF, table)
    assert not os.path.exists(os.path.join(table, "orders/batch_id=0/bucket=0"))  # superseded below batch 2
    assert sorted((f, os.path.getmtime(os.path.join(untouched, f))) for f in os.listdir(untouched)) == files
    INC.replace_batch(stamped(orders.where("o_orderkey < 100"), 3), 2, SF, table)
    INC.replace_batch(stamped(orders, 4), 3, SF, table)
    assert state(spark, table) == plain


def test_uncommitted_batch_is_not_seen_and_newest_file_wins(spark, small_buckets, tmp_path):
    orders, table = P.table(spark, SF, "orders"), str(tmp_path / "table")
    both = stamped(orders.withColumn("o_orderstatus", F.lit("P")), 1, "z").unionByName(stamped(orders, 2, "a"))
    INC.replace_batch(both, 0, SF, table)
    plain = expected(f"select * from '{SF}/orders.parquet'")
    assert state(spark, table) == plain
    spark.createDataFrame([(0, 1, 1, "x", 9, 9, 9)], "o_orderkey long, yr long, geo long, opt string, eligible long, cast_n long, votes long") \
        .write.parquet(f"{table}/counts/batch_id=1/bucket=0")
    assert state(spark, table) == plain
    INC.replace_batch(stamped(orders.limit(0), 5), 2, SF, table)  # an empty batch
    assert state(spark, table) == plain and INC.current_state(spark, str(tmp_path / "none")).collect() == []
