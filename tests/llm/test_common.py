import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from tallyframe.llm import common

KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n").split("\n")
    return {f for f in files if "/shuffle_" in f}


def test_a_written_table_leaves_no_shuffle_files(spark):
    """They go with the write that made them, while the frame is still in use."""
    before = shuffle_files(spark)
    df = spark.range(20_000).selectExpr("id % 7000 as k", "id").groupBy("k").count()
    out = common.materialize(df, "shuffled")
    until = time.time() + 20
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert out.count() == df.count() == 7000
    assert spark.conf.get(KEY, None) is None


def test_the_sessions_own_setting_comes_back(spark):
    spark.conf.set(KEY, "false")
    try:
        common.materialize(spark.range(5), "few")
        assert spark.conf.get(KEY) == "false"
    finally:
        spark.conf.unset(KEY)
