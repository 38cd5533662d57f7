"""asof_join on a hot key (a third of all rows) against brute force, carries across buckets."""

import random

from pyspark.sql import functions as F

from tallyframe.operators import joins as J


def test_asof_join_hot_key_matches_brute_force(spark):
    rnd = random.Random(7)
    right = {}
    for key in range(30):
        n = 300 if key == 0 else 20  # key 0 holds about a third of the right rows
        for t in rnd.sample(range(0, 5000), n):
            right[(key, t)] = rnd.randint(0, 10**6)
    probes = [(i, rnd.randrange(30) if i % 3 else 0, rnd.randrange(-100, 5100)) for i in range(3000)]
    r = spark.createDataFrame([(k, t, v) for (k, t), v in right.items()], "k long, rt long, v long")
    p = spark.createDataFrame(probes, "pid long, k long, lt long")
    out = J.asof_join(p, r, ["k"], "lt", "rt", ["v"], bucket=(F.col("lt") / 500).cast("long"),
                      right_bucket=(F.col("rt") / 500).cast("long"), matched_time="mt")
    got = {row.pid: (row.mt, row.v) for row in out.collect()}
    by_key = {}
    for (k, t), v in right.items():
        by_key.setdefault(k, []).append((t, v))
    for pid, k, lt in probes:
        cands = [(t, v) for t, v in by_key.get(k, []) if t <= lt]
        exp = max(cands) if cands else (None, None)
        assert got[pid] == exp, (pid, k, lt)
    assert len(got) == len(probes)


def test_bucketed_history_matches_window(spark):
    from tallyframe.operators import rank as W

    rnd = random.Random(3)
    rows = []
    for key in range(20):
        n = 400 if key == 0 else 15  # hot key
        for t in sorted(rnd.sample(range(0, 3000), n)):
            rows.append((key, t, rnd.randint(0, 1000)))
    df = spark.createDataFrame(rows, "k long, t long, v long")
    plain = W.with_history(df, ["k"], "t", ["v"])
    bucketed = W.with_history(df, ["k"], "t", ["v"], bucket=(F.col("t") / 250).cast("long"))
    cols = ["k", "t", "v", "v_lag1", "v_change"]
    assert sorted(map(tuple, plain.select(cols).collect())) == sorted(map(tuple, bucketed.select(cols).collect()))
