import duckdb
import pytest

from tallyframe.llm import licenses as X

SCHEMA = "path string, id long, text string, own string"


def scan(spark, rows, **more):
    return {r.id: (r.licence, r.evidence, r.from_dir) for r in X.scan(spark.createDataFrame(rows, SCHEMA), **more).collect()}


def test_headers_files_and_nearest_ancestor(spark):
    mit, apache = "Released under the MIT License.", "# Licensed under the Apache License, Version 2.0 (the License)"
    rows = [("LICENSE", 1, mit, ""), ("a/x.py", 2, "code\ncode", ""), ("a/b/COPYING.txt", 3, f"text\n{apache}\n", ""),
            ("a/b/c/d/y.py", 4, "words of the kind and under the", ""), ("a/b/z.py", 5, f"import x\n\n{mit}\nx = 1", ""),
            ("ab/q.py", 6, None, ""), ("a/bc/r.py", 7, "", ""), ("/abs/s.py", 8, "none", ""), (None, 9, "none", "")]
    got = scan(spark, rows)
    assert got[2] == ("MIT", "inherited", "") and got[4] == ("Apache-2.0", "inherited", "a/b")
    assert got[5] == ("MIT", "own", None) and got[6] == got[7] == ("MIT", "inherited", "")
    assert got[1][:2] == ("MIT", "own") and got[3][:2] == ("Apache-2.0", "own") and got[9] == ("MIT", "inherited", "")


def test_no_licence_anywhere_ties_and_empty(spark):
    rows = [("d/a", 1, "plain text under the sun", ""), ("d/a", 1, "plain text under the sun", "")]
    assert scan(spark, rows) == {1: (None, None, None)}
    assert X.scan(spark.createDataFrame(rows[:0], SCHEMA)).count() == 0
    both = "Licensed under CC BY 4.0\nLicensed under CC BY-NC 4.0"
    assert scan(spark, [("d/a", 1, both, ""), ("d/b", 2, "w " * 50_000, "")], by_edge_line=True)[2] == ("CC-BY-4.0", "inherited", "d")


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_op1_equals_sql(spark, sf):
    documents = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    got = sorted(map(str, (tuple(r) for r in X.op1(documents).select("path", "doc_id", "licence", "evidence", "score", "from_dir").collect())))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '/root/testdata/{sf}/documents.parquet'")
    assert got == sorted(map(str, con.execute(X.oracle()).fetchall())) and any("inherited" in r for r in got)


def test_heavy_terms_lose_nothing():
    idf = {t: 1.0 + len(t) for t in X.vocabulary()}
    rows, heavy = X.weights(idf)
    for i in range(len(X.TEMPLATES)):
        w = {t: x for k, _, t, x in rows if k == i}
        assert abs(sum(x * x for x in w.values()) - 1) < 1e-9
        assert sum(x * x for t, x in w.items() if t not in heavy) < X.THRESHOLD ** 2
