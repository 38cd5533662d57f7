import duckdb
import pytest

from tallyframe.llm import mixing as X

SCHEMA = "doc_id long, text string, lang string, source string, epoch string"
COLS = ["domain", "lang", "source", "doc_id", "epoch", "n_tokens", "take_tokens"]


def compare(spark, documents, mix=X.Mix()):
    got = X.select(documents, mix).select(COLS)
    con = duckdb.connect()
    con.register("documents", documents.toPandas().astype({"doc_id": "Int64"}))
    want = con.execute(f"SELECT {', '.join(COLS)} FROM ({X.oracle(mix)})").fetchall()
    rows = [tuple(r) for r in got.collect()]
    assert sorted(rows, key=str) == sorted(want, key=str)
    return rows


def test_shortage_goes_to_siblings_first(spark):
    docs = [(i, "t " * 10, "en", "src1", "") for i in range(100)] + [(1000 + i, "t " * 10, "de", "src1", "") for i in range(5)]
    docs += [(2000 + i, "t " * 10, "en", "src11", "") for i in range(100)]
    mix = X.Mix(domain={"web": 50, "curated": 50}, lang={"en": 50, "de": 50}, budget_percent=50, max_epochs=1)
    rows = compare(spark, spark.createDataFrame(docs, SCHEMA), mix)
    take = {}
    for r in rows:
        take[r[:3]] = take.get(r[:3], 0) + r[6]
    # 2050 tokens in all, 1025 wanted: 512 a domain; German has 50 of its 256, English takes the rest
    assert take == {("web", "de", "src1"): 50, ("web", "en", "src1"): 462, ("curated", "en", "src11"): 512}


def test_epochs_nulls_ties_and_empty(spark):
    docs = [(1, "a b c", "en", "src1", ""), (1, "a b c", "en", "src1", ""), (None, "x y", None, None, ""), (2, None, "en", "src1", ""),
            (3, " \n\t", "en", "src2", ""), (4, "w " * 30_000, "fr", "src12", ""), (5, "é é z", "xx", "src3", "")]
    rows = compare(spark, spark.createDataFrame(docs, SCHEMA), X.Mix(budget_percent=300, max_epochs=4))
    assert max(r[4] for r in rows) >= 1 and all(1 <= r[6] <= r[5] for r in rows)
    assert X.select(spark.createDataFrame(docs[:0], SCHEMA)).count() == 0


@pytest.mark.parametrize("bucket", [1, 7, 512])
def test_table_equals_sql_whatever_the_bucket(spark, monkeypatch, bucket):
    monkeypatch.setattr(X, "BUCKET", bucket)
    compare(spark, spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
