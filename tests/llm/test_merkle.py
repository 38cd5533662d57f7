import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from tallyframe.llm import merkle
from tallyframe.llm.common import table

DOC = "doc_id long, text string, lang string, source string, n_chars long"


def h(s):
    return hashlib.sha256(s.encode()).hexdigest()


def leaf_of(r, text):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r["doc_id"], r["source"], r["lang"], r["n_chars"], text)))


def climb(nodes):
    """Root and, for each node, its siblings level by level, written plainly."""
    paths, where = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, at in enumerate(where):
            run = at // 16 * 16
            paths[i].append(("".join(nodes[run:at]), "".join(nodes[at + 1:run + 16])))
        nodes = [h("".join(nodes[i:i + 16])) for i in range(0, len(nodes), 16)]
        where = [at // 16 for at in where]
    return nodes[0], paths


def brute(rows):
    """Every column of op12 for a list of dicts."""
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    sources = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    members, subroots, inner = [], [], []
    for s in sources:
        mine = sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
        root, paths = climb([leaf_of(r, r["text"]) for r in mine])
        members.append(mine)
        subroots.append(root)
        inner.append(paths)
    root, outer = climb(subroots)
    out = []
    for mine, sub, paths, top in zip(members, subroots, inner, outer):
        for r, path in zip(mine, paths):
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            folded = leaf_of(r, text)
            for left, right in path + top:
                folded = h(left + folded + right)
            out.append((r["doc_id"], leaf_of(r, r["text"]), sub, root, h("".join(a + b for a, b in path + top)), folded, folded == root))
    return out


def run(spark, rows):
    df = spark.createDataFrame([tuple(r[c] for c in ("doc_id", "text", "lang", "source", "n_chars")) for r in rows], DOC)
    cols = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    return [tuple(r[c] for c in cols) for r in merkle.op12(df.repartition(5)).collect()]


def doc(i, source, text="Some Text", **more):
    return {"doc_id": i, "source": source, "lang": "en", "n_chars": 9} | {"text": text} | more


@pytest.mark.parametrize("sizes", [[1], [17], [1, 1], [257, 256], [1, 16, 300, 15] + [1] * 40])
def test_shapes(spark, sizes):
    rows = [doc(1000 * s + i, f"s{s}", f"Text {i}") for s, n in enumerate(sizes) for i in range(n)]
    assert sorted(run(spark, rows)) == sorted(brute(rows))


def test_several_rounds_of_blocks(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    monkeypatch.setattr(merkle, "BLOCK", 16)
    rows = [doc(i, "hot") for i in range(4100)] + [doc(10_000 + i, f"x{i:03}") for i in range(300)]
    assert sorted(run(spark, rows)) == sorted(brute(rows))


def test_edge_rows(spark):
    long = "Very Long ß " * 200_000
    rows = [doc(5, None), doc(5, None), doc(5, None, "Other"), doc(None, "a"), doc(None, "a", None), doc(15, "é", ""), doc(10, "z", None, lang=None, n_chars=None),
            doc(20, "", long), doc(25, "B", "no capitals"), doc(-5, "B", "Ünï ÀÉ A")]
    got, want = run(spark, rows), brute(rows)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(not r[-1] for r in got) and any(r[-1] for r in got)
    assert run(spark, [])  == []


def test_general_interface_keeps_other_columns(spark):
    rows = spark.range(40).selectExpr("id", "id % 3 as root", "sha2(cast(id as string), 256) as leaf", "'x' as key", "array(id) as witness_of")
    got = merkle.manifest(rows, group="root", order="id", leaf="leaf")
    assert got.columns[:5] == ["id", "root", "leaf", "key", "witness_of"]
    folded = got.toDF("id", "grp", "leaf", "key", "other", "position", "witness", "subroot", "whole")
    assert folded.where(merkle.fold(F.col("leaf"), F.col("witness")) == F.col("whole")).count() == 40
    assert folded.where("other[0] = id and position = floor(id / 3)").count() == 40


def test_subtree_extends_partial_witnesses():
    tree = merkle.Subtree(2)
    for i in range(20):
        tree.append(h(str(i)))
        if i == 2:  # the second node's open witness: one digest left, one right so far
            assert tree.open[0][1]["left"] == h("0") and tree.open[0][1]["right"] == [h("2")]
    root, paths = climb([h(str(i)) for i in range(20)])
    assert tree.finish() == root and tree.witnesses == paths


def test_oracle(spark):
    d = "/root/testdata/sf0.001"
    duckdb.sql(f"create or replace view documents as select * from '{d}/documents.parquet'")
    want = sorted(duckdb.sql(merkle.oracle()).fetchall())
    cols = ("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")
    assert sorted(tuple(r[c] for c in cols) for r in merkle.op12(table(spark, d, "documents")).collect()) == want
