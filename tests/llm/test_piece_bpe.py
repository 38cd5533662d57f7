import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyframe.llm import piece_bpe
from tallyframe.llm.common import table

MODEL = piece_bpe.model_bytes()
ENCODER = piece_bpe.Encoder(MODEL)

HARD = ["", " ", "   ", "a", " a", "a ", "\n\t\r", "</s><s><unk>", "<0x41>", "▁▁ ▁a", "日本語のテキスト", "🙂👩‍👩‍👧", "\x00\x01", "ǅ﻿​",
        "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "　ﬁé", "  double  spaces  ", "x" * 1000 + " " * 1000, "1234567890" * 30, "ÿþ́̀"]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(text):
    ids = ENCODER.sp.encode(text)
    assert ENCODER.encode(text) == ids
    assert ENCODER.decode(ids) == ENCODER.sp.decode(ids)


@settings(max_examples=400, deadline=None)
@given(st.one_of(st.text(max_size=80), st.text(alphabet="abcdehilnorst ▁\n'é", max_size=120)))
def test_equals_the_library(text):
    assert ENCODER.encode(text) == ENCODER.sp.encode(text)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="adehinorst", min_size=1, max_size=40))
def test_backtracking_equals_merging(text):
    assert ENCODER.tokens(text) == ENCODER.merge(text)


def test_long_segments_without_a_cut():
    for text in ("thequickbrownfoxjumpsoverthelazydog" * 600, "吾輩は猫である名前はまだ無い" * 1500, "a" * 50_000):
        assert ENCODER.encode(text) == ENCODER.sp.encode(text)


def test_tables_are_bounded(monkeypatch):
    monkeypatch.setattr(piece_bpe, "WORDS", 10)
    monkeypatch.setattr(piece_bpe, "PAIRS", 10)
    small = piece_bpe.Encoder(MODEL)
    text = " ".join(f"word{i} other{i * i}" for i in range(200))
    assert small.encode(text) == ENCODER.sp.encode(text)
    assert len(small.words) <= 10 and len(small.pairs) <= 10


def test_whole_table_equals_the_library(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r.doc_id: r for r in piece_bpe.op11(docs).collect()}
    sp = ENCODER.sp
    rows = docs.select("doc_id", "text").collect()
    assert len(got) == len(rows)
    for r in rows:
        ids = sp.encode(r.text or "")
        assert got[r.doc_id].n_tokens == len(ids)
        assert got[r.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[r.doc_id].decoded_sha256 == hashlib.sha256(sp.decode(ids).encode()).hexdigest()


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "y"), (3, "same text", "z"), (3, "same text", None), (None, "a", "ids")],
                                 "doc_id long, text string, ids string")
    got = sorted(((r.doc_id, r.ids, r.decoded) for r in piece_bpe.encode(docs).collect()), key=str)
    same = ENCODER.sp.encode("same text")
    assert got == sorted([(1, [], ""), (2, [], ""), (3, same, "same text"), (3, same, "same text"),
                          (None, ENCODER.sp.encode("a"), "a")], key=str)
    assert piece_bpe.op11(docs.limit(0)).collect() == []


def test_batches_are_cut(spark, monkeypatch):
    monkeypatch.setattr(piece_bpe, "BATCH_IDS", 5)
    docs = spark.range(50).selectExpr("id as doc_id", "repeat('some words ', cast(id as int)) as text").coalesce(1)
    got = {r.doc_id: r.ids for r in piece_bpe.encode(docs).collect()}
    assert got == {i: ENCODER.sp.encode("some words " * i) for i in range(50)}
