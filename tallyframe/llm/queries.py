"""Query registry of the training-data operators: name -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from tallyframe.llm import (
    chat, class_lm, decontaminate, html_text, licenses, merkle, mixing, near_dedup, piece_bpe, toxicity, vector_codes, vector_dedup,
    warc)
from tallyframe.llm.common import table

QUERIES = {
    "op1_license_scan": lambda spark, d: licenses.op1(table(spark, d, "documents")),
    "op2_mix": lambda spark, d: mixing.op2(table(spark, d, "documents")),
    "op3_toxicity": lambda spark, d: toxicity.op3(table(spark, d, "documents"), table(spark, d, "labels")),
    "op4_near_dedup": lambda spark, d: near_dedup.op4(table(spark, d, "documents")),
    "op5_decontaminate": lambda spark, d: decontaminate.op5(table(spark, d, "documents"), table(spark, d, "benchmark")),
    "op6_warc": lambda spark, d: warc.op6(spark, table(spark, d, "pages")),
    "op7_chat": lambda spark, d: chat.op7(table(spark, d, "conversations")),
    "op8_class_lm": lambda spark, d: class_lm.op8(table(spark, d, "documents")),
    "op9_vector_dedup": lambda spark, d: vector_dedup.op9(table(spark, d, "embeddings")),
    "op10_html_text": lambda spark, d: html_text.op10(table(spark, d, "pages")),
    "op11_piece_bpe": lambda spark, d: piece_bpe.op11(table(spark, d, "documents")),
    "op12_merkle": lambda spark, d: merkle.op12(table(spark, d, "documents")),
    "op13_vector_codes": lambda spark, d: vector_codes.op13(table(spark, d, "embeddings")),
}

ORACLE = {
    "op1_license_scan": licenses.oracle(),
    "op2_mix": mixing.oracle(),
    "op6_warc": warc.ORACLE,
    "op7_chat": chat.ORACLE,
    "op12_merkle": merkle.oracle(),
    "op13_vector_codes": vector_codes.oracle(),
}
