"""Toxicity: weighted lexicon, Aho-Corasick over folded text, length-normalised.

Folding maps look-alike letters to Latin ones, undoes digit and sign
substitutions inside words and turns every other character into a space, so
that every pattern is anchored at a word start (`` idiot ``, `` lowei``).  The
lexicon (whole words and word stems with their log-odds) and the calibration
are learned from labelled rows; hits inside an exception phrase do not count.

Edge cases: null and empty texts have no hit and get the score of a text
without hits; labels that are null are not used; a document with several labels
counts as toxic if one says so; without any usable label of both kinds the
lexicon is empty and every score is the share of toxic labels (0 without any).
Repeated rows are scored one by one; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import fold_of, materialize

#: Labelled rows that the lexicon and the calibration are fitted on, at most (by hash of the id).
MAX_TRAIN = 20_000
#: A pattern must occur in this many toxic training texts.
MIN_TOXIC = 5
STEMS = (4, 5, 6)
#: Log-odds from which a pattern enters the lexicon.
MIN_WEIGHT = 3.0

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = {
    "а": "a", "в": "b", "с": "c", "е": "e", "н": "h", "і": "i", "ј": "j", "к": "k", "м": "m",
    "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԁ": "d", "ԛ": "q", "ԝ": "w",
    "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p",
    "τ": "t", "υ": "u", "χ": "x", "ı": "i", "ɑ": "a", "ɡ": "g", "ⅼ": "l",
}
#: Digits and signs that stand for letters inside a word.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s", "!": "i"}
#: Phrases whose words are harmless together.
EXCEPTIONS = ("pond scum", "trash can", "trash bag", "clown fish", "class clown", "idiot proof", "sore loser")

_LOOK = str.maketrans(HOMOGLYPHS)
_SUBS = str.maketrans(SUBSTITUTES)
_MIXED = re.compile(r"(?<![^\W_])[0-9@$!]*[^\W\d_](?:[^\W_]|[@$!](?=[^\W_]))*|(?<![^\W_])[@$!0-9]+(?=[^\W\d_])")
_SUSPECT = re.compile(r"[0-9@$!]")
_GAP = re.compile(r"[\W_]+")


def fold(text: str | None) -> str:
    """Folded text: words separated and surrounded by one space."""
    if not text:
        return " "
    t = text.lower()
    if not t.isascii():
        t = unicodedata.normalize("NFKC", t).lower().translate(_LOOK)
        t = re.sub("[­​-‏⁠﻿]", "", t)
    if _SUSPECT.search(t):
        t = _MIXED.sub(lambda m: m[0].translate(_SUBS), t)
    return " " + _GAP.sub(" ", t).strip() + " " if t else " "


def _patterns(folded: str) -> set[str]:
    out = set()
    for w in set(folded.split()):
        if len(w) >= 3 and not w.isdigit():
            out.add(f" {w} ")
            out.update(f" {w[:k]}" for k in STEMS if len(w) > k)
    return out


def _automaton(keys):
    import ahocorasick

    a = ahocorasick.Automaton()
    for k in keys:
        a.add_word(k, k)
    if len(a):
        a.make_automaton()
    return a


def hits(folded: str, lexicon, exceptions) -> list[str]:
    """Lexicon patterns that occur at each word (the longest one), outside exception phrases."""
    if not len(lexicon):
        return []
    best: dict[int, str] = {}
    for end, key in lexicon.iter(folded):
        at = end - len(key) + 1
        if at not in best or len(key) > len(best[at]):
            best[at] = key
    if best and len(exceptions):
        for end, key in exceptions.iter(folded):
            for at in range(end - len(key) + 1, end):
                best.pop(at, None)
    return list(best.values())


def features(folded: str, weights: dict[str, float], lexicon, exceptions) -> tuple[float, float, int]:
    """(sum of weights, sum of weights per 100 words, hits)."""
    found = hits(folded, lexicon, exceptions)
    s = sum(weights[k] for k in found)
    return s, 100.0 * s / max(1, folded.count(" ") - 1), len(found)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; the first column of x is 1."""
    b = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (y - p) - 1e-2 * b
        h = (x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(len(b))
        step = np.linalg.solve(h, g)
        b = b + np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return b


class ToxicityModel:
    """weights: pattern -> log-odds; beta: calibration of (1, log sum, log density)."""

    def __init__(self, weights: dict[str, float], beta: list[float], exceptions=EXCEPTIONS):
        self.weights, self.beta = weights, beta
        self.exceptions = [f" {' '.join(fold(e).split())} " for e in exceptions]

    def scorer(self):
        lexicon, exceptions = _automaton(self.weights), _automaton(self.exceptions)

        def score(text: str | None) -> tuple[float, int]:
            s, d, n = features(fold(text), self.weights, lexicon, exceptions)
            z = self.beta[0] + self.beta[1] * math.log1p(s) + self.beta[2] * math.log1p(d)
            return 1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), n

        return score


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> ToxicityModel:
    """Fit lexicon and calibration on labelled rows whose fold is not 0."""
    marked = (labels.where("toxic is not null").groupBy(F.col("doc_id").alias("_id"))
              .agg(F.max("toxic").alias("_toxic")))
    rows = (docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
            .where((fold_of("_id") != 0) & F.col("_id").isNotNull()))
    # the bounded sample is drawn from the labels alone; texts are joined to it
    sample = (marked.where(fold_of("_id") != 0)
              .orderBy(F.xxhash64("_id"), "_id").limit(max_train))
    fit = materialize(rows.join(F.broadcast(sample), "_id"), "toxic-train")  # at most max_train pairs of numbers
    n = {bool(r[0]): r[1] for r in fit.groupBy(F.col("_toxic") > 0).count().collect()}
    toxic, clean = n.get(True, 0), n.get(False, 0)
    if not toxic or not clean:
        share = toxic / max(1, toxic + clean)
        p = min(max(share, 1e-9), 1 - 1e-9)
        return ToxicityModel({}, [math.log(p / (1 - p)), 0.0, 0.0])
    least = max(MIN_TOXIC, toxic // 200) if toxic >= 4 * MIN_TOXIC else 2

    def emit(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            keys = [k for t in pdf["_text"] for k in _patterns(fold(t))]
            yield pd.DataFrame({"k": keys})

    found = (fit.where("_toxic > 0").select("_text").mapInPandas(emit, "k string")
             .groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least).collect())
    in_toxic = {r.k: r.n for r in found}  # bounded: the sample's patterns with that support

    def count_clean(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        a = _automaton(in_toxic)
        total: dict[str, int] = {}
        for pdf in it:
            for t in pdf["_text"]:
                for k in {k for _, k in a.iter(fold(t))} if len(a) else ():
                    total[k] = total.get(k, 0) + 1
        yield pd.DataFrame({"k": list(total), "n": list(total.values())}).astype({"k": "object", "n": "int64"})

    in_clean = {r.k: r.n for r in fit.where("_toxic = 0").select("_text")
                .mapInPandas(count_clean, "k string, n long")
                .groupBy("k").agg(F.sum("n").alias("n")).collect()}
    weights = {}
    for k, a in in_toxic.items():
        w = math.log((a + 0.5) / (toxic + 1)) - math.log((in_clean.get(k, 0) + 0.5) / (clean + 1))
        if w >= MIN_WEIGHT:
            weights[k] = round(w, 6)
    model = ToxicityModel(weights, [0.0, 0.0, 0.0])

    def feats(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon, exceptions = _automaton(model.weights), _automaton(model.exceptions)
        for pdf in it:
            f = [features(fold(t), model.weights, lexicon, exceptions) for t in pdf["_text"]]
            yield pd.DataFrame({"s": [x[0] for x in f], "d": [x[1] for x in f], "y": (pdf["_toxic"] > 0).astype(float)})

    x = fit.mapInPandas(feats, "s double, d double, y double").toPandas()
    x = x.sort_values(["s", "d", "y"])
    m = np.column_stack([np.ones(len(x)), np.log1p(x["s"]), np.log1p(x["d"])])
    model.beta = [float(b) for b in _logistic(m, x["y"].to_numpy())]
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """All columns of ``docs`` packed in ``_row`` plus ``_score``, ``_hits``."""
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col("text").alias("_text"))

    @F.pandas_udf("struct<score double, hits int>")
    def run(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        f = model.scorer()
        for texts in it:
            r = [f(t) for t in texts]
            yield pd.DataFrame({"score": [x[0] for x in r], "hits": np.array([x[1] for x in r], dtype="int32")})

    return (packed.withColumn("_s", run("_text"))
            .select("_row", F.col("_s.score").alias("_score"), F.col("_s.hits").alias("_hits")))


def op3(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        F.col("_row.doc_id").alias("doc_id"), (fold_of("_row.doc_id") == 0).alias("held_out"),
        F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted"),
        F.col("_hits").alias("n_hits"))
