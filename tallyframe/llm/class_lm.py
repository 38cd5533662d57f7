"""Brown class-based bigram model: exchange clustering, class transitions, word emissions.

Tokens are the words of the text (A-Z lower-cased, split at ASCII white space) and one
end token.  P(w | context) = (1 - u) P(class(w) | class before) P(w | class(w)) for words that
training knows and u for the unknown word; u is the share of training tokens that occur once
(Good-Turing).  Transitions are smoothed towards the classes' own frequencies; the class before is that
of the nearest known word before.

Classes.  All words with at least 1/(2 * ``SEED_SHARE``) of all training tokens (so no more than
``2 * SEED_SHARE`` whatever the corpus), and the end token, are clustered by exchange; they are found exactly,
however the documents are dealt over tasks and batches.  Each such word
moves to the class that raises the class-bigram likelihood most, sweep by sweep, on counts over the whole
training corpus.  Every other word of the corpus then takes one exchange step in Spark: each
block of documents counts the classes before and behind the word, the counts are summed over all blocks,
and the word gets the class that its neighbours in the whole corpus make likeliest.

Nothing that grows with the vocabulary is on the driver or broadcast: counts and classes are a
table by word hash (64 bits), and each block of documents gets the entries of its own
words by one join.  The driver holds seed words, class counts and transitions, all of fixed size.

Edge cases: null and empty texts are one end token; null ids are the empty text for the fold; without
training documents every word is unknown; repeated rows are documents of their own; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import fold_of, materialize

CLASSES = 32
SEED_SHARE = 1_000
SLACK = 8  # a batch lists words with 1/(SLACK * 2 * SEED_SHARE) of its tokens
SWEEPS = 10
ALPHA = 5.0  # pseudo-count of the class frequencies in a transition row
BLOCK_BITS = 13  # 8,192 documents a block
END = b""


def tokens(text: str | None) -> list[bytes]:
    """Words as bytes, then the end token; bytes.lower and bytes.split know ASCII alone."""
    return [*(text or "").encode("utf-8", "surrogatepass").lower().split(), END]


def hash_of(token: bytes) -> int:
    h = xxhash.xxh64_intdigest(token)
    return h - 2 ** 64 if h >= 2 ** 63 else h


class Numbers(dict):
    """token -> its number in order of appearance."""

    def __missing__(self, token: bytes) -> int:
        v = self[token] = len(self)
        return v

    def of(self, text: str | None) -> np.ndarray:
        toks = tokens(text)
        return np.fromiter(map(self.__getitem__, toks), "int32", len(toks))

    def hashes(self) -> np.ndarray:
        return np.fromiter((xxhash.xxh64_intdigest(t) for t in self), "uint64", len(self)).astype("int64")


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, other) -> np.ndarray:
    """values at the places of ``wanted`` in ``keys`` (distinct), ``other`` where there is none."""
    if not len(keys):
        return np.full(len(wanted), other, dtype=values.dtype)
    order = np.argsort(keys)
    at = np.minimum(np.searchsorted(keys[order], wanted), len(keys) - 1)
    return np.where(keys[order][at] == wanted, values[order][at], other)


def _xlogx(x):
    return np.where(x > 0, x * np.log(np.maximum(x, 1e-300)), 0.0)


def exchange(n: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each word from its bigram counts n (words x words), by exchange clustering."""
    words = len(n)
    size = n.sum(axis=0) + n.sum(axis=1)
    cls = np.empty(words, dtype="int64")
    cls[np.argsort(-size, kind="stable")] = np.arange(words) % classes
    one = np.eye(classes)[cls]
    big = one.T @ n @ one
    for _ in range(sweeps):
        moved = 0
        for w in np.argsort(-size, kind="stable"):
            a = cls[w]
            row, col, self_ = n[w].astype(float), n[:, w].astype(float), float(n[w, w])
            row[w] = col[w] = 0
            r = np.bincount(cls, row, classes)
            l = np.bincount(cls, col, classes)  # noqa: E741
            big[a] -= r
            big[:, a] -= l
            big[a, a] -= self_
            left, right = big.sum(axis=1), big.sum(axis=0)
            gain = (_xlogx(big + r) - _xlogx(big)).sum(axis=1) + (_xlogx(big + l[:, None]) - _xlogx(big)).sum(axis=0)
            d = np.diag(big)
            gain += _xlogx(d + r + l + self_) - _xlogx(d + r) - _xlogx(d + l) + _xlogx(d)
            gain -= _xlogx(left + r.sum() + self_) - _xlogx(left) + _xlogx(right + l.sum() + self_) - _xlogx(right)
            b = int(np.argmax(gain))
            if gain[b] <= gain[a] + 1e-9:
                b = a
            big[b] += r
            big[:, b] += l
            big[b, b] += self_
            moved += b != a
            cls[w] = b
        if not moved:
            break
    return cls


def transitions(counts: np.ndarray, alpha: float = ALPHA) -> np.ndarray:
    """P(class | class before), rows smoothed towards the class frequencies."""
    share = (counts.sum(axis=0) + 1e-3) / (counts.sum() + 1e-3 * len(counts))
    return (counts + alpha * share) / (counts.sum(axis=1, keepdims=True) + alpha)


def _counter(texts) -> Counter[bytes]:
    c: Counter[bytes] = Counter()
    for t in texts:
        c.update(tokens(t))
    return c


def _frequent(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Per batch of training documents: tokens in all (h null), and words with 1/(SLACK * 2 * SEED_SHARE) of them."""
    for pdf in it:
        c = _counter(pdf["text"])
        n = c.total()
        rows = [(hash_of(w), k) for w, k in c.items() if k * SLACK * 2 * SEED_SHARE >= n or w == END]
        yield pd.DataFrame({"h": pd.array([None, *(h for h, _ in rows)], dtype="Int64"), "n": [n, *(k for _, k in rows)]})


def _occurrences(words: np.ndarray):
    """How often each of ``words`` (hashes) occurs."""
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(words), dtype="int64")
        for pdf in it:
            c = _counter(pdf["text"])
            at = _lookup(words, np.arange(len(words)), np.fromiter(map(hash_of, c), "int64", len(c)), -1)
            n = np.fromiter(c.values(), "int64", len(c))
            np.add.at(total, at[at >= 0], n[at >= 0])
        yield pd.DataFrame({"h": words, "n": total})

    return run


def _seed_words(train: DataFrame) -> tuple[int, np.ndarray]:
    """Training tokens in all, and the hashes of all words with 1/(2 * SEED_SHARE) of them and of the end token, frequent first.

    Batches list their frequent words.  Where a batch doesn't list a word, it has less than 1/(SLACK * 2 * SEED_SHARE)
    of the batch, so a seed word's listed counts make at least (SLACK - 1)/(SLACK * 2 * SEED_SHARE) of all tokens; no more
    than SLACK * 2 * SEED_SHARE / (SLACK - 1) words reach that, and their occurrences are counted in every document.
    """
    common = materialize(
        train.mapInPandas(_frequent, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")), "lm-common")
    total = int(common.where("h is null").agg(F.sum("n")).first()[0] or 0)
    likely = (F.col("n") * SLACK * 2 * SEED_SHARE >= total * (SLACK - 1)) | (F.col("h") == hash_of(END))
    words = np.array(sorted(r.h for r in common.where("h is not null").where(likely).select("h").collect()), dtype="int64")
    if not len(words):
        return total, words
    rows = train.mapInPandas(_occurrences(words), "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).collect()
    rows = [r for r in rows if r.n * 2 * SEED_SHARE >= total or r.h == hash_of(END)]
    return total, np.array([r.h for r in sorted(rows, key=lambda r: (-r.n, r.h))], dtype="int64")


def _bigrams(seeds: np.ndarray):
    """Bigram counts of the seed words (hashes), other words skipped; the end token parts documents."""
    size = len(seeds)
    end = int(np.flatnonzero(seeds == hash_of(END))[0]) if size else 0

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(size * size, dtype="int64")
        for pdf in it:
            numbers = Numbers()
            ids = [numbers.of(t) for t in pdf["text"]]
            place = _lookup(seeds, np.arange(size), numbers.hashes(), -1)
            p = place[np.concatenate(ids)] if ids else np.zeros(0, "int64")
            p = np.r_[end, p[p >= 0]]
            total += np.bincount(p[:-1] * size + p[1:], minlength=size * size)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"pair": at, "n": total[at]})

    return run


def _evidence(seeds: np.ndarray, cls: np.ndarray):
    """Per block: each word's training count and the classes around it.

    ``e`` has a byte for each neighbour of an occurrence (class before, CLASSES + class behind) or, where that is longer,
    2 * CLASSES counts of 32 bits; a seed word's is the byte 2 * CLASSES + its class.
    """
    k = CLASSES
    end = int(cls[seeds == hash_of(END)][0]) if len(seeds) else 0

    def rows(block: int, numbers: Numbers, train: list[np.ndarray]) -> Iterator[pd.DataFrame]:
        n = len(numbers)
        hashes = numbers.hashes()
        numbers.clear()
        known = _lookup(seeds, cls, hashes, -1).astype("int16")
        stream = np.concatenate(train) if train else np.zeros(0, "int32")
        train.clear()
        count = np.bincount(stream, minlength=n)
        c = known[stream]
        seen = np.flatnonzero(c >= 0).astype("int32")
        rare = np.flatnonzero(c < 0).astype("int32")
        path = np.r_[end, c[seen], end].astype("uint8")
        nxt = np.searchsorted(seen, rare).astype("int32")
        around = np.stack([path[nxt], path[nxt + 1] + np.uint8(k)], axis=1)
        word = stream[rare]
        del c, seen, rare, nxt, stream
        order = np.argsort(word, kind="stable").astype("int32")
        around = around[order]
        del order
        ends = np.cumsum(np.where(known < 0, count, 0))
        whole = around.tobytes()
        for at in range(0, n, 100_000):
            part = slice(at, at + 100_000)
            e = []
            for i, m in enumerate(count[part].tolist(), at):
                if known[i] >= 0:
                    e.append(bytes([2 * k + known[i]]))
                elif m < 4 * k:  # shorter than the counts
                    e.append(whole[2 * (ends[i] - m):2 * ends[i]])
                else:
                    e.append(np.bincount(around[ends[i] - m:ends[i]].ravel(), minlength=2 * k).astype("int32").tobytes())
            yield pd.DataFrame({"block": np.full(len(e), block), "h": hashes[part], "c": count[part], "e": e})

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # the rows of a block follow each other, in one batch of the task or more
        at, numbers, train = None, Numbers(), []
        for pdf in it:
            for block, text, held in zip(pdf["block"], pdf["text"], pdf["held_out"]):
                if block != at and at is not None:
                    yield from rows(at, numbers, train)
                at = block
                ids = numbers.of(text)
                if not held:
                    train.append(ids)
        if at is not None:
            yield from rows(at, numbers, train)

    return run


def _decide(trans: np.ndarray):
    """Of rows (h, c, e) ordered by h: each word's count and the class that its neighbours make likeliest."""
    k = len(trans)
    log = np.log(trans)
    weight = np.concatenate([log, log.T])  # by class before and class behind: log weight of each class

    def close(h: np.ndarray, c: np.ndarray, counts: np.ndarray, seed: np.ndarray) -> pd.DataFrame:
        vote = (counts @ weight).round(6).argmax(axis=1)
        return pd.DataFrame({"h": h, "c": c, "k": np.where(seed >= 0, seed, vote).astype("int32")})

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last = None  # the word that the next batch may go on with
        for pdf in it:
            if not len(pdf):
                continue
            h, e = pdf["h"].to_numpy(), pdf["e"].tolist()
            word = np.cumsum(np.r_[False, h[1:] != h[:-1]])
            h = h[np.r_[True, h[1:] != h[:-1]]]
            c = np.bincount(word, pdf["c"]).astype("int64")
            size = np.fromiter(map(len, e), "int64", len(e))
            wide = size == 8 * k
            counts = np.zeros((len(h), 2 * k))
            for i in np.flatnonzero(wide):
                counts[word[i]] += np.frombuffer(e[i], "int32")
            flat = np.frombuffer(b"".join(x for x, w in zip(e, wide) if not w), "uint8")
            of = np.repeat(word[~wide], size[~wide])
            seed = np.full(len(h), -1)
            seed[of[flat >= 2 * k]] = flat[flat >= 2 * k].astype("int64") - 2 * k
            of, flat = of[flat < 2 * k], flat[flat < 2 * k]
            counts += np.bincount(of * (2 * k) + flat, minlength=counts.size).reshape(counts.shape)
            if last is not None and last[0][0] == h[0]:
                c[0] += last[1][0]
                counts[0] += last[2][0]
                seed[0] = max(seed[0], last[3][0])
            elif last is not None:
                yield close(*last)
            yield close(h[:-1], c[:-1], counts[:-1], seed[:-1])
            last = h[-1:], c[-1:], counts[-1:], seed[-1:]
        if last is not None:
            yield close(*last)

    return run


_DOC = ("doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, emission double, moves binary")


def _scorer(total: int, vocab: int, sizes: np.ndarray, end: int):
    """Per block: everything of a document's score that doesn't depend on the transitions, and its class moves."""
    k = len(sizes)
    base_denominator = total + 0.5 * (vocab + 1)
    log_sizes = np.log10(np.maximum(sizes, 1))

    def run(key, docs, words):
        numbers = Numbers()
        ids = [numbers.of(t) for t in docs["text"]]
        hashes = numbers.hashes()
        numbers.clear()
        h = words["h"].to_numpy()
        c = _lookup(h, words["c"].to_numpy(), hashes, 0)
        cls = _lookup(h, words["k"].to_numpy().astype("int64"), hashes, 0)
        base = np.log10((c + 0.5) / base_denominator)
        emit = np.log10(np.maximum(c, 1)) - log_sizes[cls]
        out = []
        for doc_id, held, p in zip(docs["doc_id"], docs["held_out"], ids):
            known = p[c[p] > 0]
            path = np.r_[end, cls[known]]
            pair, n = np.unique(path[:-1] * k + path[1:], return_counts=True)
            moves = np.stack([pair, n]).astype("int32").tobytes()
            out.append((doc_id, held, len(p), len(known), float(base[p].sum()), float(emit[known].sum()), moves))
        f = pd.DataFrame(out, columns=[x.split()[0] for x in _DOC.split(", ")])
        f["doc_id"] = f["doc_id"].astype("Int64")
        return f

    return run


def _sum_moves(k: int):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(k * k, dtype="int64")
        for pdf in it:
            for b in pdf["moves"]:
                pair, n = np.frombuffer(b, "int32").reshape(2, -1)
                total[pair] += n
        at = np.flatnonzero(total)
        yield pd.DataFrame({"pair": at, "n": total[at]})

    return run


def score(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    base = materialize(
        docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"),
                    (fold_of("doc_id") == 1).alias("held_out"),
                    F.shiftright(F.monotonically_increasing_id(), BLOCK_BITS).alias("block")), "lm-docs")
    train = base.where("not held_out").select("text")
    total, seeds = _seed_words(train)
    size = len(seeds)
    cls, trans = np.zeros(0, dtype="int64"), np.full((CLASSES, CLASSES), 1 / CLASSES)
    if size:
        pairs = (train.mapInPandas(_bigrams(seeds), "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
                 .toPandas())
        n = np.zeros(size * size)
        n[pairs["pair"].to_numpy()] = pairs["n"].to_numpy()
        n = n.reshape(size, size)
        cls = exchange(n)
        one = np.eye(CLASSES)[cls]
        trans = transitions(one.T @ n @ one)
    words = materialize(base.select("block", "text", "held_out").mapInPandas(
        _evidence(seeds, cls), "block long, h long, c long, e binary"), "lm-words")
    table = materialize(
        words.where("c > 0").select("h", "c", "e").repartition("h").sortWithinPartitions("h")
        .mapInPandas(_decide(trans), "h long, c long, k int"), "lm-table")
    by_class = {r.k: r for r in table.where("c > 0").groupBy("k").agg(
        F.sum("c").alias("n"), F.count(F.lit(1)).alias("v"), F.sum((F.col("c") == 1).cast("long")).alias("once")).collect()}
    vocab = sum(r.v for r in by_class.values())
    once = sum(r.once for r in by_class.values())
    sizes = np.array([by_class[i].n if i in by_class else 0 for i in range(CLASSES)], dtype="int64")
    end = int(cls[seeds == hash_of(END)][0]) if size else 0
    entries = words.select("block", "h").join(table, "h")
    parts = materialize(
        base.groupBy("block").cogroup(entries.groupBy("block"))
        .applyInPandas(_scorer(total, vocab, sizes, end), _DOC), "lm-parts")
    sums = (parts.where("not held_out").select("moves").mapInPandas(_sum_moves(CLASSES), "pair long, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")).toPandas())
    moves = np.zeros(CLASSES * CLASSES)
    moves[sums["pair"].to_numpy()] = sums["n"].to_numpy()
    log_trans = np.log10(transitions(moves.reshape(CLASSES, CLASSES))).ravel()
    unknown = (once + 0.5) / (total + 1)
    log_unknown, log_known = math.log10(unknown), math.log10(1 - unknown)

    @F.pandas_udf("double")
    def moved(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in it:
            out = []
            for b in s:
                pair, n = np.frombuffer(b, "int32").reshape(2, -1)
                out.append(float((log_trans[pair] * n).sum()))
            yield pd.Series(out, dtype="float64")

    return parts.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(int(total)).cast("long").alias("train_tokens"), "base_score",
        (F.col("emission") + moved("moves") + F.col("n_known") * log_known
         + (F.col("n_tokens") - F.col("n_known")) * log_unknown).alias("score"))


def op8(docs: DataFrame) -> DataFrame:
    return score(docs)
