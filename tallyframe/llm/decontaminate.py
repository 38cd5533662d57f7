"""Benchmark decontamination: CGK embedding and bit-sampling LSH over item-sized windows.

Texts are lower-cased runs of letters and digits.  An item of n words is in a
document if some stretch of the document is within floor(0.2 n) word edits of
it.  For every window of n words a CGK walk copies symbols to the output and
moves on in the input when a random bit of (step, symbol) says so; texts that are
close in edit distance get outputs that are close in Hamming distance.  Each of
``WALKS`` walks is sampled ``SAMPLES`` times at ``BITS`` output positions, and
a window that agrees with an item in all positions of a sample is a candidate.

A walk falls out of step for good when there are many edits, however long the text: the distortion grows with the square of
their number.  So items of two or more times ``PIECE`` words are cut into pieces of PIECE to 2 PIECE - 1 words, and
windows have the pieces' sizes.  That loses nothing: of all pieces at least one has no more than its share of the item's edits,
floor(0.2 l) for l words; recall depends on the pieces' sizes alone and grows with the item's length.

Every start in the text is a window, so that walks which start behind an early
edit also find the item; up to floor(0.2 l) words of a window may lie before the document's
start or behind its end (padding), so that documents shorter than the item and stretches at either end
are found as those in the middle are.  Candidates are verified by exact (Sellers) edit distance, the piece first, then
the whole item.

Windows that can't match are left out before the walk, without loss: at least
l - floor(0.2 l) of their words must be words of the pieces of that length, and as many
different ones as the least varied of these pieces has, less floor(0.2 l).

The random bits are a hash of walk, step and the word itself, so an answer depends on the item and the document alone.
The query set (the items) is handled in blocks of ``BLOCK`` items, each against
all rows; nothing is shuffled.  An index holds its items' words and their keys, no table of bits.  Edge cases: items and texts of any length
are whole; null and empty texts and items
without words match nothing; null item ids are left out; equal items are all
reported; repeated rows are judged one by one; an empty benchmark or table
gives empty lists; other columns are carried along untouched.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.near_dedup import words

EDITS = 0.2
WALKS, SAMPLES, BITS = 8, 12, 4
PIECE = 16
BLOCK = 5_000
SEED = 20_251
#: Words whose hash a worker keeps, and characters of the texts that it looks at together.
HASHES, CHUNK = 100_000, 2_000_000


def limit_of(n: int) -> int:
    return math.floor(EDITS * n)


def within(item: np.ndarray, text: np.ndarray, limit: int) -> bool:
    """Whether some stretch of ``text`` is within ``limit`` word edits of ``item``."""
    col = np.arange(len(item) + 1)
    ramp = np.arange(len(item) + 1)
    for t in text:
        step = np.empty_like(col)
        step[0] = 0
        step[1:] = np.minimum(col[:-1] + (item != t), col[1:] + 1)
        col = np.minimum.accumulate(step - ramp) + ramp
        if col[-1] <= limit:
            return True
    return False


def cut(n: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of an item of n words."""
    g = max(1, n // PIECE)
    return [(n * i // g, n * (i + 1) // g) for i in range(g)]


class Index:
    """LSH tables of one block of items: by piece length, for each sample the pieces' keys."""

    def __init__(self, items: list[tuple[int, list[str]]], seed: int = SEED):
        self.vocab: dict[str, int] = {}
        for _, ws in items:
            for w in ws:
                self.vocab.setdefault(w, len(self.vocab) + 1)
        # hash of each word id; 0 has none (words of no item bring their own), the last one is padding
        self.hash_of = np.array([0, *map(xxhash.xxh3_64_intdigest, self.vocab), 0x9E3779B97F4A7C15], dtype="uint64")
        rng = np.random.default_rng(seed)
        self.at = np.sort(rng.random((WALKS, SAMPLES, BITS)), axis=2)
        self.odd = rng.integers(0, 1 << 63, (WALKS, round(1.6 * 2 * PIECE) + 2), dtype="uint64") * np.uint64(2) + np.uint64(1)
        self.items: list[tuple[int, np.ndarray]] = []
        self.lengths: dict[int, list[tuple[int, int, np.ndarray]]] = {}  # item, start of the piece in it, the piece
        for i, ws in items:
            if ws:
                whole = np.array([self.vocab[w] for w in ws])
                for a, b in cut(len(ws)):
                    self.lengths.setdefault(b - a, []).append((len(self.items), a, whole[a:b]))
                self.items.append((i, whole))
        self.own, self.distinct = {}, {}  # by length: weight of each word id, the last one for the gap between documents (full windows)
        for n, group in self.lengths.items():
            own = np.zeros(len(self.vocab) + 2, dtype="int32")
            own[np.concatenate([x for *_, x in group])] = 1
            own[-1] = -n  # no full window reaches over the end of a document
            self.own[n] = own
            self.distinct[n] = min(len(np.unique(x)) for *_, x in group) - limit_of(n)
        self.keys = {}
        for n, group in self.lengths.items():
            tokens = np.concatenate([x for *_, x in group])
            self.keys[n] = [self.embed(tokens, self.hash_of[tokens], np.arange(len(group)) * n, 0, n, n, w) for w in range(WALKS)]

    def embed(self, tokens: np.ndarray, hashes: np.ndarray, starts: np.ndarray, front: np.ndarray | int, stop: np.ndarray | int,
              n: int, walk: int) -> np.ndarray:
        """Sample keys (SAMPLES x windows) of the n-word windows at ``starts``; words outside [front, stop) are padding."""
        steps = max(1, round(1.6 * n))
        at = np.minimum((self.at[walk] * steps).astype(int), steps - 1)
        needed = set(at.ravel().tolist())
        pad, out = len(self.vocab) + 1, {}
        i = np.zeros(len(starts), dtype="int64")
        for j in range(max(needed) + 1):
            inside, place = (i >= front) & (i < stop), starts + np.clip(i, front, stop - 1)
            if j in needed:
                out[j] = np.where(inside, tokens[place], pad).astype("int64")
            h = np.where(inside, hashes[place], self.hash_of[-1])
            i = i + ((h * self.odd[walk, j]) >> np.uint64(63)).astype("int64")
        keys = np.zeros((SAMPLES, len(starts)), dtype="int64")
        for s in range(SAMPLES):
            for b in range(BITS):
                keys[s] = keys[s] * 2_097_143 + out[at[s, b]]
        return keys

    def look_up(self, texts: Iterable[list[str]], known: dict[str, int] | None = None) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Word ids (0: no item's word) and hashes of texts; ``known`` keeps the hashes of words."""
        known = {} if known is None else known
        get, ids, hashes = self.vocab.get, [], []
        for ws in texts:
            if len(known) > HASHES:
                known.clear()
            for w in ws:
                if w not in known:
                    known[w] = xxhash.xxh3_64_intdigest(w)
            ids.append(np.fromiter(map(get, ws, itertools.repeat(0)), "int64", len(ws)))
            hashes.append(np.fromiter(map(known.__getitem__, ws), "uint64", len(ws)))
        return ids, hashes

    def find(self, docs: list[np.ndarray], hashes: list[np.ndarray]) -> list[list[int]]:
        """For each document (see ``look_up``) the sorted item ids found in it."""
        found: list[set[int]] = [set() for _ in docs]
        if not self.lengths or not docs:
            return [[] for _ in docs]
        gap = np.full(1, len(self.vocab) + 1)
        tokens = np.concatenate([x for d in docs for x in (d, gap)])
        hashes = np.concatenate([x for h in hashes for x in (h, self.hash_of[-1:])])
        size = np.array([len(d) for d in docs])
        ends = np.cumsum(size + 1)
        seen = np.zeros(len(self.vocab) + 2, dtype=bool)
        total = np.zeros(len(tokens) + 1, dtype="int32")
        # place of the same word's occurrence before (-1: none)
        narrow = tokens.astype("uint16") if len(self.vocab) + 2 < 1 << 16 else tokens
        order = np.argsort(narrow, kind="stable")
        again = narrow[order[1:]] == narrow[order[:-1]]
        before = np.full(len(tokens), -1)
        before[order[1:][again]] = order[:-1][again]
        checked: set[tuple[int, int, int]] = set()
        for n, group in self.lengths.items():
            own, m = self.own[n], limit_of(n)
            np.cumsum(np.take(own, tokens), out=total[1:])
            starts = np.flatnonzero(total[n:] - total[:-n] >= n - m)
            parts = [np.stack([starts, np.zeros_like(starts), np.full_like(starts, n)])]  # start, first and last place in the document
            some = size >= n - m
            begin, length = (ends - size - 1)[some], size[some]
            for r in range(n - m, n):  # r words before the document's end, the rest is padding
                at = (begin + length - r)[length >= r]
                at = at[total[at + r] - total[at] >= n - m]
                parts.append(np.stack([at, np.zeros_like(at), np.full_like(at, r)]))
            for f in range(1, m + 1):  # f words of padding before the document's start
                r = np.minimum(n - f, length)
                ok = total[begin + r] - total[begin] >= n - m
                parts.append(np.stack([begin[ok] - f, np.full(ok.sum(), f), f + r[ok]]))
            windows = np.concatenate(parts, axis=1)
            varied = []
            for lo in range(0, windows.shape[1], 20_000):
                at, front, stop = windows[:, lo:lo + 20_000, None]
                i = np.arange(n)
                place = at + np.clip(i, front, stop - 1)
                new = (before[place] < at + front) & (own[tokens[place]] > 0) & (i >= front) & (i < stop)
                varied.append(new.sum(axis=1) >= self.distinct[n])
            starts, front, stop = windows[:, np.concatenate([np.zeros(0, dtype=bool), *varied])]
            if not len(starts):
                continue
            pairs: set[tuple[int, int]] = set()
            for w in range(WALKS):
                mine = self.embed(tokens, hashes, starts, front, stop, n, w)
                for s in range(SAMPLES):
                    keys = self.keys[n][w][s]
                    order = np.argsort(keys)
                    ranked = keys[order]
                    lo, hi = np.searchsorted(ranked, mine[s], "left"), np.searchsorted(ranked, mine[s], "right")
                    for p in np.flatnonzero(hi > lo).tolist():
                        pairs.update((starts[p] + front[p], k) for k in order[lo[p]:hi[p]].tolist())
            doc_of = {p: int(np.searchsorted(ends, p, "right")) for p in {p for p, _ in pairs}}
            for p, k in sorted(pairs):
                one, start, piece = group[k]
                item, x = self.items[one]
                d, whole = doc_of[p], len(x)
                first, last = ends[d] - len(docs[d]) - 1, ends[d] - 1
                around = (d, one, (p - start - first) // whole)  # one exact check for all places of the same stretch
                if item in found[d] or around in checked:
                    continue
                if n < whole and not within(piece, tokens[max(p - m, first):min(p + n + 2 * m, last)], m):
                    continue
                checked.add(around)
                limit = limit_of(whole)
                lo = first + around[2] * whole - 2 * limit
                stretch = tokens[max(lo, first):min(lo + 2 * whole + 4 * limit, last)]
                seen[stretch] = True
                enough = seen[x].sum() >= whole - limit
                seen[stretch] = False
                if enough and within(x, stretch, limit):
                    found[d].add(item)
        return [sorted(f) for f in found]


def _chunks(texts: Iterable[str]) -> Iterator[list[str]]:
    """The texts in lists of about CHUNK characters; a longer text is a list of its own."""
    part: list[str] = []
    size = 0
    for t in texts:
        if part and size + len(t) > CHUNK:
            yield part
            part, size = [], 0
        part.append(t)
        size += len(t)
    if part:
        yield part


def _finder(items: list[tuple[int, list[str]]]):
    @F.pandas_udf("array<long>")
    def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index, known = Index(items), {}
        for texts in it:
            out: list[list[int]] = []
            for chunk in _chunks(texts):
                out += index.find(*index.look_up(map(words, chunk), known))
            yield pd.Series(out)

    return run


def find_items(docs: DataFrame, benchmark: DataFrame, block: int = BLOCK) -> DataFrame:
    """``_row`` (all columns) and ``_items`` (sorted ids of the items in the text)."""
    items = benchmark.where("item_id is not null").select(F.col("item_id").cast("long"), F.col("text"))
    blocks = max(1, -(-items.count() // block))
    out = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                      F.coalesce("text", F.lit("")).alias("_text"))
    found = []
    for b in range(blocks):
        mine = [(r[0], words(r[1])) for r in
                items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()]
        found.append(_finder(mine)("_text"))
    # the items are looked up once for each row, whatever is asked of the result
    return out.select("_row", F.array_sort(F.array_distinct(F.concat(*found))).alias("_items"))


def op5(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, contaminated, item_ids (sorted)."""
    return (find_items(docs.select("doc_id", "text"), benchmark)
            .select(F.col("_row.doc_id").alias("doc_id"), (F.size("_items") > 0).alias("contaminated"),
                    F.col("_items").alias("item_ids")))
