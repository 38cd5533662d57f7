"""Near-duplicate documents by Order MinHash.

Words are lower-cased runs of letters and digits; shingles are five words, each
labelled with its occurrence number, so that a document is a sequence of
distinct symbols.  A sketch takes the ``ELL`` symbols with the smallest hashes
and keeps them in text order; ``SKETCHES`` sketches make the buckets.  The
similarity of two documents is the order-keeping Jaccard index of their shingle
sequences, M / (n1 + n2 - M) with M the length of their longest common
subsequence; a pair links from ``THRESHOLD`` on.  A sketch of two linked
documents of many shingles agrees with probability of about 0.8**ELL = 0.41 or more, so that a
pair at the threshold is missed by all 24 sketches with probability of at most 6e-6.  That does not hold for short texts (4 of 5
shingles agree with probability 1/5), so texts of up to ``SHORT`` shingles also get a bucket for each of
their first n - ceil(0.8 n) + 1 symbols in hash order: two linked texts share one of these, so no link is lost where
the shorter text has up to 0.8 SHORT shingles.

Candidates are verified by banded alignment: symbols further apart than the
number of edits that the threshold allows can't be matched, and the longest
increasing subsequence of the matched positions is M exactly.

No bucket is capped and no bucket's pairs are all emitted.  Texts with equal words are
one vertex; a bucket's members meet its smallest member (a star), and each text is first compared
with the smallest member that it meets in most buckets: one copy of a text for each text, however many stars it is in.
Members of a bucket that then still lie in different components are compared further,
without loss.  With symbols ordered from rare to common, two linked texts
share one of their first n - ceil(0.8 n) + 1 symbols (prefix filtering; any order is right, the
counts behind it come from one fixed array of ``COUNTERS`` counters), so texts that share a common
passage alone never meet.  Texts with the same most common prefix symbol and about the same length go to
the same blocks of ``BLOCK`` texts.  A task takes two blocks, and of these only the texts that share a prefix symbol
with a text of the other block, of another component and a length that can link: it counts the shared symbols of all
their pairs with matrix products, aligns pairs of different components that can reach the
threshold, and sends a spanning forest of its links, not the pairs.  So a text is copied as often as there are
blocks with texts that it meets, not as often as its cluster (texts that meet by others) has blocks.

Edge cases: null text counts as empty; texts without words are compared as raw
strings (all empty texts are one class); texts of under five words are one
shingle, so that they link with equal ones only; repeated rows and null ids are
members like others, and a class whose ids are all null has a null id; an empty
table gives an empty result; other columns are carried along untouched.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import connected_components, materialize, shuffles_dropped

K = 5
THRESHOLD = 0.8
ELL = 4
SKETCHES = 24
SHORT = 25
COUNTERS = 1 << 20
BLOCK = 512
#: Lengths that can link differ by a factor of 1 / THRESHOLD at most, so by one class at most; a bit wider, as logarithms are rounded.
LENGTH_STEP = math.log(1.008 / THRESHOLD)
_PARTS = 64
_WORD = re.compile(r"[^\W_]+")
_M = np.uint64(0x9E3779B97F4A7C15)


class WordHash(dict):
    """word -> 64-bit hash; emptied when it grows past two million words."""

    def __missing__(self, w: str) -> int:
        if len(self) > 2_000_000:
            self.clear()
        v = self[w] = xxhash.xxh64_intdigest(w)
        return v


def words(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def symbols(ws: list[str], cache: WordHash) -> np.ndarray:
    """Occurrence-labelled shingle hashes in text order (uint64, distinct)."""
    if not ws:
        return np.empty(0, "uint64")
    h = np.fromiter(map(cache.__getitem__, ws), "uint64", len(ws))
    n = max(1, len(h) - K + 1)
    out = h[:n]
    for i in range(1, min(K, len(h))):
        out = out * _M + h[i:i + n]
    out = _mix(out)
    s = np.sort(out)
    if (s[1:] == s[:-1]).any():
        order = np.argsort(out, kind="stable")
        new = np.r_[True, s[1:] != s[:-1]]
        start = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        occurrence = np.empty(n, "uint64")
        occurrence[order] = (np.arange(n) - start).astype("uint64")
        out = np.where(occurrence > 0, _mix(out + occurrence * _M), out)
    return out


_ADD = np.array([xxhash.xxh64_intdigest(f"add {i}") for i in range(SKETCHES)], dtype="uint64")[:, None]
_MUL = np.array([xxhash.xxh64_intdigest(f"mul {i}") | 1 for i in range(SKETCHES)], dtype="uint64")[:, None]


def sketches(sym: np.ndarray) -> list[int]:
    """SKETCHES signed 64-bit values, behind them a short sequence's first symbols; [] for an empty sequence."""
    n = len(sym)
    if not n:
        return []
    if n > ELL:
        best = np.empty((SKETCHES, ELL), dtype="int64")
        rows = max(1, 2_000_000 // n)  # bounds the memory for very long texts
        for lo in range(0, SKETCHES, rows):
            v = (sym ^ _ADD[lo:lo + rows]) * _MUL[lo:lo + rows]
            best[lo:lo + rows] = np.argpartition(v, ELL - 1, axis=1)[:, :ELL]
        best.sort(axis=1)  # back to text order
        picked = sym[best]
    else:
        picked = np.broadcast_to(sym, (SKETCHES, n))
    sig = _ADD[:, 0].copy()
    for j in range(picked.shape[1]):
        sig = _mix(sig * _M + picked[:, j])
    out = sig.astype("int64").tolist()
    if n <= SHORT:
        out += np.sort(sym)[:n - math.ceil(THRESHOLD * n - 1e-9) + 1].astype("int64").tolist()
    return out


def similarity_at_least(a: np.ndarray, b: np.ndarray, threshold: float = THRESHOLD) -> bool:
    """Banded alignment of two symbol sequences against the threshold."""
    n1, n2 = len(a), len(b)
    if not n1 or not n2 or min(n1, n2) < threshold * max(n1, n2):
        return n1 == n2 == 0
    need = threshold / (1 + threshold) * (n1 + n2) - 1e-9
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    near = np.abs(i - j) <= n1 + n2 - 2 * need
    i, j = i[near], j[near]
    if len(i) < need:
        return False
    tails: list[int] = []
    for x in j[np.argsort(i)].tolist():
        if not tails or x > tails[-1]:
            tails.append(x)
        else:
            tails[bisect.bisect_left(tails, x)] = x
    return len(tails) >= need


def _digester():
    @F.pandas_udf("struct<key string, sigs array<long>, n int>")
    def digest(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        cache = WordHash()
        for texts in it:
            keys, sigs, size = [], [], []
            for t in texts:
                ws = words(t)
                keys.append(xxhash.xxh3_128_hexdigest(" ".join(ws) if ws else "\0" + (t or "")))
                sym = symbols(ws, cache)
                sigs.append(sketches(sym))
                size.append(len(sym))
            yield pd.DataFrame({"key": keys, "sigs": sigs, "n": np.array(size, dtype="int32")})

    return digest


def _verify(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    cache = WordHash()
    for pdf in it:
        last, sym = None, None
        keep = []
        for key, ta, tb in zip(pdf["a"], pdf["ta"], pdf["tb"]):
            if key != last:
                last, sym = key, symbols(words(ta), cache)
            keep.append(similarity_at_least(sym, symbols(words(tb), cache)))
        yield pdf.loc[keep, ["a", "b"]]


def _count(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counters of the symbols in a task's texts, as _PARTS binary rows."""
    cache, total = WordHash(), np.zeros(COUNTERS, dtype="int64")
    for pdf in it:
        for t in pdf["text"]:
            np.add.at(total, (symbols(words(t), cache) % np.uint64(COUNTERS)).astype("int64"), 1)
    yield pd.DataFrame({"part": np.arange(_PARTS), "counts": [x.tobytes() for x in np.split(total, _PARTS)]})


def _add(pdf: pd.DataFrame) -> pd.DataFrame:
    total = np.sum([np.frombuffer(b, "int64") for b in pdf["counts"]], axis=0)
    return pd.DataFrame({"part": pdf["part"].iloc[:1], "counts": [total.tobytes()]})


def common_counts(texts: DataFrame) -> np.ndarray:
    """Counters over all symbols of ``texts`` (COUNTERS numbers, whatever the input)."""
    tasks = texts.mapInPandas(_count, "part int, counts binary")
    # two levels, so that no task adds up more than a bounded number of rows for each part
    some = (tasks.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64))).groupBy("part", "salt")
            .applyInPandas(_add, "part int, counts binary"))
    with shuffles_dropped(texts.sparkSession):
        rows = some.groupBy("part").applyInPandas(_add, "part int, counts binary").collect()
    return np.concatenate([np.frombuffer(r.counts, "int64") for r in sorted(rows, key=lambda r: r.part)]) if rows else np.zeros(COUNTERS)


def length_class(n: int) -> int:
    """Classes of sequence lengths; those of two linked texts differ by one at most."""
    return int(math.log(n) / LENGTH_STEP)


def _prefixes(counts: np.ndarray):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = WordHash()
        for pdf in it:
            vs, lengths, keys = [], [], []
            for v, t in zip(pdf["v"], pdf["text"]):
                sym = symbols(words(t), cache)
                n = len(sym)
                size = n - math.ceil(THRESHOLD * n - 1e-9) + 1
                first = np.lexsort((sym, counts[(sym % np.uint64(COUNTERS)).astype("int64")]))[:size]
                keys.append(sym[first].astype("int64"))
                vs.append(np.full(size, v))
                lengths.append(np.full(size, length_class(n), dtype="int32"))
            if keys:
                yield pd.DataFrame({"key": np.concatenate(keys), "v": np.concatenate(vs), "length": np.concatenate(lengths)})

    return run


def shared_symbols(syms: list[np.ndarray], rows: int) -> np.ndarray:
    """Numbers of shared symbols of the first ``rows`` sequences with all of them."""
    size = np.array([len(x) for x in syms])
    _, column, seen = np.unique(np.concatenate(syms), return_inverse=True, return_counts=True)
    rank = np.cumsum(seen > 1) - 1  # symbols of one sequence alone don't matter
    doc = np.repeat(np.arange(len(syms)), size)
    keep = seen[column] > 1
    doc, column = doc[keep], rank[column[keep]]
    order = np.argsort(column, kind="stable")
    doc, column = doc[order], column[order]
    total = np.zeros((rows, len(syms)), dtype="float32")
    width = 4096
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        i, j = np.searchsorted(column, [lo, lo + width])
        m = np.zeros((len(syms), width), dtype="float32")
        m[doc[i:j], column[i:j] - lo] = 1
        total += m[:rows] @ m.T
    return total.astype("int64")


def _compare(key, pdf):
    """Forest of the links between two blocks (or within one) that join different components."""
    i, j = key
    pdf = pdf.sort_values(["block", "v"])
    cache = WordHash()
    syms = [symbols(words(t), cache) for t in pdf["text"]]
    v, n = pdf["v"].to_numpy(), np.array([len(x) for x in syms])
    first = int((pdf["block"] == i).sum())
    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.get(x, x) != x:
            x = root[x]
        return x

    own = pdf["c"].to_numpy()
    comp = own.tolist()
    both = shared_symbols(syms, first)
    can = both >= THRESHOLD / (1 + THRESHOLD) * (n[:first, None] + n[None, :]) - 1e-9
    can &= own[:first, None] != own[None, :]
    if i == j:
        can &= np.arange(first)[:, None] < np.arange(len(syms))[None, :]
    else:
        can[:, :first] = False
    a, b = np.nonzero(can)
    order = np.lexsort((b, a, -both[a, b] / (n[a] + n[b])))  # likely links first
    out = []
    for x, y in zip(a[order].tolist(), b[order].tolist()):
        cx, cy = find(comp[x]), find(comp[y])
        if cx != cy and similarity_at_least(syms[x], syms[y]):
            root[cx] = cy
            out.append((v[x], v[y]))
    return pd.DataFrame(out, columns=["a", "b"]).astype("int64")


def _rest(texts: DataFrame, parts: DataFrame) -> DataFrame:
    """Links (a, b) that join the components c of parts (v, c), by prefix filtering; texts (v, text) holds these and may hold others."""
    keys = materialize(
        texts.mapInPandas(_prefixes(common_counts(texts)), "key long, v long, length int").join(parts, "v"), "omh-prefixes")
    shared = (keys.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min("v").alias("a"), F.count(F.lit(1)).alias("texts"))
              .where("lo <> hi").select("key", "a", "texts"))
    meet = materialize(keys.join(shared, "key"), "omh-meet")
    homes = (meet.groupBy("v").agg(F.first("length").alias("length"), F.max(F.struct("texts", "key", "a")).alias("most"))
             .select("v", "length", F.col("most.a").alias("home")))
    sizes = homes.groupBy("home", "length").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    dealt = homes.join(sizes, ["home", "length"]).withColumn("nth", F.pmod(F.xxhash64("v"), F.col("blocks")).cast("int"))
    names = dealt.groupBy("home", "length", "nth").agg(F.min("v").alias("block"))
    blocks = materialize(dealt.join(names, ["home", "length", "nth"]).select("v", "block"), "omh-blocks")
    placed = materialize(meet.select("key", "v", "c", "length").join(blocks, "v"), "omh-placed")
    sides = placed.groupBy("key", F.col("block").alias("other")).agg(
        F.min("c").alias("lo"), F.max("c").alias("hi"), F.first("length").alias("there"))
    to = materialize(
        placed.join(sides, "key").where("abs(length - there) <= 1 and not (lo = c and hi = c)")
        .select("v", "c", "block", "other").distinct(), "omh-blocks-met")
    rows = texts.join(to, "v").select(F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "v", "c", "text")
    return rows.groupBy("i", "j").applyInPandas(_compare, "a long, b long")


_RATIO = f"least(na, nb) >= {THRESHOLD} * greatest(na, nb)"


def _links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) that reach the threshold."""
    ta = texts.select(F.col("v").alias("a"), F.col("text").alias("ta"))
    tb = texts.select(F.col("v").alias("b"), F.col("text").alias("tb"))
    return pairs.join(ta, "a").join(tb, "b").mapInPandas(_verify, "a long, b long")


def classes(docs: DataFrame) -> DataFrame:
    """``_row`` (all columns), ``_class`` (smallest doc_id of the class), ``_kept`` (one row
    of each class), ``_n`` (shingles)."""
    base = materialize(
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.monotonically_increasing_id().alias("_at"),
                    _digester()(F.coalesce("text", F.lit(""))).alias("_d")), "omh-rows")
    slim = base.select("_at", F.col("_row.doc_id").cast("long").alias("id"), F.col("_d.key").alias("key"), F.col("_d.n").alias("n"))
    # a vertex is a distinct text, named by one of its rows: that of the smallest id, nulls last
    one = materialize(
        slim.groupBy("key").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_at")).alias("first"), F.first("n").alias("n"))
        .select("key", "n", "first", F.col("first._at").alias("v")), "omh-texts")
    sigs = base.select(F.col("_at").alias("v"), F.col("_d.sigs").alias("sigs")).join(one.where("n > 0").select("v", "n"), "v")
    entries = (sigs.select("v", "n", F.posexplode("sigs").alias("band", "sig"))
               .select(F.xxhash64(F.least("band", F.lit(SKETCHES)), "sig").alias("bucket"), "v", "n"))
    shared = (entries.groupBy("bucket").agg(F.min("v").alias("rep"), F.min(F.struct("v", "n")).alias("r"), F.count(F.lit(1)).alias("size"))
              .where("size > 1").select("bucket", "rep", F.col("r.n").alias("rep_n")))
    buckets = materialize(entries.join(shared, "bucket"), "omh-buckets")
    star = (buckets.select(F.col("rep").alias("a"), F.col("v").alias("b"), F.col("rep_n").alias("na"), F.col("n").alias("nb"))
            .where("a <> b").where(_RATIO).groupBy("a", "b").agg(F.count(F.lit(1)).alias("often"))
            .groupBy("b").agg(F.max(F.struct("often", F.negative("a").alias("a"))).alias("most")).select(F.negative("most.a").alias("a"), "b"))
    texts = materialize(
        base.select(F.col("_at").alias("v"), F.col("_row.text").alias("text")).join(buckets.select("v").distinct(), "v"), "omh-candidates")
    vertices = one.select("v")
    near = materialize(_links(star, texts), "omh-links")
    part = connected_components(vertices, near).select("v", F.col("component").alias("c"))
    left = buckets.select("bucket", "v").join(part, "v")
    open_ = left.groupBy("bucket").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo <> hi").select("bucket")
    apart = materialize(left.join(open_, "bucket").select("v", "c").distinct(), "omh-apart")
    rest = materialize(_rest(texts, apart), "omh-rest")
    final = connected_components(vertices, near.union(rest))
    ids = one.select("v", "key", "first").join(final, "v")
    best = ids.groupBy("component").agg(F.min("first").alias("best"))
    member = ids.join(best, "component").select("key", F.col("best.id").alias("_class"), F.col("best._at").alias("keep"))
    out = slim.join(member, "key").select("_at", "_class", (F.col("_at") == F.col("keep")).alias("_kept"), F.col("n").alias("_n"))
    return base.select("_row", "_at").join(out, "_at").drop("_at")


def op4(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (smallest doc_id of its near-duplicate class), kept, n_shingles."""
    c = classes(docs.select("doc_id", "text"))
    return c.select(F.col("_row.doc_id").alias("doc_id"), F.col("_class").alias("class_id"),
                    F.col("_kept").alias("kept"), F.col("_n").alias("n_shingles"))
