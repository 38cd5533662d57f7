"""Compression of vectors to product codes, with integer k-means and adaptive distance bounds.

Vectors become integers floor(256 x) and are cut into 16 parts; each part position has a codebook of 64
entries, fitted by Lloyd rounds in exact integers (nearest entry, ties to the lower index; then the floor of
the mean).  Assignments after the first follow Drake and Hamerly: for each vector and part a table
in the shared folder keeps the b closest entries in order, an ordered lower bound for the distance to each, and one outer
bound for all others.  When entries have moved, bounds shrink by the way their entry went (the outer one by the longest way);
the distance to the entry a part had is computed anew, and

* if it is below every other bound, the entry stays;
* if it is below all bounds from the z-th on, only the first z entries are compared, in integers;
* else all entries are compared, in integers, and the bounds start afresh.

Each batch adapts its b to the z that its parts needed, between MIN_B and START_B.  Bounds are rounded down (to
16 bits) and distances up before they are compared, so they can only cause more work, never another code: results don't
depend on b, batches or files.

Partial sums by (part, entry, position) come from each task; the driver holds the codebooks alone (64 vectors).

Edge cases: rows whose vector is null, holds a null or non-finite component, or has another length than the vector of the smallest kept
id (empty ones too) are dropped; a length that 16 doesn't divide is an error, as are components so large that errors pass 64 bits; fewer than 64 kept rows
give fewer entries; rows with equal ids are ordered by their integers, null ids last; entries that
are equal leave the higher index unused, and unused entries stay; null labels count together; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import materialize

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Closest entries kept at first, and at least.
START_B, MIN_B = 4, 2
#: A batch keeps as many entries as this share of its parts needed.
ENOUGH = 0.99
_TOP = float(np.finfo(np.float16).max)


def _down16(x: np.ndarray) -> np.ndarray:
    """16-bit floats not above x."""
    x = np.clip(x, -_TOP, _TOP)
    h = x.astype(np.float16)
    return np.where(h.astype(np.float64) > x, np.nextafter(h, np.float16(-np.inf)), h).astype(np.float16)


def _up(x: np.ndarray) -> np.ndarray:
    """sqrt(x) for integers x, not below the true root."""
    return np.nextafter(np.sqrt(x.astype(np.float64)), np.inf)


def _low(x: np.ndarray) -> np.ndarray:
    return np.nextafter(np.sqrt(x.astype(np.float64)), -np.inf)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances of integer rows to integer entries, exact."""
    largest = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = np.float64 if 4 * largest * largest * x.shape[1] < 2 ** 52 else np.int64
    a, b = x.astype(kind), entries.astype(kind)
    return ((a * a).sum(1)[:, None] - 2 * (a @ b.T) + (b * b).sum(1)[None, :]).astype(np.int64)


class State:
    """Of one part position: near (n, b) entries by distance, lower (n, b) and outer (n) bounds."""

    def __init__(self, near, lower, outer):
        self.near, self.lower, self.outer = near, lower, outer


def fresh(x: np.ndarray, entries: np.ndarray, b: int) -> tuple[State, np.ndarray]:
    """All entries compared: state with the b closest, and the squared distance to the closest."""
    k, bits = len(entries), max(1, (len(entries) - 1).bit_length())
    b = min(b, k)
    keys = (distances(x, entries) << bits) | np.arange(k)
    if b < k:
        keys = np.partition(keys, b, axis=1)[:, :b + 1]
    keys.sort(axis=1)
    d = keys >> bits
    outer = _low(d[:, b]) if b < k else np.full(len(x), _TOP)
    return State((keys[:, :b] & ((1 << bits) - 1)).astype(np.uint8), _low(d[:, :b]), outer), d[:, 0]


def moved(x: np.ndarray, state: State, old: np.ndarray, entries: np.ndarray) -> tuple[State, np.ndarray, np.ndarray]:
    """The state after the entries moved, the squared distance to the closest, and how many entries each row needed."""
    n, b = state.near.shape
    bits = max(1, (len(entries) - 1).bit_length())
    way = _up(((entries - old) ** 2).sum(1))
    near = state.near.copy()
    lower = np.nextafter(state.lower - way[near], -np.inf)
    outer = np.nextafter(state.outer - way.max(), -np.inf)
    # ordered bounds: from the z-th entry on, nothing is closer than beyond[:, z]
    beyond = np.minimum.accumulate(np.concatenate([lower, outer[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1]
    d = ((x - entries[near[:, 0]]) ** 2).sum(1)
    upper = _up(d)
    safe = upper[:, None] < beyond[:, 1:]
    need = np.where(safe.any(axis=1), safe.argmax(axis=1) + 1, b + 1)
    lower[:, 0] = _low(d)
    some = np.flatnonzero((need > 1) & (need <= b))
    if len(some):  # compare the first z entries in integers
        keys = (((x[some, None, :] - entries[near[some]]) ** 2).sum(2) << bits) | near[some]
        out = np.arange(b)[None, :] >= need[some, None]
        keys = np.where(out, np.iinfo(np.int64).max, keys)
        order = np.argsort(keys, axis=1, kind="stable")
        keys = np.take_along_axis(keys, order, axis=1)
        near[some] = np.take_along_axis(near[some], order, axis=1)  # those not compared keep their places
        lower[some] = np.where(out, lower[some], _low(keys >> bits))
        d[some] = keys[:, 0] >> bits
    rest = np.flatnonzero(need > b)
    if len(rest):
        again, d[rest] = fresh(x[rest], entries, b)
        near[rest], lower[rest], outer[rest] = again.near, again.lower, again.outer
    return State(near, lower, outer), d, need


def narrow(state: State, b: int) -> State:
    """The same bounds with fewer entries."""
    if b >= state.near.shape[1]:
        return state
    return State(state.near[:, :b], state.lower[:, :b], np.minimum(state.outer, state.lower[:, b:].min(axis=1)))


# -- rows of the state table ------------------------------------------------------------------------------------

def _binary(rows: np.ndarray) -> pa.Array:
    rows = np.ascontiguousarray(rows).view(np.uint8).reshape(len(rows), -1)
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(ends), pa.py_buffer(rows.tobytes())])


def _places(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, start, width) of a binary column's rows."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8), at[:-1], np.diff(at)


def _take(places, rows: np.ndarray, kind) -> np.ndarray:
    data, start, width = places
    flat = data[start[rows][:, None] + np.arange(width[rows[0]])[None, :]]
    return np.ascontiguousarray(flat).view(kind)


def _pack(x: np.ndarray, states: list[State]) -> list[pa.Array]:
    """x, near, lower, outer of a batch; integers take 2 bytes where all of the batch fit."""
    small = np.abs(x).max(initial=0) < 2 ** 15
    return [_binary(x.reshape(len(x), -1).astype(np.int16 if small else np.int32)),
            _binary(np.stack([s.near for s in states], axis=1).reshape(len(x), -1)),
            _binary(np.stack([_down16(s.lower) for s in states], axis=1).reshape(len(x), -1)),
            _binary(np.stack([_down16(s.outer) for s in states], axis=1))]


def _pieces(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[np.ndarray, np.ndarray, list[State]]]:
    """(rows, x, states) of a batch of the state table, for each width of integers and each b."""
    if not batch.num_rows:
        return
    xs, nears, lowers, outers = (_places(batch.column(c)) for c in ("x", "near", "lower", "outer"))
    kinds = np.stack([xs[2], nears[2]], axis=1)
    for kind in np.unique(kinds, axis=0):
        rows = np.flatnonzero((kinds == kind).all(axis=1))
        x = _take(xs, rows, {2: np.int16, 4: np.int32}[int(kind[0]) // dims]).astype(np.int64).reshape(len(rows), PARTS, -1)
        near = _take(nears, rows, np.uint8).reshape(len(rows), PARTS, -1)
        lower = _take(lowers, rows, np.float16).astype(np.float64).reshape(near.shape)
        outer = _take(outers, rows, np.float16).astype(np.float64)
        yield rows, x, [State(near[:, p], lower[:, p], outer[:, p]) for p in range(PARTS)]


def _integers(column: pa.Array, dims: int) -> np.ndarray:
    """floor(SCALE x) of a list column, as (rows, parts, components of a part)."""
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    x = np.floor(SCALE * x)
    if dims * (2 * np.abs(x).max(initial=0)) ** 2 >= 2.0 ** 61:
        raise ValueError("components are too large for errors of 64 bits")
    return x.astype(np.int64).reshape(-1, PARTS, dims // PARTS)


# -- steps ----------------------------------------------------------------------------------------------------------

def _first(entries: np.ndarray, dims: int):
    """Assign every vector with all entries compared; state rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _integers(batch.column("_v"), dims)
            if len(x):
                states = [fresh(x[:, p], entries[p], START_B)[0] for p in range(PARTS)]
                yield pa.RecordBatch.from_arrays([batch.column("_id"), batch.column("_label"), *_pack(x, states)], names=_STATE)
    return run


def _again(old: np.ndarray, entries: np.ndarray, dims: int, last: bool):
    """Assign by bounds after the entries moved: state rows with an adapted b, or codes and errors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, x, states in _pieces(batch, dims):
                done = [moved(x[:, p], states[p], old[p], entries[p]) for p in range(PARTS)]
                heads = [batch.column("_id").take(pa.array(rows)), batch.column("_label").take(pa.array(rows))]
                if last:
                    codes = np.stack([s.near[:, 0] for s, _, _ in done], axis=1)
                    error = np.sum([d for _, d, _ in done], axis=0)
                    yield pa.RecordBatch.from_arrays(
                        [*heads, pa.array([c.tobytes().hex() for c in codes], pa.string()), pa.array(error, pa.int64())],
                        names=["_id", "_label", "code", "error"])
                else:
                    need = np.concatenate([n for _, _, n in done])
                    b = max(MIN_B, int(np.quantile(need, ENOUGH, method="higher")))
                    yield pa.RecordBatch.from_arrays([*heads, *_pack(x, [narrow(s, b) for s, _, _ in done])], names=_STATE)
    return run


_STATE = ["_id", "_label", "x", "near", "lower", "outer"]


def _sums(entries: int, dims: int):
    """One row per (part, entry, position) of a task: how many parts it has, and the sum of their components."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((PARTS, entries, dims // PARTS), np.int64)
        counts = np.zeros((PARTS, entries), np.int64)
        for batch in batches:
            for _, x, states in _pieces(batch, dims):
                for p, state in enumerate(states):
                    np.add.at(sums[p], state.near[:, 0], x[:, p])
                    counts[p] += np.bincount(state.near[:, 0], minlength=entries)
        part, entry = np.nonzero(counts)
        width = dims // PARTS
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(part, width), pa.int32()), pa.array(np.repeat(entry, width), pa.int32()),
             pa.array(np.tile(np.arange(width), len(part)), pa.int32()), pa.array(np.repeat(counts[part, entry], width), pa.int64()),
             pa.array(sums[part, entry].reshape(-1), pa.int64())], names=["part", "entry", "place", "n", "s"])
    return run


def _update(state: DataFrame, entries: np.ndarray, dims: int) -> np.ndarray:
    """Entries replaced by the floor of the mean of their parts; unused ones stay."""
    rows = (state.select("x", "near", "lower", "outer")
            .mapInArrow(_sums(entries.shape[1], dims), "part int, entry int, place int, n long, s long")
            .groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))).collect()  # a codebook's size
    new = entries.copy()
    for r in rows:
        new[r.part, r.entry, r.place] = r.s // r.n
    return new


def _kept(vectors: DataFrame, key: str, label: str, vector: str) -> DataFrame:
    v = F.col(vector)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vectors.where(v.isNotNull() & (F.size(v) > 0) & fine).select(
        F.col(key).alias("_id"), F.col(label).alias("_label"), v.alias("_v"))


def compress(vectors: DataFrame, key: str = "vec_id", label: str = "label", vector: str = "embedding",
             ) -> tuple[DataFrame, np.ndarray]:
    """(rows of key, label, code, error; codebooks as (part, entry, position) integers)."""
    kept = _kept(vectors, key, label, vector)
    ids, labels = (kept.schema[c].dataType.simpleString() for c in ("_id", "_label"))
    ordered = F.transform("_v", lambda x: F.floor(x.cast("double") * SCALE))
    head = kept.withColumn("_x", ordered).orderBy(F.col("_id").asc_nulls_last(), "_x").select("_v").limit(ENTRIES).collect()
    dims = len(head[0][0]) if head else 0
    if dims % PARTS:
        raise ValueError(f"vectors of {dims} components can't be cut into {PARTS} equal parts")
    result = f"_id {ids}, _label {labels}, code string, error long"
    if not head:
        return kept.sparkSession.createDataFrame([], result).toDF(key, label, "code", "error"), np.zeros((PARTS, 0, 0), np.int64)
    first = [r[0] for r in head if len(r[0]) == dims]
    entries = np.floor(SCALE * np.array(first, np.float64)).astype(np.int64).reshape(len(first), PARTS, -1).transpose(1, 0, 2)
    schema = f"_id {ids}, _label {labels}, x binary, near binary, lower binary, outer binary"
    state = materialize(kept.where(F.size("_v") == dims).mapInArrow(_first(entries, dims), schema), "codes-state")
    for left in range(ROUNDS, 0, -1):
        old, entries = entries, _update(state, entries, dims)
        rows = state.mapInArrow(_again(old, entries, dims, left == 1), result if left == 1 else schema)
        state = materialize(rows, "codes" if left == 1 else "codes-state")
    return state.toDF(key, label, "code", "error"), entries


def op13(vectors: DataFrame) -> DataFrame:
    codes, entries = compress(vectors)
    digest = hashlib.sha256(",".join(map(str, entries.reshape(-1).tolist())).encode()).hexdigest()
    totals = codes.groupBy(F.col("label").alias("_of")).agg(F.sum("error").alias("label_error"))
    return (codes.join(totals, F.col("label").eqNullSafe(F.col("_of")))
            .select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")))


def oracle() -> str:
    """DuckDB SQL for op13."""
    near = ("select a.id, a.p, arg_min(c.e, c.e + 64 * list_sum(list_transform(list_zip(a.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) e, "
            "min(list_sum(list_transform(list_zip(a.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) d from parts a join {c} c on a.p = c.p group by 1, 2")
    ctes = ["kept as (select row_number() over (order by vec_id nulls last) id, vec_id, label, "
            f"list_transform(embedding, lambda x: cast(floor({SCALE} * cast(x as double)) as bigint)) v from embeddings "
            "where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0)",
            f"parts as (select id, p, v[p * (len(v) // {PARTS}) + 1:(p + 1) * (len(v) // {PARTS})] v from kept, range({PARTS}) t(p))",
            f"c0 as (select p, id - 1 e, v from parts where id <= {ENTRIES})"]
    for i in range(ROUNDS):
        ctes.append(f"a{i} as ({near.format(c=f'c{i}')})")
        ctes.append(f"m{i} as (select p, e, list(cast((s - ((s % n) + n) % n) // n as bigint) order by j) v from (select a.p, a.e, j, "
                    f"cast(sum(x.v[j + 1]) as bigint) s, count(*) n from a{i} a join parts x on a.id = x.id and a.p = x.p, "
                    f"range(len(x.v)) t(j) group by 1, 2, 3) group by 1, 2)")
        ctes.append(f"c{i + 1} as (select c.p, c.e, coalesce(m.v, c.v) v from c{i} c left join m{i} m on c.p = m.p and c.e = m.e)")
    ctes.append(f"f as ({near.format(c=f'c{ROUNDS}')})")
    ctes.append(f"g as (select sha256(string_agg(array_to_string(v, ','), ',' order by p, e)) h from c{ROUNDS})")
    ctes.append("r as (select id, string_agg(printf('%02x', e), '' order by p) code, cast(sum(d) as bigint) error from f group by 1)")
    return ("with " + ",\n".join(ctes) + "\nselect vec_id, code, error, cast(sum(error) over (partition by label) as bigint) label_error, "
            "h codebooks_sha256 from kept join r using (id), g")
