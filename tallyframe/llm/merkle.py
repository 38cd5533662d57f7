"""Merkle manifest of a dataset: leaf digests, roots, and a witness for every row.

Rows are the leaves of one tree per group (``source``), in ascending order; at each level every 16
consecutive nodes (the last run may be shorter) become the hash of their digests, until one is left, the
group's subroot.  The subroots, ordered by group (null first, then bytewise), make the root the same way.

Witnesses are built incrementally.  ``Subtree`` takes nodes by aligned append: the children of an
open run each hold a partial witness (the digests left of them, and those that came later on their right), and every
sibling that is completed extends the witnesses before it.  In Spark, tasks stream aligned blocks of 16**LEVELS
nodes; the roots of the blocks are further appends to the tree above them, block by block, until each group
has one node; then the subroots are appended to the tree of groups.  On the way down a block's rows meet one row
with the witness of their block, so a witness is extended, never built again, and only block roots (1/256
of the rows) travel between rounds.  Positions come from one range sort; a group of any size is dealt over as many
tasks as it has blocks.

``manifest`` returns the rows with position, witness (left and right digests, level by level up to the root),
subroot and root; ``fold`` recomputes a root from a leaf and a witness.

Edge cases: nulls in any column have a digest of their own (``-``); null ids come first; rows that
agree in id are ordered by digest; equal rows are separate leaves with equal digests; a group of one row has its leaf as subroot and a
witness that starts with the tree of groups; one group alone has its subroot as root; an empty table gives an
empty manifest; texts of any length are hashed whole by Spark; columns that are not asked for are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import materialize

FANOUT = 16
#: Levels of a block; a block of 256 nodes is one streaming step.
LEVELS = 2
BLOCK = FANOUT ** LEVELS
#: Rows of a result batch.
BATCH_ROWS = 1_000
_WITNESS = "array<struct<left:string,right:string>>"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest(*columns: Column) -> Column:
    """Hash of the values: ``-`` for null, else UTF-8 byte count, ``:``, value."""
    parts = [F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
             for c in columns]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def fold(leaf: Column, witness: Column) -> Column:
    """The root that a leaf and a witness lead to."""
    return F.aggregate(witness, leaf, lambda acc, w: F.sha2(F.concat(w["left"], acc, w["right"]).cast("binary"), 256))


def _height(n: int) -> int:
    h = 0
    while FANOUT ** h < n:
        h += 1
    return h


class Subtree:
    """Aligned append of nodes; ``levels`` levels are closed by ``finish``, which gives the root."""

    def __init__(self, levels: int):
        self.levels = levels
        self.open: list[list[dict]] = [[] for _ in range(levels)]
        self.witnesses: list[list[tuple[str, str]]] = []
        self.root: str | None = None

    def append(self, node: str) -> None:
        at = len(self.witnesses)
        self.witnesses.append([])
        self._add(0, node, at, at + 1)

    def _add(self, level: int, node: str, first: int, end: int) -> None:
        if level == self.levels:
            self.root = node
            return
        run = self.open[level]
        left = run[-1]["left"] + run[-1]["digest"] if run else ""
        for sibling in run:  # a completed sibling extends the partial witnesses before it
            sibling["right"].append(node)
        run.append({"digest": node, "left": left, "right": [], "first": first, "end": end})
        if len(run) == FANOUT:
            self._close(level)

    def _close(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        for child in run:
            pair = (child["left"], "".join(child["right"]))
            for i in range(child["first"], child["end"]):
                self.witnesses[i].append(pair)
        whole = hashlib.sha256((run[-1]["left"] + run[-1]["digest"]).encode()).hexdigest()
        self._add(level + 1, whole, run[0]["first"], run[-1]["end"])

    def finish(self) -> str:
        for level in range(self.levels):
            if self.open[level]:
                self._close(level)
        return self.root


def _levels(n: int) -> int:
    """Levels that a block closes in a tree of n nodes."""
    return min(LEVELS, _height(n))


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, block, n, digest) in block order -> one row per block, as a node of the next round."""
    at, tree, total, done = None, None, 0, []

    def close():
        done.append((at[0], at[1], -(-total // BLOCK), tree.finish()))

    def flush():
        key, pos, n, node = zip(*done)
        done.clear()
        return pa.RecordBatch.from_arrays([pa.array(key, pa.string()), pa.array(pos, pa.int64()),
                                           pa.array(n, pa.int64()), pa.array(node, pa.string())],
                                          names=["key", "pos", "n", "digest"])

    for batch in batches:
        for key, block, n, node in zip(*(batch.column(c).to_pylist() for c in ("key", "block", "n", "digest"))):
            if (key, block) != at:
                if at is not None:
                    close()
                at, tree, total = (key, block), Subtree(_levels(n)), n
            tree.append(node)
        if len(done) >= BATCH_ROWS:
            yield flush()
    if at is not None:
        close()
    if done:
        yield flush()


def _witnesses(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in block order, the block's own row (pos -1, with the witness above it) first."""
    at, tree, above, held, done = None, None, None, [], []

    def close():
        tree.finish()
        for row, witness in zip(held, tree.witnesses):
            done.append((row, witness, above))

    def flush(schema: pa.Schema):
        ends, left, right = [0], [], []
        for _, witness, (up, _, _) in done:
            for a, b in witness:
                left.append(a)
                right.append(b)
            for w in up:
                left.append(w["left"])
                right.append(w["right"])
            ends.append(len(left))
        pairs = pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], names=["left", "right"])
        columns = [pa.array([row[i] for row, _, _ in done], schema.field(name).type)
                   for i, name in enumerate(schema.names) if name not in _INNER]
        columns += [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
                    pa.array([a[1] for _, _, a in done], pa.string()), pa.array([a[2] for _, _, a in done], pa.string())]
        names = [n for n in schema.names if n not in _INNER] + ["witness", "subroot", "root"]
        done.clear()
        return pa.RecordBatch.from_arrays(columns, names=names)

    schema = None
    for batch in batches:
        schema = batch.schema
        place = {name: i for i, name in enumerate(schema.names)}
        key_at, block_at, pos_at, n_at, digest_at = (place[c] for c in ("key", "block", "pos", "n", "digest"))
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[pos_at] < 0:
                if at is not None:
                    close()
                at, held = (row[key_at], row[block_at]), []
                tree, above = None, (row[place["up"]], row[place["up_subroot"]], row[place["up_root"]])
            else:
                if (row[key_at], row[block_at]) != at:
                    raise ValueError("a block without the witness above it")
                tree = tree or Subtree(_levels(row[n_at]))
                tree.append(row[digest_at])
                held.append(row)
            if len(done) >= BATCH_ROWS:
                yield flush(schema)
    if at is not None:
        close()
    if done:
        yield flush(schema)


#: Columns that only the streaming step needs.
_INNER = ("block", "up", "up_subroot", "up_root")


def _in_blocks(nodes: DataFrame) -> DataFrame:
    return nodes.repartition("key", "block").sortWithinPartitions("key", "block", "pos")


def _with_block(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long"))


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """rows (key, ...) with pos (0-based within key, by ``order``) and n (rows of the key)."""
    by = ["key", *order, "_tie"]
    placed = materialize(
        rows.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*by).sortWithinPartitions(*by)
        .drop("_tie").withColumn("_at", F.monotonically_increasing_id()), "manifest-order")
    part = F.shiftright("_at", 33)
    runs = placed.groupBy("key", part.alias("_part")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    upto = Window.partitionBy("key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("key", "_part", "_first", F.coalesce(F.sum("_rows").over(upto), F.lit(0)).alias("_before"),
                       F.sum("_rows").over(Window.partitionBy("key")).alias("n"))
    return (placed.withColumn("_part", part).join(runs, ["key", "_part"])
            .withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first"))
            .drop("_part", "_at", "_first", "_before"))


def _up(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """The nodes of each round, and (key, digest) of the roots."""
    rounds = [nodes]
    while True:
        top = materialize(_in_blocks(_with_block(rounds[-1]).select("key", "block", "pos", "n", "digest"))
                          .mapInArrow(_roots, "key string, pos long, n long, digest string"), "manifest-roots")
        if (top.agg(F.max("n")).first()[0] or 1) == 1:
            return rounds, top.select("key", "digest")
        rounds.append(top)


def _down(rounds: list[DataFrame], above: DataFrame) -> DataFrame:
    """Rows of the first round with their whole witness; ``above``: (key, up, up_subroot, up_root) of the roots."""
    above = above.withColumn("block", F.lit(0).cast("long"))
    for i in range(len(rounds) - 1, -1, -1):
        both = _with_block(rounds[i]).unionByName(
            above.withColumn("pos", F.lit(-1).cast("long")), allowMissingColumns=True)
        fields = [f for f in both.schema.fields if f.name not in _INNER]
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
        rows = _in_blocks(both).mapInArrow(_witnesses, f"{schema}, witness {_WITNESS}, subroot string, root string")
        if i:
            above = materialize(rows.select("key", F.col("pos").alias("block"), F.col("witness").alias("up"),
                                            F.col("subroot").alias("up_subroot"), F.col("root").alias("up_root")), "manifest-above")
    return rows


def manifest(rows: DataFrame, group: str = "source", order: str = "doc_id", leaf: str = "leaf") -> DataFrame:
    """``rows`` with position (in the group), witness, subroot and root; ``leaf`` names the column of leaf digests."""
    inner = {c: f"c{i}" for i, c in enumerate(rows.columns)}
    g = F.col(inner[group]).cast("string")
    leaves = materialize(rows.toDF(*inner.values()).withColumn(
        "key", F.when(g.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), g))), "manifest-leaves")
    leaves = materialize(_numbered(leaves, [inner[order], inner[leaf]]).withColumn("digest", F.col(inner[leaf])), "manifest-nodes")
    rounds, subroots = _up(leaves)
    # the tree of groups: one key, the groups as nodes
    groups = materialize(
        _numbered(subroots.select(F.lit("").alias("key"), F.col("key").alias("group"), "digest"), ["group"]), "manifest-groups")
    tops, root = _up(groups)
    above = root.select("key", F.lit(None).cast(_WITNESS).alias("up"), F.lit(None).cast("string").alias("up_subroot"),
                        F.col("digest").alias("up_root")).withColumn("up", F.array().cast(_WITNESS))
    of_groups = materialize(_down(tops, above), "manifest-of-groups")
    above = of_groups.select(F.col("group").alias("key"), F.col("witness").alias("up"), F.col("digest").alias("up_subroot"),
                             F.col("root").alias("up_root"))
    out = _down(rounds, above)
    return out.select(*[F.col(short).alias(name) for name, short in inner.items()],
                      F.col("pos").alias("position"), "witness", "subroot", "root")


def op12(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("string")
    values = [F.col(c).cast("string") for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = docs.select("doc_id", "source", digest(*values, text).alias("leaf"),
                       F.when(tampered, digest(*values, F.translate(text, _UPPER, _LOWER))).alias("claimed"))
    proof = F.array_join(F.transform("witness", lambda w: F.concat(w["left"], w["right"])), "")
    folded = fold(F.coalesce("claimed", "leaf"), F.col("witness"))
    return (manifest(rows).select("doc_id", "leaf", "subroot", "root", F.sha2(proof.cast("binary"), 256).alias("proof_sha256"),
                                  folded.alias("folded_root"))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def oracle(levels: int = 7, group_levels: int = 5) -> str:
    """DuckDB SQL for op12 (up to 16**levels rows a source and 16**group_levels sources)."""
    def part(c):
        return f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"

    head = " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars"))
    crc = ("xor(list_reduce(flatten(list_transform(range(1, length(s) + 1), lambda i: [ascii(s[i])] || [-1, -1, -1, -1, -1, -1, -1, -1])), "
           "lambda a, x: case when x >= 0 then xor(a, x) when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end, "
           "4294967295), 4294967295)")
    ctes = [f"d as (select doc_id, source, sha256({head} || {part('text')}) leaf, "
            f"sha256({head} || {part(f'''translate(text, '{_UPPER}', '{_LOWER}')''')}) lowered, cast(doc_id as varchar) s from documents)",
            f"e as (select *, case when s is null then false else {crc} % 5 = 0 end tampered, "
            "case when source is null then '0' else '1' || source end k, "
            "row_number() over (partition by source order by doc_id nulls first, leaf) - 1 pos from d)"]

    def climb(p, first, count):
        ctes.append(f"{p}0 as ({first})")
        for i in range(count):
            w = f"over (partition by k, pos // {FANOUT} order by pos rows between"
            ctes.append(f"{p}w{i} as (select k, pos, n, digest, case when n > 1 then coalesce(string_agg(digest, '') {w} unbounded preceding and 1 preceding), '') else '' end l, "
                        f"case when n > 1 then coalesce(string_agg(digest, '') {w} 1 following and unbounded following), '') else '' end r from {p}{i})")
            ctes.append(f"{p}{i + 1} as (select k, pos // {FANOUT} pos, max((n + {FANOUT - 1}) // {FANOUT}) n, "
                        f"case when max(n) > 1 then sha256(string_agg(digest, '' order by pos)) else min(digest) end digest from {p}{i} group by 1, 2)")

    climb("a", "select k, pos, count(*) over (partition by k) n, leaf digest from e", levels)
    climb("g", f"select '' k, row_number() over (order by t.k) - 1 pos, count(*) over () n, digest from a{levels} t", group_levels)
    ctes.append(f"s as (select k, digest subroot, row_number() over (order by k) - 1 gpos from a{levels})")
    ctes.append(f"f0 as (select e.*, s.subroot, s.gpos, case when tampered then lowered else leaf end f, '' p from e join s using (k))")
    step = 0
    for p, at, count in (("a", "pos", levels), ("g", "gpos", group_levels)):
        on_key = "f.k = w.k and " if p == "a" else ""
        for i in range(count):
            ctes.append(f"f{step + 1} as (select f.* replace (case when w.n > 1 then sha256(w.l || f.f || w.r) else f.f end as f, f.p || w.l || w.r as p) "
                        f"from f{step} f join {p}w{i} w on {on_key}f.{at} // {FANOUT ** i} = w.pos)")
            step += 1
    return ("with " + ",\n".join(ctes) + f"\nselect f.doc_id, f.leaf, f.subroot, r.digest root, sha256(f.p) proof_sha256, f.f folded_root, "
            f"f.f = r.digest verified from f{step} f, g{group_levels} r")
