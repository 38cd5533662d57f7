"""Embedding near-duplicates: robust-pruned flat graph over overlapping shards.

Vectors are compared only when their labels (and dimensions) are equal.  Equal
vectors are one node with a multiplicity.  A hash sample of the nodes (about one in
``SHARD``, ``MAX_CENTROIDS`` in all) gives each label its shard centres.  A node's home
is its nearest centre, or, where several centres are within ``DENSE`` cosine of it, one of
them by hash, so that a dense group of any size is spread evenly over its centres.

Build: the members of a shard (home nodes, and nodes whose second centre it is) get
edges by robust pruning (alpha ``ALPHA``, degree ``DEGREE``) and the reverse edges; a
node's lists from its shards are united.  Search: every node is a query in its nearest shards (``PROBES``, or
more where an audit needs them) and in every shard whose centre is within ``REACH`` cosine (by the triangle
inequality on angles all shards that hold partners from a dense group); a greedy beam
search starts at the shard's medoid and at the query's own place, and expands from each node
in range until no new node is in range.  The audit compares
a hash sample of each label's nodes with all nodes of the label and raises the probes until ``RECALL`` of the
sample's links, by link and by query, lead to a shard that one of the two ends asks.  A link that the other end can't
find, because it doesn't ask the shard, is counted for both ends by the end that does.  Cosines are taken in double precision and a
link needs ``THRESHOLD``.  A found node counts in its home shard only, so that counts
add up without a list of pairs; each search task sends only a spanning forest
of its links to the component step.  Queries of a busy shard are split into chunks.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components, and vectors
with null label, link with nothing; repeated rows are vectors of their own; a component of
null ids only has a null id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.common import connected_components, materialize

THRESHOLD = 0.93
SHARD = 256
MAX_CENTROIDS = 20_000  # bounds the broadcast: at most this many vectors
DENSE, REACH = 0.95, 0.76  # cos(acos(0.93) + acos(0.95)) > 0.76
PROBES = 4  # at least
RECALL = 0.99
AUDIT, FEW = 1_000, 100  # sampled nodes of a label; labels with fewer sampled nodes that have links look at all labels' too
ALPHA, DEGREE, BEAM = 1.2, 24, 24
CHUNK = 2_000  # queries of a shard in one task


def unit(v) -> np.ndarray:
    m = np.asarray([np.asarray(x, dtype="float64") for x in v])
    return m / np.linalg.norm(m, axis=1)[:, None]


def robust_prune(sims: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA) -> np.ndarray:
    """Adjacency matrix of a shard from its cosines: each row keeps diverse near nodes, with reverse edges."""
    n = len(sims)
    d = np.sqrt(np.maximum(0.0, 2 - 2 * sims))
    out = np.zeros((n, n), dtype=bool)
    for p in range(n):
        alive = np.ones(n, dtype=bool)
        alive[p] = False
        order = np.argsort(d[p], kind="stable")
        kept = 0
        for q in order:
            if alive[q]:
                out[p, q] = True
                kept += 1
                if kept == degree:
                    break
                alive &= alpha * d[q] > d[p]
    return out | out.T


def medoid(v: np.ndarray) -> int:
    return int(np.argmax(v @ v.sum(axis=0)))


def range_search(q: np.ndarray, own: np.ndarray, v: np.ndarray, adj: np.ndarray, start: int,
                 threshold: float = THRESHOLD, beam: int = BEAM) -> np.ndarray:
    """Boolean (queries x nodes): nodes in range that the search reached."""
    sims = np.full((len(q), len(v)), -np.inf)

    def visit(rows: np.ndarray, cols: np.ndarray) -> None:
        for lo in range(0, len(rows), 50_000):
            r, c = rows[lo:lo + 50_000], cols[lo:lo + 50_000]
            sims[r, c] = np.einsum("ij,ij->i", q[r], v[c])

    every = np.arange(len(q))
    visit(every, np.full(len(q), start))
    has = own >= 0
    visit(every[has], own[has])
    expanded = np.zeros(sims.shape, dtype=bool)
    live = every
    while len(live):
        s = sims[live]
        open_ = np.where(expanded[live], -np.inf, s)
        best = open_.argmax(axis=1)
        worst = np.partition(s, -beam, axis=1)[:, -beam] if s.shape[1] > beam else np.full(len(live), -np.inf)
        value = open_[np.arange(len(live)), best]
        go = (value > -np.inf) & ((value >= worst) | (value >= threshold))  # the beam grows with the range
        live, best = live[go], best[go]
        expanded[live, best] = True
        r, c = np.nonzero(adj[best] & np.isneginf(sims[live]))
        visit(live[r], c)
        # all nodes in range are expanded at once
        r, c = np.nonzero((sims[live] >= threshold) & ~expanded[live])
        while len(r):
            expanded[live[r], c] = True
            front = np.zeros((len(live), len(v)), dtype="float32")
            front[r, c] = 1
            new = (front @ adj.astype("float32") > 0) & np.isneginf(sims[live])
            r, c = np.nonzero(new)
            visit(live[r], c)
            r, c = np.nonzero((sims[live] >= threshold) & ~expanded[live])
    return sims >= threshold


def _forest(hit: np.ndarray, q_ids: np.ndarray, v_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id that each query and node reaches by links of this task."""
    lq, lv = q_ids.copy(), v_ids.copy()
    r, c = np.nonzero(hit)
    while True:
        before = (lq.sum(), lv.sum())
        np.minimum.at(lq, r, lv[c])
        np.minimum.at(lv, c, lq[r])
        if (lq.sum(), lv.sum()) == before:
            return lq, lv


Centres = dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]


def _homes(sims: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Home shard of each node by its cosines with the centres."""
    home = sims.argmax(axis=1)
    dense = sims >= DENSE
    for i in np.flatnonzero(dense.sum(axis=1) > 1):
        near = np.flatnonzero(dense[i])
        home[i] = near[int(ids[i]) * 2_654_435_761 % 4_294_967_296 * len(near) >> 32]
    return home


def _audit(centres: Centres, sample: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]]):
    """Per sampled node: its links by the probes that one of the two ends needs to ask the other's home shard."""
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = {}
        for pdf in it:
            for key, g in pdf.groupby(["label", "dim"], sort=False):
                if key not in sample:
                    continue
                c = centres[key][1]
                q_ids, q = sample[key]
                if key not in known:
                    sims_q = q @ c.T
                    rank = np.empty(sims_q.shape, dtype="int32")
                    np.put_along_axis(rank, np.argsort(-sims_q, axis=1, kind="stable"), np.arange(len(c), dtype="int32")[None], axis=1)
                    rank[sims_q >= REACH] = -1
                    known[key] = rank, _homes(sims_q, q_ids)
                rank, home_q = known[key]
                for lo in range(0, len(g), 1_000):
                    part = g.iloc[lo:lo + 1_000]
                    v, ids = unit(part["emb"]), part["at"].to_numpy()
                    sims = v @ c.T
                    r, k = np.nonzero((q @ v.T >= THRESHOLD) & (q_ids[:, None] != ids[None, :]))
                    need = rank[r, _homes(sims, ids)[k]] + 1
                    far = np.flatnonzero(need > PROBES)
                    for at in range(0, len(far), 1_000):
                        f = far[at:at + 1_000]
                        to = sims[k[f], home_q[r[f]]]
                        back = np.where(to >= REACH, 0, (sims[k[f]] > to[:, None]).sum(axis=1) + 1)
                        need[f] = np.minimum(need[f], back)
                    out = pd.DataFrame({"q": q_ids[r], "need": need.astype("int32"), "n": part["size"].to_numpy()[k]})
                    yield out.groupby(["q", "need"], as_index=False)["n"].sum().assign(label=key[0], dim=key[1])[
                        ["label", "dim", "q", "need", "n"]]

    return run


def _needed(found: pd.DataFrame) -> int:
    """Fewest probes (PROBES at least) that find RECALL of the links, and of each query's links on average."""
    if found.empty:
        return PROBES
    n = found["n"].to_numpy(dtype="float64")
    share = n / found.groupby("q")["n"].transform("sum").to_numpy() / found["q"].nunique()
    order = np.argsort(found["need"].to_numpy(), kind="stable")
    need = found["need"].to_numpy()[order]
    enough = np.minimum(np.cumsum(n[order]) / n.sum(), np.cumsum(share[order])) >= RECALL
    return max(PROBES, int(need[np.argmax(enough)]) if enough.any() else int(need[-1]))


def probes_by_label(nodes: DataFrame, centres: Centres, step: int) -> dict[tuple[int, int], int]:
    """Shards that a node asks, for each label (and dimension) with more than PROBES centres."""
    large = {k: len(c[0]) for k, c in centres.items() if len(c[0]) > PROBES}
    if not large:
        return {}
    quota = max(20, min(AUDIT, MAX_CENTROIDS // len(large)))
    rates = nodes.sparkSession.createDataFrame(
        [(int(lab), int(dim), max(1, n * step // quota)) for (lab, dim), n in large.items()], "label long, dim int, every long")
    rows = (nodes.join(F.broadcast(rates), ["label", "dim"]).where(F.pmod(F.xxhash64("at", F.lit(2)), F.col("every")) == 0)
            .select("label", "dim", "at", "emb").collect())
    groups: dict[tuple[int, int], list] = {}
    for r in rows:
        groups.setdefault((r["label"], r["dim"]), []).append(r)
    sample = {k: (np.array([r["at"] for r in g]), unit([r["emb"] for r in g])) for k, g in groups.items()}
    found = (nodes.mapInPandas(_audit(centres, sample), "label long, dim int, q long, need int, n long")
             .groupBy("label", "dim", "q", "need").agg(F.sum("n").alias("n")).toPandas())
    whole, own = _needed(found), dict(list(found.groupby(["label", "dim"])))
    return {k: max(_needed(own[k]) if k in own else PROBES, whole if k not in own or own[k]["q"].nunique() < FEW else 0)
            for k in large}


def _assigner(centres: Centres, probes: dict[tuple[int, int], int]):
    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for key, g in pdf.groupby(["label", "dim"], sort=False):
                v = unit(g["emb"])
                ids = g["at"].to_numpy()
                n = len(g)
                if key not in centres:
                    out.append(g.assign(shard=-1, home=True, member=True, query=True, lives=-1, asks=[[-1]] * n))
                    continue
                names, c = centres[key]
                sims = v @ c.T
                order = np.argsort(-sims, axis=1, kind="stable")[:, :max(2, probes.get(key, PROBES))]
                home = _homes(sims, ids)
                query = sims >= REACH
                np.put_along_axis(query, order[:, :probes.get(key, PROBES)], True, axis=1)
                member = np.zeros_like(query)
                np.put_along_axis(member, order[:, :2], True, axis=1)
                member[np.arange(n), home] = query[np.arange(n), home] = True
                r, s = np.nonzero(member | query)
                f = g.iloc[r].copy()
                lives = home[r] == s
                asks = [names[order[i]].tolist() if x else None for i, x in zip(r, lives)]
                out.append(f.assign(shard=names[s], home=lives, member=member[r, s], query=query[r, s], lives=names[home[r]], asks=asks))
            yield pd.concat(out) if out else pdf.assign(shard=0, home=False, member=False, query=False, lives=0, asks=None)

    return run


def _build(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("at")
    v, ids = unit(pdf["emb"]), pdf["at"].to_numpy()
    adj = robust_prune(v @ v.T)
    return pd.DataFrame({"at": ids, "near": [ids[row] for row in adj]})


_FOUND = "at long, links long, low long"


def _searcher(centres: Centres):
    def unseen(key, v: np.ndarray, asks: pd.Series, lives: np.ndarray) -> np.ndarray:
        """Boolean (queries x nodes): nodes that don't ask the query's home shard."""
        shards, place = np.unique(lives, return_inverse=True)
        seen = np.array([np.isin(shards, a) for a in asks]).reshape(len(v), len(shards))
        if key[:2] in centres:
            names, c = centres[key[:2]]
            seen |= v @ c[np.searchsorted(names, shards)].T >= REACH
        return ~seen.T[place]

    def search(key, members, queries):
        if members.empty or queries.empty:
            return pd.DataFrame({"at": [], "links": [], "low": []}).astype("int64")
        members = members.sort_values("at")
        ids, v = members["at"].to_numpy(), unit(members["emb"])
        place = {a: i for i, a in enumerate(ids.tolist())}
        adj = np.zeros((len(ids), len(ids)), dtype=bool)
        for i, near in enumerate(members["near"]):
            adj[i, [place[a] for a in near if a in place]] = True
        q_ids, q = queries["at"].to_numpy(), unit(queries["emb"])
        own = np.array([place.get(a, -1) for a in q_ids.tolist()])
        hit = range_search(q, own, v, adj, medoid(v))
        hit[np.flatnonzero(own >= 0), own[own >= 0]] = False
        home = members["home"].to_numpy()
        weight = np.where(home, members["size"].to_numpy(), 0)
        back = np.zeros(len(ids), "int64")
        back[home] = queries["size"].to_numpy() @ (
            hit[:, home] & unseen(key, v[home], members["asks"][home], queries["lives"].to_numpy()))
        low, low_v = _forest(hit, q_ids, ids)
        return pd.DataFrame({"at": np.r_[q_ids, ids], "links": np.r_[hit @ weight, back], "low": np.r_[low, low_v]})

    return search


def links(embeddings: DataFrame) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per row of ``embeddings``."""
    base = materialize(embeddings.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long"), F.col("label").cast("long"),
        F.col("embedding").cast("array<double>").alias("emb")), "vec-rows")
    ok = (F.col("label").isNotNull() & F.col("emb").isNotNull() & F.exists("emb", lambda x: x != 0)
          & ~F.exists("emb", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    good = base.where(F.coalesce(ok, F.lit(False)))
    nodes = materialize(
        good.groupBy("label", "emb").agg(F.min("row").alias("at"), F.count(F.lit(1)).alias("size"))
        .withColumn("dim", F.size("emb")), "vec-nodes")
    n = nodes.count()
    step = max(SHARD, -(-n // MAX_CENTROIDS))
    sample = (nodes.where(F.pmod(F.xxhash64("at"), F.lit(step)) == 0)
              .orderBy(F.xxhash64("at", F.lit(1)), "at").limit(2 * MAX_CENTROIDS).collect())
    groups: dict[tuple[int, int], list] = {}
    for r in sorted(sample, key=lambda r: r["at"]):
        groups.setdefault((r["label"], r["dim"]), []).append(r)
    centres = {k: (np.array([r["at"] for r in g]), unit([r["emb"] for r in g])) for k, g in groups.items()}
    dealt = materialize(
        nodes.mapInPandas(_assigner(centres, probes_by_label(nodes, centres, step)),
                          "label long, emb array<double>, at long, size long, dim int, shard long, home boolean, "
                          "member boolean, query boolean, lives long, asks array<long>"), "vec-dealt")
    near = (dealt.where("member").groupBy("label", "dim", "shard").applyInPandas(_build, "at long, near array<long>")
            .groupBy("at").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")))
    chunks = (dealt.where("query").groupBy("label", "dim", "shard")
              .agg(F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("chunks")))
    key = ["label", "dim", "shard", "chunk"]
    members = (dealt.where("member").join(near, "at").join(chunks, ["label", "dim", "shard"])
               .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
               .select(*key, "at", "emb", "size", "home", "near", "asks"))
    queries = (dealt.where("query").join(chunks, ["label", "dim", "shard"])
               .withColumn("chunk", F.pmod(F.xxhash64("at"), F.col("chunks")).cast("int"))
               .select(*key, "at", "emb", "size", "lives").toDF(*key, "at", "emb", "size", "lives"))  # own column ids beside members'
    found = materialize(members.groupBy(*key).cogroup(queries.groupBy(*key)).applyInPandas(_searcher(centres), _FOUND), "vec-found")
    part = connected_components(nodes.select(F.col("at").alias("v")),
                                found.where("at <> low").select(F.col("at").alias("a"), F.col("low").alias("b")))
    counted = (nodes.select("label", "emb", "at", "size")
               .join(found.groupBy("at").agg(F.sum("links").alias("links")), "at", "left")
               .join(part.withColumnRenamed("v", "at"), "at")
               .select("label", "emb", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), "component"))
    rows = materialize(good.join(counted, ["label", "emb"]).select("row", "vec_id", "n_links", "component"), "vec-linked")
    low = rows.groupBy("component").agg(F.min("vec_id").alias("component_id"))
    linked = rows.join(low, "component").select("vec_id", "n_links", "component_id")
    alone = (base.where(~F.coalesce(ok, F.lit(False)))
             .select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")))
    return linked.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def audit_recall(embeddings: DataFrame, found: DataFrame, every: int = 20) -> float:
    """Links found over links there are, for vectors whose id is divisible by ``every``, by brute force."""
    v = embeddings.where("label is not null").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
    norm = "sqrt(aggregate({0}, 0D, (s, x) -> s + x * x))"
    v = v.withColumn("n", F.expr(norm.format("e"))).where("n > 0")
    q = v.where(F.col("vec_id") % every == 0)
    dot = "aggregate(zip_with(a.e, b.e, (x, y) -> x * y), 0D, (s, x) -> s + x) / (a.n * b.n)"
    true = (q.alias("a").join(v.alias("b"), F.expr(f"a.label = b.label and a.vec_id <> b.vec_id and {dot} >= {THRESHOLD}"))
            .count())
    have = found.where(F.col("vec_id") % every == 0).agg(F.sum("n_links")).first()[0] or 0
    return 1.0 if not true else have / true


def op9(embeddings: DataFrame) -> DataFrame:
    return links(embeddings)
