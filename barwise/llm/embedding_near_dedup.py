"""Near duplicates of vectors by a robust-pruned flat graph.

Equal vectors are one node with a weight. Nodes are assigned to their
``OVERLAP`` nearest of a number of centres (fit on a bounded sample), so shards
overlap; a shard larger than ``BLOCK`` is dealt into blocks, each indexed alone
and searched by every node of the shard. In a block a flat graph is built by
robust pruning: a node keeps a neighbour only if no kept one is much nearer to
it. Centres within the threshold of each other are one shard, whose blocks all
its nodes search, so that a dense group isn't cut. The search starts from the
medoid of each component of the graph, and from a node itself in its own block, walks greedily with a beam, and from then on expands every
node within a widened range of the query until none is left. Cosines of what it
finds are verified in double precision.

Vectors that are null, zero or hold null or non-finite components link with
nothing. Vectors of different lengths never link. A pair met in several blocks
counts once, in the first shard that both share. Repeated rows are equal
vectors; rows that share a vec_id are one vertex to components. A null vec_id
has no component. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpointed, components, partitions, small_batches

THRESHOLD = 0.9
#: Vectors that the centres are fit on, at most.
SAMPLE = 20_000
#: Nodes for each centre, shards of a node, and most nodes of a block.
SHARD_NODES, OVERLAP, BLOCK = 1000, 3, 2000
#: Neighbours looked at and kept in a node's list, and the slack of pruning.
POOL, DEGREE, ALPHA = 48, 24, 1.2
BEAM = 12
#: How far below the threshold the search still expands.
SLACK = 0.08
#: Nodes' queries audited against brute force, at most.
AUDIT = 200


def unit(v: np.ndarray) -> np.ndarray:
    return v / np.sqrt((v * v).sum(1, keepdims=True))


def centres(vectors: np.ndarray, k: int, seed: int = 5) -> np.ndarray:
    """Spherical k-means, a few rounds."""
    rng = np.random.default_rng(seed)
    c = vectors[rng.choice(len(vectors), min(k, len(vectors)), replace=False)]
    for _ in range(6):
        near = np.concatenate([(vectors[i:i + 2000] @ c.T).argmax(1) for i in range(0, len(vectors), 2000)])
        total = np.zeros_like(c)
        np.add.at(total, near, vectors)
        full = np.abs(total).sum(1) > 0
        c[full] = unit(total[full])
    return c


def merged(c: np.ndarray, least: float) -> np.ndarray:
    """Labels of centres: those linked by similarities of ``least`` or more share
    one, so that a dense group cut by several centres is one shard."""
    label = np.arange(len(c))
    while True:
        low = np.concatenate([np.where(c[i:i + 256] @ c.T >= least, label, len(c)).min(1) for i in range(0, len(c), 256)])
        low = np.minimum(low, label)
        low = low[low]
        if (low == label).all():
            return label
        label = low


def pruned(x: np.ndarray) -> np.ndarray:
    """Adjacency lists [nodes, DEGREE] (-1: none) by robust pruning of each
    node's nearest ``POOL``."""
    n = len(x)
    pool = min(POOL, n - 1)
    out = np.full((n, DEGREE), -1, np.int64)
    for at in range(0, n if pool > 0 else 0, 256):
        mine = np.arange(at, min(at + 256, n))
        sim = x[mine] @ x.T
        sim[np.arange(len(mine)), mine] = -9
        near = np.argpartition(-sim, pool - 1, axis=1)[:, :pool]
        order = np.argsort(-np.take_along_axis(sim, near, 1), axis=1, kind="stable")
        near = np.take_along_axis(near, order, 1)
        far = 2 - 2 * np.take_along_axis(sim, near, 1)  # squared distances
        among = 2 - 2 * np.einsum("npd,nqd->npq", x[near], x[near])
        alive, rows = np.ones(near.shape, bool), np.arange(len(mine))
        for d in range(DEGREE):
            some = alive.any(1)
            pick = alive.argmax(1)
            out[mine[some], d] = near[rows, pick][some]
            alive &= ~(ALPHA * among[rows, pick] <= far) & some[:, None]
            alive[rows, pick] = False
    return out


def united(lists: np.ndarray) -> list[np.ndarray]:
    """Lists with edges both ways."""
    a, d = np.nonzero(lists >= 0)
    b = lists[a, d]
    pairs = np.unique(np.concatenate([np.stack([a, b], 1), np.stack([b, a], 1)]), axis=0)
    edge = np.searchsorted(pairs[:, 0], np.arange(len(lists) + 1))
    return pairs[:, 1], edge


def medoids(x: np.ndarray, heads: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """The most central node of each component of the graph."""
    label = np.arange(len(x))
    tails = np.repeat(label, np.diff(edge))
    while True:
        low = label.copy()
        np.minimum.at(low, tails, label[heads])
        low = low[low]
        if (low == label).all():
            break
        label = low
    out = []
    for k in np.unique(label):
        mine = np.flatnonzero(label == k)
        out.append(mine[(x[mine] @ x[mine].mean(0)).argmax()])
    return np.array(out)


def search(x: np.ndarray, queries: np.ndarray, heads: np.ndarray, edge: np.ndarray, least: float):
    """(query, node) pairs with a similarity of ``least`` or more. The first
    queries are the nodes themselves; each of those starts from itself, too."""
    starts = medoids(x, heads, edge)
    found = []
    for at in range(0, len(queries), 256):
        q = queries[at:at + 256]
        rows = np.arange(len(q))
        seen = np.full((len(q), len(x)), -9.0)  # similarity where visited
        open_ = np.zeros(seen.shape, bool)
        seen[:, starts] = q @ x[starts].T
        open_[:, starts] = True
        own = np.arange(at, min(at + len(q), len(x)))
        seen[own - at, own] = 1.0
        open_[own - at, own] = True

        def expand(r: np.ndarray, node: np.ndarray) -> None:
            open_[r, node] = False
            n = edge[node + 1] - edge[node]
            rr = np.repeat(r, n)
            nb = heads[np.repeat(edge[node] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))]
            new = seen[rr, nb] < -8
            key = np.unique(rr[new] * len(x) + nb[new])
            rr, nb = key // len(x), key % len(x)
            for i in range(0, len(rr), 1 << 16):
                a, b = rr[i:i + (1 << 16)], nb[i:i + (1 << 16)]
                seen[a, b] = np.einsum("nd,nd->n", q[a], x[b])
            open_[rr, nb] = True

        beam = min(BEAM, len(x))
        while True:  # greedy, until the beam's nodes are all expanded
            top = np.argpartition(-seen, beam - 1, axis=1)[:, :beam]
            score = np.where(np.take_along_axis(open_, top, 1), np.take_along_axis(seen, top, 1), -9)
            best = score.argmax(1)
            go = score[rows, best] > -8
            if not go.any():
                break
            expand(rows[go], top[rows, best][go])
        while True:  # everything within the widened range
            r, node = np.nonzero(open_ & (seen >= least - SLACK))
            if not len(r):
                break
            expand(r, node)
        r, node = np.nonzero(seen >= least)
        found.append((r + at, node))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def nodes_of(vectors: DataFrame) -> DataFrame:
    """(vec_id, key, v): valid vectors in double precision; equal ones share a key."""
    v = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    fine = (F.col("vec_id").isNotNull() & (F.size("v") > 0)
            & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v"))
            .filter(F.coalesce(fine, F.lit(False))).select("vec_id", F.sha2(F.concat_ws(",", "v"), 256).alias("key"), "v"))


def links(vectors: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = vectors.sparkSession
    small_batches(spark)
    valid = checkpointed(nodes_of(vectors))
    nodes = checkpointed(valid.groupBy("key").agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("weight"), F.first("v").alias("v")))
    n = nodes.count()
    part = F.pmod(F.xxhash64("id"), F.lit(1 << 30))
    sample = nodes.filter(part < F.lit(int((1 << 30) * min(1.0, SAMPLE / 2 / max(n, 1))))).select("v").limit(SAMPLE).collect()
    dims = sorted({len(r["v"]) for r in sample})
    per_dim, label = {}, {}
    for d in dims:
        x = unit(np.array([r["v"] for r in sample if len(r["v"]) == d]))
        per_dim[d] = centres(x, max(1, -(-n // SHARD_NODES)) if len(x) > 1 else 1)
        label[d] = merged(per_dim[d], threshold)

    def assign(batches):
        for batch in batches:
            out = []
            for i, w, v in zip(batch["id"], batch["weight"], batch["v"]):
                c = per_dim.get(len(v))
                v = np.asarray(v, float)
                scale = np.abs(v).max()
                near = [0] if c is None else np.argsort(-(c @ (v / scale)), kind="stable")[:OVERLAP]
                near = near if c is None else np.unique(label[len(v)][near]).tolist()
                out.append((i, w, v, [len(v) * (1 << 32) + k for k in near]))
            yield pd.DataFrame(out, columns=["id", "weight", "v", "shards"])

    placed = checkpointed(nodes.select("id", "weight", "v").mapInPandas(
        assign, "id long, weight long, v array<double>, shards array<long>"))
    in_shard = placed.withColumn("shard", F.explode("shards"))
    blocks = in_shard.groupBy("shard").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("long").alias("blocks"))
    dealt = in_shard.join(F.broadcast(blocks) if n <= 1000 * SHARD_NODES else blocks, "shard")
    block = F.pmod(F.xxhash64("id"), F.col("blocks"))
    indexed = dealt.select("shard", block.alias("block"), F.lit(True).alias("base"), "id", "weight", "v", "shards")
    asking = dealt.select("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
                          F.lit(False).alias("base"), "id", "weight", "v", "shards", block.alias("own")).filter("block <> own").drop("own")
    rows = indexed.unionByName(asking)

    def look(key, group: pd.DataFrame) -> pd.DataFrame:
        shard = int(key[0])
        group = group.sort_values(["base", "id"], ascending=[False, True])
        x = np.stack(group["v"].to_numpy())
        x = unit(x / np.abs(x).max(1, keepdims=True))
        ids, weight, k = group["id"].to_numpy(), group["weight"].to_numpy(), int(group["base"].sum())
        if not k:
            return pd.DataFrame({"id": [], "n": [], "to": []}, dtype="int64")
        heads, edge = united(pruned(x[:k]))
        r, c = search(x[:k], x, heads, edge, threshold - 1e-9)
        r, c = r[r != c], c[r != c]
        exact = np.concatenate([np.einsum("nd,nd->n", x[r[i:i + 65536]], x[c[i:i + 65536]]) for i in range(0, max(1, len(r)), 65536)])
        r, c = r[exact >= threshold], c[exact >= threshold]
        # either of two nodes may find the other; a block's own pairs count both ways
        pairs = np.stack([r, c], 1)
        inner = pairs[:, 0] < k
        pairs = np.unique(np.concatenate([pairs, pairs[inner][:, ::-1]]), axis=0)
        shards = [set(s) for s in group["shards"]]
        lists = group["shards"].to_numpy()
        once = np.fromiter((shard == min(shards[a].intersection(lists[b])) for a, b in pairs), bool, len(pairs))
        pairs = pairs[once]
        n_links = np.bincount(pairs[:, 0], weights=weight[pairs[:, 1]], minlength=len(x)).astype(np.int64)
        # a spanning forest says as much of components as all pairs
        to = np.arange(len(x))
        while True:
            low = to.copy()
            np.minimum.at(low, pairs[:, 0], to[pairs[:, 1]])
            np.minimum.at(low, pairs[:, 1], to[pairs[:, 0]])
            low = low[low]
            if (low == to).all():
                break
            to = low
        some = np.flatnonzero((n_links > 0) | (to != np.arange(len(x))))
        return pd.DataFrame({"id": ids[some], "n": n_links[some], "to": ids[to[some]]})

    spread = max(partitions(spark), 1)
    seen = checkpointed(rows.repartition(spread, "shard", "block").groupBy("shard", "block").applyInPandas(look, "id long, n long, to long"))
    others = seen.groupBy("id").agg(F.sum("n").alias("others"))
    comps = components(seen.select(F.col("id").alias("a"), F.col("to").alias("b")).filter("a <> b"))
    per_node = (nodes.select("id", "key", "weight").join(others, "id", "left")
                .join(comps.select(F.col("node").alias("id"), "component"), "id", "left")
                .select("key", (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                        F.coalesce("component", "id").alias("component_id")))
    keyed = nodes_of(vectors).select(F.col("vec_id").alias("_id"), "key").distinct().join(per_node, "key")
    out = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.sha2(F.concat_ws(",", F.transform(
        "embedding", lambda x: x.cast("double"))), 256).alias("_key"))
    joined = out.join(keyed.select("_id", "key", "n_links", "component_id"), (F.col("vec_id") == F.col("_id")) & (F.col("_key") == F.col("key")), "left")
    component = F.coalesce("component_id", "vec_id")
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))


def audit(vectors: DataFrame, found: DataFrame, threshold: float = THRESHOLD, queries: int = AUDIT) -> float:
    """Recall: links found of a bounded sample of vectors, out of those that
    brute force finds against all rows."""
    valid = nodes_of(vectors).select("vec_id", "v")
    some = valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(queries).collect()
    width = len(some[0]["v"]) if some else 0
    q, ids = unit(np.array([r["v"] for r in some if len(r["v"]) == width])), [r["vec_id"] for r in some if len(r["v"]) == width]

    def count(batches):
        for batch in batches:
            x = np.stack([np.asarray(v, float) for v in batch["v"] if len(v) == width])
            yield pd.DataFrame({"q": ids, "n": ((unit(x) @ q.T) >= threshold).sum(0)})

    truth = valid.mapInPandas(count, "q long, n long").groupBy("q").agg((F.sum("n") - 1).alias("truth"))
    both = truth.join(found.select(F.col("vec_id").alias("q"), "n_links"), "q").agg(F.sum("n_links"), F.sum("truth")).first()
    return 1.0 if not both[1] else both[0] / both[1]
