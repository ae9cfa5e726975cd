"""Nearest neighbours by inner product with randomly rotated one-bit codes.

A vector is its cluster's centre plus a residual. The residual's direction,
rotated at random, is kept as the signs of its components, one bit each, with
two correction scalars: the residual's length and the inner product of the
direction with its own code. From the bits and these, the inner product with a
query is estimated without bias, with an error bound that holds with a
probability set by ``epsilon``; the vectors whose upper bound reaches the k-th
best score known are reranked exactly on the original vectors.

Clusters come from k-means on a bounded sample (``SAMPLE_BYTES``) and index
every vector; a cluster of more than ``BLOCK`` vectors is dealt into blocks by
hash, so that no task holds more than one. A query first searches a block of
the cluster whose centre is nearest to it, which gives it a k-th best score,
then every block that centre and radius (a safe bound) don't rule out. Queries
of a block are dealt into slices of about ``SLICE``.

Vectors that are null, empty, zero or hold null or non-finite components take
no part. Rows count each, also with equal vec_id (each is a query of its own);
ties go to the smaller vec_id, a null one last, which asks nothing. Shorter
vectors count as padded with zeros. Extra columns are ignored, empty tables
give empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, small_batches

NEIGHBOURS, EVERY = 20, 20
#: Vectors of a block and queries of a slice, about.
BLOCK, SLICE = 8192, 2048
#: Bound of the sample that centres are fitted on, and of their number.
SAMPLE_BYTES, CENTRES = 16 << 20, 1024
#: Width of the error bound, in standard deviations of a random direction.
EPSILON = 2.5
#: Queries whose estimates are computed together.
TOGETHER = 64


@dataclass
class Space:
    dim: int
    rotation: np.ndarray  # [dim, dim], orthogonal
    centres: np.ndarray  # [centres, dim]

    def nearest(self, x: np.ndarray) -> np.ndarray:
        return ((self.centres ** 2).sum(1) - 2 * (x @ self.centres.T)).argmin(1)


def rotation(dim: int, seed: int = 11) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def k_means(x: np.ndarray, k: int, rounds: int = 8, seed: int = 5) -> np.ndarray:
    centres = x[np.random.default_rng(seed).choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        own = ((centres ** 2).sum(1) - 2 * (x @ centres.T)).argmin(1)
        sizes = np.bincount(own, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, x)
        centres[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return centres


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, v): the vectors that take part."""
    v = F.col("embedding")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.cast("array<double>").alias("v"))
            .filter(F.forall("v", fine) & F.exists("v", lambda x: x != 0)))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column, padded with zeros."""
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())
    if (sizes == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(sizes), dim))
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


def fit(rows: DataFrame) -> Space | None:
    n, dim = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    if not n:
        return None
    at_most = max(256, min(n, SAMPLE_BYTES // (8 * dim)))
    key = F.xxhash64("vec_id", "v")
    some = rows.filter(F.pmod(key, F.lit(1 << 30)) < min(1.0, at_most / n) * (1 << 30)).select("v", key.alias("k"))
    sample = [r["v"] for r in some.orderBy("k").limit(2 * at_most).collect()]
    if not sample:
        sample = [rows.select("v").first()["v"]]
    x = np.zeros((len(sample), dim))
    for i, v in enumerate(sample):
        x[i, :len(v)] = v
    k = max(1, min(CENTRES, -(-n // BLOCK), len(x) // 32))
    return Space(dim, rotation(dim), k_means(x, k))


def encode(x: np.ndarray, centre: np.ndarray, turn: np.ndarray):
    """(bits, residual lengths, inner products of directions and their codes)."""
    dim = x.shape[1]
    o = (x - centre) @ turn
    length = np.sqrt((o * o).sum(1))
    bits = o > 0
    own = np.abs(o).sum(1) / np.sqrt(dim) / np.where(length > 0, length, 1)
    return np.packbits(bits, axis=1), length, np.where(length > 0, own, 1.0)


def build(rows: DataFrame, space: Space) -> tuple[DataFrame, DataFrame]:
    """(index, clusters): a record per block with its codes and vectors, and
    the number of blocks and the radius of each cluster."""
    def assign(batches):
        for batch in batches:
            x = matrix(batch.column("v"), space.dim)
            own = space.nearest(x)
            off = np.sqrt(((x - space.centres[own]) ** 2).sum(1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.astype(np.int32)), batch.column("row"), batch.column("vec_id"), pa.array(off),
                 pa.array([r.tobytes() for r in np.ascontiguousarray(x)], pa.binary())],
                ["cluster", "row", "vec_id", "off", "v"])

    assigned = checkpointed(rows.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        assign, "cluster int, row long, vec_id long, off double, v binary"))
    clusters = checkpointed(assigned.groupBy("cluster").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"), F.max("off").alias("radius")))

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("row")
        x = np.frombuffer(b"".join(group["v"]), np.float64).reshape(-1, space.dim)
        codes, length, own = encode(x, space.centres[group["cluster"].iloc[0]], space.rotation)
        null = group["vec_id"].isna().to_numpy()
        return pd.DataFrame({
            "cluster": group["cluster"][:1], "block": group["block"][:1], "rows": [group["row"].to_numpy().tobytes()],
            "ids": [group["vec_id"].fillna(0).to_numpy(np.int64).tobytes()], "no_id": [null.tobytes()],
            "codes": [codes.tobytes()], "lengths": [length.tobytes()], "own": [own.tobytes()], "vectors": [x.tobytes()]})

    index = (assigned.join(F.broadcast(clusters), "cluster")  # at most CENTRES rows
             .withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
             .groupBy("cluster", "block").applyInPandas(
        pack, "cluster int, block int, rows binary, ids binary, no_id binary, codes binary, lengths binary, own binary, vectors binary"))
    return checkpointed(index), clusters


FOUND = "query_row long, query_id long, row long, vec_id long, score double"


def search(index: DataFrame, asked: DataFrame, space: Space, k: int, epsilon: float) -> DataFrame:
    """FOUND rows: for each of ``asked`` (cluster, block, row, vec_id, v, least)
    the k best of its block, those below ``least`` left out."""
    n_slices = max(1, -(-asked.select("row").distinct().count() // SLICE))
    asked = asked.withColumn("slice", F.pmod(F.xxhash64("row", F.lit("slice")), F.lit(n_slices)).cast("int"))
    wanted = asked.select("cluster", "block", "slice").distinct().toDF("cluster", "block", "part")

    def within(blocks: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        dim, out = space.dim, []
        if not len(blocks) or not len(queries):
            return pd.DataFrame({c.split()[0]: [] for c in FOUND.split(", ")})
        b = blocks.iloc[0]
        x = np.frombuffer(b["vectors"]).reshape(-1, dim)
        rows, ids, null = np.frombuffer(b["rows"], np.int64), np.frombuffer(b["ids"], np.int64), np.frombuffer(b["no_id"], bool)
        length, own = np.frombuffer(b["lengths"]), np.frombuffer(b["own"])
        packed = np.frombuffer(b["codes"], np.uint8).reshape(len(x), -1)
        signs = np.unpackbits(packed, axis=1, count=dim).astype(np.float64) * 2 - 1
        correct = length / own / np.sqrt(dim)
        centre = space.centres[b["cluster"]]
        spread = length * np.sqrt(np.maximum(1 - own ** 2, 0)) / own / np.sqrt(max(1, dim - 1))
        spread[spread > 0] *= epsilon
        spread += 1e-9 * (length + np.sqrt((centre ** 2).sum()))  # rounding
        q = np.frombuffer(b"".join(queries["v"])).reshape(-1, dim)
        turned, norms, base = q @ space.rotation, np.sqrt((q * q).sum(1)), q @ centre
        for at in range(0, len(q), TOGETHER):
            estimates = base[at:at + TOGETHER, None] + (turned[at:at + TOGETHER] @ signs.T) * correct
            for i, estimate in enumerate(estimates, at):
                least, me = queries["least"].iloc[i], queries["row"].iloc[i]
                if len(x) > 2 * k:  # the k-th best of the likeliest raises the bar
                    some = np.argpartition(estimate, -2 * k)[-2 * k:]
                    exact = np.sort((x[some] * q[i]).sum(1)[rows[some] != me])
                    least = max(least, exact[-k]) if len(exact) >= k else least
                some = np.flatnonzero(estimate + norms[i] * spread >= least)
                some = some[rows[some] != me]
                exact = (x[some] * q[i]).sum(1)
                some, exact = some[exact >= least], exact[exact >= least]
                best = np.lexsort((rows[some], ids[some], null[some], -exact))[:k]
                out.append((np.full(len(best), i), some[best], exact[best]))
        i, some, score = (np.concatenate(c) for c in zip(*out))
        return pd.DataFrame({"query_row": queries["row"].to_numpy()[i], "query_id": queries["vec_id"].to_numpy()[i], "row": rows[some],
                             "vec_id": pd.array(ids[some], "Int64").copy() if not null[some].any() else
                             pd.arrays.IntegerArray(ids[some].copy(), null[some].copy()), "score": score})

    keys = ["cluster", "block", "slice"]
    return (index.join(wanted, ["cluster", "block"]).withColumnRenamed("part", "slice").groupBy(*keys)
            .cogroup(asked.groupBy(*keys)).applyInPandas(within, FOUND))


def routes(queries: DataFrame, clusters: DataFrame, space: Space, home: bool) -> DataFrame:
    """``queries`` (row, vec_id, v, least) with the blocks that they go to: one
    of the likeliest cluster (``home``), or all others that aren't ruled out."""
    known = clusters.collect()  # at most CENTRES rows
    which = np.array([r["cluster"] for r in known], np.int64)
    blocks, radius = np.array([r["blocks"] for r in known]), np.array([r["radius"] for r in known])
    own = np.repeat(np.arange(len(which)), blocks)
    number = np.concatenate([np.arange(b) for b in blocks])
    first = np.cumsum(blocks) - blocks

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            q = np.frombuffer(b"".join(batch.column("v").to_pylist())).reshape(-1, space.dim)
            at = q @ space.centres[which].T
            to = at.argmax(1)
            mine = first[to] + batch.column("row").to_numpy() % blocks[to]
            if home:
                i, block = np.arange(len(q)), mine
            else:
                norms = np.sqrt((q * q).sum(1))[:, None]
                slack = 1e-9 * norms * (np.sqrt((space.centres[which] ** 2).sum(1)) + radius)
                least = batch.column("least").to_numpy()[:, None]
                may = (at + norms * radius + slack >= least)[:, own]
                may[np.arange(len(q)), mine] = False
                i, block = np.nonzero(may)
            for a in range(0, len(i), 4096):
                part = pa.array(i[a:a + 4096])
                cols = [batch.column(c).take(part) for c in ("row", "vec_id", "v", "least")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(which[own[block[a:a + 4096]]].astype(np.int32)), pa.array(number[block[a:a + 4096]].astype(np.int32)), *cols],
                    ["cluster", "block", "row", "vec_id", "v", "least"])

    return queries.select("row", "vec_id", "v", "least").mapInArrow(
        run, "cluster int, block int, row long, vec_id long, v binary, least double")


def indexed_queries(index: DataFrame, space: Space, every: int) -> DataFrame:
    """(row, vec_id, v, least) of the indexed vectors that ask."""
    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                ids, rows = np.frombuffer(r["ids"], np.int64), np.frombuffer(r["rows"], np.int64)
                ask = np.flatnonzero((ids % every == 0) & ~np.frombuffer(r["no_id"], bool))
                x = np.frombuffer(r["vectors"]).reshape(-1, space.dim)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows[ask]), pa.array(ids[ask]), pa.array([v.tobytes() for v in x[ask]], pa.binary()),
                     pa.array(np.full(len(ask), -np.inf))], ["row", "vec_id", "v", "least"])

    return index.select("rows", "ids", "no_id", "vectors").mapInArrow(run, "row long, vec_id long, v binary, least double")


def neighbours(vectors: DataFrame, k: int = NEIGHBOURS, every: int = EVERY, epsilon: float = EPSILON) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest of each vector whose
    vec_id is divisible by ``every``. An infinite ``epsilon`` reranks all."""
    spark = vectors.sparkSession
    small_batches(spark)
    rows = usable(vectors)
    space = fit(rows)
    if space is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index, clusters = build(rows, space)
    queries = checkpointed(indexed_queries(index, space, every))
    near = checkpointed(search(index, routes(queries, clusters, space, True), space, k, epsilon))
    bar = near.groupBy("query_row").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("bar"))
    raised = queries.join(bar, queries["row"] == bar["query_row"], "left").select(
        "row", "vec_id", "v", F.coalesce("bar", "least").alias("least"))
    far = search(index, checkpointed(routes(raised, clusters, space, False)), space, k, epsilon)
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (near.unionByName(far).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def recall(found: DataFrame, exact: DataFrame) -> float:
    """Share of the exact neighbours' scores that ``found`` reaches, by rank set."""
    a = found.groupBy("query_id", "vec_id").count().withColumnRenamed("count", "a")
    b = exact.groupBy("query_id", "vec_id").count().withColumnRenamed("count", "b")
    both = b.join(a, (a["query_id"] == b["query_id"]) & a["vec_id"].eqNullSafe(b["vec_id"]), "left")
    hit, all_ = both.agg(F.sum(F.least(F.coalesce("a", F.lit(0)), "b")), F.sum("b")).first()
    return hit / all_ if all_ else 1.0
