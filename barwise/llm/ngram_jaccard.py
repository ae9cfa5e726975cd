"""Similarity join of documents by the Jaccard coefficient of their shingle
sets, by PartEnum signatures, and the connected components of its links.

Two sets linked at coefficient t differ in at most (1 - t) / (1 + t) of their
sizes' sum. Sizes fall into bands such that linked sets are in the same or in
neighbouring bands. For each band the shingle domain is partitioned by hash
into k + 1 + e parts, k being the most elements in which two of its linked sets
differ: they agree on e + 1 parts at least, so if one of them has no more than
e empty parts, they agree on a part that isn't empty. The signatures are all
subsets of one such part: its elements' sum. The few sets with more empty parts
are enumerated anew under another hash; at the last level empty parts are
signatures, too. No link is lost.

Exact copies are one node (64-bit digest of the set). Candidates are verified on
whole sets of 64-bit shingle hashes. First every set is compared with one
other, the most shared one among the sets it shares signatures with. Then pairs
that aren't connected by now are looked at in two rounds, the likeliest ones
and all of them. Bit maps in which every shingle flips a bit bound the
difference of two sets from below, and only pairs within the bound are
verified; in the two rounds no others leave a task. Pairs already connected need no check, so a
large group of copies doesn't give the square of its size.

A text without words is a set without elements, linked with nothing. A null id
is linked with nothing, its component is null. Repeated rows are copies of each
other; rows that share a doc_id with different texts are one node to links and
keep a row each. Extra columns are ignored.
"""

from __future__ import annotations

import math
import string

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (WordHashes, byte_chunks, checkpointed, components, grams, key_map, mix64, only_keys, partitions, renamed,
                     small_batches, strings)

SHINGLE = 4
PERCENT = 85
LEVELS = 5
#: Bits of a set's map.
MAP_BITS = 1024
#: Rows that a task of the later rounds takes, on average.
OPEN_ROWS = 50_000
#: Text bytes whose signatures meet in one task, about.
PART_BYTES = 64 << 20
#: Bytes of a signature that travel. Those that meet in a task are some
#: millions, so that equal ones of different parts stay rare.
KEY_BYTES = 5
LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


class Bands:
    """Sizes' bands and each band's number of parts and of allowed empty ones."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent
        self.first = [1]
        self.parts: list[int] = []
        self.empty: list[int] = []

    def upto(self, n: int) -> None:
        while self.first[-1] <= n:
            j = len(self.parts)
            top = self.first[j] * 100 // self.percent
            k = 2 * top * (100 - self.percent) // (100 + self.percent)
            least, e = self.first[max(0, j - 1)], 0
            for _ in range(8):  # parts and empty ones depend on each other
                parts = k + 1 + e
                mean = parts * (1 - 1 / parts) ** least if parts > 1 else 0.0
                e = math.ceil(mean + 3 * math.sqrt(mean)) if k else 0
            self.parts.append(k + 1 + e)
            self.empty.append(e)
            self.first.append(top + 1)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        self.upto(int(sizes.max(initial=1)) * 2)
        return np.searchsorted(np.array(self.first), sizes, "right") - 1


def shingle_sets(texts: list[str | None], hashes: WordHashes) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out = []
    for t in texts:
        words = t.translate(LOWER).encode("utf-8", "surrogatepass").split() if t else []
        if not words:
            out.append(np.empty(0, np.uint64))
            continue
        h = hashes.of(words)
        g = grams(h, min(SHINGLE, len(h)))
        if len(words) < SHINGLE:  # never equal to a shingle of another length
            g = mix64(g + np.uint64(len(words)))
        out.append(np.unique(g))
    return out


def digest(s: np.ndarray) -> int:
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).astype(np.int64))


def signatures(sets: list[np.ndarray], bands: Bands) -> tuple[np.ndarray, np.ndarray]:
    """(signature, index of the set) of all non-empty sets."""
    sizes = np.array([len(s) for s in sets])
    band = bands.of(sizes)
    sigs, owners = [], []
    for up in (0, 1):  # with its own band and below, with the next band
        todo = np.flatnonzero(sizes)
        for level in range(LEVELS):
            if not len(todo):
                break
            j = band[todo] + up
            parts = np.array(bands.parts)[j]
            allowed = np.array(bands.empty)[j]
            base = np.cumsum(parts) - parts
            own = np.repeat(np.arange(len(todo)), sizes[todo])
            x = mix64(np.concatenate([sets[i] for i in todo]) + np.uint64(1 + level))
            at = ((x >> np.uint64(32)) % parts[own].astype(np.uint64)).astype(np.int64) + base[own]
            total = int(parts.sum())
            acc = np.zeros(total, np.uint64)
            np.add.at(acc, at, mix64(x ^ np.uint64(0x5BD1E995)))
            empty = np.bincount(at, minlength=total) == 0
            of = np.repeat(np.arange(len(todo)), parts)
            part = np.arange(total) - base[of]
            tag = (j[of].astype(np.uint64) << np.uint64(40)) + (part.astype(np.uint64) << np.uint64(4)) + np.uint64(level)
            keep = ~empty if level < LEVELS - 1 else np.ones(total, bool)
            sigs.append(mix64(acc + mix64(tag))[keep])
            owners.append(todo[of[keep]])
            # too many empty parts: agreeing on empty ones alone can't be ruled out
            todo = todo[np.bincount(of[empty], minlength=len(todo)) > allowed]
    if not sigs:
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    return np.concatenate(sigs), np.concatenate(owners)


def doc_sets(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node): node is the digest of the set."""
    small_batches(docs.sparkSession)

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            n, d = [], []
            texts = strings(batch.column(1))
            for part in byte_chunks(texts):
                for s in shingle_sets(texts[part], hashes):
                    n.append(len(s))
                    d.append(digest(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(d, pa.int64())],
                                             ["doc_id", "n_shingles", "node"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n_shingles long, node long")


def shared_signatures(docs: DataFrame, percent: int, n_parts: int) -> DataFrame:
    """(sig, node, n) of the signatures that several nodes have. The high bits
    of a signature choose the task where it meets its equals, ``KEY_BYTES`` of
    the low ones travel, packed node by node: a batch sends each task its nodes,
    how many signatures each has there, and these. Near copies share many
    signatures; those of the same nodes are one, named by a digest of the nodes
    (equal digests of different ones only make a group larger). n: their number
    times that of the nodes."""
    def make(batches):
        hashes, bands = WordHashes(), Bands(percent)
        for batch in batches:
            texts = strings(batch.column(0))
            for part in byte_chunks(texts):
                sets = {digest(s): s for s in shingle_sets(texts[part], hashes) if len(s)}
                nodes = np.array(list(sets), np.int64)
                sig, own = signatures(list(sets.values()), bands)
                p = ((sig >> np.uint64(8 * KEY_BYTES)) % np.uint64(n_parts)).astype(np.uint16 if n_parts <= 1 << 16 else np.uint32)
                order = np.argsort(own.astype(np.uint16), kind="stable")  # a chunk has 4096 texts at most
                order = order[np.argsort(p[order], kind="stable")]
                sig, own, p = sig[order], own[order], p[order]
                packed = sig.view(np.uint8).reshape(-1, 8)[:, :KEY_BYTES]
                run = np.flatnonzero(np.r_[True, (p[1:] != p[:-1]) | (own[1:] != own[:-1])]) if len(p) else np.empty(0, np.int64)
                count = np.diff(np.r_[run, len(p)]).astype(np.uint32)
                edge = np.searchsorted(p, np.arange(n_parts + 1))
                run_edge = np.searchsorted(run, edge)
                ps, blobs, owners, counts = [], [], [], []
                for k in np.flatnonzero(np.diff(edge)):
                    at = slice(run_edge[k], run_edge[k + 1])
                    ps.append(int(k))
                    blobs.append(packed[edge[k]:edge[k + 1]].tobytes())
                    owners.append(nodes[own[run[at]]].tobytes())
                    counts.append(count[at].tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ps, pa.int32()), *(pa.array(x, pa.binary()) for x in (blobs, owners, counts))],
                    ["p", "sigs", "nodes", "counts"])

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        raw = np.frombuffer(b"".join(group["sigs"]), np.uint8).reshape(-1, KEY_BYTES)
        sig = np.zeros((len(raw), 8), np.uint8)
        sig[:, :KEY_BYTES] = raw
        sig = sig.view(np.uint64).ravel()
        node = np.repeat(np.frombuffer(b"".join(group["nodes"]), np.int64), np.frombuffer(b"".join(group["counts"]), np.uint32))
        order = np.argsort(sig)
        sig, node = sig[order], node[order]
        same = np.flatnonzero(sig[1:] == sig[:-1])
        keep = np.zeros(len(sig), bool)
        keep[same] = keep[same + 1] = True
        out = pd.DataFrame({"sig": sig[keep], "node": node[keep]}).drop_duplicates()
        out = out[out.groupby("sig")["node"].transform("size") > 1]
        sig, node = out["sig"].to_numpy(), out["node"].to_numpy()
        if not len(sig):
            return pd.DataFrame({"members": sig, "node": node, "n": node})
        # signatures that the same nodes have are one group
        start = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        size = np.diff(np.r_[start, len(sig)])
        members = mix64(np.add.reduceat(mix64(node.view(np.uint64)), start) + size.astype(np.uint64))
        _, first, times = np.unique(members, return_index=True, return_counts=True)
        of = np.repeat(np.arange(len(first)), size[first])
        rows = start[first][of] + np.arange(len(of)) - (np.cumsum(size[first]) - size[first])[of]
        return pd.DataFrame({"members": members[first][of].view(np.int64), "node": node[rows],
                             "n": (size[first] * times)[of]})

    packed = docs.select(F.col("text").cast("string")).mapInArrow(make, "p int, sigs binary, nodes binary, counts binary")
    groups = packed.groupBy("p").applyInPandas(meet, "members long, node long, n long")
    return groups.groupBy("members", "node").agg(F.sum("n").alias("n")).withColumnRenamed("members", "sig")


def sets_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, s, bits): shingle hashes of the documents in ``ids``, and their
    bit maps."""
    def bits(s: np.ndarray) -> bytes:
        return np.packbits((np.bincount((s % np.uint64(MAP_BITS)).astype(np.int64), minlength=MAP_BITS) & 1).astype(np.uint8)).tobytes()

    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            texts = strings(batch.column(1))
            for part in byte_chunks(texts):
                sets = shingle_sets(texts[part], hashes)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.start, part.stop - part.start),
                     pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array(map(bits, sets), pa.binary())],
                    ["doc_id", "s", "bits"])

    some = only_keys(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")), ids, "doc_id")
    return some.join(ids, "doc_id", "left_semi").dropDuplicates(["doc_id"]).mapInArrow(run, "doc_id long, s array<long>, bits binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that are linked."""
    pairs = checkpointed(pairs)
    # sets that are in no pair never reach a shuffle
    left = only_keys(sets.select(F.col("doc_id").alias("b"), F.col("s").alias("sb")), pairs, "b")
    right = only_keys(sets.select(F.col("doc_id").alias("a"), F.col("s").alias("sa")), pairs, "a")
    both = F.size(F.array_intersect("sa", "sb"))
    return (pairs.join(left, "b").join(right, "a")
            .filter(both * (100 + percent) >= percent * (F.size("sa") + F.size("sb"))).select("a", "b"))


def possible(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) that can be similar enough by their maps."""
    def look(batches):
        for x in batches:
            a, b = (np.frombuffer(b"".join(x[c]), np.uint64).reshape(len(x), MAP_BITS // 64) for c in ("bits_a", "bits_b"))
            apart = np.bitwise_count(a ^ b).sum(1, dtype=np.int64)
            yield x.loc[apart <= (x["n_a"] + x["n_b"]) * (100 - percent) // (100 + percent), ["a", "b"]]

    for c in "ba":
        pairs = pairs.join(maps.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("bits").alias(f"bits_{c}")), c)
    return pairs.mapInPandas(look, "a long, b long")


def first_partners(shared: DataFrame) -> DataFrame:
    """A pair (a, b) for each node: itself and the most shared node among those
    that stand first in one of its groups."""
    weight = shared.groupBy("id").agg(F.sum("n").alias("w"))
    rows = shared.select("sig", "id").join(weight, "id")
    first = rows.groupBy("sig").agg(F.max(F.struct("w", "id")).alias("first"))
    partner = (shared.select("sig", "id").join(first, "sig").filter(F.col("id") != F.col("first.id"))
               .groupBy("id").agg(F.max("first").alias("first")))
    return partner.select(F.col("first.id").alias("a"), F.col("id").alias("b"))


def open_pairs(rows: DataFrame, percent: int, best: bool) -> DataFrame:
    """Pairs (a, b) of rows (sig, id, comp, n, bits) that share a signature,
    belong to different components and can be similar enough by their maps.
    With ``best`` only the likeliest one of each row in a group."""
    def look(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["sig", "id"])
        sig, ids, comp, n = (group[c].to_numpy() for c in ("sig", "id", "comp", "n"))
        maps = np.frombuffer(b"".join(group["bits"]), np.uint64).reshape(len(group), MAP_BITS // 64)
        starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        out = []
        for at, end in zip(starts, np.r_[starts[1:], len(sig)]):
            for i in range(at, end, 128):
                mine = slice(i, min(i + 128, end))
                apart = np.bitwise_count(maps[mine, None, :] ^ maps[None, at:end, :]).sum(2, dtype=np.int64)
                most = (n[mine, None] + n[None, at:end]) * (100 - percent) // (100 + percent)
                fits = (comp[mine, None] != comp[None, at:end]) & (apart <= most)
                if best:
                    score = np.where(fits, apart, 1 << 30)
                    r = np.flatnonzero(fits.any(1))
                    c = score.argmin(1)[r]
                else:
                    r, c = np.nonzero(fits)
                out.append(np.stack([ids[mine][r], ids[at:end][c]], 1))
        pairs = np.sort(np.concatenate(out), 1)
        return pd.DataFrame(np.unique(pairs, axis=0), columns=["a", "b"])

    n_parts = max(partitions(rows.sparkSession), -(-rows.count() // OPEN_ROWS))
    bucket = F.pmod(F.xxhash64("sig"), F.lit(n_parts))
    return rows.withColumn("_p", bucket).groupBy("_p").applyInPandas(look, "a long, b long").distinct()


def join(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row; component_id is the
    smallest doc_id that links reach."""
    spark = docs.sparkSession
    base = checkpointed(doc_sets(docs))
    reps = base.filter("node IS NOT NULL AND doc_id IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("rep"))
    size = docs.agg(F.sum(F.octet_length(F.col("text").cast("string")))).first()[0] or 0
    n_parts = max(partitions(spark), -(-size // PART_BYTES))
    shared = shared_signatures(docs.filter(F.col("doc_id").isNotNull()), percent, n_parts)
    shared = checkpointed(shared.join(reps, "node").select("sig", F.col("rep").alias("id"), "n"))
    sets = checkpointed(sets_of(docs, shared.select(F.col("id").alias("doc_id")).distinct()))
    maps = sets.select(F.col("doc_id").alias("id"), F.size("s").cast("long").alias("n"), "bits")
    links = checkpointed(verified(possible(first_partners(shared), maps, percent), sets, percent))
    comps = checkpointed(components(links))
    for best in (True, False):
        now = shared.select("sig", "id").join(comps, F.col("id") == F.col("node"), "left").select(
            "sig", "id", F.coalesce("component", "id").alias("comp"))
        split = now.groupBy("sig").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("sig")
        rows = checkpointed(now.join(split, "sig", "left_semi").join(maps, "id"))
        found = checkpointed(verified(open_pairs(rows, percent, best), sets, percent))
        if found.head(1):
            links = links.unionByName(found)
            comps = checkpointed(components(links))
    out = base.join(reps, "node", "left")
    return (out.join(comps.select(F.col("node").alias("rep"), "component"), "rep", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id")))


def keep_one(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of near duplicates, the one with the
    smallest doc_id; rows with a null id stay. Of rows that share an id, the one
    with the least (hash, text) stays. Only texts whose id may be left out, or
    is shared, are shuffled."""
    rows, names = renamed(docs)
    key = F.col("doc_id").cast("long")
    rows = rows.withColumn("_id", key)
    linked = checkpointed(join(rows).filter("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.min("component_id").alias("component_id"), F.count(F.lit(1)).alias("n")))
    out = checkpointed(linked.filter("doc_id != component_id").select(F.col("doc_id").alias("_id")))
    many = linked.filter("doc_id = component_id AND n > 1").select(F.col("doc_id").alias("_id"))
    keyed = key_map(rows, out.unionByName(many), "_id")
    some = keyed.filter("_may").join(out, "_id", "left_anti").withColumn("_t", F.xxhash64("text"))
    first = some.withColumn("_n", F.row_number().over(Window.partitionBy("_id").orderBy("_t", "text")))
    kept = first.filter("_n = 1 OR _id IS NULL").select(*rows.columns).unionByName(keyed.filter("NOT _may").select(*rows.columns))
    return kept.drop("_id").toDF(*names)


ORACLE = r"""
WITH RECURSIVE norm AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + least(4, len(w)) - 1], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i FROM norm WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
x AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM x JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.n + nb.n - i)),
r AS (SELECT doc_id AS d, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON e.a = r.d)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, k.c AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT d AS doc_id, min(c) AS c FROM r GROUP BY 1) k USING (doc_id)
"""
