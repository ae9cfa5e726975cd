"""Exact ranked lexical search with sparse ball trees.

A document is a sparse vector over the query items' terms, an item another; the
score is their inner product, in 64-bit integers. Consecutive documents of a
task form shards of bounded size, each with a balanced ball tree: a node has
the centre of its documents and the radius around it, and no document below it
scores more than the centre's inner product plus radius times the item's
length, rounded up by more than the sums can be off. Nodes are taken best
first, and a subtree is left out when its bound is below the item's k-th best
score so far; leaves are scored exactly. A task carries its best scores from
shard to shard and returns k rows an item; the rows of all tasks are ranked.

Terms are the maximal runs of ASCII letters, digits and non-ASCII characters,
A-Z lower-cased. Items are taken in passes of about ``PASS_BYTES`` of text, whose
vocabulary every task gets; documents are read once a pass.

Null texts, and texts without terms, are no documents and find nothing. Every
row counts, also with equal ids; equal scores go by ascending doc_id, a null
one last. Extra columns are ignored, empty tables give no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_chunks, checkpointed, small_batches, strings

TOP = 20
#: Bytes of items' texts in one pass, about: they come to the driver.
PASS_BYTES = 4 << 20
#: Terms of the documents of a shard, documents of a leaf.
SHARD_TERMS, LEAF = 1 << 20, 128
#: (node, term) pairs up to which a level's centres are one dense array.
DENSE = 1 << 22
#: Separators become blanks, A-Z become a-z.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(FOLD).split() if text else []


def vectors(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """(doc_id, n, terms, tf): of every document with a term, the number of its
    terms and its counts of those of the vocabulary, as 32-bit integers."""
    def run(batches):
        find = vocabulary.get
        for batch in batches:
            ids, texts = batch.column(0), strings(batch.column(1))
            for part in byte_chunks(texts):
                at, sizes, which, counts = [], [], [], []
                for i, text in enumerate(texts[part], part.start):
                    words = terms(text)
                    if not words:
                        continue
                    found = np.fromiter(map(lambda w: find(w, -1), words), np.int64, len(words))
                    term, tf = np.unique(found[found >= 0], return_counts=True)
                    at.append(i)
                    sizes.append(len(words))
                    which.append(term.astype("<u4").tobytes())
                    counts.append(tf.astype("<u4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(at, pa.int64())), pa.array(sizes, pa.int64()), pa.array(which, pa.binary()), pa.array(counts, pa.binary())],
                    ["doc_id", "n", "terms", "tf"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, n long, terms binary, tf binary")


def document_frequencies(found: DataFrame, n_terms: int) -> np.ndarray:
    """Of each term; a task adds up its documents first."""
    def run(batches):
        total = np.zeros(n_terms, np.int64)
        for batch in batches:
            total += np.bincount(np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4"), minlength=n_terms)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for r in found.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]  # as many rows as the pass's vocabulary has terms
    return out


class Level:
    """Sums of values by (node, term) of one level of the tree."""

    def __init__(self, node, term, value, n_nodes: int, n_terms: int):
        self.n_terms, self.shape = n_terms, (n_nodes, n_terms)
        key = node * n_terms + term
        if n_nodes * n_terms <= DENSE:
            self.keys, self.sums = None, np.bincount(key, weights=value, minlength=n_nodes * n_terms)
        else:
            self.keys, inverse = np.unique(key, return_inverse=True)
            self.sums = np.bincount(inverse, weights=value)

    def at(self, node, term):
        key = node * self.n_terms + term
        if self.keys is None:
            return self.sums[key]
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[i] == key, self.sums[i], 0.0)

    def entries(self):
        i = np.flatnonzero(self.sums)
        key = i if self.keys is None else self.keys[i]
        return key // self.n_terms, key % self.n_terms, self.sums[i]


class BallTree:
    """Documents of one shard: ``sizes`` terms each, one document's after the
    other's, with values ``x``. Every document has a term."""

    def __init__(self, sizes: np.ndarray, term: np.ndarray, x: np.ndarray, n_terms: int, leaf: int = LEAF):
        n = len(sizes)
        self.depth = max(0, int(math.log2(max(1, n / leaf))))
        order = np.arange(n)
        local, term_of = np.unique(term, return_inverse=True)
        y = x.astype(np.float64)
        radius, postings = [], []
        starts = np.cumsum(sizes) - sizes
        square = np.add.reduceat(y * y, starts)
        for level in range(self.depth + 1):
            k = 1 << level
            bound = np.arange(k + 1) * n >> level
            node = np.repeat(np.arange(k), np.diff(bound))  # by document
            count = np.diff(bound)
            owner = np.repeat(node, sizes)
            sums = Level(owner, term_of, y, k, len(local))
            sums.sums /= count[(np.arange(len(sums.sums)) if sums.keys is None else sums.keys) // len(local)]
            entry = sums.entries()
            length = np.bincount(entry[0], weights=entry[2] ** 2, minlength=k)
            dots = np.add.reduceat(sums.at(owner, term_of) * y, starts)
            # the difference of squares is off by less than what is added
            away = np.maximum(square - 2 * dots + length[node], 0) + 1e-11 * (square + length[node])
            radius.append(np.sqrt(np.maximum.reduceat(away, bound[:-1])))
            postings.append((entry[0] + k - 1, local[entry[1]], entry[2]))
            if level == self.depth:
                break
            a = self.farthest(away, bound, node)
            to_a = self.dots(a, starts, sizes, owner, term_of, y, k, len(local))
            b = self.farthest(square + square[a][node] - 2 * to_a, bound, node)
            to_b = self.dots(b, starts, sizes, owner, term_of, y, k, len(local))
            turn = np.lexsort((to_a - to_b, node))
            order, square = order[turn], square[turn]
            moved = np.repeat(starts[turn], sizes[turn])
            sizes = sizes[turn]
            starts = np.cumsum(sizes) - sizes
            moved += np.arange(len(term_of)) - np.repeat(starts, sizes)
            term_of, y, x = term_of[moved], y[moved], x[moved]
        self.n, self.order = n, order
        self.bound = np.arange((1 << self.depth) + 1) * n >> self.depth
        self.radius = np.concatenate(radius)
        nodes, at, value = (np.concatenate(c) for c in zip(*postings))
        by = np.lexsort((nodes, at))
        self.node, self.centre = nodes[by], value[by]
        self.centre_at = np.searchsorted(at[by], np.arange(n_terms + 1))
        key = local[term_of] * n + np.repeat(np.arange(n), sizes)
        by = np.argsort(key, kind="stable")
        self.key, self.x = key[by], x[by]

    @staticmethod
    def farthest(distance, bound, node):
        """A document of each node with the largest distance."""
        hit = np.flatnonzero(distance >= np.maximum.reduceat(distance, bound[:-1])[node])
        return hit[np.searchsorted(node[hit], np.arange(len(bound) - 1))]

    @staticmethod
    def dots(pivot, starts, sizes, owner, term_of, y, k, n_terms):
        """Inner products of all documents with their node's pivot."""
        own = np.concatenate([np.arange(starts[p], starts[p] + sizes[p]) for p in pivot])
        row = Level(np.repeat(np.arange(k), sizes[pivot]), term_of[own], y[own], k, n_terms)
        return np.add.reduceat(row.at(owner, term_of) * y, starts)

    def bounds(self, term: np.ndarray, q: np.ndarray) -> np.ndarray:
        """What no document of a node scores more than."""
        out = np.zeros(len(self.radius))
        for t, w in zip(term, q):
            a, b = self.centre_at[t], self.centre_at[t + 1]
            out[self.node[a:b]] += w * self.centre[a:b]
        out += math.sqrt(float((q.astype(float) ** 2).sum())) * self.radius
        return np.floor(out * (1 + 1e-9)) + 1

    def scores(self, leaf: int, term: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Exact scores of a leaf's documents."""
        lo, hi = self.bound[leaf], self.bound[leaf + 1]
        a, b = np.searchsorted(self.key, term * self.n + lo), np.searchsorted(self.key, term * self.n + hi)
        size = b - a
        i = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        out = np.zeros(hi - lo, np.int64)
        np.add.at(out, self.key[i] - np.repeat(term * self.n + lo, size), np.repeat(q, size) * self.x[i])
        return out


class Best:
    """The k best (score, id) of an item so far."""

    def __init__(self, k: int):
        self.k, self.score, self.id, self.null, self.least = k, np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool), 1

    def add(self, score, ids, null):
        some = score >= self.least
        if not some.any():
            return
        score, ids, null = (np.r_[x, y[some]] for x, y in ((self.score, score), (self.id, ids), (self.null, null)))
        order = np.lexsort((ids, null, -score))[:self.k]
        self.score, self.id, self.null = score[order], ids[order], null[order]
        if len(order) == self.k:
            self.least = int(self.score[-1])


def look(tree: BallTree, ids, null, item, best: Best) -> int:
    """Best-first search of one item; returns the leaves it scored."""
    bounds, heap, seen = tree.bounds(*item), [], 0
    first_leaf = (1 << tree.depth) - 1
    heappush(heap, (-bounds[0], 0))
    while heap:
        bound, node = heappop(heap)
        if -bound < best.least:
            break
        if node >= first_leaf:
            lo, hi = tree.bound[node - first_leaf], tree.bound[node - first_leaf + 1]
            best.add(tree.scores(node - first_leaf, *item), ids[lo:hi], null[lo:hi])
            seen += 1
            continue
        for child in (2 * node + 1, 2 * node + 2):
            if bounds[child] >= best.least:
                heappush(heap, (-min(bounds[child], -bound), child))
    return seen


def values(n: np.ndarray, sizes: np.ndarray, tf: np.ndarray, n_docs: int, all_terms: int) -> np.ndarray:
    m = 100 - 25 + (25 * n * n_docs) // all_terms
    return (1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, sizes))


def ranked(docs: DataFrame, items: list, k: int) -> DataFrame:
    """(item, doc_id, score): best rows of every task for ``items``, a list of
    lists of terms; ``item`` is the place in it."""
    vocabulary: dict[bytes, int] = {}
    for words in items:
        for w in words:
            vocabulary.setdefault(w, len(vocabulary))
    found = checkpointed(vectors(docs, vocabulary))
    n_docs, all_terms = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = document_frequencies(found, len(vocabulary))
    weight = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(d) + 1))) for d in df]
    asked = []
    for words in items:
        counts = Counter(vocabulary[w] for w in words)
        term = np.array(sorted(t for t in counts if df[t]), np.int64)
        asked.append((term, np.array([counts[t] * weight[t] for t in term], np.int64)))
    n_terms = len(vocabulary)

    def run(batches):
        best = [Best(k) for _ in asked]

        def shard(rows):
            ids, n, which, tf = (sum((r[i] for r in rows), []) for i in range(4))
            sizes = np.array([len(w) // 4 for w in which], np.int64)
            term, tf = (np.frombuffer(b"".join(x), "<u4").astype(np.int64) for x in (which, tf))
            tree = BallTree(sizes, term, values(np.array(n, np.int64), sizes, tf, n_docs, all_terms), n_terms)
            null = np.array([i is None for i in ids])[tree.order]
            ids = np.array([i or 0 for i in ids], np.int64)[tree.order]
            for item, b in zip(asked, best):
                if len(item[0]):
                    look(tree, ids, null, item, b)

        rows, held = [], 0
        for batch in batches:
            columns = [c.to_pylist() for c in batch.filter(pa.compute.greater(pa.compute.binary_length(batch.column(2)), 0)).columns]
            at = 0
            for i, w in enumerate(columns[2]):
                held += len(w) // 4
                if held >= SHARD_TERMS:
                    shard([*rows, [c[at:i + 1] for c in columns]])
                    rows, held, at = [], 0, i + 1
            rows.append([c[at:] for c in columns])
        if held:
            shard(rows)
        for i, b in enumerate(best):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(b.score), i, np.int32)), pa.array(b.id, mask=b.null), pa.array(b.score)], ["item", "doc_id", "score"])

    return found.mapInArrow(run, "item int, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = TOP) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item."""
    spark = docs.sparkSession
    small_batches(spark)
    asked = items.select("item_id", F.col("text").cast("string").alias("text")).filter(F.octet_length("text") > 0)
    passes = max(1, -(-(asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // PASS_BYTES))
    out = None
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    for p in range(passes):
        rows = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p).collect()
        best = ranked(docs, [terms(r["text"]) for r in rows], k)
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], spark.createDataFrame(
            [], "item int").join(items.select("item_id")).schema)
        one = (best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
               .join(names, "item").select("item_id", "rank", "doc_id", "score"))
        out = one if out is None else out.unionByName(one)
    return out


ORACLE = r"""
WITH words AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
docs AS (SELECT d, doc_id, len(w)::BIGINT AS n FROM words WHERE len(w) > 0),
size AS (SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS all_terms FROM docs),
counts AS (SELECT d, term, count(*)::BIGINT AS tf FROM (SELECT d, unnest(w) AS term FROM words) GROUP BY ALL),
items AS (SELECT row_number() OVER () AS i, item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark WHERE text IS NOT NULL),
asked AS (SELECT i, item_id, term, count(*)::BIGINT AS times FROM items GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
    FROM counts, size WHERE term IN (SELECT term FROM asked) GROUP BY term, n_docs),
scored AS (SELECT i, item_id, c.d, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // all_terms))))::BIGINT AS score
    FROM asked JOIN weights USING (term) JOIN counts c USING (term) JOIN docs USING (d), size GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM best WHERE rank <= 20
"""
