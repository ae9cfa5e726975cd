"""Removal of word passages that a document with a smaller id has, too.

Every window of 50 words that also starts in a document with a smaller id is
covered. Segments of texts that may hold such windows are gathered in shards
(``window_routing``). A shard's segments are indexed by a compressed FM-index:
the Burrows-Wheeler transform of their words in a wavelet matrix of packed bits
with sampled popcounts. The segments are then streamed against it, many at a
time: backward search prepends word after word, and where the match fails it
goes to the parent interval, which gives the matching statistics; a window
whose statistic reaches the threshold has an interval of suffixes, and the
least document id in it decides.

Windows are judged on the input. A text that is null has no words. A null id is
neither compared nor cut. Rows that repeat an id count as one document when
windows are compared; a repeated row gets the same result each time. Of rows that
share an id with different texts, one is looked at. Extra columns stay.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes
from .window_routing import Units, covered_texts, placed, repeated_runs

WINDOW = 50
WORDS = Units(size=WINDOW, k=8, words=True, within=False, shard=1 << 20)


def suffixes(ranks: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array by doubling, exact up to ``depth`` values."""
    n, have = len(ranks), 1
    rank = np.unique(ranks, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    while have < depth:
        key = rank * (n + 1)
        key[:n - have] += rank[have:] + 1
        order = np.argsort(key, kind="stable")
        new = np.r_[0, (np.diff(key[order]) != 0).cumsum()]
        rank = np.empty(n, np.int64)
        rank[order] = new
        have *= 2
        if new[-1] == n - 1:
            break
    return order


def common_prefixes(text: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it, up to ``most``."""
    padded = np.concatenate([text, -1 - np.arange(most)])
    out = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for d in range(most):
        live = live[padded[order[live] + d] == padded[order[live - 1] + d]]
        if not len(live):
            break
        out[live] += 1
    return out


class Wavelet:
    """Wavelet matrix: for each bit of the symbols a packed bit vector, stably
    partitioned by the bits above, with the ones before every 64 bits."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.n = bits, len(symbols)
        self.words, self.before, self.zeros = [], [], []
        for level in reversed(range(bits)):
            bit = (symbols >> level) & 1
            packed = np.packbits(np.pad(bit, (0, -len(bit) % 64 + 64)).astype(np.uint8), bitorder="little").view(np.uint64)
            self.words.append(packed)
            self.before.append(np.concatenate([[0], np.cumsum(np.bitwise_count(packed), dtype=np.int64)]))
            self.zeros.append(int(self.n - bit.sum()))
            symbols = np.concatenate([symbols[bit == 0], symbols[bit == 1]])

    def ones(self, level: int, i: np.ndarray) -> np.ndarray:
        w = i >> 6
        mask = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][w] + np.bitwise_count(self.words[level][w] & mask)

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often symbol ``c`` occurs before place ``i``."""
        start = np.zeros_like(i)
        for level in range(self.bits):
            one = (c >> (self.bits - 1 - level)) & 1
            a, b = self.ones(level, start), self.ones(level, i)
            start = np.where(one, self.zeros[level] + a, start - a)
            i = np.where(one, self.zeros[level] + b, i - b)
        return i - start


class FmIndex:
    """Index of word sequences: symbols from 1 on, 0 ends a sequence."""

    def __init__(self, text: np.ndarray, most: int):
        n, ends = len(text), text == 0
        unique = text + int(ends.sum())  # every end is another symbol, less than all words
        unique[ends] = np.arange(int(ends.sum()))
        longest = int(np.diff(np.flatnonzero(np.r_[True, ends])).max(initial=1)) + 1
        self.order = suffixes(unique, longest)
        self.lcp = common_prefixes(unique, self.order, most)
        bits = max(1, int(text.max(initial=1)).bit_length())
        self.wavelet = Wavelet(text[self.order - 1], bits)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=1 << bits))])
        self.lower, self.upper = self.edges(most)

    def edges(self, most: int) -> tuple[np.ndarray, np.ndarray]:
        """For each place, the nearest ones to the left and to the right with a
        smaller common prefix: the bounds of parent intervals."""
        n = len(self.lcp)
        lcp = np.append(self.lcp, 0)
        left, right = np.zeros(n + 1, np.int64), np.full(n + 1, n, np.int64)
        places = np.arange(n + 1)
        for t in range(1, most + 1):
            mine = np.flatnonzero(lcp == t)
            if len(mine):
                small = places[lcp < t]
                left[mine] = small[np.searchsorted(small, mine) - 1]
                right[mine] = small[np.searchsorted(small, mine)]
        return left, right

    def match(self, queries: np.ndarray, ends: np.ndarray, lens: np.ndarray, most: int):
        """Streams queries (ending at ``ends`` in the array) from their last word
        to the first. Yields (queries, place in them, lower bound, match length)
        after each word."""
        lo, hi = np.zeros(len(ends), np.int64), np.full(len(ends), len(self.order), np.int64)
        size = np.zeros(len(ends), np.int64)
        lcp = np.append(self.lcp, 0)
        for step in range(int(lens.max(initial=0))):
            live = np.flatnonzero(lens > step)
            todo = live
            while len(todo):
                c = queries[ends[todo] - 1 - step]
                a = self.first[c] + self.wavelet.rank(c, lo[todo])
                b = self.first[c] + self.wavelet.rank(c, hi[todo])
                ok = a < b
                hit, miss = todo[ok], todo[~ok]
                lo[hit], hi[hit] = a[ok], b[ok]
                size[hit] += 1
                stuck = miss[size[miss] == 0]
                todo = miss[size[miss] > 0]
                lo[stuck], hi[stuck] = 0, len(self.order)
                low, high = lcp[lo[todo]], lcp[hi[todo]]
                size[todo] = np.minimum(size[todo], np.maximum(low, high))
                at = np.where(low >= high, lo[todo], hi[todo])
                empty = np.maximum(low, high) == 0
                lo[todo], hi[todo] = np.where(empty, 0, self.lower[at]), np.where(empty, len(self.order), self.upper[at])
            # a match needn't be known beyond the threshold; where a longer one fails,
            # its parent is the interval of all suffixes that share the window
            over = live[size[live] > most]
            size[over] = most
            yield live, lens[live] - 1 - step, lo[live], size[live]


def earlier_windows(segments: list[list[bytes]], doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Flags of the segments' windows that a segment of a smaller document has."""
    hashes = WordHashes(1 << 20)
    values = np.concatenate([hashes.of(s) for s in segments])
    symbols = np.unique(values, return_inverse=True)[1].astype(np.int64) + 1
    lens = np.array([len(s) for s in segments])
    text = np.insert(symbols, np.cumsum(lens), 0)
    ends = np.cumsum(lens + 1) - 1
    index = FmIndex(text, WINDOW)
    owner = np.repeat(doc, lens + 1)[index.order]
    group = np.cumsum(index.lcp < WINDOW) - 1  # suffixes that share a window
    least = np.minimum.reduceat(owner, np.flatnonzero(index.lcp < WINDOW))
    flags, base = np.zeros(int(n.sum()), bool), np.cumsum(n) - n
    for q, at, lo, size in index.match(text, ends, lens, WINDOW):
        full = (size >= WINDOW) & (at < n[q])
        q, at, lo = q[full], at[full], lo[full]
        flags[base[q] + at] = least[group[lo]] < doc[q]
    return flags


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, start, n): runs of n windows from word ``start`` on that start
    in a document with a smaller id, too."""
    return repeated_runs(placed(docs.withColumn("doc_id", F.col("doc_id").cast("long"))), WORDS, earlier_windows)


def digest(text, words, covered):
    kept = words if covered is None else [w for w, c in zip(words, covered.tolist()) if not c]
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def digests(docs: DataFrame) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_sha256."""
    return covered_texts(docs, WORDS, earlier_windows, digest, "n_words long, n_removed long, kept_sha256 string")


def cut(text, words, covered):
    if covered is None or text is None:
        return (text,)
    return (b" ".join([w for w, c in zip(words, covered.tolist()) if not c]).decode("utf-8", "surrogatepass"),)


def remove(docs: DataFrame) -> DataFrame:
    """``docs`` with the covered words cut out; a text that loses words is its
    other words joined by one space, any other stays as it is."""
    names = docs.columns
    out = covered_texts(docs, WORDS, earlier_windows, cut, "kept string").toDF(*[f"_c{i}" for i in range(len(names) + 1)])
    return out.select(*[F.col(f"_c{len(names) if c == 'text' else i}").alias(c) for i, c in enumerate(names)])


ORACLE = r"""
WITH d AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)),
f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM g JOIN f USING (g) WHERE doc_id > first),
k AS (SELECT x.doc_id, string_agg(x.word, ' ' ORDER BY x.p) AS kept, count(*) AS n
      FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d) x
      ANTI JOIN c ON c.doc_id = x.doc_id AND c.p = x.p GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)
"""
