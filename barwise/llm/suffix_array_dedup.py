"""Removal of 100-byte strings that start earlier, by a suffix array with common
prefixes, built by external induced sorting.

Segments that may hold such strings are gathered in shards (``window_routing``).
Of a shard's text, runs of strings whose hash occurs again are kept, each content
once; equal strings have equal hashes, so none that is repeated is left out.
They are sorted as follows. Suffixes that begin a local minimum are
sorted by the names of the substrings between them; all others are induced from
them, first those larger than their right neighbour, upwards, then the others,
downwards. Queues keyed by first character carry the induced suffixes, as tuples
of a place and its common prefix with the tuple before it, which follows from
the least common prefix between the two suffixes that induced them. A queue
keeps its tuples in arrival order, which is their sorted order, and the queues
move to a temporary file once they exceed a bound, so a shard's tuples need not
fit in memory. Runs of suffixes with common prefixes of 100 bytes are equal
strings; all but the earliest of each run are repeated.

Order is by doc_id, then by start; strings are judged on the input. A null text
has no bytes. A null id is neither compared nor cut. Rows that repeat an id are
one document; a repeated row gets the same result each time. Extra columns stay.
"""

from __future__ import annotations

import hashlib
import tempfile

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import grams
from .window_routing import CHUNK, Units, covered_texts, placed, repeated_runs

LENGTH = 100
BYTES = Units(size=LENGTH, k=32, words=False, within=True, shard=4 << 20)
#: Bytes of tuples that the queues of a shard keep in memory.
QUEUE_BYTES = 64 << 20
TUPLE = np.dtype([("at", "<i4"), ("lcp", "u1")])


class Queues:
    """First-in first-out queues of tuples, one for each character, that share
    a bound of memory; beyond it they are written to a file without a name."""

    def __init__(self, bound: int = QUEUE_BYTES):
        self.bound, self.held, self.file = bound, 0, None
        self.parts: dict[int, list] = {}

    def push(self, char: int, tuples: np.ndarray) -> None:
        self.parts.setdefault(char, []).append(tuples)
        self.held += tuples.nbytes
        if self.held > self.bound:
            self.spill()

    def spill(self) -> None:
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.parts.values():
            for i, part in enumerate(parts):
                if isinstance(part, np.ndarray):
                    parts[i] = (self.file.tell(), len(part))
                    self.file.write(part.tobytes())
        self.held = 0

    def pop(self, char: int):
        """The next part of a queue, or None."""
        parts = self.parts.get(char)
        if not parts:
            return None
        part = parts.pop(0)
        if isinstance(part, tuple):
            self.file.seek(part[0])
            return np.frombuffer(self.file.read(part[1] * TUPLE.itemsize), TUPLE)
        self.held -= part.nbytes
        return part

    def close(self) -> None:
        if self.file:
            self.file.close()


def prefixes(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: int) -> np.ndarray:
    """Common prefixes of suffix pairs, up to ``most``; text is padded by that."""
    out = np.zeros(len(a), np.int64)
    live = np.arange(len(a))
    for d in range(most):
        live = live[(text[a[live] + d] == text[b[live] + d]) & (np.maximum(a[live], b[live]) + d < len(text) - most)]
        if not len(live):
            break
        out[live] += 1
    return out


def minima_order(text: np.ndarray, smaller: np.ndarray, places: np.ndarray, most: int) -> np.ndarray:
    """``places`` (of local minima) in the order of their suffixes, exact up to
    ``most`` bytes: names of the substrings between minima, then doubling."""
    ends = np.append(places[1:], len(text) - 1)
    lens = ends - places + 1
    symbol = (text.astype(np.uint64) << np.uint64(1)) | smaller.astype(np.uint64)
    symbol = np.append(symbol, np.zeros(7, np.uint64))

    def word(which: np.ndarray, k: int) -> np.ndarray:
        out = np.zeros(len(which), np.uint64)
        for i in range(7 * k, 7 * k + 7):
            inside = lens[which] > i
            out = (out << np.uint64(9)) | np.where(inside, symbol[np.minimum(places[which] + i, len(symbol) - 1)], np.uint64(0))
        return out

    name, which, k = np.zeros(len(places), np.int64), np.arange(len(places)), 0
    while len(which):  # a name counts the smaller ones; no substring is a prefix of another
        w = word(which, k)
        order = np.lexsort((w, name[which]))
        old, w = name[which][order], w[order]
        group = np.r_[True, old[1:] != old[:-1]]
        new = group | np.r_[True, w[1:] != w[:-1]]
        index = np.arange(len(w))
        name[which[order]] = old + index[new][np.cumsum(new) - 1] - index[group][np.cumsum(group) - 1]
        k += 1
        which = which[lens[which] > 7 * k]
    have, n = 1, len(name)
    order = np.argsort(name, kind="stable")
    while 2 * have < most + 2:  # every name spans two bytes at least
        rank = np.unique(name, return_inverse=True)[1].astype(np.int64)
        if int(rank.max(initial=0)) == n - 1:
            break
        key = rank * (n + 1)
        key[:max(0, n - have)] += rank[have:] + 1
        order = np.argsort(key, kind="stable")
        name = np.empty(n, np.int64)
        name[order] = np.r_[0, (np.diff(key[order]) != 0).cumsum()]
        have *= 2
    return places[order]


def induced(text: np.ndarray, most: int, bound: int = QUEUE_BYTES) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and common prefixes (with the suffix before, up to
    ``most``) of bytes that end in the least one, exact up to ``most`` bytes."""
    n = len(text)
    step = np.sign(text[1:].astype(np.int16) - text[:-1])
    turn = np.append(step, 1)  # the last suffix counts as smaller than what follows it
    last = np.minimum.accumulate(np.where(turn != 0, np.arange(n), n)[::-1])[::-1]
    smaller = turn[last] > 0  # than its right neighbour
    minima = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    padded = np.concatenate([text, np.zeros(most, np.uint8)])
    if not len(minima):  # one falling run
        order = np.arange(n)[::-1]
        return order, np.concatenate([[0], prefixes(padded, order[:-1], order[1:], most)])
    ranked = minima_order(text, smaller, minima, most)
    chars = np.unique(text)
    seam = lambda a, b: int(prefixes(padded, np.array([a]), np.array([b]), most)[0])
    lcp = np.concatenate([[0], prefixes(padded, ranked[:-1], ranked[1:], most)]).astype(np.uint8)
    edge = np.searchsorted(text[ranked], np.arange(257))

    def induce(queues: Queues, at: np.ndarray, lcp: np.ndarray, since: np.ndarray, want: bool) -> None:
        """Pushes what suffixes ``at`` induce; ``since`` has, for each char, the
        least common prefix since its queue's last tuple."""
        before = at - 1
        ok = np.flatnonzero(before >= 0)
        ok = ok[smaller[before[ok]] == want]
        if len(ok):
            c = text[before[ok]]
            order = np.argsort(c, kind="stable")
            src, c = ok[order], c[order]
            new = np.r_[True, c[1:] != c[:-1]]
            begin = np.where(new, 0, np.r_[0, src[:-1] + 1])
            least = np.minimum.reduceat(np.append(lcp, 255), np.stack([begin, src + 1], 1).ravel())[::2]
            least = np.where(new, np.minimum(least, since[c]), least)
            tuples = np.empty(len(src), TUPLE)
            tuples["at"], tuples["lcp"] = at[src] - 1, np.minimum(least.astype(np.int64) + 1, most)
            firsts = np.flatnonzero(new)
            for i, j in zip(firsts, np.r_[firsts[1:], len(src)]):
                queues.push(int(c[i]), tuples[i:j])
            # since each char's last tuple, over the rest of this part
            rest = np.minimum.accumulate(np.append(lcp, 255)[::-1])[::-1]
            others = np.ones(256, bool)
            others[c] = False
            since[others] = np.minimum(since[others], lcp.min())
            ends = np.r_[firsts[1:], len(src)] - 1
            since[c[ends]] = rest[src[ends] + 1]
        elif len(lcp):
            np.minimum(since, lcp.min(), out=since)

    larger: dict[int, list] = {}
    queues, sofar = Queues(bound), np.zeros(256, np.uint8)
    # the suffix before the whole text's end isn't induced by any other
    for c in chars.tolist():
        sofar[:] = 0
        out, tail = [], None
        while (part := queues.pop(c)) is not None:
            out.append(part)
            tail = int(part["at"][-1])
            induce(queues, part["at"].astype(np.int64), part["lcp"], sofar, False)
        larger[c] = out
        mine = slice(edge[c], edge[c + 1])
        at, own = ranked[mine], lcp[mine].copy()
        if len(at):
            own[0] = 0 if tail is None else seam(tail, at[0])
            induce(queues, at, own, sofar, False)
    queues.close()
    queues, order, common = Queues(bound), [], []
    for c in reversed(chars.tolist()):
        sofar[:] = 0
        down = []
        while (part := queues.pop(c)) is not None:
            down.append(part)
            induce(queues, part["at"].astype(np.int64), part["lcp"], sofar, True)
        if c == int(text[-1]):
            end = np.array([(n - 1, 0)], TUPLE)  # the least suffix of all of its kind
            if down:
                end["lcp"] = seam(int(down[-1]["at"][-1]), n - 1)
            induce(queues, end["at"].astype(np.int64), end["lcp"], sofar, True)
            down.append(end)
        up = np.concatenate(larger[c]) if larger[c] else np.empty(0, TUPLE)
        fall = np.concatenate(down) if down else np.empty(0, TUPLE)
        join = seam(int(fall["at"][-1]), int(up["at"][-1])) if len(fall) and len(up) else 0
        if len(up):  # downwards, a common prefix is with the suffix after it
            induce(queues, up["at"][::-1].astype(np.int64), np.r_[np.uint8(join), up["lcp"][1:][::-1]].astype(np.uint8), sofar, True)
        rise = np.r_[np.uint8(join), fall["lcp"][1:][::-1]].astype(np.uint8) if len(fall) else fall["lcp"]
        order.append(np.concatenate([up["at"], fall["at"][::-1]]))
        both = np.concatenate([up["lcp"], rise])
        both[:1] = 0
        common.append(both)
    queues.close()
    return np.concatenate(order[::-1]).astype(np.int64), np.concatenate(common[::-1]).astype(np.int64)


def string_hashes(segments: list[bytes], n: np.ndarray) -> np.ndarray:
    """Hashes of the segments' windows, some segments at a time."""
    out, at = [], 0
    ends = np.cumsum(n + LENGTH - 1)
    while at < len(segments):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + CHUNK, "right")))
        m = n[at:end]
        base = np.cumsum(m + LENGTH - 1) - (m + LENGTH - 1) - (np.cumsum(m) - m)
        text = np.frombuffer(b"".join(segments[at:end]), np.uint8).astype(np.uint64)
        out.append(grams(text, LENGTH)[np.repeat(base, m) + np.arange(int(m.sum()))])
        at = end
    return np.concatenate(out)


def earlier_strings(segments: list[bytes], doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Flags of the segments' windows that start earlier, too. Segments come in
    the order of (doc, start). Runs of windows whose hash occurs again are
    sorted, those of equal content as one, the first."""
    hashes = string_hashes(segments, n)
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    again = np.zeros(len(hashes), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    flags = np.zeros(len(hashes), bool)
    windows = np.flatnonzero(again)
    if not len(windows):
        return flags
    owner = np.repeat(np.arange(len(n)), n)[windows]
    at = windows - (np.cumsum(n) - n)[owner]
    first = np.flatnonzero(np.r_[True, (windows[1:] != windows[:-1] + 1) | (owner[1:] != owner[:-1])])
    m, owner, at = np.diff(np.r_[first, len(windows)]), owner[first], at[first]
    kinds: dict[bytes, int] = {}
    parts = [segments[i][a:a + k + LENGTH - 1] for i, a, k in zip(owner.tolist(), at.tolist(), m.tolist())]
    of = np.array([kinds.setdefault(x, len(kinds)) for x in parts])
    _, one = np.unique(of, return_index=True)  # of each content the first run, in order
    whose, place = doc[owner], start[owner] + at
    earlier = sorted_strings([parts[i] for i in one.tolist()], whose[one], place[one], m[one])
    later = (whose > whose[one][of]) | ((whose == whose[one][of]) & (place > place[one][of]))
    ends = np.cumsum(m[one])
    within = np.arange(len(windows)) - np.repeat(first, m)
    flags[windows] = earlier[np.repeat((ends - m[one])[of], m) + within] | np.repeat(later, m)
    return flags


def sorted_strings(segments: list[bytes], doc: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Flags of the segments' windows that start earlier, too, by a suffix array.
    Segments come in the order of (doc, start); a byte 0, made unlike any in the
    text by raising the others where it occurs, ends each."""
    lens = np.array([len(s) for s in segments])
    text = np.frombuffer(b"\0".join(segments) + b"\0", np.uint8)
    ends = np.cumsum(lens + 1) - 1
    if np.count_nonzero(text == 0) > len(ends):  # a text has byte 0: UTF-8 has no 0xFF to need its place
        text = text + 1
        text[ends] = 0
    order, lcp = induced(text, LENGTH)
    inside = np.zeros(len(text), bool)
    base = ends - lens
    windows = np.repeat(base - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    inside[windows] = True
    key = np.zeros(len(text), np.int64)
    place = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    owner = np.repeat(np.unique(doc, return_inverse=True)[1], n)
    key[windows] = (owner.astype(np.int64) << 40) | place
    group = np.cumsum(lcp < LENGTH) - 1
    mine = inside[order]
    order, group = order[mine], group[mine]
    new = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    least = np.minimum.reduceat(key[order], new)
    flags = np.zeros(len(text), bool)
    flags[order] = key[order] > np.repeat(least, np.diff(np.r_[new, len(order)]))
    return flags[windows]


def repeated(docs: DataFrame) -> DataFrame:
    """(doc_id, start, n): runs of n strings from byte ``start`` on that start
    earlier, too."""
    return repeated_runs(placed(docs.withColumn("doc_id", F.col("doc_id").cast("long"))), BYTES, earlier_strings)


def digest(text, raw, covered):
    if covered is None:
        return len(raw), 0, 0, hashlib.sha256(raw).hexdigest()
    kept = np.frombuffer(raw, np.uint8)[~covered].tobytes()
    spans = int(covered[0]) + int(np.count_nonzero(covered[1:] & ~covered[:-1]))
    return len(raw), len(raw) - len(kept), spans, hashlib.sha256(kept).hexdigest()


def digests(docs: DataFrame) -> DataFrame:
    """``docs`` with n_bytes, n_removed, n_spans and kept_sha256."""
    return covered_texts(docs, BYTES, earlier_strings, digest, "n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cut(text, raw, covered):
    if covered is None:
        return (raw if text is not None else None,)
    return (np.frombuffer(raw, np.uint8)[~covered].tobytes(),)


def remove(docs: DataFrame) -> DataFrame:
    """``docs`` with ``kept``, the bytes that stay (binary: a cut may split a
    character)."""
    return covered_texts(docs, BYTES, earlier_strings, cut, "kept binary")
