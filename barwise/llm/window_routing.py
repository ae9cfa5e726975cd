"""Sends equal windows of texts to the same task, without sending every window.

A text is a sequence of units (words or bytes). In each window of ``size`` units
the run of ``k`` units with the least hash is its anchor; consecutive windows
with the same anchor are a segment. Equal windows have equal anchors, so two
equal windows always lie in segments with the same anchor hash, and only the
segments are shuffled, packed, about one for every size / 2 units.

Where an anchor hash meets, segments of equal content are one: all but the
first are copies, every window of theirs is repeated; where only other documents
count, those in the first one's own document get its windows' flags. A window
holds half of the units beside its anchor on one side of it: segments with a
window in common agree in the anchor with so many units to its left or to its
right. Firsts of different content that do need a look at their text (an index or
a suffix sort, in shards by anchor); only those are fetched. The very many different segments of a frequent
anchor are first cut to the runs of windows whose hash occurs again, and meet
once more as such. If they are still as many, they are dealt to ``SPLIT`` shards
by the hash of each window, so that no shard has to hold all of a frequent
passage's surroundings.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import WordHashes, checkpointed, grams, key_map, mix64, only_keys, partitions, renamed, small_batches, strings

#: Most units looked at together: an anchor's place takes 20 bits.
CHUNK = 1 << 19
#: Different segments of one anchor from which on they are split, and into how
#: many shards.
HOT, SPLIT = 20_000, 64
#: Text bytes whose segments meet in one task, about.
PART_BYTES = 16 << 20
BASE = 0x9E3779B97F4A7C15
PACKED = np.dtype([("h", "<u8"), ("sig", "<u8"), ("doc", "<u2"), ("start", "<u4"), ("n", "u1"),
                   ("left", "<u4"), ("right", "<u4")])
#: A window of a hot segment: its hash and its place there.
WINDOW = np.dtype([("hash", "<u8"), ("h", "<u8"), ("doc", "<i8"), ("start", "<i8"), ("at", "u1")])
MET = "doc_id long, start long, n long, h long, look boolean, hot boolean, copies binary"


@dataclass(frozen=True)
class Units:
    size: int  # units of a window
    k: int  # units of an anchor
    words: bool
    within: bool  # repeats within a document count, too
    shard: int  # units in a shard, about

    def split(self, text: str | None):
        raw = (text or "").encode("utf-8", "surrogatepass")
        return raw.split() if self.words else raw

    def values(self, units, hashes: WordHashes) -> np.ndarray:
        if self.words:
            return hashes.of(units)
        return np.frombuffer(units, np.uint8).astype(np.uint64)

    def join(self, units) -> bytes:
        return b" ".join(units) if self.words else bytes(units)


def least_of(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours, by doubling."""
    have = 1
    while 2 * have <= w:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:len(x) - (w - have)], x[w - have:]) if w > have else x


def powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    have = 1
    while have < n:
        m = min(have, n - have)
        out[have:have + m] = out[:m] * np.uint64(pow(base, have, 1 << 64))
        have += m
    return out


class Segments:
    """Segments of the units of several documents at once."""

    def __init__(self, units: Units):
        self.u = units
        self.up = powers(BASE, CHUNK + 1)
        self.down = powers(pow(BASE, -1, 1 << 64), CHUNK + 1)

    def of(self, values: list[np.ndarray]):
        """Arrays (h, sig, owner, start, n, left, right) of all segments."""
        size, parts, group, total = self.u.size, [], [], 0
        for i, v in enumerate(values):  # long ones are looked at in overlapping pieces
            for at in range(0, max(1, len(v) - size + 1), CHUNK // 2):
                piece = v[at:at + CHUNK // 2 + size - 1]
                if len(piece) < size:
                    continue
                if total + len(piece) > CHUNK:
                    parts.append(self.chunk(group))
                    group, total = [], 0
                group.append((i, at, piece))
                total += len(piece)
        if group:
            parts.append(self.chunk(group))
        return [np.concatenate(c) for c in zip(*parts)] if parts else [np.empty(0, np.int64)] * 7

    def chunk(self, group):
        size, k = self.u.size, self.u.k
        x = np.concatenate([p for _, _, p in group])
        lens = np.array([len(p) for _, _, p in group])
        ends = np.cumsum(lens)
        g = grams(x, k)
        key = (g & ~np.uint64((1 << 20) - 1)) | np.arange(len(g), dtype=np.uint64)
        anchor = (least_of(key, size - k + 1) & np.uint64((1 << 20) - 1)).astype(np.int64)
        windows = np.concatenate([np.arange(e - n, e - size + 1) for e, n in zip(ends, lens)])
        piece = np.repeat(np.arange(len(group)), lens - size + 1)
        a = anchor[windows]
        first = np.flatnonzero(np.r_[True, (a[1:] != a[:-1]) | (piece[1:] != piece[:-1])])
        n = np.diff(np.r_[first, len(a)])
        at, p = windows[first], piece[first]
        h = g[a[first]]
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((mix64(x + np.uint64(1))) * self.up[:len(x)])])
        sig = mix64((sums[at + n + size - 1] - sums[at]) * self.down[at] + n.astype(np.uint64))
        owner = np.array([i for i, _, _ in group])[p]
        offset = np.array([o for _, o, _ in group])[p]
        # the anchor with its neighbours on either side, 0 where no window has them all
        half = (size - k) // 2
        g = (grams(x, k + half) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
        a = a[first]
        left = np.where(a - at >= half, g[np.maximum(a - half, 0)], 0)
        right = np.where(a - (at + n - 1) <= half, g[np.minimum(a, len(g) - 1)], 0)
        return h, sig, owner, at - (ends - lens)[p] + offset, n, left, right


def runs(flags: np.ndarray, starts: np.ndarray, owners: np.ndarray):
    """Runs of flagged windows that follow each other in one document: (owner, start, n)."""
    s, o = starts[flags], owners[flags]
    if not len(s):
        return o, s, s
    first = np.flatnonzero(np.r_[True, (s[1:] != s[:-1] + 1) | (o[1:] != o[:-1])])
    return o[first], s[first], np.diff(np.r_[first, len(s)])


def placed(docs: DataFrame) -> DataFrame:
    """``docs`` with ``_offset``. Rows that share a doc_id are one document, its
    different texts one after the other in the order of their hashes: the offset
    is where a row's text lies in it, 0 for nearly all. Windows never cross
    texts."""
    text_hash = F.xxhash64("text")
    each = docs.select("doc_id", text_hash.alias("_t"), F.coalesce(F.octet_length("text"), F.lit(0)).alias("_b")).filter("doc_id IS NOT NULL").groupBy("doc_id", "_t").agg(F.max("_b").alias("_b"))
    more = each.groupBy("doc_id").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select("doc_id")
    before = Window.partitionBy("doc_id").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
    offsets = checkpointed(each.join(more, "doc_id", "left_semi").select(
        F.col("doc_id").alias("_d"), "_t", F.coalesce(F.sum(F.col("_b") + 1).over(before), F.lit(0)).alias("_offset")))
    if not offsets.head(1):
        return docs.withColumn("_offset", F.lit(0).cast("long"))
    keyed = key_map(docs, offsets.select(F.col("_d").alias("doc_id")), "doc_id")
    some = keyed.filter("_may").drop("_may")
    found = some.join(offsets, (F.col("doc_id") == F.col("_d")) & (text_hash == F.col("_t")), "left")
    return (found.withColumn("_offset", F.coalesce("_offset", F.lit(0))).drop("_d", "_t")
            .unionByName(keyed.filter("NOT _may").drop("_may").withColumn("_offset", F.lit(0).cast("long"))))


def meeting(h: np.ndarray, sig: np.ndarray, start: np.ndarray, n: np.ndarray, doc: np.ndarray, within: bool,
            sides: tuple[np.ndarray, ...] = ()) -> pd.DataFrame:
    """The rows of ``MET`` for all segments of some anchors. ``sides``: what two
    of an anchor agree in, in one of the arrays (0: nothing), if they have a
    window in common."""
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    rows = np.flatnonzero(twice)
    rows = rows[np.lexsort((start[rows], doc[rows], sig[rows], h[rows]))]
    h, sig, start, n, doc = h[rows], sig[rows], start[rows], n[rows], doc[rows]
    new_h = np.r_[True, h[1:] != h[:-1]][:len(h)]
    new = new_h | np.r_[True, sig[1:] != sig[:-1]][:len(h)]
    first = np.flatnonzero(new)
    of = np.cumsum(new) - 1
    later = doc > doc[first][of]
    if within:
        later |= (doc == doc[first][of]) & (start > start[first][of])
    anchor = np.cumsum(new_h) - 1
    look = new
    if sides:
        look = np.zeros(len(h), bool)
        for side in sides:
            some = first[side[rows[first]] > 0]
            key = (anchor[some].astype(np.uint64) << np.uint64(32)) | side[rows[some]].astype(np.uint64)
            _, which, times = np.unique(key, return_inverse=True, return_counts=True)
            look[some[times[which] > 1]] = True
    kinds = np.bincount(anchor, weights=look).astype(np.int64)[anchor] if len(h) else of
    look = look & (kinds > 1)
    keep = look | later
    copies = np.full(len(h), None, object)
    twin = ~new & ~later & look[first][of] & np.r_[True, start[1:] != start[:-1]][:len(h)]
    if not within and twin.any():
        whose, at = first[of[twin]], start[twin]
        edge = np.flatnonzero(np.r_[True, whose[1:] != whose[:-1], True])
        copies[whose[edge[:-1]]] = [at[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])]
    return pd.DataFrame({"doc_id": doc[keep], "start": start[keep], "n": n[keep],
                         "h": pd.array(np.where(look, h.view(np.int64), 0)[keep], "Int64").copy(),
                         "look": look[keep], "hot": (look & (kinds > HOT))[keep],
                         "copies": copies[keep]})


def met(docs: DataFrame, u: Units) -> DataFrame:
    """(doc_id, start, n, h, look, hot, copies): segments whose anchor occurs
    elsewhere. Copies of an earlier segment aren't to be looked at; where a repeat
    in the same document doesn't count, ``copies`` has the starts (64 bits each)
    of the equal segments in it, which share what the look at the first finds."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_parts = max(partitions(docs.sparkSession), -(-size // PART_BYTES))

    def make(batches):
        hashes, segments = WordHashes(), Segments(u)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            texts = strings(batch.column(1))
            offsets = batch.column(2).to_numpy(zero_copy_only=False)
            at = 0
            while at < len(texts):  # a few million characters at a time, in the order of ids
                end, chars = at, 0
                while end < len(texts) and (end == at or chars < 4 << 20):
                    chars += len(texts[end] or "")
                    end += 1
                h, sig, owner, start, n, left, right = segments.of([u.values(u.split(t), hashes) for t in texts[at:end]])
                if len(h):
                    p = (h % np.uint64(n_parts)).astype(np.int64)
                    order = np.argsort(p, kind="stable")
                    row = np.empty(len(h), PACKED)
                    row["h"], row["sig"], row["doc"], row["start"], row["n"] = h, sig, owner, start, n
                    row["left"], row["right"] = left, right
                    row, p = row[order], p[order]
                    edge = np.searchsorted(p, np.arange(n_parts + 1))
                    own = ids[at:end].astype(np.int64)
                    if offsets[at:end].any():  # pairs with their offsets, only where there are any
                        own = np.stack([own, offsets[at:end].astype(np.int64)], 1)
                    ks = np.flatnonzero(np.diff(edge))
                    used = [np.unique(row["doc"][edge[k]:edge[k + 1]], return_inverse=True) for k in ks]
                    blobs, names = [], []
                    for k, (docs_used, place) in zip(ks, used):
                        part = row[edge[k]:edge[k + 1]].copy()
                        part["doc"] = place
                        blobs.append(part.tobytes())
                        names.append(own[docs_used].tobytes())
                    yield pa.RecordBatch.from_arrays([pa.array(ks.astype(np.int32)), pa.array(blobs, pa.binary()),
                                                      pa.array(names, pa.binary())], ["p", "segments", "ids"])
                at = end

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        rows = [np.frombuffer(b, PACKED) for b in group["segments"]]
        named = [np.frombuffer(i, np.int64) for i in group["ids"]]
        pairs = [i.reshape(-1, 2) if len(i) > r["doc"].max() + 1 else np.stack([i, np.zeros_like(i)], 1) for i, r in zip(named, rows)]
        doc, offset = np.concatenate([i[r["doc"]] for i, r in zip(pairs, rows)]).T
        rows = np.concatenate(rows)
        h, sig, start, n = rows["h"], rows["sig"], rows["start"] + offset, rows["n"].astype(np.int64)
        return meeting(h, sig, start, n, doc, u.within, (rows["left"], rows["right"]))

    packed = docs.select("doc_id", "text", "_offset").mapInArrow(make, "p int, segments binary, ids binary")
    return packed.groupBy("p").applyInPandas(meet, MET)


def with_texts(docs: DataFrame, todo: DataFrame) -> DataFrame:
    """(doc_id, text, _offset, segments): texts of the documents of ``todo``. They
    are dealt by doc_id alone, which serves both the aggregate and the join."""
    return (only_keys(docs, todo.select("doc_id"), "doc_id").repartition("doc_id").dropDuplicates(["doc_id", "_offset"])
            .join(todo, "doc_id").select("doc_id", "text", "_offset", "segments"))


def narrowed(docs: DataFrame, hot: DataFrame, u: Units) -> DataFrame:
    """Rows as of ``met`` for the hot segments ``hot`` cut to the runs of windows
    whose hash occurs again. Equal windows have equal hashes, so no repeated one
    is lost; the runs' equal contents are copies once more. Only hashes are
    shuffled, by hash and then by anchor."""
    todo = hot.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "n", "h", "copies"))).alias("segments"))
    size = (hot.agg(F.sum("n")).first()[0] or 0) * WINDOW.itemsize
    n_parts = max(partitions(docs.sparkSession), -(-size // PART_BYTES))

    def dealt(rows: np.ndarray, by: str):
        p = (rows[by] % np.uint64(n_parts)).astype(np.int64)
        order = np.argsort(p, kind="stable")
        rows, edge = rows[order], np.searchsorted(p[order], np.arange(n_parts + 1))
        ks = np.flatnonzero(np.diff(edge))
        return ks.astype(np.int32), [rows[edge[k]:edge[k + 1]].tobytes() for k in ks]

    def windows(batches):
        hashes = WordHashes()

        def packed(parts, places):
            h, doc, start, n = (np.array(c, np.int64) for c in zip(*places))
            base = np.cumsum(n + u.size - 1) - (n + u.size - 1)
            at = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
            rows = np.empty(len(at), WINDOW)
            rows["hash"], rows["at"] = grams(np.concatenate(parts), u.size)[np.repeat(base, n) + at], at
            rows["h"], rows["doc"], rows["start"] = np.repeat(h.view(np.uint64), n), np.repeat(doc, n), np.repeat(start, n)
            ks, blobs = dealt(rows, "hash")
            return pa.RecordBatch.from_arrays([pa.array(ks), pa.array(blobs, pa.binary())], ["p", "windows"])

        for batch in batches:
            parts, places, total = [], [], 0
            for doc, text, offset, segments in zip(batch.column(0).to_pylist(), strings(batch.column(1)), batch.column(2).to_pylist(),
                                                   batch.column(3).to_pylist()):
                units = u.split(text)
                for s in segments:
                    at, n = s["start"] - offset, s["n"]
                    if not 0 <= at < len(units):  # of another text of the document
                        continue
                    parts.append(u.values(units[at:at + n + u.size - 1], hashes))
                    places.append((s["h"], doc, s["start"], n))
                    for twin in np.frombuffer(s["copies"] or b"", np.int64).tolist():
                        parts.append(parts[-1])
                        places.append((s["h"], doc, twin, n))
                    total += n + u.size - 1
                    if total > CHUNK:
                        yield packed(parts, places)
                        parts, places, total = [], [], 0
            if parts:
                yield packed(parts, places)

    def again(group: pd.DataFrame) -> pd.DataFrame:
        rows = np.concatenate([np.frombuffer(b, WINDOW) for b in group["windows"]])
        rows = rows[np.argsort(rows["hash"], kind="stable")]
        same = rows["hash"][1:] == rows["hash"][:-1]
        ks, blobs = dealt(rows[np.r_[False, same] | np.r_[same, False]], "h")
        return pd.DataFrame({"p": ks, "windows": blobs})

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        rows = np.concatenate([np.frombuffer(b, WINDOW) for b in group["windows"]])
        rows = rows[np.lexsort((rows["at"], rows["start"], rows["doc"], rows["h"]))]
        h, doc, start, at = (rows[c].copy() for c in ("h", "doc", "start", "at"))
        at = at.astype(np.int64)
        first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1]) | (start[1:] != start[:-1]) | (at[1:] != at[:-1] + 1)])
        n = np.diff(np.r_[first, len(h)])
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(rows["hash"] * powers(BASE, len(h)))])
        down = powers(pow(BASE, -1, 1 << 64), len(h))[first]
        sig = mix64((sums[first + n] - sums[first]) * down + n.astype(np.uint64))
        return meeting(h[first], sig, start[first] + at[first], n, doc[first], u.within)

    packed = with_texts(docs, todo).mapInArrow(windows, "p int, windows binary")
    return packed.groupBy("p").applyInPandas(again, "p int, windows binary").groupBy("p").applyInPandas(meet, MET)


def repeated_runs(docs: DataFrame, u: Units, look: Callable[[list, np.ndarray, np.ndarray, np.ndarray], list]) -> DataFrame:
    """(doc_id, start, n): runs of windows that occur earlier. ``look`` takes a
    shard's segments (units, doc, start, n) and gives flags for each window."""
    spark = docs.sparkSession
    small_batches(spark)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), "_offset").filter(
        "doc_id IS NOT NULL AND text IS NOT NULL")
    found = checkpointed(met(docs, u))
    sums = F.sum(F.col("n") + F.lit(u.size)).alias("units"), F.max("hot").alias("hot")
    total = found.filter("look").agg(*sums).first()
    if total["hot"]:
        found = found.filter("NOT hot").unionByName(checkpointed(narrowed(docs, found.filter("hot"), u)))
        total = found.filter("look").agg(*sums).first()
    todo = found.filter("look").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "n", "h", "hot", "copies"))).alias("segments"))
    n_shards = max(partitions(spark), -(-(total["units"] or 0) // u.shard))

    def fetch(batches):
        hashes = WordHashes()
        for batch in batches:
            out: list[tuple] = []
            for doc, text, offset, segments in zip(batch.column(0).to_pylist(), strings(batch.column(1)), batch.column(2).to_pylist(),
                                                   batch.column(3).to_pylist()):
                all_units = u.split(text)
                for s in segments:
                    at = s["start"] - offset
                    if not 0 <= at < len(all_units):  # of another text of the document
                        continue
                    part = all_units[at:at + s["n"] + u.size - 1]
                    if not s["hot"]:
                        out.append((s["h"] % n_shards, doc, s["start"], s["n"], u.join(part), s["copies"]))
                        continue
                    deal = (grams(u.values(part, hashes), u.size) % np.uint64(SPLIT)).astype(np.int64)
                    edges = np.flatnonzero(np.r_[True, deal[1:] != deal[:-1], True])
                    starts = np.frombuffer(s["copies"] or b"", np.int64)
                    for a, b in zip(edges[:-1], edges[1:]):
                        shard = (s["h"] + int(deal[a]) * BASE) % n_shards
                        out.append((shard, doc, s["start"] + int(a), int(b - a), u.join(part[a:b + u.size - 1]),
                                    (starts + a).tobytes() if len(starts) else None))
            cols = list(zip(*out)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int64(),) * 4 + (pa.binary(),) * 2)],
                                             ["shard", "doc_id", "start", "n", "units", "copies"])

    def sort_out(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "start"])
        doc, start, n = (group[c].to_numpy() for c in ("doc_id", "start", "n"))
        flags = look([x.split(b" ") if u.words else x for x in group["units"]], doc, start, n)
        at = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        parts = [runs(flags, at, np.repeat(doc, n))]
        base = np.cumsum(n) - n
        for i, copies in enumerate(group["copies"]):
            if copies is not None:  # the same windows at other places of the document
                _, s, m = runs(flags[base[i]:base[i] + n[i]], np.arange(n[i]), np.zeros(n[i]))
                starts = np.add.outer(np.frombuffer(copies, np.int64), s).ravel()
                parts.append((np.full(len(starts), doc[i]), starts, np.tile(m, len(starts) // max(1, len(m)))))
        o, s, m = (np.concatenate(c) for c in zip(*parts))
        return pd.DataFrame({"doc_id": o, "start": s, "n": m})

    fetched = with_texts(docs, todo).mapInArrow(fetch, "shard long, doc_id long, start long, n long, units binary, copies binary")
    looked = fetched.groupBy("shard").applyInPandas(sort_out, "doc_id long, start long, n long")
    return found.filter("NOT look").select("doc_id", "start", "n").unionByName(looked)


def covered_texts(docs: DataFrame, u: Units, look, finish, schema: str) -> DataFrame:
    """Maps (row of ``docs``, covered units) by ``finish(text, units, covered)``
    to the columns of ``schema``, after all columns of ``docs``; covered is a
    boolean array, or None if nothing is. Texts without runs aren't shuffled."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    small_batches(docs.sparkSession)
    plain, names = renamed(docs)
    rows = placed(plain.withColumn("_id", F.col("doc_id")).withColumn("doc_id", F.col("doc_id").cast("long")))
    runs_ = repeated_runs(rows, u, look)
    covered = checkpointed(runs_.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("start", "n"))).alias("_runs")))
    keyed = key_map(rows, covered, "doc_id")
    hit = keyed.filter("_may").drop("_may").join(covered, "doc_id", "left")
    rest = keyed.filter("NOT _may").drop("_may").withColumn("_runs", F.lit(None).cast("array<struct<start:bigint,n:bigint>>"))
    kept = [F.col("_id" if c == "doc_id" else c) for c in plain.columns]
    at = plain.columns.index("text")

    def run(batches):
        for batch in batches:
            done, width = [], batch.num_columns
            texts, offsets = strings(batch.column(at)), batch.column(width - 2).to_pylist()
            for text, offset, some in zip(texts, offsets, batch.column(width - 1).to_pylist()):
                units, mask = u.split(text), None
                some = [(r["start"] - offset, r["n"]) for r in some or [] if 0 <= r["start"] - offset < len(units)]
                if some:
                    edge = np.zeros(len(units) + 1, np.int64)
                    np.add.at(edge, [a for a, _ in some], 1)
                    np.add.at(edge, [a + n + u.size - 1 for a, n in some], -1)
                    mask = np.cumsum(edge)[:-1] > 0
                done.append(finish(text, units, mask))
            cols = [pa.array(c, f.type) for c, f in zip(zip(*done), extra)] if done else [pa.array([], f.type) for f in extra]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], *cols], [f"_c{i}" for i in range(width - 2 + len(extra))])

    added = StructType.fromDDL(schema)
    extra = [pa.field(f.name, to_arrow_type(f.dataType)) for f in added]
    wide = hit.select(*kept, "_offset", "_runs").unionByName(rest.select(*kept, "_offset", "_runs"))
    numbered = StructType()
    for i, f in enumerate([*docs.schema.fields, *added.fields]):
        numbered.add(f"_c{i}", f.dataType, True)
    return wide.mapInArrow(run, numbered).toDF(*names, *[f.name for f in added])
