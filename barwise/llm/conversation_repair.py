"""Least-cost repair of conversation structure.

A conversation's rows, in order, are kept, rerolled or deleted and empty turns
inserted until the roles' initials spell ``(s?(ua)+)?``, at the least cost; of
the cheapest edit lists the one whose initials are least in ASCII wins.

Rows are put in order by a range sort over (conv_id, turn, role, text), so a
long conversation spreads over tasks, and numbered; runs of at most 4,096 rows
of one conversation are its segments. The cost of crossing a segment from each
state of the grammar to each other is a 4 x 4 matrix, and the matrices' products
(least sums, by a tree over the segments) give the cost to go behind every
segment. Within a segment the cost to go of every node (place, state) follows
row by row, all segments of a batch at once. Then the nodes of optimal arcs are
ranked by the first 1, 2, 4, ... initials of their least audits: a rank of the
double length is the pair of a node's rank and that of the node its pointer
leads to. Equal costs are settled by (initial, rank of the target), and the
doubled pointers mark the least path without a walk. The grammar is
deterministic, so a node's optimal arcs have distinct initials and one pointer
each is enough. A segment's four paths, one for each state it may be entered
in, are maps of states, whose products choose the path that is taken.

Rows: a null role or text is one space, a null turn comes first, equal turns go
by role and text, equal rows count each. A null conv_id is a conversation like
any other. Initials are the role's first character. Empty tables give empty
results; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, small_batches, strings

#: Rows of a segment, and segments of one node of the tree, as powers of two.
SEGMENT_BITS, FAN_BITS = 12, 10
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLANKS = " \t\n\x0b\x0c\r"
#: States of the grammar: nothing yet, and after s, u and a.
START, S, U, A = range(4)
#: Initials in ASCII order, and the state a missing turn leads to.
LETTERS = "DIKR"
D, I, K, R = range(4)
FORCED = np.array([U, U, A, U])
INF = 1 << 40


def min_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """[..., 4, 4] by [..., 4, n]: least sums instead of sums of products."""
    return np.minimum((a[..., :, :, None] + b[..., None, :, :]).min(-2), INF)


def identity() -> np.ndarray:
    return np.where(np.eye(4, dtype=bool), 0, INF).astype(np.int64)


def grammar():
    """(cost, target) of edit D, K, R [code, letter, state]; code is the initial
    (0 other, 1 s, 2 u, 3 a) + 4 x the fault (0 none, 1 blank, 2 duplicate, 3 truncated)."""
    cost = np.full((16, 4, 4), INF, np.int64)
    target = np.zeros((16, 4, 4), np.int64)
    keeps = {1: [(START, S)], 2: [(START, U), (S, U), (A, U)], 3: [(U, A)]}
    for code in range(16):
        initial, fault = code % 4, code // 4
        cost[code, D] = DELETE
        target[code, D] = np.arange(4)
        if fault in (1, 2):
            continue
        more = TRUNCATED if fault == 3 else 0
        cost[code, R] = REROLE + more
        target[code, R] = FORCED
        for p, q in keeps.get(initial, []):
            cost[code, K, p], target[code, K, p] = KEEP + more, q
    return cost, target


COST, TARGET = grammar()


def inserts() -> np.ndarray:
    step = identity()
    step[np.arange(4), FORCED] = INSERT
    return min_plus(step, min_plus(step, step))


def crossings() -> np.ndarray:
    """[code, 4, 4]: least cost of any inserts and then the row's edit."""
    one = np.full((16, 4, 4), INF, np.int64)
    for letter in (D, K, R):
        for p in range(4):
            q = TARGET[:, letter, p]
            at = one[np.arange(16), p, q]
            one[np.arange(16), p, q] = np.minimum(at, COST[:, letter, p])
    return min_plus(inserts(), one)


CROSS = crossings()
#: Cost to go after the last row: inserts up to an accepted state.
FINAL = min_plus(inserts(), np.array([0, INF, INF, 0], np.int64)[:, None])[:, 0]


@dataclass
class Segments:
    """Segments of one batch, their rows one after the other."""

    codes: np.ndarray
    sizes: np.ndarray

    def __post_init__(self):
        self.first = np.cumsum(self.sizes) - self.sizes
        self.by_size = np.argsort(-self.sizes, kind="stable")
        self.ranked = -self.sizes[self.by_size]

    def backwards(self):
        """(step, segments that have so many rows) from each segment's end."""
        for j in range(1, int(self.sizes.max(initial=0)) + 1):
            yield j, self.by_size[:np.searchsorted(self.ranked, -j, side="right")]

    def matrices(self) -> np.ndarray:
        out = np.broadcast_to(identity(), (len(self.sizes), 4, 4)).copy()
        for j, some in self.backwards():
            out[some] = min_plus(CROSS[self.codes[self.first[some] + self.sizes[some] - j]], out[some])
        return out

    def illegal(self) -> np.ndarray:
        """Adjacent initials inside each segment that are not su, ua or au."""
        c = self.codes % 4
        fine = np.isin(c[:-1] * 4 + c[1:], [1 * 4 + 2, 2 * 4 + 3, 3 * 4 + 2])
        owner = np.repeat(np.arange(len(self.sizes)), self.sizes)
        bad = ~fine & (owner[1:] == owner[:-1])
        return np.bincount(owner[1:][bad], minlength=len(self.sizes))

    def paths(self, ends: np.ndarray, last: np.ndarray, entries: list[np.ndarray]):
        """Cost to go at every segment's start [segments, 4], and for each entry
        (a state per segment, or -1) the audits and the states they end in.
        ``ends`` are the costs to go behind the segments, ``last`` marks those
        behind which the conversation ends."""
        n = len(self.sizes)
        zero = self.first + np.arange(n)  # a segment's first place; it has one more than rows
        end = zero + self.sizes
        togo = np.empty((len(self.codes) + n, 4), np.int64)
        togo[end] = ends
        for j, some in self.backwards():
            row = self.first[some] + self.sizes[some] - j
            togo[end[some] - j] = (CROSS[self.codes[row]] + togo[end[some] - j + 1][:, None, :]).min(2)
        togo = np.minimum(togo, INF)

        # optimal arcs of the nodes 4 x place + state
        n_nodes = togo.size
        inner = np.ones(len(togo), bool)
        inner[end] = False
        place = np.flatnonzero(inner)
        target = np.tile(np.arange(n_nodes)[:, None], (1, 4)).reshape(len(togo), 4, 4)  # [place, state, letter]
        best = np.zeros((len(togo), 4, 4), bool)
        may_insert = inner.copy()
        may_insert[end[last]] = True
        at = np.flatnonzero(may_insert)
        target[at, :, I] = 4 * at[:, None] + FORCED
        best[at, :, I] = INSERT + togo[at][:, FORCED] == togo[at]
        for letter in (D, K, R):
            t = TARGET[self.codes, letter]
            target[place, :, letter] = 4 * (place[:, None] + 1) + t
            best[place, :, letter] = COST[self.codes, letter] + np.take_along_axis(togo[place + 1], t, 1) == togo[place]
        best &= (togo < INF)[:, :, None]
        best, target = best.reshape(n_nodes, 4), target.reshape(n_nodes, 4)

        # ranks of the first 2^k initials, and the nodes behind them
        some = best.any(1)
        letter = np.where(some, best.argmax(1), -1)
        nodes = np.arange(n_nodes)
        rank = letter + 1
        jumps, length = [np.where(some, target[nodes, letter], nodes)], some.astype(np.int64)
        while (length[jumps[-1]] > 0).any():
            jump = jumps[-1]
            rank = np.unique(rank * (rank.max() + 1) + rank[jump], return_inverse=True)[1]
            length = length + length[jump]
            jumps.append(jump[jump])
        key = np.where(best, np.arange(4) * (n_nodes + 1) + rank[target], np.iinfo(np.int64).max)
        letter = np.where(some, key.argmin(1), -1)

        owner = np.repeat(np.arange(n), self.sizes + 1)
        out = []
        for entry in entries:
            on = np.zeros(n_nodes, bool)
            on[(4 * zero + entry)[entry >= 0]] = True
            for jump in jumps:
                on[jump[np.flatnonzero(on)]] = True
            walk = np.flatnonzero(on)
            walk = walk[np.lexsort((-length[walk], owner[walk // 4]))]
            stop = ~some[walk]
            state = np.full(n, -1)
            state[owner[walk[stop] // 4]] = walk[stop] % 4
            step = walk[~stop]
            text = np.frombuffer(LETTERS.encode(), np.uint8)[letter[step]].tobytes().decode()
            edge = np.cumsum(np.bincount(owner[step // 4], minlength=n))
            out.append(([text[a:b] for a, b in zip(np.r_[0, edge[:-1]], edge)], state))
        return togo[zero], out


def initial_code(role) -> F.col:
    first = F.substring(role, 1, 1)
    return F.when(first == "s", 1).when(first == "u", 2).when(first == "a", 3).otherwise(0)


def plain(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text), nulls as one space."""
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"),
                                F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
                                F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"))


def numbered(rows: DataFrame) -> DataFrame:
    """(pos, conv_id, turn, code): all rows in order, with their faults. The
    texts pass one range shuffle and are dropped; what is left is checkpointed."""
    ends = F.rtrim(F.col("text"), F.lit(BLANKS))
    order = ["conv_id", "turn", "role", "text", "_in"]
    ordered = (rows.withColumn("_in", F.monotonically_increasing_id())
               .repartitionByRange(*order).sortWithinPartitions(*order))
    at = F.monotonically_increasing_id().alias("at")
    named = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit("")), F.isnull("conv_id").cast("string"),
                        F.length("role").cast("string"), F.concat("role", "text"))
    narrow = checkpointed(ordered.select(
        at, "conv_id", "turn", initial_code(F.col("role")).alias("initial"), (ends == "").alias("blank"),
        (~F.right(ends, F.lit(1)).isin(".", "!", "?")).alias("truncated"), F.unhex(F.md5(named)).alias("name")))
    # consecutive numbers: one row for each partition is enough to know where its own begin
    part = F.shiftright("at", 33).alias("part")
    sizes = narrow.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    first = narrow.filter("NOT blank").groupBy("name").agg(
        F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    blank = F.when(F.col("blank"), F.col("at").cast("string").cast("binary"))  # joins with nothing, each on its own
    told = narrow.withColumn("name", F.coalesce(blank, "name")).join(first, "name", "left")
    fault = (F.when(F.col("blank"), 1).when(F.col("at") > F.col("first"), 2).when(F.col("truncated"), 3).otherwise(0))
    return (told.withColumn("part", part).join(F.broadcast(before), "part")
            .select((F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1)).alias("pos"), "conv_id", "turn",
                    (F.col("initial") + 4 * fault).cast("short").alias("code")))


def exclusive(parts: DataFrame, reverse: bool, fan_bits: int) -> DataFrame:
    """(conv, chunk, m): for every part the product of the matrices before it in
    its conversation (behind it, if ``reverse``). Parts meet in groups of at
    most 2^fan_bits; the groups' products are treated alike, level by level."""
    def ordered(group: pd.DataFrame):
        group = group.sort_values("chunk", ascending=not reverse)
        return group, [np.array(m, np.int64).reshape(4, 4) for m in group["m"]]

    def times(a, b):
        return min_plus(b, a) if reverse else min_plus(a, b)

    def within(group: pd.DataFrame) -> pd.DataFrame:
        group, ms = ordered(group)
        before = group["before"].iloc[0]
        total = identity() if before is None else np.array(before, np.int64).reshape(4, 4)
        out = []
        for m in ms:
            out.append(total.ravel())
            total = times(total, m)
        return pd.DataFrame({"conv": group["conv"], "chunk": group["chunk"], "m": out})

    def product(group: pd.DataFrame) -> pd.DataFrame:
        group, ms = ordered(group)
        total = identity()
        for m in ms:
            total = times(total, m)
        return pd.DataFrame({"conv": group["conv"][:1], "chunk": group["chunk"][:1] // (1 << fan_bits), "m": [total.ravel()]})

    schema = "conv long, chunk long, m array<long>"
    node = F.shiftright("chunk", fan_bits).alias("node")
    most = parts.groupBy("conv").count().agg(F.max("count")).first()[0] or 0
    if most <= 1 << fan_bits:
        return parts.withColumn("before", F.lit(None).cast("array<long>")).groupBy("conv").applyInPandas(within, schema)
    totals = checkpointed(parts.groupBy("conv", node).applyInPandas(product, schema))
    before = exclusive(totals, reverse, fan_bits).select("conv", F.col("chunk").alias("node"), F.col("m").alias("before"))
    return (parts.withColumn("node", node).join(before, ["conv", "node"]).groupBy("conv", "node")
            .applyInPandas(within, schema))


def segment_codes(batch: pa.RecordBatch, name: str = "rows") -> Segments:
    column = batch.column(name)
    return Segments(column.flatten().field("code").to_numpy(zero_copy_only=False).astype(np.int64),
                    np.diff(column.offsets.to_numpy()))


def whole_paths(batches):
    """Audits of conversations that are one segment."""
    for batch in batches:
        s = segment_codes(batch)
        n = len(s.sizes)
        togo, [(audits, _)] = s.paths(np.tile(FINAL, (n, 1)), np.ones(n, bool), [np.zeros(n, np.int64)])
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("chunk"), pa.array(audits, pa.string()), pa.array(togo[:, START]),
             pa.array(s.illegal(), pa.int64())], ["conv", "chunk", "audit", "cost", "illegal"])


def segment_matrices(batches):
    for batch in batches:
        m = segment_codes(batch).matrices().reshape(-1, 16)
        yield pa.RecordBatch.from_arrays([batch.column("conv"), batch.column("chunk"), pa.array(list(m), pa.list_(pa.int64()))],
                                         ["conv", "chunk", "m"])


def segment_paths(batches):
    """The four paths through each segment of a longer conversation."""
    for batch in batches:
        s = segment_codes(batch)
        n = len(s.sizes)
        behind = np.array(batch.column("m").to_pylist(), np.int64).reshape(n, 4, 4)
        last = np.array(batch.column("last").to_pylist(), bool)
        ends = min_plus(behind, FINAL[:, None])[:, :, 0]
        togo, took = s.paths(ends, last, [np.where(ends.min(1) < INF, p, -1) for p in range(4)])
        exits = np.full((n, 4, 4), INF, np.int64)
        for p, (_, state) in enumerate(took):
            ok = (state >= 0) & (togo[:, p] < INF)
            exits[ok, p, state[ok]] = 0
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("chunk"), pa.array(list(zip(*(a for a, _ in took))), pa.list_(pa.string())),
             pa.array(togo[:, START]), pa.array(s.illegal(), pa.int64()), pa.array(list(exits.reshape(-1, 16)), pa.list_(pa.int64()))],
            ["conv", "chunk", "audits", "cost", "illegal", "m"])


PIECE = "conv long, chunk long, audit string, cost long, illegal long"


def long_paths(segments: DataFrame, fan_bits: int) -> DataFrame:
    """PIECE rows of conversations that have several segments."""
    mats = segments.select("conv", "chunk", "rows").mapInArrow(segment_matrices, "conv long, chunk long, m array<long>")
    behind = exclusive(checkpointed(mats), True, fan_bits)
    took = checkpointed(segments.join(behind, ["conv", "chunk"]).select("conv", "chunk", "rows", "last", "m").mapInArrow(
        segment_paths, "conv long, chunk long, audits array<string>, cost long, illegal long, m array<long>"))
    before = exclusive(took.select("conv", "chunk", "m"), False, fan_bits)
    entered = before.select("conv", "chunk", F.array_position(F.slice("m", 1, 4), F.lit(0)).cast("int").alias("state"))
    # the pair of rows that a border parts: the row before it is the last of the segment before
    edge = segments.select((F.col("final") + 1).alias("start"), F.col("conv").alias("_conv"),
                           (F.element_at("rows", -1)["code"] % 4).alias("left"))
    pair = F.col("left") * 4 + F.element_at("rows", 1)["code"] % 4
    borders = (segments.join(edge, (segments["start"] == edge["start"]) & (segments["conv"] == edge["_conv"]))
               .filter(~pair.isin(6, 11, 14)).select("conv", "chunk", F.lit(1).alias("border")))
    return (took.join(entered, ["conv", "chunk"]).join(borders, ["conv", "chunk"], "left")
            .select("conv", "chunk", F.element_at("audits", F.col("state")).alias("audit"), "cost",
                    (F.col("illegal") + F.coalesce("border", F.lit(0))).alias("illegal")))


def reports(rows: DataFrame, segment_bits: int = SEGMENT_BITS, fan_bits: int = FAN_BITS) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit."""
    told = numbered(rows)
    segments = told.groupBy("conv_id", F.shiftright("pos", segment_bits).alias("chunk")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "code"))).alias("rows"))
    segments = checkpointed(segments.select(
        "conv_id", "chunk", "rows", F.element_at("rows", 1)["pos"].alias("start"), F.element_at("rows", -1)["pos"].alias("final")))
    fault = lambda k: F.size(F.filter("rows", lambda r: F.floor(r["code"] / 4) == k))
    whole = segments.groupBy("conv_id").agg(
        F.min("start").alias("conv"), F.max("final").alias("end"), F.count(F.lit(1)).alias("n_segments"),
        *[F.sum(fault(k)).alias(name) for k, name in ((1, "blank"), (2, "duplicate"), (3, "truncated"))])
    turns = rows.groupBy("conv_id").agg(F.max("turn").alias("hi"), F.min("turn").alias("lo"), F.count_distinct("turn").alias("n"))
    wide = "decimal(20,0)"
    gaps = F.coalesce((F.col("hi").cast(wide) - F.col("lo").cast(wide) + 1 - F.col("n")).try_cast("long"), F.lit(0))
    whole = checkpointed(whole.join(turns.withColumnRenamed("conv_id", "_c"), F.col("conv_id").eqNullSafe(F.col("_c")))
                         .select("conv_id", "conv", "end", "n_segments", F.when(F.col("n") > 0, gaps).otherwise(0).cast("long").alias("gaps"),
                                 "blank", "duplicate", "truncated"))
    placed = segments.withColumnRenamed("conv_id", "_c").join(
        whole.select("conv_id", "conv", "end", "n_segments"), F.col("_c").eqNullSafe(F.col("conv_id"))).select(
        "conv", "chunk", "rows", "start", "final", (F.col("final") == F.col("end")).alias("last"), "n_segments")
    short = placed.filter("n_segments = 1").select("conv", "chunk", "rows").mapInArrow(whole_paths, PIECE)
    pieces = short.unionByName(long_paths(placed.filter("n_segments > 1"), fan_bits))
    audits = pieces.groupBy("conv").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "audit"))), lambda x: x["audit"]), "").alias("audit"),
        F.min_by("cost", "chunk").alias("cost"), F.sum("illegal").alias("illegal"))
    return whole.join(audits, "conv").select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")


def repaired(rows: DataFrame, report: DataFrame) -> DataFrame:
    """(conv_id, place, turn, role, text, edit): what the audits leave, edits K,
    R and I. A conversation's rows lie in one partition, in order, and stream
    through its task; nothing of it is held but the audit."""
    small_batches(rows.sparkSession)
    none = lambda kind: F.lit(None).cast(kind)
    both = report.select("conv_id", F.lit(0).alias("kind"), none("long").alias("turn"), F.lit("").alias("role"),
                         F.col("audit").alias("text")).unionByName(
        rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text"))
    names = {S: "system", U: "user", A: "assistant"}
    kept = {"s": S, "u": U, "a": A}

    def run(batches):
        audit, at, state, place = "", 0, START, 0
        for batch in batches:
            took, turns, roles, texts, edits, places = [], [], [], [], [], []
            ids, columns = batch.column(0), [batch.column(k).to_pylist() for k in (1, 2)]

            def emit(i, turn, role, text, edit):
                nonlocal place
                for column, value in zip((took, turns, roles, texts, edits, places), (i, turn, role, text, edit, place)):
                    column.append(value)
                place += 1

            for i, (kind, turn, role, text) in enumerate(zip(*columns, strings(batch.column(3)), strings(batch.column(4)))):
                if kind == 0:
                    audit, at, state, place = text, 0, START, 0
                else:
                    if audit[at] == "K":
                        state = kept[role[0]]
                        emit(i, turn, role, text, "K")
                    elif audit[at] == "R":
                        state = int(FORCED[state])
                        emit(i, turn, names[state], text, "R")
                    at += 1
                while at < len(audit) and audit[at] == "I":
                    state = int(FORCED[state])
                    emit(i, None, names[state], "", "I")
                    at += 1
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(took, pa.int64())), pa.array(places, pa.int64()), pa.array(turns, pa.int64()),
                 pa.array(roles, pa.string()), pa.array(texts, pa.string()), pa.array(edits, pa.string())],
                ["conv_id", "place", "turn", "role", "text", "edit"])

    from pyspark.sql.types import StructType

    schema = StructType([rows.schema["conv_id"], *StructType.fromDDL("place long, turn long, role string, text string, edit string")])
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text").mapInArrow(run, schema)


def repair(conversations: DataFrame, segment_bits: int = SEGMENT_BITS, fan_bits: int = FAN_BITS) -> tuple[DataFrame, DataFrame]:
    """(reports, repaired rows) of the conversations."""
    rows = plain(conversations)
    report = checkpointed(reports(rows, segment_bits, fan_bits))
    return report, repaired(rows, report)


def digests(repaired_rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``repaired``'s rows as they come: of
    ``role:text``, joined by newlines. A digest is one sequential sum, so this
    streams a conversation through one task, without holding it."""
    def run(batches):
        conv, sha = None, None
        for batch in batches:
            ids, out_ids, out = batch.column(0), [], []
            for i, (place, role, text) in enumerate(zip(batch.column(1).to_pylist(), strings(batch.column(2)), strings(batch.column(3)))):
                if place == 0:
                    if sha is not None:
                        out_ids.append(conv)
                        out.append(sha.hexdigest())
                    conv, sha = ids[i].as_py(), hashlib.sha256()
                else:
                    sha.update(b"\n")
                sha.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([pa.array(out_ids, ids.type), pa.array(out, pa.string())], ["conv_id", "repaired_sha256"])
            kind = ids.type
        if sha is not None:
            yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([sha.hexdigest()])], ["conv_id", "repaired_sha256"])

    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType([repaired_rows.schema["conv_id"], StructField("repaired_sha256", StringType())])
    return repaired_rows.select("conv_id", "place", "role", "text").mapInArrow(run, schema)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows harmed by crc32(`conv_id:turn`) mod 20: 0 drops the row, 1 empties
    its text, 2 removes its sentence ends, 3 repeats it, 4 sets role user."""
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                    F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    kind = F.pmod(F.crc32(name.cast("binary")), F.lit(20))
    rows = plain(conversations).withColumn("_kind", kind).filter("_kind != 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_time")).drop("_time")


def repair_damaged(conversations: DataFrame) -> DataFrame:
    """The damaged conversations' reports and digests, for every conv_id."""
    report, rows = repair(damage(conversations))
    ids = conversations.select(F.col("conv_id").alias("_id")).distinct()
    done = digests(rows).select(F.col("conv_id").alias("_d"), "repaired_sha256")
    longs = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return (ids.join(report, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
            .join(done, F.col("_id").eqNullSafe(F.col("_d")), "left")
            .select(F.col("_id").alias("conv_id"), *[F.coalesce(F.col(c).cast("long"), F.lit(0)).alias(c) for c in longs],
                    F.coalesce("audit", F.lit("")).alias("audit"),
                    F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256")))


#: The same by a forward search: per row and state the cheapest edits so far.
ORACLE = r"""
WITH RECURSIVE
named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
summed AS (SELECT *, xor(list_reduce(
    list_transform(string_split(name, ''), lambda c: ascii(c)::BIGINT),
    lambda crc, byte: list_reduce([xor(crc, byte)] || [i::BIGINT FOR i IN range(8)],
        lambda x, i: xor(x >> 1, (x & 1) * 3988292384)), 4294967295::BIGINT), 4294967295) % 20 AS kind FROM named),
harmed AS (SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE kind WHEN 3 THEN [1, 2] ELSE [1] END) AS time FROM summed WHERE kind != 0),
ordered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut FROM harmed),
told AS (SELECT *, CASE WHEN cut = '' THEN 'blank'
    WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
    WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) || substr(role, 1, 1) AS pair FROM ordered),
counts AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM told GROUP BY conv_id),
inserts(p, q, price, letters, put) AS (VALUES
    ('', '', 0, '', []::VARCHAR[]), ('s', 's', 0, '', []), ('u', 'u', 0, '', []), ('a', 'a', 0, '', []),
    ('', 'u', 3, 'I', ['user:']), ('s', 'u', 3, 'I', ['user:']), ('a', 'u', 3, 'I', ['user:']),
    ('u', 'a', 3, 'I', ['assistant:']), ('', 'a', 6, 'II', ['user:', 'assistant:']), ('s', 'a', 6, 'II', ['user:', 'assistant:'])),
search AS (
    SELECT conv_id, 0::BIGINT AS i, '' AS state, {'cost': 0::BIGINT, 'audit': '', 'rows': []::VARCHAR[]} AS best FROM counts
    UNION ALL
    SELECT conv_id, i, state, min(best) FROM (
        SELECT s.conv_id, s.i + 1 AS i, e.state,
            {'cost': s.best.cost + n.price + e.price, 'audit': s.best.audit || n.letters || e.letter,
             'rows': list_concat(s.best.rows, list_concat(n.put, e.put))} AS best
        FROM search s JOIN told t ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.i = s.i + 1
        JOIN inserts n ON n.p = s.state,
        LATERAL (SELECT unnest([
            {'state': n.q, 'price': 4, 'letter': 'D', 'put': []::VARCHAR[]},
            CASE WHEN t.fault NOT IN ('blank', 'duplicate') AND (n.q = '' AND substr(t.role, 1, 1) = 's' OR n.q IN ('', 's', 'a') AND substr(t.role, 1, 1) = 'u' OR n.q = 'u' AND substr(t.role, 1, 1) = 'a')
                THEN {'state': substr(t.role, 1, 1), 'price': CASE t.fault WHEN 'truncated' THEN 3 ELSE 0 END, 'letter': 'K', 'put': [t.role || ':' || t.text]} END,
            CASE WHEN t.fault NOT IN ('blank', 'duplicate')
                THEN {'state': CASE n.q WHEN 'u' THEN 'a' ELSE 'u' END, 'price': CASE t.fault WHEN 'truncated' THEN 6 ELSE 3 END, 'letter': 'R',
                      'put': [CASE n.q WHEN 'u' THEN 'assistant' ELSE 'user' END || ':' || t.text]} END]) AS x) u(x),
        LATERAL (SELECT u.x.state AS state, u.x.price AS price, u.x.letter AS letter, u.x.put AS put) e
        WHERE u.x IS NOT NULL)
    GROUP BY conv_id, i, state),
ended AS (SELECT s.conv_id, min({'cost': s.best.cost + n.price, 'audit': s.best.audit || n.letters, 'rows': list_concat(s.best.rows, n.put)}) AS best
    FROM search s JOIN counts c ON c.conv_id IS NOT DISTINCT FROM s.conv_id AND s.i = c.n
    JOIN inserts n ON n.p = s.state AND n.q IN ('', 'a') GROUP BY s.conv_id)
SELECT d.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
    coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal, coalesce(e.best.cost, 0)::BIGINT AS cost,
    coalesce(e.best.audit, '') AS audit, sha256(coalesce(array_to_string(e.best.rows, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d
LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM d.conv_id
"""
