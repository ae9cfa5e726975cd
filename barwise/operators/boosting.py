"""Second-order gradient boosting over binned rows, many trials at once (M2-M5).

Features are cut into bins once, at quantiles of the training rows, and every
trial shares the binned frame. A tree grows level by level. For one level, each
task adds up gradients and weights of its rows by (trial, node, feature, bin),
the partial sums meet by (trial, block of features), and the best split of every
node follows from the whole sums with the penalties of the leaf formula: with
gradient sum G and weight sum H a leaf is -soft(G, alpha) / (H + lambda), its
score soft(G, alpha)^2 / (H + lambda), and a split gains its children's scores
less its node's. Only splits, a few numbers a node, come to the driver.

All unfinished trials share a pass, each at its own tree and level. Gradients
are summed as integers, so the trees don't depend on partitions or retries. Rows
carry the sum of the trees up to the last checkpoint; younger trees are applied
on the fly, at most ``PENDING`` of them.

A frame of few rows (``TASK_ROWS``) would spend its time on starting passes, one
for each level of each tree. There every trial gets a copy of the binned rows
and a task of its own, which takes the same levels by the same steps.

With validation rows, the pass that starts a tree also adds up their squared
errors, so the error after every iteration costs no pass of its own. A trial
stops ``patience`` iterations after its best one and keeps the trees up to that.

The three profiles differ as their models do: ``lightgbm`` limits leaves and
asks for rows in each, ``xgboost`` limits depth, ``catboost`` splits all nodes
of a level alike and weights rows at random.
"""

from __future__ import annotations

import json
import math
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from barwise.session import checkpoint_dir, task_partitions

MAX_BINS = 32
#: Trees that rows may lack; then the frame is checkpointed with them applied.
PENDING = 16
#: Iterations without a better validation error (fixed value of the reference).
PATIENCE = 100
#: Row x trial pairs of a task, features x trials of a block, about. Frames of
#: no more rows are fitted with a task for each trial.
TASK_ROWS, BLOCK_FEATURES = 1 << 15, 256
#: Bits of the largest gradient, so that a batch's float sums of them are exact.
GRADIENT_BITS = 36
SEED = 42


@dataclass
class Trial:
    """One learner's settings."""

    name: str
    features: list[str]
    rounds: int = 100
    rate: float = 0.1
    depth: int = 6
    alpha: float = 0.0
    lambda_: float = 1.0
    row_fraction: float = 1.0
    feature_fraction: float = 1.0
    leaves: int | None = None
    min_child: float = 1.0
    symmetric: bool = False
    temperature: float = 0.0
    noise: float = 0.0
    seed: int = SEED


@dataclass
class Tree:
    """Nodes by number; the children of an inner one are ``left`` and left + 1."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [0])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    depth: int = 0

    def split(self, node: int, feature: int, at: int, gain: float, values: tuple[float, float]) -> tuple[int, int]:
        self.feature[node], self.bin[node], self.left[node], self.gain[node] = feature, at, len(self.feature), gain
        for v in values:
            for column, x in ((self.feature, -1), (self.bin, 0), (self.left, 0), (self.value, v), (self.gain, 0.0)):
                column.append(x)
        return len(self.feature) - 2, len(self.feature) - 1

    def leaf_of(self, codes: np.ndarray) -> np.ndarray:
        """Each row's node, by its bins [rows, features]."""
        feature, at, left = np.array(self.feature), np.array(self.bin), np.array(self.left)
        node, rows = np.zeros(len(codes), np.int64), np.arange(len(codes))
        for _ in range(self.depth):
            f = feature[node]
            node = np.where(f >= 0, left[node] + (codes[rows, np.maximum(f, 0)] > at[node]), node)
        return node


@dataclass
class Booster:
    """A fitted learner. ``edges`` are the bins' upper ends of its features."""

    name: str
    features: list[str]
    edges: list[list[float]]
    base: float
    trees: list[Tree]
    errors: list[float] = field(default_factory=list)

    @property
    def n_trees(self) -> int:
        return len(self.trees)

    def predict(self, x: np.ndarray) -> np.ndarray:
        codes = bins_of(x, self.edges)
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += np.array(tree.value)[tree.leaf_of(codes)]
        return out

    def transform(self, df: DataFrame) -> DataFrame:
        return score(df, {self.name: self})

    def to_json(self) -> str:
        return json.dumps({"name": self.name, "features": self.features, "edges": self.edges, "base": self.base,
                           "trees": [t.__dict__ for t in self.trees], "errors": self.errors})

    @staticmethod
    def from_json(text: str) -> Booster:
        d = json.loads(text)
        return Booster(d["name"], d["features"], d["edges"], d["base"], [Tree(**t) for t in d["trees"]], d["errors"])


def columns_of(batch: pa.RecordBatch, names: Sequence[str]) -> np.ndarray:
    return np.stack([batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in names], 1)


def bins_of(x: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    """Bins of raw values: the number of edges below; NaN goes last."""
    return np.stack([np.searchsorted(np.array(e), x[:, i]) for i, e in enumerate(edges)], 1).astype(np.uint8)


def score(df: DataFrame, models: dict[str, Booster], drop: Sequence[str] = ()) -> DataFrame:
    """One prediction column per model, all in a single pass."""
    keep = [f for f in df.schema.fields if f.name not in drop and f.name not in models]
    names = sorted({c for m in models.values() for c in m.features})
    place = {c: i for i, c in enumerate(names)}

    def run(batches):
        for batch in batches:
            x = columns_of(batch, names)
            found = [pa.array(m.predict(x[:, [place[c] for c in m.features]])) for m in models.values()]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in keep], *found], [*[f.name for f in keep], *models])

    return df.mapInArrow(run, StructType([*keep, *[StructField(m, DoubleType()) for m in models]]))


def quantile_edges(df: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS) -> dict[str, list[float]]:
    """Distinct quantiles of every feature, in one aggregate: at most
    ``max_bins`` - 1 numbers a feature, the last below the feature's maximum."""
    at = ", ".join(repr(k / max_bins) for k in range(1, max_bins))
    row = df.agg(*[F.expr(f"approx_percentile(CAST(`{c}` AS DOUBLE), array({at}), 10000)").alias(f"q{i}") for i, c in enumerate(features)],
                 *[F.max(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(features)]).first()
    return {c: sorted({v for v in row[f"q{i}"] or [] if v < row[f"m{i}"]}) for i, c in enumerate(features)}


def mixed(x: np.ndarray) -> np.ndarray:
    """Scrambled 64-bit values, as floats in [0, 1)."""
    x = x.astype(np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)) / float(1 << 53)


def row_weights(trial: Trial, number: int, ids: np.ndarray) -> np.ndarray:
    """Weights of the rows in tree ``number``, from their ids alone."""
    key = np.uint64((trial.seed * 1_000_003 + number) * 0x9E3779B97F4A7C15 % (1 << 64))
    u = mixed(ids.view(np.uint64) ^ key)
    out = (u < trial.row_fraction).astype(float) if trial.row_fraction < 1 else np.ones(len(ids))
    if trial.temperature > 0:
        out *= np.minimum(-np.log(mixed(ids.view(np.uint64) + key) + 1e-12), 16.0) ** trial.temperature
    return out


def soft(g, alpha: float):
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def node_score(g, h, alpha: float, lambda_: float):
    return soft(g, alpha) ** 2 / np.where(h + lambda_ > 0, h + lambda_, 1)


def leaf_value(g: float, h: float, trial: Trial) -> float:
    return float(-trial.rate * soft(g, trial.alpha) / (h + trial.lambda_)) if h + trial.lambda_ > 0 else 0.0


@dataclass
class Grown:
    """A trial's progress: finished trees, and the one that grows."""

    trial: Trial
    columns: np.ndarray  # places of its features in the binned frame
    trees: list[Tree] = field(default_factory=list)
    applied: int = 0  # trees that the state already holds
    tree: Tree = field(default_factory=Tree)
    frontier: list[int] = field(default_factory=lambda: [0])
    chosen: np.ndarray | None = None
    errors: list[float] = field(default_factory=list)
    best: int = 0
    done: bool = False

    def choose(self) -> None:
        """Features of the next tree."""
        rng = np.random.default_rng([self.trial.seed, len(self.trees)])
        n = max(1, math.ceil(self.trial.feature_fraction * len(self.columns)))
        self.chosen = np.sort(rng.choice(len(self.columns), n, replace=False))


@dataclass
class Work:
    """What a pass needs to know of a trial: no more than its young trees."""

    index: int
    trial: Trial
    number: int
    columns: np.ndarray
    young: list[Tree]
    tree: Tree
    frontier: list[int]
    chosen: np.ndarray
    starts: bool


SPLIT = "trial int, slot int, feature int, bin int, gain double, left array<long>, all array<long>"


PARTIAL = "trial int, block int, slot int, hist binary"


def sums(work: list[Work], n_features: int, base: float, scale: float, blocks: int):
    """Maps rows to a task's PARTIAL sums; block -1 has the validation rows'
    squared errors."""
    def run(batches):
        totals: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            ids, y = batch.column("id").to_numpy(), batch.column("y").to_numpy()
            val = batch.column("val").to_numpy(zero_copy_only=False)
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(len(ids), n_features)
            held = batch.column("f").to_pylist()
            f = np.frombuffer(b"".join(held)).reshape(len(ids), -1) if held and held[0] else None
            for w in work:
                own = codes[:, w.columns]
                now = np.full(len(ids), base) if f is None else f[:, w.index].copy()
                for t in w.young:
                    now += np.array(t.value)[t.leaf_of(own)]
                if w.starts and val.any():
                    err = np.array([np.rint((now - y)[val] ** 2 * scale).sum(), val.sum()]).astype(np.int64)
                    key = (w.index, -1, 0)
                    totals[key] = totals.get(key, 0) + err
                if not w.frontier:
                    continue
                slots = np.full(len(w.tree.feature), -1)
                slots[w.frontier] = np.arange(len(w.frontier))
                slot = slots[w.tree.leaf_of(own)]
                weight = np.where(val, 0.0, row_weights(w.trial, w.number, ids))
                some = (slot >= 0) & (weight > 0)
                slot, weight = slot[some], weight[some]
                g = np.rint(np.clip((now - y)[some] * weight * scale, -2.0 ** GRADIENT_BITS, 2.0 ** GRADIENT_BITS))
                h = np.rint(weight * (1 << 20))
                for k, block in enumerate(np.array_split(w.chosen, blocks)):
                    if not len(block):
                        continue
                    key = ((slot[:, None] * len(block) + np.arange(len(block))) * MAX_BINS + own[some][:, block]).ravel()
                    size = len(w.frontier) * len(block) * MAX_BINS
                    hist = np.stack([np.bincount(key, np.repeat(v, len(block)), size) for v in (g, h)], 1).astype(np.int64)
                    for s, part in enumerate(hist.reshape(len(w.frontier), -1)):
                        if part.any():
                            name = (w.index, k, s)
                            totals[name] = totals.get(name, 0) + part
        if totals:
            keys = np.array(list(totals), np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(keys[:, 2]), pa.array([v.tobytes() for v in totals.values()], pa.binary())],
                ["trial", "block", "slot", "hist"])

    return run


def best_splits(work: list[Work], scale: float, blocks: int, spread: float):
    """Maps PARTIAL sums to SPLIT rows: the best split of every node over a
    task's blocks, gains in units of the gradients. Slot -1: all nodes of a
    level split alike, sums of all of them; feature -1: validation error."""
    by_index = {w.index: w for w in work}

    def run(batches):
        total: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            for trial, block, slot, hist in zip(*[c.to_pylist() for c in batch.columns]):
                key = (trial, block, slot)
                total[key] = total.get(key, 0) + np.frombuffer(hist, np.int64)
        found: dict[tuple[int, int], tuple] = {}
        out = []
        blocks_of: dict[tuple[int, int], dict[int, np.ndarray]] = {}
        for (trial, block, slot), v in total.items():
            if block < 0:
                out.append((trial, 0, -1, 0, 0.0, v.tolist(), []))
            else:
                blocks_of.setdefault((trial, block), {})[slot] = v
        for (trial, block), slots in blocks_of.items():
            w = by_index[trial]
            t, features = w.trial, np.array_split(w.chosen, blocks)[block]
            hist = np.zeros((len(w.frontier), len(features), MAX_BINS, 2), np.int64)
            for s, v in slots.items():
                hist[s] = v.reshape(len(features), MAX_BINS, 2)
            whole = hist[:, 0].sum(1)
            left = hist.cumsum(2)[:, :, :-1]
            right = whole[:, None, None] - left
            real = lambda x: (x[..., 0] / scale, x[..., 1] / (1 << 20))
            (gl, hl), (gr, hr), (ga, ha) = real(left), real(right), real(whole)
            parts = [node_score(g, h, t.alpha, t.lambda_) for g, h in ((gl, hl), (gr, hr), (ga, ha))]
            gain = parts[0] + parts[1] - parts[2][:, None, None]
            fits = (hl >= t.min_child) & (hr >= t.min_child)
            gain = np.where(fits, gain, 0.0 if t.symmetric else -np.inf)
            if t.symmetric:
                gain = gain.sum(0, keepdims=True)
                if t.noise > 0:
                    drawn = [np.random.default_rng([t.seed, w.number, w.tree.depth, int(f)]).normal(size=MAX_BINS - 1) for f in features]
                    gain += np.stack(drawn) * t.noise * spread / (1 + w.number) * (gain > 0)
            flat = gain.reshape(len(gain), -1)
            for s, k in enumerate(flat.argmax(1)):
                f, at = divmod(int(k), MAX_BINS - 1)
                slot = -1 if t.symmetric else s
                some = slice(None) if t.symmetric else slice(s, s + 1)
                row = (float(flat[s, k]), -int(features[f]), -at, left[some, f, at].ravel().tolist(), whole[some].ravel().tolist())
                if (trial, slot) not in found or row[:3] > found[trial, slot][:3]:
                    found[trial, slot] = row
        out += [(trial, slot, -f, -at, gain, a, b) for (trial, slot), (gain, f, at, a, b) in found.items()]
        cols = list(zip(*out)) or [()] * 7
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                         ["trial", "slot", "feature", "bin", "gain", "left", "all"])

    return run


def level(state: DataFrame, work: list[Work], n_features: int, base: float, scale: float, spread: float) -> DataFrame:
    """One pass over the rows for all ``work``."""
    parts = task_partitions(state.sparkSession)
    blocks = max(1, min(parts, sum(len(w.chosen) for w in work) // BLOCK_FEATURES))
    add, pick = sums(work, n_features, base, scale, blocks), best_splits(work, scale, blocks, spread)
    return state.mapInArrow(add, PARTIAL).repartition(blocks, "trial", "block").mapInArrow(pick, SPLIT)


def grow(g: Grown, rows: list, scale: float) -> None:
    """Takes a level's best splits into the trial's tree; a tree that is done is
    added to the trees."""
    t, tree = g.trial, g.tree
    real = lambda a: (a[0] / scale, a[1] / (1 << 20))
    best: dict[int, tuple] = {}
    for r in rows:  # the best of all blocks: largest gain, then first feature
        key = (r["gain"], -r["feature"], -r["bin"])
        if r["slot"] not in best or key > best[r["slot"]][0]:
            best[r["slot"]] = (key, r)
    chosen = []
    if t.symmetric:
        if -1 in best:
            r = best[-1][1]
            for s, node in enumerate(g.frontier):
                left, whole = r["left"][2 * s:2 * s + 2], r["all"][2 * s:2 * s + 2]
                chosen.append((r["gain"], node, r, left, whole))
    else:
        chosen = [(r["gain"], g.frontier[s], r, r["left"], r["all"]) for s, (_, r) in best.items()]
    if tree.depth == 0:
        for _, node, _, _, whole in chosen[:1]:
            tree.value[0] = leaf_value(*real(whole), t)
    room = math.inf if t.leaves is None else t.leaves - tree.feature.count(-1)
    after = []
    for gain, node, r, left, whole in sorted(chosen, key=lambda c: (-c[0], c[1])):
        if not gain > 1e-12 or room <= 0:
            break
        room -= 1
        right = [w - a for w, a in zip(whole, left)]
        pair = tree.split(node, r["feature"], r["bin"], gain, (leaf_value(*real(left), t), leaf_value(*real(right), t)))
        weights = [real(left)[1], real(right)[1]]
        after += [n for n, h in zip(pair, weights) if t.symmetric or h >= 2 * t.min_child]
    if after:
        tree.depth += 1
    if after and tree.depth < t.depth and room > 0:
        g.frontier = sorted(after)
        return
    g.trees.append(tree)
    g.tree, g.frontier = Tree(), [0]
    g.choose()


def apply_trees(todo: list[tuple[int, np.ndarray, list[Tree]]], n_features: int, base: float):
    """Maps rows to rows that carry the sums of their (trial, columns, trees)."""
    def run(batches):
        for batch in batches:
            m = batch.num_rows
            codes = np.frombuffer(b"".join(batch.column("codes").to_pylist()), np.uint8).reshape(m, n_features)
            held = batch.column("f").to_pylist()
            f = np.frombuffer(b"".join(held)).reshape(m, -1).copy() if held and held[0] else np.full((m, len(todo)), base)
            for i, at, trees in todo:
                for t in trees:
                    f[:, i] += np.array(t.value)[t.leaf_of(codes[:, at])]
            yield batch.set_column(batch.schema.get_field_index("f"), "f", pa.array([r.tobytes() for r in f], pa.binary()))

    return run


def boost(grown: list[Grown], splits, apply, has_val: bool, patience: int, scale: float) -> None:
    """Grows all trees: ``splits`` gives the SPLIT rows of a level's work, and
    ``apply`` adds finished trees to what the rows carry."""
    while True:
        work = []
        for i, g in enumerate(grown):
            if g.done:
                continue
            full = len(g.trees) >= g.trial.rounds
            starts = has_val and len(g.trees) > len(g.errors)
            if full and not starts:
                g.done = True
                continue
            work.append(Work(i, g.trial, len(g.trees), g.columns, g.trees[g.applied:], g.tree, [] if full else g.frontier, g.chosen, starts))
        if not work:
            break
        found: dict[int, list] = {}
        for r in splits(work):
            found.setdefault(r["trial"], []).append(r)
        for w in work:
            g, rows_of = grown[w.index], found.get(w.index, [])
            if w.starts:
                error = next(r for r in rows_of if r["feature"] < 0)
                g.errors.append(error["left"][0] / scale / max(1, error["left"][1]))
                if g.errors[-1] < g.errors[g.best]:
                    g.best = len(g.errors) - 1
                if len(g.errors) - 1 - g.best >= patience:
                    g.done = True
            if not g.done and w.frontier:
                grow(g, [r for r in rows_of if r["feature"] >= 0], scale)
        if any(len(g.trees) - g.applied >= PENDING for g in grown if not g.done):
            apply([(i, g.columns, g.trees[g.applied:]) for i, g in enumerate(grown)])
            for g in grown:
                g.applied = len(g.trees)


def fit_one(grown: list[Grown], n_features: int, base: float, scale: float, spread: float, has_val: bool, patience: int):
    """Maps the rows of a trial to its booster's trees, as JSON."""
    def run(key, rows):
        g = grown[key[0].as_py()]
        held = rows.to_batches(max_chunksize=10_000)

        def splits(work):
            add, pick = sums(work, n_features, base, scale, 1), best_splits(work, scale, 1, spread)
            return [r for batch in pick(add(held)) for r in batch.to_pylist()]

        def apply(todo):
            held[:] = apply_trees(todo, n_features, base)(held)

        boost([g], splits, apply, has_val, patience, scale)
        text = json.dumps({"trees": [t.__dict__ for t in g.trees], "errors": g.errors, "best": g.best})
        return pa.table({"trial": pa.array([key[0].as_py()], pa.int32()), "fitted": [text]})

    return run


def fit_many(df: DataFrame, trials: Sequence[Trial], label: str, validation_col: str | None = None,
             patience: int = PATIENCE, max_bins: int = MAX_BINS) -> list[Booster]:
    """Fits all trials to ``df``. ``validation_col`` marks rows that train
    nothing and stop a trial (``patience``). Rows with a NULL label are left out."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    features = sorted({c for t in trials for c in t.features})
    val = F.coalesce(F.col(validation_col), F.lit(False)) if validation_col else F.lit(False)
    rows = df.select(F.xxhash64(*df.columns).alias("id"), F.col(label).cast("double").alias("y"), val.alias("val"), *features).filter("y IS NOT NULL")
    train = rows.filter("NOT val")
    edges = quantile_edges(train, features, min(max_bins, MAX_BINS))
    exact = F.col("y").cast("decimal(38,18)")
    n, total, largest, variance = train.agg(F.count(F.lit(1)), F.sum(exact), F.max(F.abs("y")), F.var_pop("y")).first()
    if not n:
        return [Booster(t.name, list(t.features), [edges[c] for c in t.features], 0.0, []) for t in trials]
    base = float(total) / n
    # |gradient| <= 4 x the largest label, in as many bits as whole sums allow
    bits = min(GRADIENT_BITS, 61 - max(1, n).bit_length())
    scale = 2.0 ** (bits - math.ceil(math.log2(4 * largest))) if largest else 1.0
    spread = float(f"{variance:.6g}")  # the order of the sum shows in later digits
    n_features, edge_list = len(features), [edges[c] for c in features]

    def cut(batches):
        for batch in batches:
            codes = bins_of(columns_of(batch, features), edge_list)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("y"), batch.column("val"), pa.array([r.tobytes() for r in codes], pa.binary()),
                 pa.array([b""] * len(codes), pa.binary())], ["id", "y", "val", "codes", "f"])

    columns = "id long, y double, val boolean, codes binary, f binary"
    state = rows.mapInArrow(cut, columns)  # binned once, for all trials
    n_tasks = max(1, -(-n * len(trials) // TASK_ROWS))
    state = state.coalesce(n_tasks).checkpoint()
    place = {c: i for i, c in enumerate(features)}
    grown = [Grown(t, np.array([place[c] for c in t.features])) for t in trials]
    for g in grown:
        g.choose()
    n_val = state.filter("val").count() if validation_col else 0
    if n + n_val <= TASK_ROWS:
        # ranges of single numbers: a task for each trial
        copies = state.select(F.explode(F.sequence(F.lit(0), F.lit(len(trials) - 1))).alias("trial"), "*").repartitionByRange(4 * len(trials), "trial")
        one = fit_one(grown, n_features, base, scale, spread, n_val > 0, patience)
        for r in copies.groupBy("trial").applyInArrow(one, "trial int, fitted string").collect():
            g, fitted = grown[r["trial"]], json.loads(r["fitted"])
            g.trees, g.errors, g.best = [Tree(**t) for t in fitted["trees"]], fitted["errors"], fitted["best"]
    else:
        def splits(work):
            return level(state, work, n_features, base, scale, spread).collect()

        def apply(todo):
            nonlocal state
            state = state.mapInArrow(apply_trees(todo, n_features, base), columns).checkpoint()

        boost(grown, splits, apply, n_val > 0, patience, scale)
    out = []
    for g in grown:
        trees = g.trees[:g.best + 1] if g.errors else g.trees[:g.trial.rounds]
        out.append(Booster(g.trial.name, list(g.trial.features), [edges[c] for c in g.trial.features], base, trees, g.errors))
    return out


def tree_rows(model: Booster) -> list[tuple]:
    """(tree, path, feature, threshold, gain, value) of every node; the path has
    an L for every branch at or below a threshold, an R for one above. Leaves
    have no feature, inner nodes no value."""
    out = []
    for number, t in enumerate(model.trees):
        todo = [(0, "")]
        while todo:
            i, path = todo.pop()
            f = t.feature[i]
            if f >= 0:
                todo += [(t.left[i], path + "L"), (t.left[i] + 1, path + "R")]
                out.append((number, path, model.features[f], model.edges[f][t.bin[i]], t.gain[i], None))
            else:
                out.append((number, path, None, None, None, t.value[i]))
    return out
