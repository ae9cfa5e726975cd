"""The booster against a plain row-by-row version, and its patience rule."""
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barwise.operators import boosting as B

SCHEMA = "a double, b double, c double, y double, val boolean"


def table(n=400, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.gauss(0, 1), rng.uniform(-3, 3), float(rng.randint(0, 4))
        rows.append((a, b, c, math.sin(2 * a) + (b > 0) * c * 0.4 + rng.gauss(0, 0.6), i % 4 == 3))
    return rows


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def plain(rows, edges, t):
    """Trees grown by trying every edge on raw values; returns the validation
    errors and the predictions after each iteration."""
    x, y = np.array([r[:3] for r in rows]), np.array([r[3] for r in rows])
    val = np.array([r[4] for r in rows])
    base = y[~val].mean()
    f = np.full(len(y), base)
    soft = lambda g: math.copysign(max(abs(g) - t.alpha, 0), g)
    score = lambda g, h: soft(g) ** 2 / (h + t.lambda_) if h + t.lambda_ > 0 else 0.0
    errors, after = [], []
    for _ in range(t.rounds):
        g = f - y
        step = np.zeros(len(y))

        def grow(some, depth):
            own = some & ~val
            best = (0.0, None)
            for j in range(3):
                for e in edges["abc"[j]]:
                    left = own & (x[:, j] <= e)
                    right = own & ~(x[:, j] <= e)
                    if depth and left.sum() >= t.min_child and right.sum() >= t.min_child:
                        gain = score(g[left].sum(), left.sum()) + score(g[right].sum(), right.sum()) - score(g[own].sum(), own.sum())
                        if gain > best[0] + 1e-9:
                            best = (gain, (j, e))
            if best[1] is None:
                step[some] = -t.rate * soft(g[own].sum()) / (own.sum() + t.lambda_)
                return
            j, e = best[1]
            grow(some & (x[:, j] <= e), depth - 1)
            grow(some & ~(x[:, j] <= e), depth - 1)

        grow(np.ones(len(y), bool), t.depth)
        f = f + step
        errors.append(((f - y)[val] ** 2).mean())
        after.append(f.copy())
    return errors, after


@pytest.mark.parametrize("pending", [2, 16])
def test_trees_match_plain_growth_and_patience(spark, monkeypatch, pending):
    monkeypatch.setattr(B, "PENDING", pending)
    rows = table()
    df = frame(spark, rows)
    t = B.Trial("t", ["a", "b", "c"], rounds=25, rate=0.5, depth=3, alpha=0.5, lambda_=1.5, min_child=5)
    edges = B.quantile_edges(df.filter("NOT val"), t.features)
    errors, after = plain(rows, edges, t)
    for patience in (3, 100):
        model = B.fit_many(df, [t], "y", "val", patience)[0]
        best = 0
        for i, e in enumerate(errors):  # the rule: stop after ``patience`` iterations without a better one
            if e < errors[best]:
                best = i
            if i - best >= patience:
                break
        assert model.n_trees == best + 1 and len(model.errors) == i + 1
        np.testing.assert_allclose(model.errors, errors[:i + 1], rtol=1e-5)
        got = model.predict(np.array([r[:3] for r in rows]))
        np.testing.assert_allclose(got, after[best], atol=1e-5)


def test_many_trials_equal_single_ones_on_any_partitions(spark, monkeypatch):
    monkeypatch.setattr(B, "TASK_ROWS", 200)  # several tasks
    monkeypatch.setattr(B, "BLOCK_FEATURES", 2)
    rows = table()
    trials = [B.Trial("leaves", ["a", "b", "c"], rounds=6, depth=8, leaves=6, min_child=4, row_fraction=0.7),
              B.Trial("same", ["a", "c"], rounds=9, depth=3, symmetric=True, temperature=1.0, noise=0.5),
              B.Trial("deep", ["b"], rounds=4, depth=9, feature_fraction=0.5, alpha=1.0)]
    together = B.fit_many(frame(spark, rows, 5), trials, "y", "val", 4)
    monkeypatch.setattr(B, "TASK_ROWS", 1 << 15)
    for t, model in zip(trials, together):
        alone = B.fit_many(frame(spark, rows, 1), [t], "y", "val", 4)[0]
        assert alone.to_json() == model.to_json()
        assert B.Booster.from_json(model.to_json()) == model
        for tree in model.trees:
            if t.leaves:
                assert tree.feature.count(-1) <= t.leaves
            if t.symmetric:  # one split a level
                splits, level = [], [0]
                while level:
                    inner = [n for n in level if tree.feature[n] >= 0]
                    splits.append({(tree.feature[n], tree.bin[n]) for n in inner})
                    level = [c for n in inner for c in (tree.left[n], tree.left[n] + 1)]
                assert all(len(s) <= 1 for s in splits)


def test_score_and_odd_tables(spark):
    df = frame(spark, table())
    t = B.Trial("t", ["a", "b"], rounds=3, depth=2)
    model = B.fit_many(df, [t], "y")[0]
    out = B.score(df.withColumn("t", F.lit("old")), {"t": model, "u": model})
    r = out.first()
    assert out.columns == ["a", "b", "c", "y", "val", "t", "u"] and r.t == r.u
    assert r.t == pytest.approx(model.predict(np.array([[r.a, r.b]]))[0])
    empty = B.fit_many(df.limit(0), [t], "y")[0]
    assert empty.n_trees == 0 and empty.transform(df.limit(0)).count() == 0
    same = df.withColumn("y", F.lit(2.0)).withColumn("a", F.lit(1.0)).withColumn("b", F.lit(None).cast("double"))
    assert {r.t for r in B.fit_many(same, [t], "y")[0].transform(same).collect()} == {2.0}


def test_a_small_frame_starts_no_pass_a_level(spark, monkeypatch):
    rows = table(300)
    trials = [B.Trial("a", ["a", "b", "c"], rounds=18, depth=3), B.Trial("s", ["a", "c"], rounds=3, depth=2, symmetric=True, temperature=1.0, noise=1.0)]
    monkeypatch.setattr(B, "TASK_ROWS", 100)
    passes = B.fit_many(frame(spark, rows), trials, "y", "val", 2)
    monkeypatch.setattr(B, "TASK_ROWS", 1 << 15)
    monkeypatch.setattr(B, "level", None)
    for got, want in zip(B.fit_many(frame(spark, rows), trials, "y", "val", 2), passes):
        assert got.to_json() == want.to_json() and got.n_trees > 1
