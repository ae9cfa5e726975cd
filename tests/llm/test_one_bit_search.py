"""One-bit search against brute force."""
import numpy as np
import pytest

from barwise.llm import one_bit_search as ob

SCHEMA = "vec_id long, embedding array<float>, label int, row int, cluster string, score string"


def brute(rows, k, every):
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows
            if v and None not in v and np.isfinite(v).all() and np.any(v)]
    dim = max((len(v) for _, v in rows), default=0)
    x = np.array([np.pad(v, (0, dim - len(v))) for _, v in rows])
    out = {}
    for n, (i, _) in enumerate(rows):
        if i is None or i % every:
            continue
        scores = (x * x[n]).sum(1)
        order = sorted((m for m in range(len(rows)) if m != n), key=lambda m: (-scores[m], rows[m][0] is None, rows[m][0] or 0))
        out.setdefault(i, []).append([(rows[m][0], scores[m]) for m in order[:k]])
    return out


def table(n=3000, dim=24):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(n, dim))
    x[:n // 3] = rng.normal(size=dim) * 3  # a third of all rows are copies
    x[n // 3:n // 2] = x[n // 3] * 2 + rng.normal(size=(n // 2 - n // 3, dim)) * 0.1
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    odd = [(None, x[5].tolist()), (20, x[9].tolist()), (40, None), (60, []), (80, [0.0] * dim), (100, [1.0, None] * (dim // 2)),
           (120, [float("nan")] + [1.0] * (dim - 1)), (140, [float("inf")] + [1.0] * (dim - 1)), (160, [1.0, 2.0]), (-20, x[7].tolist())]
    return rows + odd


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 1, "c", "s") for i, v in rows], SCHEMA).repartition(4)


def grouped(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    return out


@pytest.mark.parametrize("block", [8192, 200])
def test_all_reranked_is_exact(spark, monkeypatch, block):
    monkeypatch.setattr(ob, "BLOCK", block)
    monkeypatch.setattr(ob, "SLICE", 50)
    rows = table()
    want = brute(rows, 20, 20)
    got = grouped(ob.neighbours(frame(spark, rows), epsilon=float("inf")))
    assert got.keys() == want.keys()
    for q, lists in want.items():
        if len(lists) == 1:
            assert [r for r, *_ in got[q]] == list(range(1, 21))
            np.testing.assert_allclose([s for *_, s in got[q]], [s for _, s in lists[0]], rtol=1e-12)
            assert [v for _, v, _ in got[q]] == [v for v, _ in lists[0]]
        else:
            assert len(got[q]) == 20 * len(lists)


def test_recall(spark, monkeypatch):
    monkeypatch.setattr(ob, "BLOCK", 500)
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(4000, 64)))]
    df = frame(spark, rows)
    found, exact = ob.neighbours(df).persist(), ob.neighbours(df, epsilon=float("inf"))
    assert ob.recall(found, exact) >= 0.97
    by_id = dict(rows)
    for r in found.limit(200).collect():
        a, b = (np.array(by_id[r[c]], np.float32).astype(float) for c in ("query_id", "vec_id"))
        assert r["score"] == pytest.approx(a @ b, rel=1e-12)


def test_bound_holds():
    rng = np.random.default_rng(1)
    x, c, turn = rng.normal(size=(2000, 64)), rng.normal(size=64), ob.rotation(64)
    codes, length, own = ob.encode(x, c, turn)
    signs = np.unpackbits(codes, axis=1, count=64) * 2.0 - 1
    q = rng.normal(size=(50, 64))
    est = (q @ c)[:, None] + (q @ turn @ signs.T) * length / own / 8
    err = np.abs(est - q @ x.T)
    bound = np.linalg.norm(q, axis=1)[:, None] * length * np.sqrt(1 - own ** 2) / own * ob.EPSILON / np.sqrt(63)
    assert (err <= bound).mean() > 0.98


def test_few_and_none(spark):
    assert ob.neighbours(frame(spark, [])).count() == 0
    assert ob.neighbours(frame(spark, [(20, [1.0, 2.0])])).count() == 0
    got = grouped(ob.neighbours(frame(spark, [(20, [1.0, 2.0]), (3, [2.0]), (4, [1.0, 2.0]), (40, [1.0, 2.0])])))
    assert got[20] == [(1, 4, 5.0), (2, 40, 5.0), (3, 3, 2.0)]
