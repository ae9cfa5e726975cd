"""Ball-tree search against plain scoring of every document."""
import math
import re
from collections import Counter

import numpy as np
import pytest

from barwise.llm import ball_tree_search as bt

SCHEMA = "doc_id long, text string, item int, n long, score string, terms string, rank int"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=20):
    docs = [(i, split(t)) for i, t in docs if split(t)]
    n_docs, total = len(docs), sum(len(w) for _, w in docs)
    df = Counter(t for _, w in docs for t in set(w))
    out = {}
    for item, text in items:
        rows = []
        for i, w in docs:
            tf, m = Counter(w), 75 + 25 * len(w) * n_docs // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m))
                        for t in split(text) if tf[t])
            if score > 0:
                rows.append((-score, i is None, i or 0))
        out[item] = [(r, None if null else i, -s) for r, (s, null, i) in enumerate(sorted(rows)[:k], 1)]
    return out


def tables():
    rng = np.random.default_rng(4)
    vocab = [f"W{i}" for i in range(400)] + ["É", "日本", "a_b", "x.y", " z"]
    p = 1 / np.arange(1, len(vocab) + 1)
    p /= p.sum()
    texts = [" ".join(rng.choice(vocab, rng.integers(1, 120), p=p)) for _ in range(900)]
    texts[300:600] = [texts[3]] * 300  # a third of all rows are copies
    texts += ["", None, " .,; ", " ".join(rng.choice(vocab, 50_000, p=p)), "w1", "W1 w1 W1"]
    docs = list(enumerate(texts)) + [(5, texts[7]), (None, texts[3]), (None, texts[9])]
    items = [(i, " ".join(rng.choice(vocab, 12, p=p))) for i in range(25)]
    items += [(100, texts[3]), (101, None), (102, ""), (103, "nowhere else"), (104, "w1, w1; W1"), (105, texts[20] + " nowhere")]
    return docs, items


def frames(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, 2, "s", "t", 3) for i, t in docs], SCHEMA).repartition(3)
    return d, spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, doc_id int")


def grouped(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: r["rank"]):
        out.setdefault(r["item_id"], []).append((r["rank"], r["doc_id"], r["score"]))
    return out


@pytest.mark.parametrize("shard, pass_bytes", [(1 << 20, 4 << 20), (3000, 2000)])
def test_search(spark, monkeypatch, shard, pass_bytes):
    monkeypatch.setattr(bt, "SHARD_TERMS", shard)
    monkeypatch.setattr(bt, "PASS_BYTES", pass_bytes)
    docs, items = tables()
    got = grouped(bt.search(*frames(spark, docs, items)))
    want = brute(docs, items)
    assert got == {i: rows for i, rows in want.items() if rows}


@pytest.mark.parametrize("leaf, dense", [(2, 1 << 22), (2, 100), (16, 1 << 22)])
def test_bounds_and_pruning(monkeypatch, leaf, dense):
    monkeypatch.setattr(bt, "DENSE", dense)
    rng = np.random.default_rng(6)
    sizes = rng.integers(1, 30, 700)
    sizes[200:500] = sizes[200]
    rows = [np.sort(rng.choice(60, s, replace=False)) for s in sizes]
    x = [rng.integers(1, 10**6, s) for s in sizes]
    rows[200:500], x[200:500] = [rows[200]] * 300, [x[200]] * 300
    tree = bt.BallTree(sizes, np.concatenate(rows), np.concatenate(x), 60, leaf)
    term, q = np.array([1, 5, 20, 33]), np.array([4000, 9000, 12, 7000])
    exact = np.array([(q * [dict(zip(r, v)).get(t, 0) for t in term]).sum() for r, v in zip(rows, x)])[tree.order]
    bounds, leaves = tree.bounds(term, q), 1 << tree.depth
    for level in range(tree.depth + 1):
        edge = np.arange((1 << level) + 1) * len(sizes) >> level
        top = np.maximum.reduceat(exact, edge[:-1])
        assert (bounds[(1 << level) - 1:(2 << level) - 1] >= top).all()
    for i in range(leaves):
        assert (tree.scores(i, term, q) == exact[tree.bound[i]:tree.bound[i + 1]]).all()
    best = bt.Best(5)
    seen = bt.look(tree, tree.order, np.zeros(700, bool), (term, q), best)
    assert sorted(zip(-exact, tree.order))[:5] == list(zip(-best.score, best.id)) and seen < leaves


def test_empty(spark):
    docs, items = tables()
    d, i = frames(spark, docs, items)
    assert bt.search(d.limit(0), i).count() == 0 and bt.search(d, i.limit(0)).count() == 0
