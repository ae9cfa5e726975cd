"""The trained classifiers' scores against forward passes written out plainly."""
import math
import zlib

import numpy as np
import pytest

from barwise.llm import language_id, quality_classifier

TEXTS = ["Das ist ein Satz mit Wörtern.", "A short one.", "x", "日本 語 text", "ab " * 900, "same same same word", "long" * 40 + " tail", "",
         None, "1 2 3", "Ünï " * 200 + "end"]


def network():
    rng = np.random.default_rng(2)
    langs = ["de", "en", "fr"]
    classes = rng.integers(1, language_id.CLASSES, 256).astype(np.uint8)
    classes[0] = 0
    n = language_id.FILTERS * len(language_id.WIDTHS)
    taps = {w: rng.normal(size=(w, language_id.CLASSES, language_id.FILTERS)).astype(np.float32) for w in language_id.WIDTHS}
    return language_id.Network(langs, classes, taps, rng.normal(size=n).astype(np.float32),
                               rng.normal(size=(n, 3)).astype(np.float32), rng.normal(size=3).astype(np.float32))


def plain_language(net, text):
    """Mean log probabilities of a text's windows, every place and tap on its own."""
    raw = text.encode()
    total = np.zeros(len(net.langs))
    for at in range(0, max(1, len(raw)), language_id.WINDOW):
        window = raw[at:at + language_id.WINDOW]
        codes = [int(net.classes[b]) for b in window.ljust(language_id.WINDOW, b"\0")] + [0] * 3
        hidden = []
        for w, taps in net.taps.items():
            for f in range(language_id.FILTERS):
                hidden.append(max(sum(float(taps[k, codes[i + k], f]) for k in range(w)) for i in range(language_id.WINDOW)))
        hidden = [max(0.0, h + float(b)) for h, b in zip(hidden, net.bias)]
        z = [sum(h * float(net.out[j, k]) for j, h in enumerate(hidden)) + float(net.out_bias[k]) for k in range(len(net.langs))]
        top = max(z) + math.log(sum(math.exp(x - max(z)) for x in z))
        total += np.array([x - top for x in z]) * max(1, len(window)) / language_id.WINDOW
    return total


def test_language_forward_pass(spark):
    net = network()
    rows = [(i, t, "kept", 0.5) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows + rows[:2], "doc_id long, text string, lang_pred string, score double")
    got = language_id.identify(df, net).collect()
    assert len(got) == len(rows) + 2
    for r in got:
        if not r["text"] or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        logs = plain_language(net, r["text"])
        p = np.exp(logs - logs.max())
        assert r["lang_pred"] == net.langs[int(logs.argmax())]
        assert r["score"] == pytest.approx(p.max() / p.sum(), rel=1e-3)


def test_quality_forward_pass(spark):
    q = quality_classifier
    rng = np.random.default_rng(1)
    model = q.Model(rng.normal(size=q.BUCKETS + 1), 0.3)
    df = spark.createDataFrame([(i, t, 1.0, "p") for i, t in enumerate(TEXTS)] + [(None, "x", 2.0, "p")],
                               "doc_id long, text string, score double, predicted string")
    got = {r["doc_id"]: r for r in q.score(df, model).collect()}
    for i, t in [*enumerate(TEXTS), (None, "x")]:
        words, ids = (t or "").encode().split(), []
        for w in words:
            marked = b"<" + w + b">"
            ids.append(zlib.crc32(w) % q.BUCKETS)
            ids += [zlib.crc32(marked[k:k + n], n) % q.BUCKETS for n in q.GRAMS for k in range(len(marked) - n + 1)]
        ids += [q.REPEAT] * q.REPEAT_TIMES * sum(a == b for a, b in zip(words, words[1:]))
        z = 0.3 + (sum(float(model.margins[k]) for k in ids) / len(ids) if ids else 0.0)
        p = 1 / (1 + math.exp(-z))
        assert got[i]["score"] == pytest.approx(p, abs=1e-9) and got[i]["predicted"] == int(p >= 0.7)
