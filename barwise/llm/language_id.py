"""Language ID by a byte convolutional network.

Filters of several widths slide over byte classes, each filter's maximum over
a window of fixed length feeds a softmax over the languages. The network is
trained in numpy on windows of a bounded sample of labelled texts; every whole
text is then cut into windows, scored in batches, and the windows' log
probabilities are added up.

A text that is null or has no letter is ``und`` with score 0. Rows with null
labels or ids train nothing (a null id is never held out, its label may be
used). Ties go to the first language by name. Without any labelled row every
text is ``und``. Repeated rows and extra columns change nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_chunks, held_out_remainder, renamed, small_batches, strings

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 10
CLASSES = 64
#: Labelled texts of each language that the sample holds, about; of each,
#: ``SAMPLE_WINDOWS`` windows at hashed places.
SAMPLE_TEXTS = 800
SAMPLE_WINDOWS = 3
STEPS, BATCH, RATE = 500, 96, 0.01
#: Windows scored at once.
CHUNK = 64


@dataclass
class Network:
    langs: list[str]
    classes: np.ndarray  # 256 -> byte class
    taps: dict[int, np.ndarray]  # width -> [width, CLASSES, FILTERS]
    bias: np.ndarray  # of all filters
    out: np.ndarray  # [filters, langs]
    out_bias: np.ndarray

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """The filters as tables of pairs of byte classes: the pair at a place
        gives the first two taps of every width, the pair two places on the
        rest (widths 2, 3 and 4)."""
        first = [t[0][:, None, :] + t[1][None, :, :] for t in self.taps.values()]
        zero = np.zeros((1, FILTERS), np.float32)
        rest = []
        for w, t in self.taps.items():
            if w > 2:
                a, b = t[2], t[3] if w > 3 else zero
                rest.append(np.broadcast_to(a[:, None, :] + b[None, :, :], (CLASSES, CLASSES, FILTERS)))
        flat = lambda x: np.ascontiguousarray(np.concatenate(x, 2).reshape(CLASSES * CLASSES, -1))
        return flat(first), flat(rest)

    def log_probs(self, windows: np.ndarray, tables) -> np.ndarray:
        """[windows, langs] of byte classes [windows, WINDOW + 3]."""
        first, rest = tables
        c = windows.astype(np.int32)
        pair = c[:, :-1] * CLASSES + c[:, 1:]
        z = first[pair[:, :WINDOW]]
        z[:, :, FILTERS:] += rest[pair[:, 2:WINDOW + 2]]
        return self.head(z.max(1))

    def head(self, top: np.ndarray) -> np.ndarray:
        x = np.maximum(top + self.bias, 0) @ self.out + self.out_bias
        x -= x.max(1, keepdims=True)
        return x - np.log(np.exp(x).sum(1, keepdims=True))

    def score(self, texts: list[bytes]) -> np.ndarray:
        """[texts, langs]: mean log probability per window, weighted by its
        bytes; the last window of a text may be shorter."""
        tables, total = self.pairs(), np.zeros((len(texts), len(self.langs)))
        counts = [max(1, -(-len(t) // WINDOW)) for t in texts]
        owner = np.repeat(np.arange(len(texts)), counts)
        padded = b"".join([t.ljust(n * WINDOW, b"\0") for t, n in zip(texts, counts)])
        codes = self.classes[np.frombuffer(padded, np.uint8)].reshape(-1, WINDOW)
        last = np.cumsum(counts) - 1
        size = np.full(len(owner), WINDOW, float)
        size[last] = [max(1, len(t) - (n - 1) * WINDOW) for t, n in zip(texts, counts)]
        logs = np.empty((len(owner), len(self.langs)))
        for i in range(0, len(owner), CHUNK):
            logs[i:i + CHUNK] = self.log_probs(np.pad(codes[i:i + CHUNK], ((0, 0), (0, 3))), tables)
        np.add.at(total, owner, logs * (size / WINDOW)[:, None])
        return total


def train(texts: list[bytes], labels: list[str], seed: int = 7) -> Network:
    """Fit the network to windows; random cuts teach it short texts. Classes
    are the most frequent bytes, A-Z taken as a-z; class 0 is padding."""
    rng = np.random.default_rng(seed)
    langs = sorted(set(labels))
    fold = np.arange(256)
    fold[65:91] += 32
    often = np.bincount(fold[np.frombuffer(b"".join(texts), np.uint8)], minlength=256)
    often[0] = 0
    classes = np.full(256, CLASSES - 1, np.uint8)
    top = [b for b in np.argsort(-often, kind="stable")[:CLASSES - 2] if often[b]]
    classes[top] = np.arange(1, len(top) + 1)
    classes[0] = 0
    classes[65:91] = classes[97:123]
    y = np.array([langs.index(x) for x in labels])
    codes = np.zeros((len(texts), WINDOW), np.uint8)
    for i, t in enumerate(texts):
        codes[i, :len(t[:WINDOW])] = classes[np.frombuffer(t[:WINDOW], np.uint8)]
    sizes = np.array([min(len(t), WINDOW) for t in texts])
    by_lang = [np.flatnonzero(y == k) for k in range(len(langs))]
    n_f = FILTERS * len(WIDTHS)
    net = Network(langs, classes, {w: rng.normal(0, 0.3, (w, CLASSES, FILTERS)).astype(np.float32) for w in WIDTHS},
                  np.zeros(n_f, np.float32), rng.normal(0, 0.3, (n_f, len(langs))).astype(np.float32),
                  np.zeros(len(langs), np.float32))
    params = [*net.taps.values(), net.bias, net.out, net.out_bias]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, STEPS + 1):
        pick = np.array([rng.choice(by_lang[k]) for k in rng.integers(0, len(langs), BATCH)])
        x = np.zeros((BATCH, WINDOW + 3), np.uint8)
        for r, i in enumerate(pick):  # half of them are cut to a random length
            n = sizes[i] if rng.random() < 0.5 else min(sizes[i], int(rng.integers(4, 80)))
            at = int(rng.integers(0, sizes[i] - n + 1))
            x[r, :n] = codes[i, at:at + n]
        tops, where = [], []
        for w, t in net.taps.items():
            z = sum(t[j][x[:, j:WINDOW + j]] for j in range(w))
            where.append(z.argmax(1))
            tops.append(np.take_along_axis(z, where[-1][:, None, :], 1)[:, 0])
        h = np.maximum(np.concatenate(tops, 1) + net.bias, 0)
        logits = h @ net.out + net.out_bias
        p = np.exp(logits - logits.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        p[np.arange(BATCH), y[pick]] -= 1
        p /= BATCH
        dh = (p @ net.out.T) * (h > 0)
        grads = []
        for k, w in enumerate(WIDTHS):
            g = np.zeros_like(net.taps[w])
            d = dh[:, k * FILTERS:(k + 1) * FILTERS]
            rows, cols = np.arange(BATCH)[:, None], np.arange(FILTERS)[None, :]
            for j in range(w):
                np.add.at(g[j], (x[rows, where[k] + j], np.broadcast_to(cols, d.shape)), d)
            grads.append(g)
        grads += [dh.sum(0), h.T @ p, p.sum(0)]
        for i, (q, g) in enumerate(zip(params, grads)):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.99 * v[i] + 0.01 * g * g
            q -= (RATE * (m[i] / (1 - 0.9 ** step)) / (np.sqrt(v[i] / (1 - 0.99 ** step)) + 1e-8)).astype(q.dtype)
    return net


def training_windows(docs: DataFrame, fold: int = 3, held_out: int = 1) -> tuple[list[bytes], list[str]]:
    """Windows of about ``SAMPLE_TEXTS`` labelled texts of each language, picked
    by the hash of their ids; whatever the input, so many reach the driver."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & (held_out_remainder(fold) != held_out) & F.col("text").rlike("\\p{L}"))
    counts = rows.groupBy("lang").count().collect()
    if not counts:
        return [], []
    share = F.coalesce(*[F.when(F.col("lang") == r["lang"], F.lit(min(1.0, SAMPLE_TEXTS / r["count"]))) for r in counts])
    some = rows.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < share * (1 << 20))
    at = [F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(F.length("text") - WINDOW // 2, F.lit(1))) + 1
          for k in range(SAMPLE_WINDOWS)]
    cut = some.select("lang", F.xxhash64("doc_id", "lang").alias("k"), F.explode(F.array(
        *[F.col("text").substr(a.cast("int"), F.lit(WINDOW)) for a in at])).alias("w"))
    got = cut.orderBy("k", "w").limit(4 * SAMPLE_TEXTS * SAMPLE_WINDOWS * len(counts)).collect()
    return [r["w"].encode("utf-8") for r in got], [r["lang"] for r in got]


def has_letter() -> F.col:
    return F.coalesce(F.col("text").cast("string").rlike("\\p{L}"), F.lit(False))


def keep_known(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose language the network tells, after learning from
    their own labels; where there are none, those that have a letter."""
    network = fit(docs)
    if network is None:
        return docs.filter(has_letter())
    rows, names = renamed(docs)
    return identify(rows, network).filter("lang_pred != 'und'").select(rows.columns).toDF(*names)


def identify(docs: DataFrame, network: Network | None) -> DataFrame:
    """All columns of ``docs``, with lang_pred and score instead of any of that
    name; the score is the probability of lang_pred."""
    small_batches(docs.sparkSession)
    rest = [c for c in docs.columns if c not in ("lang_pred", "score", "_letters")]
    if network is None:
        return docs.select(*rest).withColumn("lang_pred", F.lit("und")).withColumn("score", F.lit(0.0))

    def run(batches):
        for batch in batches:
            letters = batch.column(batch.num_columns - 1).to_pylist()
            texts = strings(batch.column(at))
            logs = np.concatenate([np.zeros((0, len(network.langs)))] + [
                network.score([t.encode("utf-8", "surrogatepass") if t and ok else b"" for t, ok in zip(texts[part], letters[part])])
                for part in byte_chunks(texts)])
            best = logs.argmax(1)
            p = np.exp(logs - logs.max(1, keepdims=True))
            p = p.max(1) / p.sum(1)
            lang = [network.langs[k] if ok else "und" for k, ok in zip(best, letters)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(lang, pa.string()), pa.array(np.where(letters, p, 0.0), pa.float64())],
                [*batch.schema.names[:-1], "lang_pred", "score"])

    at = rest.index("text")
    wide = docs.select(*rest, has_letter().alias("_letters"))
    schema = docs.select(*rest).schema.add("lang_pred", "string").add("score", "double")
    return wide.mapInArrow(run, schema)


def fit(docs: DataFrame, fold: int = 3, held_out: int = 1) -> Network | None:
    texts, labels = training_windows(docs, fold, held_out)
    return train(texts, labels) if texts else None
