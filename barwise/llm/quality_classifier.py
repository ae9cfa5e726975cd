"""Quality scores by supervised subword embeddings.

A word's features are itself and its character n-grams, each hashed to a
learned vector; one more vector stands for a word that repeats the one before
it. A document is the average over all its features, and a softmax
gives the probability of label 1. Vectors and output layer are trained
together by stochastic gradient descent in numpy.

At scoring time the output layer is linear in the average, so every word is
reduced to two remembered numbers: the sum of its features' margins and their
number. Empty and null texts score the bias alone. Null labels and ids train
nothing. Repeated rows are scored each on its own; a document with several
labels trains with each. Extra columns and clashing names are ignored.
"""

from __future__ import annotations

import operator
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out_remainder, small_batches, strings, text_words

BUCKETS = 1 << 17
DIM = 12
GRAMS = (2, 3, 4)
#: Labelled documents in the training sample, about, half of each label if
#: there are so many.
SAMPLE_DOCS = 4000
#: Words of a training text that one step looks at, a run at a random place.
STEP_WORDS = 150
EPOCHS, RATE = 4, 0.5
REMEMBERED = 400_000
#: Bytes above which a word's n-grams are hashed together and not remembered.
LONG = 64
#: Table of the checksum, a byte at a time.
CRC = np.arange(256, dtype=np.uint32)
for _ in range(8):
    CRC = (CRC >> 1) ^ np.where(CRC & 1, np.uint32(0xEDB88320), np.uint32(0))


#: The bucket of a word that repeats the one before it, and how often it counts.
REPEAT, REPEAT_TIMES = BUCKETS, 10


def repeats(words: list[bytes]) -> int:
    return sum(map(operator.eq, words, words[1:]))


def long_features(word: bytes) -> np.ndarray:
    """``features``, over all bytes at once."""
    marked = np.frombuffer(b"<" + word + b">", np.uint8).astype(np.uint32)
    out = [np.array([zlib.crc32(word) % BUCKETS])]
    for n in GRAMS:
        crc = np.full(len(marked) - n + 1, n ^ 0xFFFFFFFF, np.uint32)
        for k in range(n):
            crc = CRC[(crc ^ marked[k:k + len(crc)]) & 0xFF] ^ (crc >> 8)
        out.append(((crc ^ 0xFFFFFFFF) % BUCKETS).astype(np.int64))
    return np.concatenate(out)


def features(word: bytes) -> list[int] | np.ndarray:
    """Buckets of a word and of its n-grams, with marks at both ends."""
    if len(word) > LONG:
        return long_features(word)
    marked = b"<" + word + b">"
    return [zlib.crc32(word) % BUCKETS] + [
        zlib.crc32(marked[i:i + n], n) % BUCKETS for n in GRAMS for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    margins: np.ndarray  # of a feature: its vector times the output layer
    bias: float

    def scorer(self) -> "Words":
        return Words(self.margins)


class Words(dict):
    """word -> (sum of margins) + (number of features) i: one sum over a text
    adds up both."""

    def __init__(self, margins: np.ndarray):
        super().__init__()
        self.margins = margins

    def __missing__(self, word: bytes) -> complex:
        f = features(word)
        value = complex(float(self.margins[f].sum()), len(f))
        if len(word) <= LONG and len(self) < REMEMBERED:
            self[word] = value
        return value


def train(texts: list[list[bytes]], labels: list[int], prior: float | None = None, seed: int = 11) -> Model:
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (BUCKETS + 1, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    known: dict[bytes, np.ndarray] = {}
    y = np.array(labels)
    by = [np.flatnonzero(y == k) for k in (0, 1)]
    steps = EPOCHS * len(texts)
    for step in range(steps):
        side = by[step % 2] if len(by[0]) and len(by[1]) else np.arange(len(y))
        i = int(side[rng.integers(0, len(side))])
        words = texts[i]
        if not words:
            continue
        n = min(len(words), STEP_WORDS if rng.random() < 0.7 else int(rng.integers(1, 20)))
        at = int(rng.integers(0, len(words) - n + 1))
        ids = []
        for w in words[at:at + n]:
            if (f := known.get(w)) is None:
                f = np.array(features(w))
                if len(w) <= LONG:
                    known[w] = f
            ids.append(f)
        ids.append(np.full(REPEAT_TIMES * repeats(words[at:at + n]), REPEAT))
        ids = np.concatenate(ids)
        h = vectors[ids].mean(0)
        z = h @ out + bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[y[i]] -= 1
        rate = RATE * (1 - step / steps)
        np.add.at(vectors, ids, (-rate / len(ids)) * (out @ p))
        out -= rate * np.outer(h, p)
        bias -= 0.1 * rate * p
    # the steps saw both labels equally often; the bias takes their real odds
    odds = np.log(len(by[1]) / len(by[0])) if len(by[0]) and len(by[1]) and prior is None else prior or 0.0
    return Model(vectors @ (out[:, 1] - out[:, 0]), float(bias[1] - bias[0] + odds))


def fit(docs: DataFrame, labels: DataFrame, fold: int = 4, held_out: int = 2) -> Model | None:
    """Train on a bounded sample of labelled documents outside the held-out
    fold, picked by the hash of their ids."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .filter(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull())
             .filter(held_out_remainder(fold) != held_out))
    counts = {r["quality"]: r["count"] for r in known.groupBy("quality").count().collect()}
    if not counts:
        return None
    share = F.coalesce(*[F.when(F.col("quality") == k, F.lit(min(1.0, SAMPLE_DOCS / 2 / n))) for k, n in counts.items()])
    some = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 20)) < share * (1 << 20))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # ids only, and no more than the limit: a bounded broadcast, so that no text is shuffled
    got = (texts.join(F.broadcast(some.limit(2 * SAMPLE_DOCS)), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "text")
           .limit(2 * SAMPLE_DOCS).toLocalIterator())
    words, y = [], []
    for r in got:
        words.append(text_words(r["text"]))
        y.append(r["quality"])
    prior = float(np.log(counts[1] / counts[0])) if len(counts) == 2 else None
    return train(words, y, prior) if y else None


def score(docs: DataFrame, model: Model | None, threshold: float = 0.7) -> DataFrame:
    """(doc_id, score, predicted) of every whole text."""
    small_batches(docs.sparkSession)
    ids = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    if model is None:
        return ids.select("doc_id", F.lit(0.5).alias("score"), F.lit(int(0.5 >= threshold)).alias("predicted"))

    def run(batches):
        words = model.scorer()
        repeated = REPEAT_TIMES * complex(float(model.margins[REPEAT]), 1)
        for batch in batches:
            total = []
            for t in strings(batch.column(1)):
                w = text_words(t)
                total.append(sum(map(words.__getitem__, w), 0j) + repeated * repeats(w))
            total = np.array(total, complex)
            z = model.bias + total.real / np.maximum(total.imag, 1)
            p = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return ids.mapInArrow(run, "doc_id long, score double, predicted int")
