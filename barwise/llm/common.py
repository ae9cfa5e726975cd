"""Helpers shared by the corpus operators."""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barwise.session import checkpoint_dir

#: Rows in an Arrow batch handed to a Python worker, unless the session names
#: its own: texts may be long, so fewer than Spark's default of 10,000.
BATCH_ROWS = 2000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Bits of ``only_keys``' map for each key, and at most: 32 MB to broadcast.
KEY_BITS, MOST_BITS = 16, 1 << 28

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    if spark.conf.get(ARROW_ROWS, "10000") == "10000":
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df``: its rows go to the shared checkpoint folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def tokenizer_path(name: str) -> str:
    """Where a public tokenizer's file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def single_thread_tokenizers() -> None:
    """A Spark task owns one core; the tokenizer library must not start more."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def key_map(df: DataFrame, keys: DataFrame, col: str) -> DataFrame:
    """``df`` with ``_may``: whether ``col`` may be in ``keys``. The keys are
    hashed into a bit map of ``KEY_BITS`` bits for each, so that one of 16 other
    keys is taken for one of them; a map never exceeds ``MOST_BITS`` bits, with
    more errors and none lost. It is broadcast in pieces of 4 kB, which the hash
    finds by a join."""
    n = keys.agg(F.approx_count_distinct(col)).first()[0]
    bits = min(MOST_BITS, 1 << max(15, (KEY_BITS * n - 1).bit_length()))
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(bits)) + 1
    maps = (keys.select(place(F.col(col)).alias("_place")).groupBy(F.bitmap_bucket_number("_place").alias("_piece"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_place")).alias("_map")))
    bit = F.bitmap_bit_position(F.col("_place"))
    byte = F.conv(F.hex(F.substring(F.col("_map"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    may = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    placed = df.withColumn("_place", place(F.col(col)))
    return (placed.withColumn("_piece", F.bitmap_bucket_number("_place")).join(F.broadcast(maps), "_piece", "left")
            .withColumn("_may", may).drop("_piece", "_place", "_map"))


def only_keys(df: DataFrame, keys: DataFrame, col: str) -> DataFrame:
    """Rows of ``df`` whose ``col`` may be in ``keys``: none of those in it is
    lost, some others stay. Wide rows of ``df`` that surely don't match never
    reach a shuffle."""
    return key_map(df, keys, col).filter("_may").drop("_may")


def without_keys(df: DataFrame, keys: DataFrame, col: str) -> DataFrame:
    """The rows that ``only_keys`` leaves out."""
    return key_map(df, keys, col).filter("NOT _may").drop("_may")


def renamed(df: DataFrame, prefix: str = "_c") -> tuple[DataFrame, list[str]]:
    """``df`` with its columns but doc_id and text renamed by number, so that no
    name clashes with a helper column, and the names to go back to. The last
    ``doc_id`` or ``text`` that a case-insensitive lookup finds is the one used."""
    names = [c if c in ("doc_id", "text") else f"{prefix}{i}" for i, c in enumerate(df.columns)]
    return df.toDF(*names), list(df.columns)


def held_out_remainder(n: int) -> F.col:
    """crc32(doc_id as text) mod n; a null id counts as the text ''."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(n))


def text_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8. ``bytes.split`` splits on exactly
    those six characters."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, bound: int = 200_000):
        super().__init__()
        self.bound = bound

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = xxhash.xxh3_64_intdigest(word)
        if len(self) < self.bound:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def grams(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` values, in order: a polynomial in a fixed odd
    base (by doubling: the hash of a run of a+b follows from its two parts),
    then mixed."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    base, mask = 0x9E3779B97F4A7C15, (1 << 64) - 1
    power = lambda e: np.uint64(pow(base, e, 1 << 64) & mask)
    out, have = None, 0
    block, size = hashes, 1
    while True:
        if k & size:
            if out is None:
                out, have = block, size
            else:  # ``block`` follows the ``have`` values already hashed
                m = min(len(out), len(block) - have)
                out = out[:m] * power(size) + block[have:have + m]
                have += size
        if have == k:
            return mix64(out[:n])
        block = block[:len(block) - size] * power(size) + block[size:]
        size *= 2


def strings(column) -> list:
    return column.cast(pa.string()).to_pylist()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Connected components of an undirected graph given by rows (a, b) of
    longs. Returns (node, component): the smallest node that it reaches.

    Rounds of large-star and small-star: every node is tied to the least
    neighbour it knows, until nothing changes. Each round is two group-bys and
    joins of the edges (AQE splits a hot node's join), the edges never exceed
    their first number, and a round's result is checkpointed. Nothing but a
    checksum comes to the driver."""
    def star(e: DataFrame, small: bool) -> DataFrame:
        # rows (u, v): v a neighbour of u, either all or only those below u
        both = e if small else e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"))
        least = least.withColumn("m", F.least("m", "u"))
        near = both.join(least, "u")
        if small:
            out = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
                least.select("u", F.col("m").alias("v")))
        else:
            out = near.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        return out.filter(F.col("u") != F.col("v")).select(
            F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    e = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
         .filter(F.col("u") != F.col("v")).distinct())
    last = None
    while True:
        e = checkpointed(star(star(e, small=False), small=True))
        now = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == last:
            break
        last = now
    return (e.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()))


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of bytes in a byte-level vocabulary: printable
    Latin-1 characters stand for themselves, the rest, in order, for 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


#: Below this character two regular-expression libraries agree on letters.
PLAIN = "\u0250"


class Merges:
    """Token ids of single pre-tokens by the merges of a byte-level vocabulary.

    The merging itself is tiktoken's, which takes the adjacent pair of least
    rank, as the vocabulary's own library does, but costs a tenth. With a
    word-end suffix, the last byte of a word is a symbol of its own: symbols
    are then spelled as two bytes of disjoint ranges, so that both bytes of a
    symbol join first and nothing else can join across them."""

    def __init__(self, tokenizer, end: str = ""):
        import tiktoken

        letters = byte_letters()
        self.inner = [bytes([0x80 + (b >> 4), b & 15]) if end else bytes([b]) for b in range(256)]
        self.last = [bytes([0x90 + (b >> 4), b & 15]) for b in range(256)] if end else self.inner
        special = {t.content for t in tokenizer.get_added_tokens_decoder().values()}
        ranks = {}
        for token, rank in tokenizer.get_vocab(with_added_tokens=True).items():
            if token in special:
                continue
            ended = bool(end) and token.endswith(end)
            raw = [letters[c] for c in (token.removesuffix(end) if ended else token)]
            ranks[self.spelled(raw, ended)] = rank
        if end:  # single bytes never stay alone; they only need some rank
            top = len(ranks) + len(special)
            ranks |= {bytes([b]): top + b for b in range(256) if bytes([b]) not in ranks}
        self.bpe = tiktoken.Encoding("merges", pat_str=r"\S+", mergeable_ranks=ranks, special_tokens={})._core_bpe

    def spelled(self, raw, ended: bool) -> bytes:
        if not raw:
            return b""
        return b"".join([self.inner[b] for b in raw[:-1]]) + (self.last if ended else self.inner)[raw[-1]]

    def ids(self, pre_token: str) -> list[int]:
        raw = pre_token.encode("utf-8")
        return self.bpe.encode_single_piece(raw if self.last is self.inner else self.spelled(raw, True))


def byte_chunks(texts: list[str | None], limit: int = 1 << 20, rows: int = 4096):
    """Slices of a batch with about ``limit`` characters at most, so that a
    batch of very long texts doesn't need all its arrays at once."""
    at = size = 0
    for i, t in enumerate(texts):
        n = len(t or "")
        if i > at and (size + n > limit or i - at >= rows):
            yield slice(at, i)
            at, size = i, 0
        size += n
    if at < len(texts):
        yield slice(at, len(texts))
