"""Best-fit packing of tokenized documents into sequences of fixed length.

Documents become token ids followed by a separator; only those longer than a
sequence are cut, into full pieces. Pieces are dealt by hash into blocks of
bounded size, and each block packs its own with a bounded-space best fit: a
fixed number of open bins, found through a bitset that has a bit for every
amount of free space. Long pieces come first within a block.

Nulls and empty texts are the separator alone. A null doc_id is carried.
Repeated rows are packed each on its own. Extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PLAIN, Merges, byte_chunks, checkpointed, single_thread_tokenizers, small_batches, strings, tokenizer_path

MAX_TOKENS = 2048
SEPARATOR = 0
#: Open bins of a block; one that doesn't fit closes the fullest.
OPEN_BINS = 16_384
#: Pieces of a block, on average.
BLOCK_PIECES = 65_536
#: Strings between spaces whose ids a worker remembers.
REMEMBERED = 300_000
#: Characters of the longest of them.
LONGEST = 64


#: Fixed value: the vocabulary's public pre-token pattern.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"


#: Characters from which on a text is left to the tokenizer.
ODD = re.compile(f"[{PLAIN}-\U0010ffff]")


def odd(text: str) -> bool:
    try:
        text.encode("latin-1")  # settles most texts, at a fraction of a search's cost
        return False
    except UnicodeEncodeError:
        return ODD.search(text) is not None


class ChunkIds(dict):
    """Ids of whole texts, from remembered ids of the strings between spaces.

    Exact for tokenizers whose tokens never hold or depend on white space and
    whose normalizer lower-cases: the ids of a text are those of its lower-case
    parts in order. Plain Latin parts are split into pre-tokens and merged here;
    any other is left to the tokenizer. Ids take 16 bits where the vocabulary
    allows, else 32."""

    def __init__(self, path: str):
        super().__init__()
        single_thread_tokenizers()
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Merges(self.tokenizer, WORD_END)
        self.pre_tokens = regex.compile(PRE_TOKEN).findall
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.width == 2 else "I"
        self.end = SEPARATOR.to_bytes(self.width, "little")

    def __missing__(self, part: str) -> bytes:
        if not part:
            return b""
        low = part.lower()
        if odd(low) or "<|" in part:
            ids = self.tokenizer.encode(part, add_special_tokens=False).ids
        else:
            ids = [i for p in self.pre_tokens(low) for i in self.merges.ids(p)]
        found = struct.pack(f"<{len(ids)}{self.code}", *ids)
        if len(self) < REMEMBERED and len(part) <= LONGEST:
            self[part] = found
        return found

    def parts(self, text: str | None) -> list[str]:
        text = (text or "").replace("\n", " ")
        if text and "<|" not in text and not odd(text):  # no special string, neither now nor in lower case
            text = text.lower()
        return text.split(" ")

    def encode(self, text: str | None) -> bytes:
        """Little-endian ids of a text, ``width`` bytes each."""
        return b"".join(map(self.__getitem__, self.parts(text)))


@lru_cache(maxsize=2)
def chunk_ids(name: str) -> ChunkIds:
    return ChunkIds(tokenizer_path(name))


def pieces(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """(doc_id, piece, start, length, ids): the documents' pieces, their ids in
    16 bits each where the vocabulary allows, else 32."""
    small_batches(docs.sparkSession)

    def cut(batches):
        known = chunk_ids(tokenizer)
        size = known.width * max_tokens
        for batch in batches:
            docs_of, texts = batch.column(0).to_pylist(), strings(batch.column(1))
            for part in byte_chunks(texts):
                out: list[tuple] = []
                for doc, text in zip(docs_of[part], texts[part]):
                    ids = known.encode(text) + known.end
                    for k, at in enumerate(range(0, len(ids), size)):
                        some = ids[at:at + size]
                        out.append((doc, k, at // known.width, len(some) // known.width, some))
                cols = list(zip(*out)) or [()] * 5
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                                 ["doc_id", "piece", "start", "length", "ids"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids binary")


def wide(df: DataFrame) -> DataFrame:
    """``df`` with all ids in 32 bits."""
    at, n = df.columns.index("ids"), df.columns.index("length")

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                some = batch.slice(start, 500)
                ids = [b if len(b) == 4 * k else np.frombuffer(b, "<u2").astype("<u4").tobytes()
                       for b, k in zip(some.column(at).to_pylist(), some.column(n).to_pylist())]
                yield some.set_column(at, "ids", pa.array(ids, pa.binary()))

    return df.mapInArrow(run, df.schema)


def best_fit(lengths: list[int], capacity: int, open_bins: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length, in the order given. The bins with equal
    free space are a stack; ``free`` has a bit for each stack that isn't empty,
    so the tightest bin that fits is the lowest bit from the length upwards."""
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    free = n_open = n_bins = 0
    bins, offsets = [], []
    for length in lengths:
        fits = free >> length
        if fits:
            room = length + (fits & -fits).bit_length() - 1
            b = stacks[room].pop()
            n_open -= 1
            if not stacks[room]:
                free ^= 1 << room
        else:
            room, b = capacity, n_bins
            n_bins += 1
        bins.append(b)
        offsets.append(capacity - room)
        room -= length
        if room:
            if not stacks[room]:
                free |= 1 << room
            stacks[room].append(b)
            n_open += 1
            if n_open > open_bins:
                fullest = (free & -free).bit_length() - 1
                stacks[fullest].pop()
                n_open -= 1
                if not stacks[fullest]:
                    free ^= 1 << fullest
    return bins, offsets


def pack(docs: DataFrame, tokenizer: str, max_tokens: int = MAX_TOKENS, open_bins: int = OPEN_BINS,
         block_pieces: int = BLOCK_PIECES, emit: str = "ids") -> DataFrame:
    """Pieces of ``docs`` with their ids, sequence_id and offset in it.

    The pieces are checkpointed once: the number of blocks follows from their
    number, and a lost executor doesn't bring back the tokenizer. Blocks are
    packed by lengths alone, so that no task holds a block's ids, and the places
    are joined back by row."""
    if emit != "ids":
        raise ValueError(f"emit: {emit!r}; only the ids themselves are returned")
    cut = checkpointed(pieces(docs, tokenizer, max_tokens).withColumn("_row", F.monotonically_increasing_id()))
    n_blocks = max(1, -(-cut.count() // block_pieces))

    def place(key, group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece", "start"], ascending=[False, True, True, True])
        bins, offsets = best_fit(group["length"].tolist(), max_tokens, open_bins)
        group["sequence_id"] = [(int(key[0]) << 32) + b for b in bins]
        group["offset"] = offsets
        return group[["_row", "sequence_id", "offset"]]

    block = F.pmod(F.xxhash64("doc_id", "piece", "_row"), F.lit(n_blocks))  # rows of one id (or none) spread, too
    placed = (cut.select("doc_id", "piece", "start", "length", "_row", block.alias("_block")).groupBy("_block")
              .applyInPandas(place, "_row long, sequence_id long, offset long"))
    return wide(cut.join(placed, "_row").drop("_row"))
