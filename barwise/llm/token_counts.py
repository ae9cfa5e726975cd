"""Token counts of a byte-level BPE by a whole-token shortcut.

Which vocabulary strings encode alone as one token is proved once per worker
by encoding every one of them; a pre-token that is such a string counts one.
Only the rest is merged. Counts of pieces (a word with the space before it) are remembered up
to a bound.

Nulls and empty texts have 0 bytes and 0 tokens. Repeated rows and null ids
are returned as they come. Extra columns are ignored.
"""

from __future__ import annotations

import re
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import PLAIN, Merges, byte_letters, single_thread_tokenizers, small_batches, strings, tokenizer_path

MAX_TOKENS = 1024
#: Pieces whose counts a worker remembers.
REMEMBERED = 800_000
#: Fixed value: the public pre-token pattern of this vocabulary.
PRE_TOKEN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: characters with the Unicode property White_Space.
SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A pre-token never crosses the edge of one of these.
PIECE = re.compile(rf" ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]")


class TokenCounts:
    def __init__(self, path: str):
        single_thread_tokenizers()
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.pre_tokens = regex.compile(PRE_TOKEN).findall
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.merges = Merges(self.tokenizer)
        self.whole = self.proved()
        self.known: dict[str, int] = {}

    def proved(self) -> frozenset[str]:
        """Vocabulary strings that are one pre-token and one token alone."""
        letters, found = byte_letters(), []
        for token in self.tokenizer.get_vocab(with_added_tokens=False):
            try:
                s = bytes(letters[c] for c in token).decode("utf-8")
            except (UnicodeDecodeError, KeyError):
                continue
            if s not in self.special and len(self.pre_tokens(s)) == 1:
                found.append(s)
        counts = self.merged(found)
        return frozenset(s for s, n in zip(found, counts) if n == 1)

    def merged(self, some: list[str]) -> list[int]:
        out: list[int] = []
        for i in range(0, len(some), 20_000):
            out += [len(e) for e in self.tokenizer.encode_batch_fast(some[i:i + 20_000], add_special_tokens=False)]
        return out

    def learn(self, fresh: set[str]) -> None:
        """Counts of pieces. Pre-tokens that are whole tokens count one, the
        others are merged; pieces outside the plain range, where the libraries
        may differ on letters, are left to the tokenizer."""
        odd = []
        for piece in fresh:
            if max(piece) < PLAIN:
                self.known[piece] = sum([1 if p in self.whole else len(self.merges.ids(p))
                                         for p in self.pre_tokens(piece)])
            else:
                odd.append(piece)
        self.known.update(zip(odd, self.merged(odd)))

    def count(self, texts: list[str | None]) -> list[int]:
        extra, pieces = [], []
        for t in texts:
            parts, n = [t or ""], 0
            for s in self.special:
                if any(s in p for p in parts):
                    parts = [x for p in parts for x in p.split(s)]
            n = len(parts) - 1
            extra.append(n)
            pieces.append([x for p in parts for x in PIECE.findall(p)] if n else PIECE.findall(parts[0]))
        if len(self.known) > REMEMBERED:
            self.known = {}
        fresh: set[str] = set()
        for p in pieces:
            fresh.update(p)
        fresh.difference_update(self.known)
        self.learn(fresh)
        return [n + sum(map(self.known.__getitem__, p)) for n, p in zip(extra, pieces)]


@lru_cache(maxsize=2)
def token_counts_of(name: str) -> TokenCounts:
    return TokenCounts(tokenizer_path(name))


def count_tokens(docs: DataFrame, tokenizer: str, limit: int = MAX_TOKENS) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""
    small_batches(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = strings(batch.column(1))
            n = token_counts_of(tokenizer).count(texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"])

    text = F.col("text").cast("string")
    out = docs.select(F.col("doc_id").cast("long"), text.alias("text"),
                      F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"))
    return (out.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
