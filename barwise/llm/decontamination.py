"""Benchmark decontamination with DataFrame functions only.

Texts are normalised to lower-case words. Every run of 13 consecutive words of
a benchmark item (the whole item, if it has fewer) is a window; a document word
inside any occurrence of a window is hit.

The scan has two steps. Any occurrence of a window of n words holds, at one of
every n - k + 1 places of the document, k whole words of it (k is about n / 2):
so a document is probed only there, against the broadcast hash set of all k-word
runs of the windows. Documents with a probe that matches, and a few others by
chance, have all their windows compared as text, which verifies the hits.

The windows are broadcast only while their counted number is bounded; beyond
that the same joins shuffle. Null and empty texts have no words. Rows that
repeat a doc_id with another text are judged each on its own (the key is
doc_id and the text's hash, null ids included). An empty benchmark hits
nothing. Extra columns, in whatever names, are left alone.
"""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import checkpointed, only_keys, renamed

WINDOW = 13
#: A document is contaminated if at least one word in so many is hit.
ONE_IN = 20
#: Most rows of a broadcast: hashes or windows of some 100 bytes.
BROADCAST_ROWS = 200_000
#: Fixed value: what separates words, once A-Z are a-z.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text) -> F.col:
    low = F.translate(text.cast("string"), string.ascii_uppercase, string.ascii_lowercase)
    return F.coalesce(F.array_remove(F.split(low, SEPARATORS), ""), F.array().cast("array<string>"))


def run_text(w: str, at, n: int) -> F.col:
    return F.concat_ws(" ", *[F.get(F.col(w), at + i) for i in range(n)])


def run_hash(w: str, at, n: int) -> F.col:
    return F.xxhash64(*[F.get(F.col(w), at + i) for i in range(n)])


def places(w: str, n: int, step: int = 1) -> F.col:
    """0, step, 2 * step, ... up to the last place where n words begin."""
    last = F.floor((F.size(w) - n) / step).cast("int")
    return F.when(F.size(w) >= n, F.transform(F.sequence(F.lit(0), last), lambda i: i * step))


def bounded(df: DataFrame) -> DataFrame:
    """``df`` as a broadcast side if it's small enough, else as it is."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def item_windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(n, w, items): distinct windows, their numbers of words, and the items
    that hold them, as strings."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("_w"))
    full = items.filter(F.size("_w") >= size).select(
        "item", F.lit(size).alias("n"), F.explode(F.transform(places("_w", size), lambda i: run_text("_w", i, size))).alias("w"))
    short = items.filter((F.size("_w") > 0) & (F.size("_w") < size)).select(
        "item", F.size("_w").alias("n"), F.array_join("_w", " ").alias("w"))
    return full.unionByName(short).groupBy("n", "w").agg(F.collect_set("item").alias("items"))


def hits(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, text_hash, start, n, items): every occurrence of a window, by
    the number of its first word in the document, from 0."""
    windows = checkpointed(item_windows(benchmark, size))
    lengths = sorted(r["n"] for r in windows.select("n").distinct().collect())  # at most ``size`` numbers
    text = F.col("text").cast("string")
    docs = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), text.alias("_text"))
    found = None
    for n in lengths:
        k = (n + 1) // 2
        step = n - k + 1
        mine = windows.filter(F.col("n") == n)
        runs = mine.select(F.split("w", " ").alias("_w")).select(
            F.explode(F.transform(places("_w", k), lambda i: run_hash("_w", i, k))).alias("h")).distinct()
        probes = docs.select("text_hash", words(F.col("_text")).alias("_w")).select("text_hash", F.explode(
            F.transform(places("_w", k, step), lambda i: run_hash("_w", i, k))).alias("h"))
        some = probes.join(bounded(runs), "h", "left_semi").select("text_hash").distinct()
        near = only_keys(docs, checkpointed(some), "text_hash")
        places_of = near.select("doc_id", "text_hash", words(F.col("_text")).alias("_w")).select(
            "doc_id", "text_hash", F.posexplode(F.transform(places("_w", n), lambda i: run_text("_w", i, n))).alias("start", "w"))
        got = places_of.join(bounded(mine), "w").select("doc_id", "text_hash", "start", "n", "items")
        found = got if found is None else found.unionByName(got)
    if found is None:
        return docs.limit(0).select("doc_id", "text_hash", F.lit(0).alias("start"), F.lit(0).alias("n"),
                                    F.array().cast("array<string>").alias("items"))
    return found.distinct()


def judge(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, one_in: int = ONE_IN) -> DataFrame:
    """(doc_id, text_hash, n_words, n_hit, items, contaminated) of every row of
    ``docs``; items are the sorted ids of the items hit."""
    found = checkpointed(hits(docs, benchmark, size))
    key = ["doc_id", "text_hash"]
    before = Window.partitionBy(*key).orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("n")
    covered = (found.withColumn("_done", F.coalesce(F.max(end).over(before), F.lit(0)))
               .groupBy(*key).agg(F.sum(F.greatest(end - F.greatest("start", "_done"), F.lit(0))).alias("n_hit")))
    items = (found.select(*key, F.explode("items").alias("item")).distinct()
             .groupBy(*key).agg(F.sort_array(F.collect_list("item")).alias("items")))
    per_doc = covered.join(items, (covered["doc_id"].eqNullSafe(items["doc_id"])) & (covered["text_hash"] == items["text_hash"])).select(
        covered["doc_id"].alias("_d"), covered["text_hash"].alias("_t"), "n_hit", "items")
    text = F.col("text").cast("string")
    all_docs = docs.select("doc_id", F.xxhash64(text).alias("text_hash"), F.size(words(text)).cast("long").alias("n_words"))
    out = all_docs.join(per_doc, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("text_hash") == F.col("_t")), "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select("doc_id", "text_hash", "n_words", n_hit.alias("n_hit"),
                      F.coalesce("items", F.array().cast("array<string>")).alias("items"),
                      ((n_hit > 0) & (n_hit * one_in >= F.col("n_words"))).alias("contaminated"))


def remove_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without its contaminated documents."""
    rows, names = renamed(docs)
    bad = judge(rows, benchmark).filter("contaminated").select(
        F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")).distinct()
    return rows.join(bad, F.col("doc_id").eqNullSafe(F.col("_d"))
                     & (F.xxhash64(F.col("text").cast("string")) == F.col("_t")), "left_anti").toDF(*names)


def remove_spans(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with the hit words, and what separates them, cut out of the
    texts; untouched texts stay as they are."""
    docs, names = renamed(docs)
    found = hits(docs, benchmark)
    spans = found.groupBy(F.col("doc_id").alias("_d"), F.col("text_hash").alias("_t")).agg(
        F.sort_array(F.collect_set(F.struct("start", "n"))).alias("_spans"))
    token = rf"{SEPARATORS[:-1]}*(?:(?!{SEPARATORS[:-1]})[\s\S])+"
    low = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    joined = docs.join(spans, F.col("doc_id").eqNullSafe(F.col("_d"))
                       & (F.xxhash64(F.col("text").cast("string")) == F.col("_t")), "left")
    joined = joined.withColumn("_low", F.regexp_extract_all(low, F.lit(token), F.lit(0)))
    at = F.transform("_low", lambda x: F.length(x))
    cut = F.aggregate(
        F.zip_with(at, F.sequence(F.lit(0), F.size("_low") - 1), lambda size, i: F.struct(size.alias("size"), i.alias("i"))),
        F.struct(F.lit(1).alias("at"), F.lit("").alias("kept")),
        lambda acc, x: F.struct(
            (acc["at"] + x["size"]).alias("at"),
            F.when(F.exists("_spans", lambda s: (x["i"] >= s["start"]) & (x["i"] < s["start"] + s["n"])), acc["kept"])
            .otherwise(F.concat(acc["kept"], F.col("text").substr(acc["at"], x["size"]))).alias("kept")))
    text = F.when(F.col("_spans").isNull(), F.col("text")).otherwise(cut["kept"])
    return joined.select(*[text.alias("text") if c == "text" else F.col(c) for c in docs.columns]).toDF(*names)


ORACLE = r"""
WITH norm AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
d AS (SELECT doc_id, coalesce(w, []) AS w, len(coalesce(w, [])) AS n_words FROM norm),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS g
       FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
h AS (SELECT doc_id, i, n, item FROM dw JOIN bw USING (n, g)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY 1),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
       FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY 1)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= n_words AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN it USING (doc_id)
"""
