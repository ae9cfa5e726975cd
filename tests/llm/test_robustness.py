"""Shared ids, clashing column names and unlabelled tables in the pipeline's stages."""
import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from barwise.llm import best_fit_packing, common, decontamination, ngram_jaccard, substring_dedup, suffix_array_dedup

ODD = "doc_id long, text string, lang string, _id int, _n int, _d int, _t int, _c0 string, _offset string, _runs string, score string, kept int"


def words(seed, n):
    return " ".join(f"w{i}" for i in np.random.default_rng(seed).integers(0, 500, n))


P, Q = words(1, 70), words(2, 90)
ROWS = [(1, P), (2, words(3, 40) + " " + P), (2, Q + " " + words(4, 30)), (2, Q + " " + words(4, 30)), (3, Q), (3, P + " " + words(5, 9)),
        (4, words(6, 120)), (4, words(6, 120) + " more"), (5, None), (5, Q), (None, P), (None, Q), (6, "x")]


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(i, t, "en", 1, 2, 3, 4, "a", "b", "c", "d", 5) for i, t in rows], ODD).repartition(3)


def test_shared_ids_word_windows(spark):
    """Rows of one id are one document; a window repeats if a smaller id has it."""
    size = 50
    windows = {}
    for i, t in ROWS:
        w = (t or "").split()
        for k in range(len(w) - size + 1):
            if i is not None:
                windows.setdefault(tuple(w[k:k + size]), set()).add(i)
    want = []
    for i, t in ROWS:
        w = (t or "").split()
        hit = {p for k in range(len(w) - size + 1) if i is not None and min(windows[tuple(w[k:k + size])]) < i for p in range(k, k + size)}
        kept = " ".join(x for p, x in enumerate(w) if p not in hit)
        want.append((i, len(w), len(hit), hashlib.sha256(kept.encode()).hexdigest()))
    out = substring_dedup.digests(frame(spark))
    assert out.columns == [f.split()[0] for f in ODD.split(", ")] + ["n_words", "n_removed", "kept_sha256"]
    got = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in out.collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_shared_ids_byte_strings(spark):
    """A document's texts follow each other by hash; a string repeats if it
    starts in an earlier one, or earlier in its own. Equal rows share their cut."""
    df = frame(spark)
    texts = {(r["doc_id"], r["text"]): r["h"] for r in df.select("doc_id", "text", F.xxhash64("text").alias("h")).collect()}
    seen, cuts = set(), {}
    for (i, t), _ in sorted(((k, h) for k, h in texts.items() if k[0] is not None and k[1] is not None), key=lambda x: (x[0][0], x[1])):
        raw, hit, fresh = t.encode(), set(), []
        for k in range(len(raw) - 99):
            s = raw[k:k + 100]
            if s in seen:
                hit.update(range(k, k + 100))
            seen.add(s)
        cuts[i, t] = len(hit)
    out = suffix_array_dedup.digests(df)
    for r in out.collect():
        assert r["n_removed"] == cuts.get((r["doc_id"], r["text"]), 0), r["doc_id"]


def test_stages_keep_every_column(spark, tmp_path):
    df = frame(spark)
    bench = spark.createDataFrame([(1, Q)], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, str(tmp_path))
        assert out.schema.simpleString() == df.schema.simpleString(), name
        rows = out.collect()
        assert rows and all((r["_id"], r["_n"], r["_d"], r["_c0"], r["score"], r["kept"]) == (1, 2, 3, "a", "d", 5) for r in rows), name
    assert {r["doc_id"] for r in decontamination.remove_documents(df, bench).collect()} == {1, 2, 3, 4, 5, 6, None}
    assert decontamination.remove_spans(df, bench).columns == df.columns
    kept = [(r["doc_id"], r["text"]) for r in ngram_jaccard.keep_one(df).collect()]
    assert len([k for k in kept if k[0] is None]) == 2 and len([k for k in kept if k[0] == 2]) == 1


def test_nothing_is_dropped_without_labels(spark):
    df = frame(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.identify_language(spark, df, "")
    assert kept.count() == len([t for _, t in ROWS if t])


def test_null_ids_spread_over_blocks(spark):
    df = spark.createDataFrame([(None, words(i, 20)) for i in range(300)], "doc_id long, text string")
    out = best_fit_packing.pack(df, "word_bpe_49k.json", block_pieces=50)
    blocks = {r[0] >> 32 for r in out.select("sequence_id").collect()}
    assert len(blocks) > 2 and out.count() == 300


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_key_map_loses_nothing(spark, n):
    keys = spark.range(0, 3 * n, 3).withColumnRenamed("id", "k")
    df = spark.range(20_000).withColumnRenamed("id", "k")
    some = {r[0] for r in common.only_keys(df, keys, "k").collect()}
    assert {k for k in range(0, min(3 * n, 20_000), 3)} <= some
    assert len(some) <= min(3 * n, 20_000) / 3 + 20_000 / 8
    assert some.isdisjoint({r[0] for r in common.without_keys(df, keys, "k").collect()})


def test_a_common_line_does_not_send_its_surroundings_to_the_sort(spark, monkeypatch):
    from barwise.llm import substring_dedup, suffix_array_dedup, window_routing

    rng = np.random.default_rng(11)
    letters = np.frombuffer(b"abcdefghijklmnopqrstuvwxyz ", np.uint8)
    prose = lambda n: letters[rng.integers(0, len(letters), n)].tobytes().decode()
    line, longer, passage = prose(60), prose(90), prose(180)
    rows = [(i, prose(150) + (passage if i % 10 == 0 else longer if i % 2 else line) + prose(150)) for i in range(120)]
    rows += [(200, rows[0][1][40:330] + passage[30:]), (200, prose(220)), (200, prose(120) + passage), (201, "short")]
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append(t)
    first = {}  # rows of one doc_id lie one after the other, in the order of their hashes
    for i in sorted(texts):
        for t in spark.createDataFrame([(t,) for t in texts[i]], "t string").selectExpr("t", "xxhash64(t) h").orderBy("h").collect() if len(texts[i]) > 1 else [(texts[i][0],)]:
            covered = np.zeros(len(t[0]), bool)
            for s in range(len(t[0]) - 99):
                covered[s:s + 100] |= t[0][s:s + 100] in first
                first.setdefault(t[0][s:s + 100], i)
            texts[i, t[0]] = int(covered.sum())
    want = sorted((i, texts[i, t]) for i, t in rows)
    assert sum(r[1] for r in want) > 10 * 180

    table = spark.createDataFrame(rows, "doc_id long, text string")
    sorted_bytes = spark.sparkContext.accumulator(0)
    sort = suffix_array_dedup.earlier_strings

    def counted(segments, doc, start, n):
        sorted_bytes.add(sum(map(len, segments)))
        return sort(segments, doc, start, n)

    for hot in (window_routing.HOT, 20, 1):
        monkeypatch.setattr(window_routing, "HOT", hot)
        got = sorted((r.doc_id, r.n_removed) for r in suffix_array_dedup.digests(table).collect())
        assert got == want
        sorted_bytes.value = 0
        window_routing.repeated_runs(window_routing.placed(table), suffix_array_dedup.BYTES, counted).count()
        # 108 documents have one of the lines, which are shorter than a string; before, their segments were all fetched
        # and those of a hot anchor were cut to strings of 100 bytes each
        assert sorted_bytes.value < (15_000 if hot == window_routing.HOT else 8_000), (hot, sorted_bytes.value)
