"""Corpus operators against brute force on small tables with odd rows."""
import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from barwise.llm import (best_fit_packing, decontamination, embedding_near_dedup, language_id, license_scan, ngram_jaccard,
                         quality_classifier, substring_dedup, suffix_array_dedup, token_counts, window_routing)
from barwise.llm.common import components, held_out_remainder, tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, rank int, p int"


def words(seed, n, span=300):
    rng = np.random.default_rng(seed)
    return [f"w{i}" for i in rng.integers(0, span, n)]


def corpus():
    long = words(1, 4000, 3000)
    a, b = words(2, 200), words(3, 200)
    near = a[:100] + ["other"] + a[101:]
    texts = [" ".join(a), " ".join(a), " ".join(near), " ".join(b), " ".join(words(4, 30) + a[40:120] + words(5, 30)),
             "", None, "one", "one two", "One  two", " \t\n", "x" * 3000, "é ñ 日本 \x1f y", " ".join(long),
             "q " * 400, " ".join(b[:60] + words(6, 10)), "a<|endoftext|>b", "12 34"]
    rows = [(i, t, "en" if i % 2 else "fr", "s", None, "x", 1, 2) for i, t in enumerate(texts)]
    return rows + [rows[3], (None, "one two", None, None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(corpus(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    out = best_fit_packing.pack(docs, "word_bpe_49k.json", max_tokens=256, emit="ids").toPandas()
    want = {}
    for i, t, *_ in corpus():
        ids = tok.encode(t or "", add_special_tokens=False).ids + [0]
        want.setdefault(i, set()).update((k, k * 256, np.array(ids[k * 256:(k + 1) * 256], "<u4").tobytes())
                                         for k in range(-(-len(ids) // 256)))
    got = {}
    for r in out.itertuples():
        got.setdefault(None if np.isnan(r.doc_id) else int(r.doc_id), set()).add((r.piece, r.start, bytes(r.ids)))
    assert got == want
    for _, g in out.sort_values("offset").groupby("sequence_id"):
        assert g["offset"].tolist() == [0, *g["length"].cumsum().tolist()[:-1]] and g["length"].sum() <= 256
    assert best_fit_packing.pack(empty, "word_bpe_49k.json").count() == 0


def test_packed_ids_are_the_output(docs, spark, tmp_path):
    from tokenizers import Tokenizer

    import corpus_pipeline
    from barwise.llm import queries

    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = {i: tok.encode(t or "", add_special_tokens=False).ids + [0] for i, t, *_ in corpus()}
    got = {}
    for r in corpus_pipeline.pack(spark, docs, "").orderBy("start").dropDuplicates(["doc_id", "piece"]).collect():
        got.setdefault(r.doc_id, {})[r.piece] = list(np.frombuffer(r.ids, "<u4"))
    assert {i: sum((p[k] for k in sorted(p)), []) for i, p in got.items()} == want
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    crc = {(r.doc_id, r.piece): r.ids_crc32 for r in queries.op1_best_fit_packing(spark, str(tmp_path)).collect()}
    assert crc == {(i, k): zlib.crc32(np.array(p[k], "<u4").tobytes()) for i, p in got.items() for k in p}
    with pytest.raises(ValueError):
        best_fit_packing.pack(docs, "word_bpe_49k.json", emit="crc32")


def test_best_fit_takes_the_tightest_and_closes_the_fullest():
    assert best_fit_packing.best_fit([6, 5, 3, 4], 10, 9) == ([0, 1, 0, 1], [0, 0, 6, 5])
    assert best_fit_packing.best_fit([6, 5, 4], 10, 1)[0] == [0, 1, 1]


def test_token_counts(docs, empty):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    got = token_counts.count_tokens(docs, "byte_bpe_50k.json").collect()
    want = {i: (len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t, *_ in corpus()}
    assert {r.doc_id: (r.n_bytes, r.n_tokens) for r in got} == want and len(got) == len(corpus())
    assert all(r.over_limit == (r.n_tokens > 1024) for r in got)
    assert token_counts.count_tokens(empty, "byte_bpe_50k.json").count() == 0


def test_language_id(spark, docs, empty):
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = language_id.fit(table)
    out = language_id.identify(table, net).withColumn("held", held_out_remainder(3) == 1).toPandas()
    held = out[out["held"]]
    assert (held["lang"] == held["lang_pred"]).mean() > 0.97 and out["score"].between(0, 1).all()
    odd = {r.doc_id: r.lang_pred for r in language_id.identify(docs, net).collect()}
    assert odd[5] == odd[6] == odd[10] == odd[17] == "und" and odd[7] != "und"
    assert language_id.identify(empty, language_id.fit(empty)).count() == 0


def test_license_scan(docs, empty, spark):
    rows = [(100, "intro text\nReleased under the MIT License.\nmore", "en", None, None, None, None, None),
            (101, "Licensed under the Apache License, Version 2.0.", "en", None, None, None, None, None)]
    got = license_scan.scan(docs.unionByName(spark.createDataFrame(rows, SCHEMA))).collect()
    assert sorted((r.doc_id, r.paragraph, r.family, r.confirmed) for r in got) == [
        (100, 1, "mit", True), (101, 0, "apache-2.0", True)]


def test_license_scan_of_repeated_rows(spark, monkeypatch):
    names = [license_scan.UNKNOWN, *license_scan.TEMPLATES]
    weights = {g: [0.3 * (n == "mit") for n in names] for g in ("the mit", "mit license")}
    monkeypatch.setattr(license_scan, "train", lambda docs: (names, weights, [0.0] * len(names), 0.0))
    text = "Released under the MIT License."
    table = spark.createDataFrame([(1, text)] + [(2, text)] * 3 + [(None, text)] * 4, "doc_id long, text string")
    got = license_scan.scan(table).collect()
    assert len(got) == 3 and len({round(r.score, 12) for r in got}) == 1


def test_license_scan_learns_from_every_paragraph(spark):
    lines = ["the terms of the sea", "plain words here", "under the terms", "see", "Released under the MIT License."]
    texts = [(i, "\n".join([lines[i % 4], lines[i % 5]])) for i in range(9000)] + [(None, None), (9001, "")]
    known = ["mit license", "of the", "released under", "terms of", "the mit", "the terms", "under the"]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = license_scan.unknowns(docs, known).collect()
    want = {}
    for line in [x for _, t in texts if t is not None for x in t.split("\n")]:
        w = line.lower().rstrip(".").split()
        grams = tuple(sorted({f"{a} {b}" for a, b in zip(w, w[1:])} & set(known)))
        want[grams] = want.get(grams, 0) + 1
    del want["mit license", "released under", "the mit", "under the"]  # a notice, not an unknown paragraph
    counts = {}
    for r in got:
        counts[tuple(r.grams)] = counts.get(tuple(r.grams), 0) + r.n
    assert counts == want and sum(want.values()) > 16_000
    assert 0.2 < sum(r.n for r in got if r.held) / sum(want.values()) < 0.3
    names, weights, intercepts, least = license_scan.train(docs)
    assert len(names) == len(intercepts) and all(len(w) == len(names) for w in weights.values()) and 0.5 <= least <= 0.95


def removed_words(rows, size=50):
    first, out = {}, {}
    texts = {i: (t or "").encode().split() for i, t, *_ in rows if i is not None}
    for i, w in sorted(texts.items()):
        for s in range(len(w) - size + 1):
            first.setdefault(tuple(w[s:s + size]), i)
    for i, w in texts.items():
        cut = set()
        for s in range(len(w) - size + 1):
            if first[tuple(w[s:s + size])] < i:
                cut.update(range(s, s + size))
        out[i] = (len(w), len(cut), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in cut)).hexdigest())
    return out


def test_substring_dedup(docs, empty, monkeypatch):
    want = removed_words(corpus())
    out = substring_dedup.digests(docs).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in out if r.doc_id is not None} == want
    assert len(out) == len(corpus()) and sum(x[1] for x in want.values()) > 300
    assert substring_dedup.digests(empty).count() == 0
    kept = {r.doc_id: r.text for r in substring_dedup.remove(docs).collect()}
    assert kept[0] == corpus()[0][1] and kept[1] == "" and kept[6] is None


def test_substring_dedup_of_a_stretch_twice_in_a_document(spark, monkeypatch):
    rows = []
    for t in range(12):  # the smaller document has the middle of a stretch that another has twice
        x, p, y, v, z, w = (words(1000 + 10 * t + k, n, 100_000) for k, n in enumerate((70, 70, 70, 40, 60, 60)))
        rows += [(10 * t + 3, " ".join(z + p + w)), (10 * t + 5, " ".join(x + p + y + v + x + p + y))]
    rows.append(rows[-1])
    want = removed_words(rows)
    assert sum(r[1] for r in want.values()) >= 12 * 140
    table = spark.createDataFrame(rows, "doc_id long, text string")
    for hot in (window_routing.HOT, 1):
        monkeypatch.setattr(window_routing, "HOT", hot)
        got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.digests(table).collect()}
        assert got == want


def test_fm_index_windows():
    rng = np.random.default_rng(0)
    base = [b"%d" % x for x in rng.integers(0, 5, 140)]
    segs = [base[:90], base[20:110], base[:60] + [b"z"] + base[61:130], base[50:140]]
    doc, n = np.array([1, 2, 3, 3]), np.array([len(s) - 49 for s in segs])
    got = substring_dedup.earlier_windows(segs, doc, np.zeros(4, int), n)
    first = {}
    for d, s in zip(doc, segs):
        for k in range(len(s) - 49):
            first[tuple(s[k:k + 50])] = min(d, first.get(tuple(s[k:k + 50]), 99))
    assert got.tolist() == [bool(first[tuple(s[k:k + 50])] < d) for d, s in zip(doc, segs) for k in range(len(s) - 49)]


def test_suffix_array_dedup(docs, empty):
    seen, want = set(), {}
    for i, t in sorted({(i, t or "") for i, t, *_ in corpus() if i is not None}):
        b = t.encode()
        cov = np.zeros(len(b), bool)
        for s in range(len(b) - 99):
            if b[s:s + 100] in seen:
                cov[s:s + 100] = True
            seen.add(b[s:s + 100])
        kept = np.frombuffer(b, np.uint8)[~cov].tobytes()
        want[i] = (len(b), len(b) - len(kept), int(np.diff(np.r_[0, cov]).clip(0).sum()), hashlib.sha256(kept).hexdigest())
    out = suffix_array_dedup.digests(docs).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out if r.doc_id is not None} == want
    assert suffix_array_dedup.digests(empty).count() == 0


@pytest.mark.parametrize("bound", [40, 1 << 20])
def test_induced_sorting(bound):
    rng = np.random.default_rng(3)
    for _ in range(120):
        t = rng.integers(1, rng.integers(2, 20), rng.integers(1, 90)).astype(np.uint8)
        t = np.r_[t, np.uint8(0), t[::-1], np.uint8(0)].astype(np.uint8)
        order, lcp = suffix_array_dedup.induced(t, 100, bound)
        raw = t.tobytes()
        want = sorted(range(len(t)), key=lambda i: raw[i:])
        assert order.tolist() == want
        for k in range(1, len(want)):
            a, b = raw[want[k - 1]:], raw[want[k]:]
            assert lcp[k] == next((i for i in range(min(len(a), len(b))) if a[i] != b[i]), min(len(a), len(b)))


def shingles(t):
    w = (t or "").translate(ngram_jaccard.LOWER).encode().split()
    return {tuple(w[i:i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def test_ngram_jaccard(docs, empty):
    texts = {i: shingles(t) for i, t, *_ in corpus() if i is not None}
    comp = {i: i for i in texts}
    for _ in texts:
        for a in texts:
            for b in texts:
                u = len(texts[a] | texts[b])
                if texts[a] and texts[b] and 100 * len(texts[a] & texts[b]) >= 85 * u:
                    comp[a] = comp[b] = min(comp[a], comp[b])
    out = ngram_jaccard.join(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in out if r.doc_id is not None} == {
        i: (len(texts[i]), comp[i]) for i in texts}
    assert len(out) == len(corpus()) and comp[2] == 0
    assert ngram_jaccard.join(empty).count() == 0
    assert sorted(r.doc_id for r in ngram_jaccard.keep_one(docs).filter("doc_id is not null").collect()) == sorted(
        i for i in comp if comp[i] == i)


def test_partenum_loses_no_pair():
    rng = np.random.default_rng(5)
    bands = ngram_jaccard.Bands()
    for n in [*range(1, 40), 100, 700, 3000]:
        a = np.unique(rng.integers(0, 1 << 62, n).astype(np.uint64))
        drop = int(len(a) * 0.15 / 1.0)
        b = a[np.sort(rng.permutation(len(a))[drop:])] if drop else a
        sig, own = ngram_jaccard.signatures([a, b], bands)
        if 100 * len(b) >= 85 * len(a):
            assert set(sig[own == 0]) & set(sig[own == 1]), n


def test_decontamination(spark, docs, empty):
    item = " ".join(words(2, 200)[10:40]).upper()
    bench = spark.createDataFrame([("i1", item), ("i2", "one two"), ("i3", None), ("i4", "")], "item_id string, text string")
    got = {(r.doc_id, r.n_hit, tuple(r["items"]), r.contaminated) for r in decontamination.judge(docs, bench).collect()}
    assert (0, 30, ("i1",), True) in got and (8, 2, ("i2",), True) in got and (9, 2, ("i2",), True) in got
    assert (None, 2, ("i2",), True) in got and (6, 0, (), False) in got and (3, 0, (), False) in got
    assert decontamination.judge(empty, bench).count() == 0
    assert decontamination.judge(docs, bench.limit(0)).filter("n_hit > 0").count() == 0
    kept = {r.doc_id for r in decontamination.remove_documents(docs, bench).collect()}
    assert not kept & {0, 1, 2, 8, 9} and {3, 5, 6} <= kept
    cut = {r.doc_id: r.text for r in decontamination.remove_spans(docs, bench).collect()}
    assert len(cut[0].split()) == 170 and cut[3] == corpus()[3][1]


def test_quality_classifier(spark, docs, empty):
    table = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    model = quality_classifier.fit(table, labels)
    out = quality_classifier.score(table, model).join(labels, "doc_id").filter(held_out_remainder(4) == 2)
    assert out.select(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0] > 0.97
    odd = quality_classifier.score(docs, model).collect()
    assert len(odd) == len(corpus()) and all(0 <= r.score <= 1 for r in odd)
    none = quality_classifier.fit(empty, labels.limit(0))
    assert none is None and quality_classifier.score(docs, none).count() == len(corpus())


def test_quality_features_of_whole_words():
    word = "東京都の天気は晴れです。".encode() * 9
    marked = b"<" + word + b">"
    assert list(quality_classifier.features(word)) == [zlib.crc32(word) % quality_classifier.BUCKETS] + [
        zlib.crc32(marked[i:i + n], n) % quality_classifier.BUCKETS
        for n in quality_classifier.GRAMS for i in range(len(marked) - n + 1)]
    same = b"x" * 64  # tells nothing; what decides comes after it
    tail = {0: "悪い".encode() * 8, 1: "良い".encode() * 8}
    rng = np.random.default_rng(2)
    labels = [i % 2 for i in range(200)]
    model = quality_classifier.train([[same + b"%d" % rng.integers(1 << 40) + tail[y]] for y in labels], labels)
    words_ = model.scorer()
    margin = [words_[same + b"new%d" % y + tail[y]].real for y in (0, 1)]
    assert margin[0] < 0 < margin[1] and not words_


def test_embedding_near_dedup(spark):
    rng = np.random.default_rng(4)
    base = rng.normal(size=(40, 16))
    v = np.concatenate([base, base[:15] + rng.normal(size=(15, 16)) * 0.15, base[:5], base[:5] * 2])
    rows = [(i, [float(x) for x in np.float32(r)], i % 3) for i, r in enumerate(v)]
    rows += [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] + [1.0] * 15, 1), (903, [None] + [1.0] * 15, 1), (904, [], 0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    out = embedding_near_dedup.links(table)
    x = np.array([r[1] for r in rows[:len(v)]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= 0.9
    np.fill_diagonal(near, False)
    comp = np.arange(len(v))
    for _ in v:
        comp = np.array([min([comp[i], *comp[near[i]]]) for i in range(len(v))])
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in out.collect()}
    assert got == {i: (int(near[i].sum()), int(comp[i]), bool(comp[i] == i)) for i in range(len(v))} | {
        i: (0, i, True) for i in range(900, 905)}
    assert embedding_near_dedup.audit(table, out) >= 0.9
    assert embedding_near_dedup.links(table.limit(0)).count() == 0


def test_search_reaches_every_group():
    rng = np.random.default_rng(8)
    base = rng.normal(size=(3, 32))
    x = embedding_near_dedup.unit(np.concatenate([b + rng.normal(size=(n, 32)) * 0.1 for b, n in zip(base, (80, 70, 60))]))
    heads, edge = embedding_near_dedup.united(embedding_near_dedup.pruned(x))
    assert len(embedding_near_dedup.medoids(x, heads, edge)) > 1
    more = embedding_near_dedup.unit(x[::7] + 1e-3)
    q = np.concatenate([x, more])
    r, c = embedding_near_dedup.search(x, q, heads, edge, 0.9)
    assert len(r) >= 0.99 * (q @ x.T >= 0.9).sum()


def test_dense_group_is_one_shard():
    rng = np.random.default_rng(9)
    group = embedding_near_dedup.unit(rng.normal(size=64) + rng.normal(size=(8000, 64)) * 0.2)
    other = embedding_near_dedup.unit(rng.normal(size=(2000, 64)))
    x = np.concatenate([group, other])
    c = embedding_near_dedup.centres(x, 10)
    label = embedding_near_dedup.merged(c, 0.9)
    near = label[(x @ c.T).argmax(1)]
    assert len(set(near[:8000])) == 1 and len(set(near[8000:])) > 1


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (3, 9), (7, 8), (8, 8), (20, 10), (10, 20)], "a long, b long")
    assert {(r.node, r.component) for r in components(edges).collect()} == {
        (3, 3), (4, 3), (5, 3), (9, 3), (7, 7), (8, 7), (10, 10), (20, 10)}


def test_pipeline(spark):
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    kept = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    sets = {i: shingles(t) for i, t in kept}
    comp = {i: i for i in sets}
    for _ in range(3):
        for a in sets:
            for b in sets:
                if sets[a] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                    comp[a] = comp[b] = min(comp[a], comp[b])
    kept = [(i, t) for i, t in kept if comp[i] == i]
    cut = removed_words(kept)
    left = {i: t for i, t in kept if cut[i][1] < cut[i][0]}
    bench = spark.read.parquet(f"{sf}/benchmark.parquet")
    frame = spark.createDataFrame([(i, t) for i, t in left.items() if not cut[i][1]], "doc_id long, text string")
    bad = {r.doc_id for r in decontamination.judge(frame, bench).filter("contaminated").collect()}
    out = corpus_pipeline.run(spark, sf).toPandas()
    uncut = {i for i in left if not cut[i][1]}
    assert set(out["doc_id"]) & uncut == uncut - bad
    assert set(out["doc_id"]) <= set(left)
    assert zlib.crc32(b"") == 0 and (out.groupby("sequence_id")["length"].sum() <= 2048).all()
