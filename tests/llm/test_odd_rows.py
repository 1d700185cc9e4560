"""Odd rows that the other modules leave out, pairs at the edge of the threshold, crowded keys, and whole query results against plain versions."""

import hashlib
import math
import os
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_contracts import BPE, documents, library_ids, packed, plain_fingerprint, plain_spans, tokenizers_files

from wildtally.llm import bpe, decontam, embeddings, langid, lattice, pii, queries, simhash, urlrules, warc
from wildtally.llm.shared import fresh_path, heavy_first, stored

FOLDER = "/root/testdata/sf0.001"
PIECES = tokenizers_files.path("piece_bpe_32k.model")


def groups_of(linked, n):
    """Smallest position reachable, for each of n; linked(i, j) for j < i."""
    root = list(range(n))

    def top(k):
        while root[k] != k:
            k = root[k]
        return k

    for i in range(n):
        for j in range(i):
            if linked(i, j) and top(i) != top(j):
                a, b = sorted((top(i), top(j)))
                root[b] = a
    return [top(k) for k in range(n)]


def test_vectors_at_the_edge_of_the_threshold(spark):
    rng = np.random.default_rng(95)
    n, width = 1500, 64
    x = rng.normal(size=(n, width))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    off = rng.normal(size=(n, width))
    off -= (off * x).sum(axis=1, keepdims=True) * x
    off /= np.linalg.norm(off, axis=1, keepdims=True)
    cosine = rng.uniform(0.95, 0.96, size=(n, 1))
    y = cosine * x + np.sqrt(1 - cosine**2) * off
    below = 0.949 * x[:200] + math.sqrt(1 - 0.949**2) * off[200:400]
    rows = [(k, v.tolist()) for k, v in enumerate([*x, *y, *below])]
    found = {r.vec_id: r for r in embeddings.near_duplicate_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()}
    u = np.array([v for _, v in rows])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = (u @ u.T >= 0.95).sum(axis=1) - 1
    got = np.array([found[k].n_links for k in range(len(rows))])
    assert links[: 2 * n].sum() >= 2 * n - 4 and (got <= links).all() and got.sum() >= 0.93 * links.sum()


def test_heavy_keys_are_sent_and_the_rest_is_shuffled(spark):
    rows = spark.createDataFrame([("hot", k) for k in range(600)] + [(f"k{k % 40}", k) for k in range(400)], "name string, n long")
    told = rows.groupBy("name").agg(F.count("*").alias("w"), F.max("n").alias("last")).filter("name <> 'k3'")
    want = sorted((r.name, r.n, r.last) for r in rows.join(told, "name", "left").collect())
    for most in (100, 10, 1):
        got = heavy_first(rows, told, "name", "w", most)
        assert got.columns == ["name", "n", "last"] and sorted((r.name, r.n, r.last) for r in got.collect()) == want
    assert heavy_first(rows, told.limit(0), "name", "w").filter("last IS NULL").count() == 1000
    plan = heavy_first(rows, told, "name", "w", 10)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") >= 2


def test_many_repeated_pages_with_a_hot_one(spark, monkeypatch):
    rows = [(k, f"u{k}", "hot") for k in range(200)] + [(1000 + k, "v", f"twice {k // 2}") for k in range(60)] + [(5000 + k, None, f"once {k}") for k in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({c: F.lit("own") for c in ("sha1", "last", "n", "refers_to", "payload_digest", "file", "offset")})
    want = sorted((r.page_id, r.refers_to or 0) for r in warc.with_originals(pages).collect())
    monkeypatch.setattr(warc, "SENT_KEYS", 4)
    assert sorted((r.page_id, r.refers_to or 0) for r in warc.with_originals(pages).collect()) == want
    assert want[:2] == [(0, 199), (1, 199)] and want[199] == (199, 0) and (1000, 1001) in want and (1001, 0) in want and want[-1] == (5019, 0)
    folder = fresh_path(spark, "w")
    index, _ = stored(warc.write_archives(warc.with_originals(pages), folder), "i")
    read = sorted((r.page_id, r.refers_to or 0) for r in warc.read_records(index, folder).collect())
    assert read == want


def test_many_distinct_vectors_with_a_hot_one(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(40, 16))
    rows = [(k, x[0].tolist()) for k in range(100)] + [(1000 + k, x[k % 40].tolist()) for k in range(80)] + [(2000, x[5].tolist()), (2000, x[6].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    plain = lambda: sorted(map(tuple, embeddings.near_duplicate_vectors(df).collect()))
    want = plain()
    monkeypatch.setattr(embeddings, "SENT_VECTORS", 5)
    assert plain() == want and len(want) == len(rows) and want[0] == (0, 101, 0, True)


def test_very_long_texts(spark):
    rnd = random.Random(12)
    words = ["pako", "tiko", "schreng", "wurst", "moku", "--"]
    filler = " ".join(f"{w}{k}" if k % 997 == 0 else w for k, w in enumerate(rnd.choices(words, k=20_000)))
    long = f"{filler} mail a.b@c.org or +1 (386) 555-0123 {filler} 10.0.0.1"
    texts = [long, "x" * 120_000, "pako tiko moku " * 10, "schreng wurst " * 10, long]
    docs = documents(spark, texts).withColumn("lang", F.when(F.col("doc_id") == 2, "aa").when(F.col("doc_id") == 3, "bb"))
    named = {r.doc_id: r for r in langid.identify(docs, langid.learn(docs)).collect()}
    assert named[2].lang_pred == "aa" and named[3].lang_pred == "bb" and 0 <= named[0].score <= 1 and named[0][1:] == named[4][1:]
    spans = {r.doc_id: r for r in pii.find_personal_data(docs, pii.learn(docs)).collect()}
    assert [tuple(s) for s in spans[0].base] == plain_spans(long) and len(spans[0].base) == 3 and not spans[1].base
    coded = {r.doc_id: r for r in bpe.token_digests(docs, BPE).collect()}
    assert coded[0].ids_sha256 == hashlib.sha256(packed(library_ids(long))).hexdigest() == coded[4].ids_sha256
    prints = {r.doc_id: r for r in simhash.near_duplicates(docs, 4).collect()}
    assert prints[0].fingerprint == f"{plain_fingerprint(long, 4):016x}" and prints[4].component_id == 0
    item = " ".join(filler.split()[15_000:15_030])
    held = decontam.contained(docs, spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r.doc_id for r in held} == {0, 4}
    scored = {r.doc_id: r for r in lattice.score_documents(docs, PIECES, F.lit(True)).collect()}
    assert scored[0].n_tokens == len(long.split()) + 1 and scored[0].score == pytest.approx(scored[4].score) and scored[1].n_tokens == 2
    url = spark.createDataFrame([(1, "http://www.example.com/en/" + "a/" * 100_000), (2, "http://" + "h" * 100_000)], "page_id long, url string")
    assert {r.page_id: r.rule for r in urlrules.judge(url).collect()} == {1: "www.example.com/en/", 2: None}


def test_rows_without_an_id_and_repeated_rows(spark):
    long = "one two three four five six seven eight nine ten"
    texts = [long, long, long, "another text altogether of seven words", None, "", long]
    docs = documents(spark, texts, [None, 7, 7, 3, None, 4, 9])
    found = simhash.near_duplicates(docs, 4)
    rows = sorted(map(tuple, found.select("doc_id", "component_id").collect()), key=str)
    assert rows == sorted([(None, 7), (7, 7), (7, 7), (3, 3), (None, 4), (4, 4), (9, 7)], key=str)
    kept = sorted((r.doc_id for r in simhash.one_of_each(docs).collect()), key=str)
    assert kept == [3, 4, 7]
    items = spark.createDataFrame([(1, long), (1, long), (None, long)], "item_id long, text string")
    held = sorted((tuple(r)[0] for r in decontam.contained(docs, items).collect()), key=str)
    assert held == [7, 9, None]  # equal rows count once
    assert sorted((r.doc_id for r in decontam.without_contaminated(docs, items).collect()), key=str) == [3, 4, None]
    scored = lattice.score_documents(docs, PIECES, F.lit(True)).collect()
    assert len(scored) == 7 and sorted((r.doc_id for r in scored), key=str) == sorted([None, 7, 7, 3, None, 4, 9], key=str)
    assert len({round(r.score, 9) for r in scored if r.doc_id in (7, 9)}) == 1
    vectors = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    assert sorted(map(tuple, embeddings.near_duplicate_vectors(vectors).collect())) == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]


def test_nothing_to_identify_and_names_that_clash(spark):
    none = documents(spark, [])
    assert langid.identify(none, langid.learn(none)).count() == 0 and langid.keep_identified(none, langid.learn(none)).count() == 0
    docs = documents(spark, ["pako tiko", "wurst", None]).withColumns({c: F.lit("own") for c in ("lang_pred", "score", "base", "spans", "n_tokens", "node", "cell", "component", "hash", "words")})
    assert langid.identify(docs, langid.learn(docs)).columns == ["doc_id", "lang_pred", "score"]
    assert pii.find_personal_data(docs, pii.learn(docs)).count() == 3
    assert bpe.token_digests(docs, BPE).count() == 3 and simhash.near_duplicates(docs, 4).count() == 3
    assert lattice.score_documents(docs, PIECES, F.lit(True)).count() == 3
    assert decontam.contained(docs, spark.createDataFrame([(1, "wurst", "own")], "item_id long, text string, hash string")).count() == 1


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the driver's tables aren't here")
def test_whole_results_are_the_plain_ones(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()}
    ids = sorted(texts)
    run = lambda op: {r[0]: r for r in queries.queries()[op](spark, FOLDER).collect()}
    crc = lambda k: zlib.crc32(str(k).encode()) % 5

    coded = run("op7_bpe_chunks")
    assert {k: coded[k].ids_sha256 for k in ids} == {k: hashlib.sha256(packed(library_ids(texts[k]))).hexdigest() for k in ids}

    prints = [plain_fingerprint(texts[k], 4) for k in ids]
    alike = run("op9_simhash_pivots")
    root = groups_of(lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4, len(ids))
    assert [(alike[k].fingerprint, alike[k].component_id) for k in ids] == [(f"{p:016x}", ids[r]) for p, r in zip(prints, root, strict=True)]

    found = run("op3_pii_skip_chain")
    for k in ids:
        base = plain_spans(texts[k] or "")
        written = [f"{s[0]}:{s[1]}:{s[2]}" for s in base]
        assert found[k].base_sha256 == hashlib.sha256(",".join(written).encode()).hexdigest() and set(written) <= set(found[k].spans.split(",")) | {""}
        assert [found[k][f"n_{n}"] for n in ("email", "ip", "card", "phone")] == [sum(s[0] == n for s in base) for n in ("email", "ip", "card", "phone")]

    scored = run("op10_lattice_scores")
    tokens = {k: [*re.findall(rb"[^\x20\x09-\x0D]+", (texts[k] or "").encode().lower()), None] for k in ids}
    seen = {}
    for k in ids:
        if crc(k) != 1:
            for w in tokens[k]:
                seen[w] = seen.get(w, 0) + 1
    n, v = sum(seen.values()), len(seen)
    for k in ids:
        r = scored[k]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (crc(k) == 1, len(tokens[k]), sum(w in seen for w in tokens[k]), n)
        assert r.base_score == pytest.approx(sum(math.log10((seen.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in tokens[k]))

    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    told = run("op2_language_crf")
    held = [k for k in ids if told[k].held_out and langs[k] and re.search(r"[^\W\d_]", texts[k] or "")]
    assert all(told[k].held_out == (crc(k) == 0) for k in ids) and sum(told[k].lang_pred == langs[k] for k in held) >= 0.95 * len(held)

    vectors = spark.read.parquet(f"{FOLDER}/embeddings.parquet").select("vec_id", "embedding").collect()
    near = run("op8_lattice_neighbours")
    whole = [(r.vec_id, np.asarray(r.embedding, float)) for r in vectors if r.embedding and None not in r.embedding and np.isfinite(np.asarray(r.embedding, float)).all() and any(r.embedding)]
    u = np.stack([x / np.linalg.norm(x) for _, x in whole])
    links = (u @ u.T >= 0.95).sum(axis=1) - 1
    got = np.array([near[k].n_links for k, _ in whole])
    assert (got <= links).all() and got.sum() >= 0.9 * links.sum()
