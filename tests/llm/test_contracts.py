"""Each operator against a plain version, and the odd cases: nulls, empty and long texts, ties, repeats, clashing columns."""

import hashlib
import json
import math
import random
import re
import zlib
from array import array

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from wildtally.llm import bpe, components, decontam, embeddings, langid, lattice, pii, queries, rangecoder, resemblance, simhash, tokenfile, urlrules, warc
from wildtally.llm.shared import fresh_path, stored

tokenizers_files = pytest.importorskip("public_tokenizers")
BPE = tokenizers_files.path("word_bpe_49k.json")
TEXTS = [None, "", "  ", "Hello there, don't stop. É é 123 <|endoftext|> x\x1cy\xa0z", "hello there", "hello there", "word " * 3000, "x" * 5000, "The end.", "Die Straße, der Öl. ﬁn"]


def documents(spark, texts=TEXTS, ids=None):
    rows = [(k if ids is None else ids[k], t, "en", k, "row", "key") for k, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, row string, fingerprint string")


def library_ids(text):
    return Tokenizer.from_file(BPE).encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return array("I", ids).tobytes()


def test_bpe_is_the_library(spark):
    found = {r.doc_id: r for r in bpe.token_digests(documents(spark), BPE).collect()}
    own = Tokenizer.from_file(BPE)
    for k, text in enumerate(TEXTS):
        ids = library_ids(text)
        assert (found[k].n_tokens, found[k].ids_sha256) == (len(ids), hashlib.sha256(packed(ids)).hexdigest())
        assert found[k].decoded_sha256 == hashlib.sha256(own.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.token_digests(documents(spark, []), BPE).count() == 0


def test_chunks_are_reused_and_joins_repaired():
    words = [f"w{k}" for k in random.Random(2).choices(range(900), k=6000)]
    text = " ".join(words)
    coder = bpe.ChunkEncoder(BPE)
    assert coder.encode([text.encode()]) == [packed(library_ids(text))]
    before = coder.encoded
    coder.encode([("new start " + text).encode()])
    assert coder.encoded - before <= 3 < coder.reused
    assert coder._grown(b"hello wor", b"ld again") == packed(library_ids("hello world again"))


def test_words_are_encoded_once(monkeypatch):
    rnd, given, library = random.Random(8), [], bpe.ChunkEncoder._library
    monkeypatch.setattr(bpe.ChunkEncoder, "_library", lambda self, texts: [given.extend(texts), library(self, texts)][1])
    texts = [" ".join(rnd.choices([f"Word{k}'s," for k in range(300)], k=2000)) for _ in range(5)]
    for most in (96 << 20, 1 << 14):  # also with a memo that is full again and again
        given.clear()
        coder = bpe.ChunkEncoder(BPE, max_chunk_bytes=1 << 14, max_word_bytes=most)
        assert coder.by_word and [coder.encode([t.encode()])[0] for t in texts] == [packed(library_ids(t)) for t in texts]
        assert most < 1 << 20 or sum(map(len, given)) < 0.1 * sum(map(len, texts))


def test_words_apart_are_the_library():
    rnd, own = random.Random(9), Tokenizer.from_file(BPE)
    odd = [*" \t\n\r\v\f\x1c\x85\xa0\u2003\u200b\u0301\u0338\u1100\u1161<=|>'sSΣİßéÉﬁ漢9½🙂\0", "e\u0301", "<|endoftext|>", "<|startoftext|>", "'re", "don't", "ΣΑΣ", "the "]
    texts = ["".join(rnd.choices(odd, k=rnd.randint(0, 60))) for _ in range(3000)]
    want = [packed(x.ids) for x in own.encode_batch(texts, add_special_tokens=False)]
    assert bpe.ChunkEncoder(BPE).encode([t.encode() for t in texts]) == want
    assert not bpe.ChunkEncoder(tokenizers_files.path("byte_bpe_50k.json")).by_word
    told = json.loads(own.to_str())
    for change in ({"normalizer": {"type": "NFKC"}}, {"pre_tokenizer": None}, {"added_tokens": [{"content": "a b", "lstrip": False, "rstrip": False, "single_word": False}]}):
        assert bpe.apart_at_blanks(json.dumps(told)) and not bpe.apart_at_blanks(json.dumps(told | change))


@pytest.mark.parametrize("sizes", [[], [0], [1, 5, 0, 700, 300, 300]])
def test_range_coder_round_trip(sizes):
    rng = np.random.default_rng(0)
    blocks = [rng.integers(0, 1 << 16, n).astype(np.uint32) for n in sizes] + [np.full(2000, 49407, np.uint32)]
    coded = rangecoder.encode(blocks)
    assert all(np.array_equal(a, b) for a, b in zip(blocks, rangecoder.decode(coded, [len(b) for b in blocks]), strict=True))
    assert len(coded[-1]) < 100


def test_token_files(spark):
    ids = [3, None, 3, 7, 1, 1, 5, 6, 2, 9]
    folder = fresh_path(spark, "t")
    manifest, _ = stored(tokenfile.write_token_files(documents(spark, ids=ids), BPE, folder, 1), "m")
    rows = sorted(tokenfile.read_token_files(manifest, folder).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == sorted(ids, key=lambda i: -1 if i is None else i)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    want = sorted((i is not None, i or 0, len(x) + 1, zlib.crc32(packed([*x, 1]))) for i, x in zip(ids, map(library_ids, TEXTS), strict=True))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in rows) == want
    with pytest.raises(ValueError):
        list(tokenfile.read_file(b"WTIDS01\n"))


def plain_fingerprint(text, words):
    import xxhash

    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_simhash_groups(spark):
    rnd = random.Random(4)
    base = [rnd.choice("abcdefgh") * rnd.randint(1, 4) for _ in range(400)]
    texts = [*TEXTS, *(" ".join(base[:k] + [f"new{k}"] + base[k + 1 :]) for k in range(0, 400, 3))]
    docs = documents(spark, texts)
    found = {r.doc_id: r for r in simhash.near_duplicates(docs, 4, 4).collect()}
    prints = [plain_fingerprint(t, 4) for t in texts]
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4 and group[i] != group[j]:
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    assert [found[k].fingerprint for k in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [found[k].component_id for k in range(len(texts))] == group
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_wider_search_with_a_second_fingerprint(spark):
    rnd = random.Random(8)
    base = ["".join(rnd.choices("abcdefgh", k=4)) for _ in range(300)]
    texts = [" ".join(base)] + [" ".join("odd" if k in chosen else w for k, w in enumerate(base)) for chosen in ([10, 90, 200], [5, 6, 7, 100])] + [" ".join("".join(rnd.choices("abcdefgh", k=4)) for _ in range(300))]
    docs = documents(spark, texts)
    found = {r.doc_id: r.component_id for r in simhash.near_duplicates(docs, 2, 7, second_words=5, second_bits=14).collect()}
    one, two = ([plain_fingerprint(t, n) for t in texts] for n in (2, 5))
    close = lambda i, j: (one[i] ^ one[j]).bit_count() <= 7 and (two[i] ^ two[j]).bit_count() <= 14
    assert [found[k] == 0 for k in (1, 2, 3)] == [close(0, 1) or (close(0, 2) and close(1, 2)), close(0, 2) or (close(0, 1) and close(1, 2)), False]
    assert simhash.one_of_each(docs).count() == len(set(found.values()))


def plain_similarity(a, b):
    sets = []
    for t in (a, b):
        w = t.lower().split()
        sets.append({" ".join(w[i : i + 5]) for i in range(len(w) - 4)} or {" ".join(w)})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def edited_copies():
    """Pairs of texts: a passage appended, words changed here and there, half of them over and half under 0.8."""
    rnd = random.Random(12)
    words = lambda n: ["".join(rnd.choices("abcdefgh", k=5)) for _ in range(n)]
    pairs = []
    for k in range(60):
        base, other = words(200), words(90)
        copy = base + other[: 10 + k] if k % 2 else [w if i % (200 // (2 + k // 5)) else "odd" for i, w in enumerate(base)]
        pairs.append((" ".join(base), " ".join(copy)))
    return pairs


def component_ids(spark, texts, **sizes):
    docs = spark.createDataFrame(list(enumerate(texts)), "key long, text string")
    return {r.key: r.component_id for r in resemblance.groups(docs, **sizes).collect()}


def test_near_duplicates_of_the_pipeline_are_all_found(spark):
    pairs = edited_copies()
    found = component_ids(spark, [t for p in pairs for t in p])
    close = [k for k, p in enumerate(pairs) if plain_similarity(*p) >= 0.8]
    assert 20 < len(close) < 50 and all(found[2 * k] == found[2 * k + 1] for k in close)
    docs = documents(spark, [t for k in close for t in pairs[k]])
    assert simhash.one_of_each(docs).count() == len(close)


@pytest.mark.parametrize("sizes", [{}, {"cell_rows": 2, "group_shingles": 1000}])
def test_near_duplicates_of_the_pipeline_are_verified(spark, sizes):
    texts = [t for p in edited_copies() for t in p]
    base = texts[0].split()
    texts += [" ".join(base[: 200 - k] + [f"x{k}y{j}" for j in range(k)]) for k in range(5, 60, 3)]  # a chain: each is near the next ones
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if group[i] != group[j] and plain_similarity(texts[i], texts[j]) >= 0.8:
                a, b = sorted((group[i], group[j]))
                group = [a if g == b else g for g in group]
    found = component_ids(spark, [*texts, None, "", " A b", "a B"], **sizes)
    n = len(texts)
    assert [found[k] for k in range(n + 4)] == [*group, n, n, n + 2, n + 2]
    assert sum(found[2 * k] != found[2 * k + 1] for k in range(60)) >= 20


def test_candidates_of_the_pipeline_come_from_fingerprints_first(spark, monkeypatch):
    rnd = random.Random(3)
    base = [["".join(rnd.choices("abcdefgh", k=5)) for _ in range(300)] for _ in range(6)]
    docs = documents(spark, [" ".join(x) for b in base for x in (b, [*b[:150], "odd", *b[151:]])])
    seen, rest = [], resemblance.candidates

    def none_left(sets, cell_rows, joined):
        seen.append(joined.count())
        found = rest(sets, cell_rows, joined)
        assert found.isEmpty()  # what the fingerprints' links connect is not proposed again
        return found

    monkeypatch.setattr(resemblance, "candidates", none_left)
    assert simhash.one_of_each(docs).count() == 6 and seen == [12]


def test_cells_meet():
    rng = np.random.default_rng(6)
    for bits, (widths, shared) in simhash.PARTITIONS.items():
        assert sum(widths) == 64 and len(widths) - bits >= shared
        edges = np.cumsum((0, *widths))
        for _ in range(200):
            flipped = rng.choice(64, bits, replace=False)
            assert sum(not ((flipped >= a) & (flipped < b)).any() for a, b in zip(edges, edges[1:], strict=False)) >= shared


def test_pivot_forest_connects_large_cells():
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 1 << 63, dtype=np.uint64)
    prints = np.unique(np.array([centre ^ (np.uint64(1) << np.uint64(a)) ^ (np.uint64(1) << np.uint64(b)) for a in range(64) for b in range(a)], np.uint64))
    i, j = simhash.cell_links(np.zeros(len(prints), np.int64), prints, 4)
    assert len(i) == len(prints) - 1 and (np.bitwise_count(prints[i] ^ prints[j]) <= 64).all()


def test_one_of_each_keeps_all_columns_and_one_row(spark):
    docs = documents(spark, ["same words here"] * 4 + ["other"] * 2, [5, 2, 2, None, None, None])
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == [(0, "other"), (2, "same words here")]


def test_components_take_few_plans_where_few_edges_are_left(spark, monkeypatch):
    edges = spark.createDataFrame([(k, k + 1) for k in range(0, 300) if k % 50] + [(7, 7)], "a long, b long")
    found, jobs = [], []
    for rest in (4096, 20, 0):
        monkeypatch.setattr(components, "REST", rest)
        spark.sparkContext.setJobGroup(f"components-{rest}", "")
        found.append({r.node: r.component for r in components.components(edges).collect()})
        jobs.append(len(spark.sparkContext.statusTracker().getJobIdsForGroup(f"components-{rest}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert found[0] == found[1] == found[2] == {k: (k - 1) // 50 * 50 + 1 for k in range(1, 301)}
    assert jobs[0] <= 12 < jobs[2]


def test_pipeline_plans_few_jobs_for_near_duplicates(spark):
    rnd = random.Random(3)
    base = [["".join(rnd.choices("abcdefgh", k=5)) for _ in range(60)] for _ in range(20)]
    docs = documents(spark, [" ".join(x) for b in base for x in (b, [*b, "odd"], ["even", *b])])
    spark.sparkContext.setJobGroup("one_of_each", "")
    kept = simhash.one_of_each(docs).count()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("one_of_each"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    print("jobs", jobs)
    assert kept == 20 and jobs <= 90  # each holds plans and code in the driver's memory; 5 runs of components() took more


def test_components(spark):
    edges = [(k, k + 1) for k in range(0, 30)] + [(100, 90), (100, 80), (7, 7), (0, 1)]
    found = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{k: 0 for k in range(31)}, 80: 80, 90: 80, 100: 80}


def plain_items(text):
    """The shingles of an item, and a document's runs of their length: five words, or all of a shorter item's."""
    w = re.sub(r"[\W_]+", " ", (text or "").lower()).split()
    n = min(5, len(w))
    runs = lambda t: {tuple(t[i : i + n]) for i in range(len(t) - n + 1)}
    return (runs(w), lambda d: runs(re.sub(r"[\W_]+", " ", (d or "").lower()).split())) if n else (set(), None)


def test_decontamination(spark):
    rnd = random.Random(3)
    word = lambda: rnd.choice(["ab", "cd", "ef", "gh", "ij", "kl", "mn"]) + rnd.choice("xyz")
    items = [" ".join(word() for _ in range(n)) for n in (14, 30, 60, 3)] + ["Quo", "vadis quo", "!!", ""]
    filler = lambda n: " ".join(word() for _ in range(n))
    part = items[2].split()
    texts = [None, "", filler(50), f"{filler(900)} {items[0].upper()}! {filler(40)}", f"{items[1]} {items[2]}", " ".join(part[:50] + ["odd"] + part[51:]), " ".join(part[:30]), items[3], "say: vadis, quo?", "quo", "quota", items[3], None]
    docs, table = documents(spark, texts), spark.createDataFrame([*enumerate(items), (None, items[0]), (9, None)], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontam.contained(docs, table).collect()}
    want = {(d, i) for d, t in enumerate(texts) for i, q in enumerate(items) if (s := plain_items(q))[0] and len(s[0] & s[1](t)) >= 0.8 * len(s[0])}
    assert found == want and {(3, 0), (4, 1), (4, 2), (5, 2), (7, 3), (8, 4), (8, 5), (9, 4), (11, 3)} <= want
    clean = decontam.without_contaminated(docs, table)
    assert clean.columns == docs.columns and {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in want} and {0, 1, 6, 10, 12} <= {r.doc_id for r in clean.collect()}
    assert decontam.contained(docs, table.limit(0)).count() == 0


def plain_spans(text):
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    ok = {
        "email": lambda m: True, "ip": lambda m: all(int(p) <= 255 for p in m.split(".")),
        "card": lambda m: 14 <= len(d := re.sub("[ -]", "", m)) <= 19 and sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(d[::-1])) % 10 == 0,
        "phone": lambda m: 10 <= len(re.sub("[^0-9]", "", m)) <= 15,
    }
    found = [(k, *m.span()) for k, p in kinds.items() for m in re.finditer(p, text) if ok[k](m.group())]
    return sorted(found, key=lambda s: (s[1], list(kinds).index(s[0])))


def test_pii_base_and_added(spark):
    rnd = random.Random(1)
    for _ in range(3000):
        text = "".join(rnd.choice("a.@1-5+ ()_9%") for _ in range(rnd.randint(0, 40)))
        assert pii.base_spans(text) == plain_spans(text)
    calls = [f"call +1 (386) 555-{k:04d} or a{k}@b.org from 10.0.0.{k % 250}, then 386-555-{k:04d} again" for k in range(300)]
    docs = documents(spark, [*calls, None, "", "no data in 10 of 20 words"])
    model = pii.learn(docs)
    rows = {r.doc_id: r for r in pii.find_personal_data(docs, model).collect()}
    assert [tuple(s) for s in rows[0].base] == plain_spans(calls[0])
    assert {tuple(s) for s in rows[0].base} < {tuple(s) for s in rows[0].spans}
    assert all(not rows[k].spans for k in (300, 301, 302))
    masked = {r.doc_id: r.text for r in pii.mask_personal_data(docs, model).collect()}
    assert masked[0] == "call <phone> or <email> from <ip>, then <phone> again" and masked[300] is None
    assert pii.learn(docs.limit(0)).weights.shape[1] == 5


def test_pii_reaches_every_mention_of_a_document():
    field = pii.Field({}, np.zeros((1, 5)), np.full((5, 5), -2.0) + np.eye(5) * 14, np.full((5, 5), -3.0) + np.eye(5) * 5.4)
    said = [f"we say {'555-0123' if k % 2 else '5550123'} in words" for k in range(60)]
    base, spans = pii.all_spans(" ".join([*said[:5], "call +1 (386) 555-0123 now", *said[5:]]), field)
    assert len(base) == 1 and len(spans) == 61 and {s[0] for s in spans} == {"phone"}
    n, p = 120, np.eye(5)[4]  # a chain seen at one end only, against its exact marginals
    observed = np.full(n, -1)
    observed[0] = 4
    step = np.exp(field.chain) / np.exp(field.chain).sum(axis=1, keepdims=True)
    found = field.marginals(pii.Graph([], ["a"] * n, observed, [(k, k + 1) for k in range(n - 1)], []))
    for k in range(n):
        assert np.allclose(found[k], p, atol=1e-3)
        p = p @ step


def test_language(spark):
    rnd = random.Random(5)
    vocabulary = {"aa": ["pako", "tiko", "moku", "kopa"], "bb": ["schreng", "wurst", "stroff", "gruntz"], "cc": ["quesie", "doñar", "miente", "llora"]}
    rows = [(k, " ".join(rnd.choices(vocabulary[lang], k=30)), lang) for k in range(240) for lang in [list(vocabulary)[k % 3]]]
    rows += [(900, None, "aa"), (901, "12 34 !", "aa"), (902, "", None), (903, "Pako, moku wurst", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.learn(docs.filter("doc_id % 5 != 0"))
    found = {r.doc_id: r for r in langid.identify(docs.drop("lang"), model).collect()}
    assert sum(found[k].lang_pred == lang for k, _, lang in rows[:240]) >= 238
    assert all(found[k].lang_pred == "und" and found[k].score == 0 for k in (900, 901, 902))
    assert found[903].lang_pred == "aa" and 0 <= found[903].score <= 1
    mixed = model.predict([" ".join(["pako"] * 40 + ["wurst"] * 20)])[0]
    assert mixed[0] == "aa" and 0.5 < mixed[1] < 0.8
    assert {r.doc_id for r in langid.keep_identified(docs, model).collect()}.isdisjoint({900, 901, 902})
    assert langid.keep_identified(docs, langid.learn(docs.limit(0))).count() == docs.count()


def test_language_reads_whole_words(monkeypatch):
    assert langid.bare("-" * 250 + "Hello" + "1" * 250) == "hello" and langid.bare("-" * 300) == langid.bare("") == "" and langid.bare("'x") == "x"
    windows = [("aa", ["pakotiko", "mokukopa"] * 9), ("bb", ["schreng", "gruntzst"] * 9)] * 20
    model = langid.train(windows)
    assert [p[0] for p in model.predict(["-" * 250 + "Pako", "pako" * 12 + "schreng" * 90, "-" * 250])] == ["aa", "bb", "und"]
    long = "pako" * 12 + "schreng" * 90
    whole = model.predict([long])[0][2]
    monkeypatch.setattr(langid, "PIECE", 7)
    model.memo, model.rows = {}, None
    assert np.allclose(model.predict([long])[0][2], whole) and sorted(f for p in langid.pieces(long, model.lexicon) for f in p) == sorted(langid.features(long, model.lexicon))


def test_forward_backward_is_exact():
    rng = np.random.default_rng(0)
    t, size = rng.normal(size=(3, 3)), np.array([1, 70, 0, 33, 32])
    e = rng.normal(size=(size.sum(), 3)) * 2
    p, at = langid.marginals(e, size, t), 0
    for n in size[size > 0]:
        x = e[at : at + n]
        a, b = np.zeros((n, 3)), np.zeros((n, 3))
        a[0] = np.logaddexp.reduce(t, axis=0) + x[0]
        for k in range(1, n):
            a[k] = np.logaddexp.reduce(a[k - 1][:, None] + t, axis=0) + x[k]
        for k in range(n - 2, -1, -1):
            b[k] = np.logaddexp.reduce(t + x[k + 1] + b[k + 1], axis=1)
        q = np.exp(a + b - np.logaddexp.reduce(a + b, axis=1, keepdims=True))
        assert np.allclose(q, p[at : at + n], atol=1e-9)
        at += n


def test_lattice_scores(spark):
    import math

    lat = lattice.Lattice({p: math.log(x) for p, x in {"▁a": 0.2, "b": 0.3, "▁ab": 0.1, "▁": 0.1, "a": 0.3}.items()})
    assert lat.log_marginal("ab") == pytest.approx(math.log(0.2 * 0.3 + 0.1 + 0.1 * 0.3 * 0.3))
    counts = {}
    lat.expect("ab", 2.0, counts)
    assert counts["▁ab"] == pytest.approx(2 * 0.1 / 0.169)
    texts = [*TEXTS, *(f"the words {k} of the text" for k in range(20))]
    docs = documents(spark, texts)
    scored = lattice.score_documents(docs, tokenizers_files.path("piece_bpe_32k.model"), F.col("doc_id") % 2 == 0)
    found = {r.doc_id: r for r in scored.collect()}
    tokens = [[*re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower()), None] for t in texts]
    seen = {}
    for k in range(0, len(texts), 2):
        for w in tokens[k]:
            seen[w] = seen.get(w, 0) + 1
    n, v = sum(seen.values()), len(seen)
    for k, ws in enumerate(tokens):
        r = found[k]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(ws), sum(w in seen for w in ws), n)
        assert r.base_score == pytest.approx(sum(math.log10((seen.get(w, 0) + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        assert r.score < 0
    assert lattice.score_documents(docs.limit(0), tokenizers_files.path("piece_bpe_32k.model"), F.lit(True)).count() == 0


def test_word_probabilities_sum_to_one_at_most():
    import math

    totals = lattice.Totals(tokens=12, words=3, ends=2, discount=0.5)
    known = {"a": 5, "b": 4, "c": 1}
    spread = {"a": 0.2, "b": 0.1, "c": 0.1, "d": 0.6}
    whole = 10 ** totals.end() + sum(10 ** totals.model(known.get(w, 0), math.log(p)) for w, p in spread.items())
    assert whole == pytest.approx(1)


def test_warc(spark):
    rows = [(1, "http://a/", "z"), (2, None, None), (3, "u", "z"), (4, "u\n v", ""), (5, "é", "zé"), (None, "q", "z"), (6, "w", "x" * 200_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    folder = fresh_path(spark, "w")
    index, _ = stored(warc.write_archives(warc.with_originals(pages), folder), "i")
    found = {r.page_id: r for r in warc.read_records(index, folder).collect()}
    import base64

    for page, _, html in rows:
        body = (html or "").encode()
        assert (found[page].payload_bytes, found[page].payload_digest) == (len(body), base64.b32encode(hashlib.sha1(body).digest()).decode())
    assert {k: (r.record_type, r.refers_to) for k, r in found.items()} == {
        1: ("revisit", 3), 2: ("revisit", 4), 3: ("response", None), 4: ("response", None), 5: ("response", None), None: ("response", None), 6: ("response", None),
    }
    assert found[6].html == "x" * 200_000
    some = warc.read_records(index.filter("page_id in (5, 1)"), folder).collect()
    assert sorted(r.page_id for r in some) == [1, 5]


@pytest.mark.parametrize(
    ("url", "rule", "verdict"),
    [
        ("http://www.Example.com/en/x?q#f", "www.example.com/en/", "allow"), ("https://m.example.com/en/", "example.com/en/", "block"), ("http://notexample.com/en/", "com/", "allow"),
        ("http://a.net/es/1", "net/es/", "block"), ("http://a.net/x/es/", None, "allow"), ("http://com/", "com/", "allow"), ("http://a.com", None, "allow"), ("http://casino-x.org/a", None, "block"),
        ("http://ok.org/.example.com/en/", None, "allow"), (None, None, "allow"), ("nothing", None, "allow"), ("", None, "allow"), ("http://a.org/" + "p" * 5000, None, "allow"),
    ],
)
def test_urls(spark, url, rule, verdict):
    df = spark.createDataFrame([(1, url, "x")], "page_id long, url string, host string")
    r = urlrules.judge(df).first()
    assert (r.rule, r.verdict) == (rule, verdict)


def test_automaton_is_glob():
    from fnmatch import fnmatchcase

    rnd = random.Random(9)
    globs = ["".join(rnd.choice("ab*") for _ in range(rnd.randint(0, 9))) for _ in range(60)]
    texts = ["".join(rnd.choice("ab") for _ in range(rnd.randint(0, 9))) for _ in range(200)]
    fits = urlrules.ShiftAnd([urlrules.glob_symbols(g) for g in globs]).fits([list(t.encode()) for t in texts])
    assert all(fits[i, k] == fnmatchcase(t, g) for i, t in enumerate(texts) for k, g in enumerate(globs))


def test_lattice_hash_finds_near_vectors(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 64))
    near = x[:60] + rng.normal(size=(60, 64)) * 0.15
    rows = [(k, v.tolist()) for k, v in enumerate([*x, *near, *x[:3], *x[:3] * 2])]
    rows += [(1000, None), (1001, [0.0] * 64), (1002, [float("nan")] * 64), (1003, [None] * 64), (None, x[0].tolist()), (1004, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("n_links", F.lit("clash"))
    found = {r.vec_id: r for r in embeddings.near_duplicate_vectors(df).collect()}
    u = np.array([v for _, v in rows[:366]])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    links = (u @ u.T >= 0.95).sum(axis=1) - 1
    got = np.array([found[k].n_links for k in range(366)])
    assert (got <= links).all() and got.sum() >= 0.9 * links.sum()
    assert all(found[k].n_links == 0 for k in (1000, 1001, 1002, 1003, 1004, None))
    assert found[361].component_id == 1 and not found[361].kept and found[1].kept


def test_large_cells_are_dealt_out(spark):
    rng = np.random.default_rng(3)
    v = rng.normal(size=8) + rng.normal(size=(300, 8)) * 0.001
    classes = spark.createDataFrame([(k, x.tolist(), 1) for k, x in enumerate(v)], "rep long, embedding array<double>, weight long")
    found = embeddings.linked_classes(classes, 0.95, cell_rows=64)
    counts = {r.a: r.n for r in found.filter("b is null").groupBy("a").agg(F.sum("n").alias("n")).collect()}
    assert counts == {k: 299 for k in range(300)}


def test_pipeline_stages(spark, tmp_path):
    rows = [(k, f"text number {k} with quite different words {' '.join(str((k * j) % 97) + 'w' for j in range(40))} and a{k}@b.org", "en", "s", 9) for k in range(30)]
    rows += [(50, rows[0][1], "en", "s", 9), (51, None, "en", "s", 0), (52, "123 456", None, "s", 7), (None, "fine text without an id", "en", "s", 1), (53, "one two three four five six seven eight nine ten", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, rows[53 - 20][1]), (2, "one two three four five six seven eight nine ten")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(out) >= {0, 1, 29} and set(out).isdisjoint({50, 51, 52, 53})
    want = library_ids(rows[1][1].replace("a1@b.org", "<email>"))
    assert list(out[1].token_ids) == want
    assert len(corpus_pipeline.STAGES) == 5


def test_registered_names():
    assert sorted(int(re.match(r"op(\d+)_", n).group(1)) for n in queries.queries()) == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(queries.queries())
    assert json.dumps(queries.oracle_sql())


def test_pii_marginals_are_exact_on_trees():
    from itertools import product

    rng = np.random.default_rng(4)
    field = pii.Field({}, rng.normal(size=(1, 5)), rng.normal(size=(5, 5)), (lambda x: x + x.T)(rng.normal(size=(5, 5))))
    chain, skip = [(0, 1), (1, 2)], [(1, 3), (0, 4)]
    observed = np.array([-1, -1, 2, -1, -1])
    want = np.zeros((5, 5))
    for labels in product(range(5), repeat=5):
        if labels[2] != 2:
            continue
        weight = np.exp(sum(field.weights[0, y] for y in labels) + sum(field.chain[labels[i], labels[j]] for i, j in chain) + sum(field.skip[labels[i], labels[j]] for i, j in skip))
        for node, y in enumerate(labels):
            want[node, y] += weight
    found = field.marginals(pii.Graph([], ["a"] * 5, observed, chain, skip))
    assert np.allclose(found, want / want.sum(axis=1, keepdims=True), atol=1e-3)


def test_pii_recovers_hidden_spans():
    rnd = random.Random(11)
    number = lambda n: "".join(rnd.choices("0123456789", k=n))
    say = {"email": lambda: f"w{number(3)}@mail{number(1)}.example.com", "phone": lambda: f"+1 ({number(3)}) 555-{number(4)}", "ip": lambda: f"{rnd.randrange(256)}.{rnd.randrange(256)}.1.{rnd.randrange(99)}"}
    texts = [" ".join(x for _ in range(3) for x in ("words and", say[rnd.choice(list(say))](), f"version {number(1)}.0 of {number(16)} too")) for _ in range(300)]
    graphs = [pii.graph(t, pii.base_spans(t)) for t in texts]
    field = pii.train(graphs[:200])
    hits = misses = wrong = 0
    for t in texts[200:]:
        base = pii.base_spans(t)
        kind, a, b = rnd.choice(base)
        g = pii.graph(t, [s for s in base if s != (kind, a, b)])
        p = field.marginals(g)
        for n, (x, y) in enumerate(g.spans):
            if g.observed[n] < 0:
                called = pii.LABELS[p[n].argmax()] if p[n].max() >= 0.8 else "none"
                if x < b and a < y:
                    hits, misses = hits + (called == kind), misses + (called != kind)
                else:
                    wrong += called != "none"
    assert hits >= 0.95 * (hits + misses) and wrong <= 0.02 * hits


def test_pii_compares_whole_tokens():
    long = "a" * 100 + "1"
    assert not set(pii.alike_keys(long + "2")) & set(pii.alike_keys(long + "3")) and pii.alike_keys(long) == pii.alike_keys(long.upper())
    assert pii.shape("9" * 30) != pii.shape("9" * 30 + "-" * 40 + "b")


def test_joins_are_repaired_where_tokens_reach_over_them():
    path = tokenizers_files.path("byte_bpe_50k.json")
    rnd = random.Random(6)
    texts = [" ".join(rnd.choices(["the", "Cat", "sat,", "on", "mats.", "again"], k=400)) for _ in range(3)]
    coder = bpe.ChunkEncoder(path)
    want = [packed(Tokenizer.from_file(path).encode(t, add_special_tokens=False).ids) for t in texts]
    assert coder.encode([t.encode() for t in texts]) == want
    assert coder.repaired > 10 and coder.whole == 0
    own = bpe.ChunkEncoder(BPE)
    shared = " ".join(rnd.choices("abcdefghij", k=500))
    assert own.encode([f"first {shared}".encode(), f"and the second {shared}".encode()]) == [packed(library_ids(f"first {shared}")), packed(library_ids(f"and the second {shared}"))]
    assert own.reused >= 0.4 * (own.reused + own.encoded)


def test_lattices_side_by_side_are_the_plain_one():
    prior = lattice.vocabulary_prior(tokenizers_files.path("piece_bpe_32k.model"))
    plain = lattice.Lattice({p: math.log(x) for p, x in prior.items()})
    own, rnd = lattice.SideBySide(plain), random.Random(5)
    words = ["".join(rnd.choices("theanroéüß漢x9-", k=rnd.randint(0, 14))) for _ in range(400)] + ["the", "and", "𝄞𝄞"]
    marginal, counts, uses = {}, {}, 0.0
    for at in lattice.of_one_length([lattice.SPACE + w for w in words]):
        marginal.update(zip(at, own.log_marginals([lattice.SPACE + words[k] for k in at]).tolist(), strict=True))
        uses = uses + own.expect([lattice.SPACE + words[k] for k in at], np.arange(len(words))[at] + 1.0)
    for k, w in enumerate(words):
        assert marginal[k] == pytest.approx(plain.log_marginal(w))
        plain.expect(w, k + 1.0, counts)
    found = {p: n for p, n in zip(own.names, uses.tolist(), strict=False) if n > 1e-9}
    assert found == pytest.approx({p: n for p, n in counts.items() if n > 1e-9})


def test_long_words_go_by_a_digest(spark):
    long = ["x" * 5000, "x" * 5000 + "y"]
    docs = documents(spark, [f"{long[0]} a", f"a {long[0]}", long[1]])
    found = {r.doc_id: r for r in lattice.score_documents(docs, tokenizers_files.path("piece_bpe_32k.model"), F.col("doc_id") == 0).collect()}
    assert [found[k].n_known for k in range(3)] == [3, 3, 1] and found[2].score < found[1].score


def test_empty_tables(spark, tmp_path):
    none = documents(spark, [])
    assert tokenfile.read_token_files(stored(tokenfile.write_token_files(none, BPE, fresh_path(spark, "t"), 1), "m")[0], fresh_path(spark, "t")).count() == 0
    assert pii.find_personal_data(none, pii.learn(none)).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = fresh_path(spark, "w")
    assert warc.read_records(stored(warc.write_archives(warc.with_originals(pages), folder), "i")[0], folder).count() == 0
    assert urlrules.judge(pages).count() == 0
    assert embeddings.near_duplicate_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0
    none.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_repeated_rows_stay(spark):
    texts = ["call +1 (386) 555-0123 now", "words and words", "call +1 (386) 555-0123 now"]
    docs = documents(spark, texts, [1, 2, 1])
    assert sorted(r.doc_id for r in pii.find_personal_data(docs, pii.learn(docs)).collect()) == [1, 1, 2]
    assert sorted(r.doc_id for r in bpe.token_digests(docs, BPE).collect()) == [1, 1, 2]
    pages = spark.createDataFrame([(5, "u", "same"), (5, "v", "same"), (3, "w", "same")], "page_id long, url string, html string")
    folder = fresh_path(spark, "w")
    found = warc.read_records(stored(warc.write_archives(warc.with_originals(pages), folder), "i")[0], folder).collect()
    assert sorted((r.page_id, r.record_type, r.refers_to) for r in found if r.page_id == 5) == [(5, "response", None)] * 2 and [r.refers_to for r in found if r.page_id == 3] == [5]
    assert sorted(r.page_id for r in urlrules.judge(pages).collect()) == [3, 5, 5]


def test_clashing_columns(spark):
    docs = documents(spark, ["one two three four five six", "one two three four five six", "other"]).withColumns({c: F.lit("own") for c in ("_key", "_k1", "_k2", "_doc_key", "key", "node", "cell", "task")})
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id, r._k1) for r in kept.collect()) == [(0, "own"), (2, "own")]
    items = spark.createDataFrame([(1, "one two three four five six")], "item_id long, text string")
    clean = decontam.without_contaminated(docs, items)
    assert clean.columns == docs.columns and [(r.doc_id, r._doc_key) for r in clean.collect()] == [(2, "own")]


def test_partitions_for_many_fingerprints_are_exact():
    assert simhash.key_blocks(4, 1000) == simhash.PARTITIONS[4] and simhash.key_blocks(4, 1 << 34)[1] > 2
    for count in (0, 1 << 28, 1 << 34, 1 << 45):
        widths, shared = simhash.key_blocks(4, count)
        assert sum(widths) == 64 and len(widths) - 4 >= shared


FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not __import__("os").path.isdir(FOLDER), reason="the driver's tables aren't here")
@pytest.mark.parametrize("name", queries.queries())
def test_queries_over_a_folder(spark, name):
    import duckdb

    table = {"op4": "pages", "op6": "pages", "op8": "embeddings", "op13": "conversations"}.get(name.split("_")[0], "documents")
    df = queries.queries()[name](spark, FOLDER)
    rows = df.collect()
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    if name in queries.oracle_sql():
        found = con.execute(queries.oracle_sql()[name])
        at = [[c[0] for c in found.description].index(c) for c in df.columns]
        key = lambda r: tuple((v is None, str(v)) for v in r)
        assert sorted(map(tuple, rows), key=key) == sorted((tuple(r[k] for k in at) for r in found.fetchall()), key=key)
    elif name.startswith("op13_"):
        assert len(rows) == spark.read.parquet(f"{FOLDER}/{table}.parquet").select("conv_id").distinct().count()
    else:
        assert len(rows) == spark.read.parquet(f"{FOLDER}/{table}.parquet").count()
    if name.startswith("op1_"):
        own = Tokenizer.from_file(BPE)
        start = 0
        for r, (doc, text) in zip(sorted(rows, key=lambda r: r.doc_id), con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall(), strict=True):
            ids = [*own.encode(text or "", add_special_tokens=False).ids, 1]
            assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (doc, start, len(ids), zlib.crc32(packed(ids)))
            start += len(ids)
