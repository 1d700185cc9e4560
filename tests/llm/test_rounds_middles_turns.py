"""SentencePiece rounds against the library, fill-in-middle against plain code and SQL, conversation repair against all edits."""

import hashlib
import itertools
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from wildtally.llm import middle, pieces, turns

tokenizers_files = pytest.importorskip("public_tokenizers")
sentencepiece = pytest.importorskip("sentencepiece")
MODEL = tokenizers_files.path("piece_bpe_32k.model")
ALPHABETS = [
    "abcdefghij " * 3 + "\n\t.,", "aab " * 3, "  ▁▁x\n", "=-_*#/\\ ", "日本語中文한국 のは。", "éüßñ żó 😀‍\x00�퟿", "0123456789 .,", "<s></s><unk><0x41>", "etaoin shrdlu THE ",
]


def odd_texts(seed, n):
    pick = random.Random(seed)
    out = []
    for _ in range(n):
        letters = pick.choice(ALPHABETS) if pick.random() < 0.7 else "".join(pick.sample(ALPHABETS, 3))
        out.append("".join(pick.choices(letters, k=pick.choice([0, 1, 2, 3, 5, 10, 40, 200, 800]))))
    return out


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def test_pieces_are_the_library(library):
    own = pieces.PieceRounds(MODEL, max_kept_bytes=100_000)
    long = ["a" * 3000, " " * 1000, "▁" * 700 + "hello", "ab" * 2000, "=" * 999, " " * 5000 + "x\n" + " " * 77, "".join(chr(random.Random(5).randrange(1, 0x3000)) for _ in range(5000))]
    texts = odd_texts(3, 2500) + long
    for at in range(0, len(texts), 64):
        some = texts[at : at + 64]
        for text, ids in zip(some, own.encode([t.encode() for t in some]), strict=True):
            told = library.encode(text)
            assert ids.tolist() == told, text[:100]
            assert own.digits(ids) == ",".join(map(str, told)).encode()
            assert own.decode(ids) == library.decode(told)


def test_any_ids_decode_as_the_library_does(library):
    own, pick = pieces.PieceRounds(MODEL), random.Random(1)
    for _ in range(1500):
        ids = [pick.choice([pick.randrange(300), pick.randrange(32000), pick.randrange(5)]) for _ in range(pick.randrange(12))]
        assert own.decode(np.array(ids, int)) == library.decode(ids), ids


def test_words_are_merged_once():
    own = pieces.PieceRounds(MODEL)
    own.encode([b"one two one two", b"two one"])
    assert own.merged == 2
    own.encode([b"one three"])
    assert own.merged == 3


def test_merges_that_bring_an_earlier_pair_are_known():
    own = pieces.PieceRounds(MODEL)
    spaces = own.symbol_of[ord("▁")], own._pair(*[np.array([own.symbol_of[ord("▁")]])] * 2)[0][0]
    assert own.early[spaces[1]]  # two spaces and two more have the same score
    assert not own.early[spaces[0]]


def test_piece_queries_handle_odd_rows(spark, library):
    texts = [None, "", " ", "Hello wörld", "Hello wörld", "x" * 20_000, "a b " * 20_000]
    docs = spark.createDataFrame([(None if k == 3 else k, t, "clash", k) for k, t in enumerate(texts)], "doc_id long, text string, decoded string, n_tokens long")
    found = pieces.encode_documents(docs, MODEL).collect()
    told = sorted(((r.doc_id, tuple(r.piece_ids), r.decoded) for r in found), key=repr)
    ids = [library.encode(t or "") for t in texts]
    assert told == sorted(((None if k == 3 else k, tuple(x), library.decode(x)) for k, x in enumerate(ids)), key=repr)
    rows = {r.doc_id: r for r in pieces.piece_digests(docs, MODEL).collect()}
    for k, x in enumerate(ids):
        r = rows[None if k == 3 else k]
        assert (r.n_tokens, r.ids_sha256) == (len(x), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(x).encode()).hexdigest()
    assert pieces.piece_digests(docs.limit(0), MODEL).count() == 0


def plain_middle(text, doc_id, cut=100, spm=50):
    h = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k : k + 8], 16) for k in (0, 8, 16, 24))
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    few, more = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b, c = "".join(units[:few]), "".join(units[few:more]), "".join(units[more:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= cut:
        return n, "plain", None, None, text
    if h4 % 100 < spm:
        return n, "spm", len(a), len(b), f"<S>{c}<P>{a}<M>{b}"
    return n, "psm", len(a), len(b), f"<P>{a}<S>{c}<M>{b}"


MIDDLES = [None, "", "\n", "one line", "a\nb\nc", "a\n\n\nb\n", "with <P> mark\nx", "<S>", "x<M>", "é😀\nü\n" * 7, "long\n" * 30_000, "y" * 100_000, "a\nb\nc", "<Q>\r\n<", "< P >\n\x00"]


@pytest.mark.parametrize("cut", [100, 40, 0])
def test_fill_in_middle(spark, cut):
    rows = [(None if k == 4 else k, t, "own") for k, t in enumerate(MIDDLES)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fim_n string")
    layout = middle.Layout(cut_percent=cut)
    found = middle.fill_in_middle(docs, layout)
    assert found.columns == ["doc_id", "text", "fim_n", "_fim_n", "fim_form", "fim_prefix_chars", "fim_middle_chars", "fim_output"]
    again = found.withColumn("again", middle.text_of(F.col("fim_output"), F.col("fim_form"), layout)).collect()
    assert len(again) == len(rows)
    for r in again:
        assert (r._fim_n, r.fim_form, r.fim_prefix_chars, r.fim_middle_chars, r.fim_output) == plain_middle(r.text or "", r.doc_id, cut)
        assert r.again == (r.text or "") and r.fim_n == "own"
    assert middle.fill_in_middle(docs.limit(0), layout).count() == 0


def test_other_units_and_marks():
    layout = middle.Layout(unit=r"\X", prefix_mark="«", suffix_mark="»", middle_mark="¦")
    unit = regex.compile(layout.unit)
    for doc_id, text in itertools.product(range(40), ["éa👩‍👩‍👧b", "plain « text", "ab"]):
        n, form, before, inner, output = middle.rearranged(text, doc_id, layout, unit)
        assert n == len(unit.findall(text))
        assert middle.restored(output, form, layout) == text
        assert form == "plain" or (output.count("¦") == 1 and output.endswith("¦" + text[before : before + inner]))


def test_fill_in_middle_sql(spark, tmp_path):
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(MIDDLES) if "\x00" not in (t or "")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = middle.op12_fill_in_middle(spark, str(tmp_path))
    told = duckdb.sql(f"SELECT {', '.join(found.columns)} FROM ({middle.OP12_SQL})").fetchall()
    assert sorted(map(tuple, found.collect())) == sorted(told)


INK = re.compile(r"[^\x20\x09-\x0D]")


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        ink = INK.findall(text)
        out.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def all_edits(rows, faults):
    """Cost, audit and lines of every sequence of edits (at most two inserted turns in one place) that gives good roles."""
    good = re.compile(r"(s?(ua)+)?")
    each = []
    for (_, role, text), fault in zip(rows, faults, strict=True):
        late = fault == "truncated"
        own = [(3, "D", ())]
        if fault not in ("blank", "duplicate"):
            own += [(late, "K", ((role, text),))] + [(2 + late, "R", ((r, text),)) for r in ("user", "assistant")]
        each.append(own)
    runs = [(2 * n, "I" * n, tuple((r, "") for r in roles)) for n in range(3) for roles in itertools.product(("user", "assistant"), repeat=n)]
    for steps in itertools.product(*[part for own in each for part in (runs, own)], runs):
        lines = [x for s in steps for x in s[2]]
        if good.fullmatch("".join(r[:1] or "x" for r, _ in lines)):
            yield sum(s[0] for s in steps), "".join(s[1] for s in steps), "\n".join(f"{r}:{t}" for r, t in lines)


def layered(rows, faults):
    """The same by whole audits for each state, without ranks or pieces."""
    best = {"": (0, "", [])}
    insert = lambda q, c, a, x: (("a", "assistant") if q == "u" else ("u", "user"), c + 2, a + "I", x)

    def more(state, told):
        yield state, *told
        for _ in range(3):
            (state, name), cost, audit, lines = insert(state, *told)
            told = cost, audit, [*lines, f"{name}:"]
            yield state, *told

    for (_, role, text), fault in zip(rows, faults, strict=True):
        new = {}
        late = fault == "truncated"
        for start, told in best.items():
            for q, c, a, x in more(start, told):
                options = [(q, c + 3, a + "D", x)]
                if fault not in ("blank", "duplicate"):
                    to, name = ("a", "assistant") if q == "u" else ("u", "user")
                    options.append((to, c + 2 + late, a + "R", [*x, f"{name}:{text}"]))
                    if (role[:1] == "s" and q == "") or role[:1] == to:
                        options.append((role[:1], c + late, a + "K", [*x, f"{role}:{text}"]))
                for state, *found in options:
                    if state not in new or tuple(found[:2]) < tuple(new[state][:2]):
                        new[state] = tuple(found)
        best = new
    cost, audit, lines = min((c, a, x) for s, t in best.items() for q, c, a, x in more(s, t) if q in ("", "a"))
    return cost, audit, "\n".join(lines)


def plain_repair(table, damage=True):
    groups = {}
    for conv, turn, role, text in table:
        kept = groups.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 9
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        kept += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    out = []
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        faults, dated = faults_of(rows), {r[0] for r in rows if r[0] is not None}
        cost, audit, text = layered(rows, faults)
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
        gaps = max(dated) - min(dated) + 1 - len(dated) if dated else 0
        out.append((conv, gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def random_rows(seed, n):
    pick = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", "u"]
    return [(k if pick.random() < 0.9 else None, pick.choices(roles, [5, 5, 2, 1, 0.3, 0.3])[0], pick.choice(["Hi.", "So?", "no end", "", " \t", f"Text {k}.", "Well!  \n"])) for k in range(n)]


def test_the_least_audit_of_all_edits():
    for seed in range(120):
        rows = random_rows(seed, seed % 4)
        faults = faults_of(rows)
        told = min(all_edits(rows, faults), key=lambda x: x[:2])
        assert layered(rows, faults) == told
        symbols = "".join(turns._symbol(r[1][:1], f) for r, f in zip(rows, faults, strict=True))
        cost, borders, tail = turns.joined([turns.summed(symbols)])
        assert (cost, turns.traced(symbols, *borders[0]) + tail) == told[:2]


def test_pieces_of_a_conversation_give_what_the_whole_does():
    pick = random.Random(4)
    for _ in range(300):
        symbols = "".join(pick.choices(turns.SYMBOLS, k=pick.randrange(40)))
        cost, borders, tail = turns.joined([turns.summed(symbols)])
        cuts = sorted(pick.choices(range(len(symbols) + 1), k=3))
        parts = [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)], strict=True)]
        told = turns.joined([turns.summed(p) for p in parts])
        assert (told[0], told[2]) == (cost, tail)
        assert "".join(turns.traced(p, *b) for p, b in zip(parts, told[1], strict=True)) == turns.traced(symbols, *borders[0])


def odd_conversations():
    pick = random.Random(9)
    rows = [(c, k, pick.choice(["user", "assistant", "system", None, "tool"]), pick.choice(["Yes.", "cut", "", None, f"Turn {k}!"])) for c in range(60) for k in range(pick.randrange(1, 9))]
    rows += [(None, 1, "user", "Hi."), (None, 2, "assistant", "Ho."), (None, None, "system", "Rules.")]
    rows += [(700, 3, "user", "Same."), (700, 3, "assistant", "Same."), (700, 3, "user", "Other."), (700, None, "user", "First."), (700, None, "user", "First.")]
    rows += [(701, k, "user" if k % 2 else "assistant", "Word. " * 5000) for k in range(4)]
    return rows + [(800, k, "assistant" if k % 3 else "user", f"Line {k}." if k % 5 else "Line.") for k in range(3000)]  # one conversation has most rows


def test_conversation_repair(spark, tmp_path):
    rows = odd_conversations()
    told = plain_repair(rows)
    turns_ = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("audit", F.lit("clash")).withColumn("pos", F.lit(0))
    turns_.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # else so few rows are one range
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        found = sorted(map(tuple, turns.op13_conversation_repair(spark, str(tmp_path)).collect()), key=repr)
        assert found == told
        done = turns.repair(turns.damaged(spark.read.parquet(f"{tmp_path}/conversations.parquet")))
        assert done.choices.filter("conv_id = 800").count() > 3  # so it was dealt out
        lines = {}
        for r in done.turns().orderBy("conv_id", "place").collect():
            lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
        shown = {t[0]: hashlib.sha256("\n".join(lines.get(t[0], [])).encode()).hexdigest() for t in told}
        assert shown == {t[0]: t[-1] for t in told}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty_and_wholly_dropped_conversations(spark, tmp_path):
    dropped = next((c, 0) for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(*dropped, "user", "Hi."), (-5, 7, None, None)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/a/conversations.parquet")
    assert sorted(map(tuple, turns.op13_conversation_repair(spark, f"{tmp_path}/a").collect()), key=repr) == plain_repair(rows)
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/b/conversations.parquet")
    assert turns.op13_conversation_repair(spark, f"{tmp_path}/b").collect() == []


@pytest.mark.skipif(not __import__("os").path.isdir("/root/testdata/sf0.001"), reason="the driver's tables aren't here")
def test_conversations_of_the_folder(spark):
    found = sorted(map(tuple, turns.op13_conversation_repair(spark, "/root/testdata/sf0.001").collect()), key=repr)
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert found == plain_repair(map(tuple, table.collect()))
