"""Language-model scores from a subword lattice.

An existing unigram vocabulary spans a lattice over each word: every way to cut it into pieces is a path, weighted by
the product of its pieces' probabilities. A log-space forward recursion sums all paths. Piece probabilities start from
the vocabulary's scores and are fitted once to the training words (expected counts of a forward-backward pass). Whole
words seen in training have an edge of their own, with a discounted count; what the discount frees is shared out by
the lattice, so that all words and the end of a text have probability one together, and a text's score is the log10 of
its marginal probability. A word seen often is scored mainly by its own count, a rare one in part and an unseen one
wholly by the lattice, which is the back-off of this model.

Words are counted over all documents. Each word's lattice is summed once, not once for each place it stands, and words
of one length side by side. Counts and scores of the HEAD most frequent words (of all documents, not only the training
ones) go to all tasks; other words are joined to their document by a shuffle, so no frequent word is ever a join key.
Long words go by a digest, so what is sent is bounded in bytes.
"""

from __future__ import annotations

import hashlib
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wildtally.llm.shared import as_bytes, in_blocks, over_batches, remainder, remove, stored, table

SPACE = "▁"
#: Words whose counts and scores are sent to every task: about 8 MB; words over KEY_BYTES go by a digest of half as many.
HEAD, KEY_BYTES = 65_536, 64
#: Words a task counts before it passes them on.
HELD_WORDS = 400_000
#: Symbols of words whose lattices are summed side by side, and such words at most; longer ones are summed alone.
SIDE_BY_SIDE, ABREAST = 64, 8192

class Lattice:
    """Pieces with log probabilities; characters without a piece are spelt in byte pieces."""

    def __init__(self, log_p: dict[str, float]) -> None:
        self.log_p = log_p
        self.prefixes = {p[:k] for p in log_p for k in range(1, len(p) + 1)}
        rarest = min(log_p.values(), default=0.0)
        self.byte = [log_p.get(f"<0x{b:02X}>", rarest) for b in range(256)]

    def edges(self, text: str) -> list[list[tuple[int, float, str]]]:
        """For each position: end, log probability and piece of the edges that leave it."""
        log_p, prefixes, out = self.log_p, self.prefixes, []
        for a in range(len(text)):
            here = []
            for b in range(a + 1, len(text) + 1):
                piece = text[a:b]
                if piece not in prefixes:
                    break
                p = log_p.get(piece)
                if p is not None:
                    here.append((b, p, piece))
            if not here or here[0][0] != a + 1:
                here.append((a + 1, sum(self.byte[x] for x in text[a].encode("utf-8", "surrogatepass")), ""))
            out.append(here)
        return out

    @staticmethod
    def forward(edges: list) -> list[float]:
        """Log of the summed probability of all paths to each position."""
        into: list[list[float]] = [[] for _ in range(len(edges) + 1)]
        into[0].append(0.0)
        total = []
        for at, terms in enumerate(into):
            most = max(terms)
            sum_ = most if len(terms) == 1 else most + math.log(sum([math.exp(t - most) for t in terms]))
            total.append(sum_)
            if at < len(edges):
                for b, p, _ in edges[at]:
                    into[b].append(sum_ + p)
        return total

    def log_marginal(self, word: str) -> float:
        return self.forward(self.edges(SPACE + word))[-1]

    def expect(self, word: str, times: float, counts: dict[str, float]) -> None:
        """Adds the expected number of uses of each piece in `times` copies of the word."""
        edges = self.edges(SPACE + word)
        alpha = self.forward(edges)
        beta = [0.0] * (len(edges) + 1)
        for a in range(len(edges) - 1, -1, -1):
            terms = [p + beta[b] for b, p, _ in edges[a]]
            most = max(terms)
            beta[a] = most + math.log(sum([math.exp(t - most) for t in terms]))
            for (_, _, piece), t in zip(edges[a], terms, strict=True):
                if piece:
                    counts[piece] = counts.get(piece, 0.0) + times * math.exp(alpha[a] + t - alpha[-1])


#: Multiplier of the hash that finds a run of symbols among the pieces.
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class SideBySide:
    """The same lattice for many words of one length at a time: pieces are found by hash, columns are word positions."""

    def __init__(self, plain: Lattice) -> None:
        self.plain = plain
        self.names = [p for p in plain.log_p if not (len(p) == 6 and p.startswith("<0x"))]
        self.log_p = np.array([*(plain.log_p[p] for p in self.names), -np.inf])
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for length in sorted({len(p) for p in self.names}):
            own = np.array([k for k, p in enumerate(self.names) if len(p) == length])
            codes = np.array([[ord(c) for c in self.names[k]] for k in own], np.uint64)
            hashes = self._hashes(codes)[:, length]
            order = np.argsort(hashes)
            self.by_length[length] = (hashes[order], own[order])

    @staticmethod
    def _hashes(codes: np.ndarray) -> np.ndarray:
        """[word, position]: hash of the symbols before each position."""
        h = np.zeros((len(codes), codes.shape[1] + 1), np.uint64)
        for k in range(codes.shape[1]):
            h[:, k + 1] = h[:, k] * FACTOR + (codes[:, k] + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
        return h

    def edges(self, words: list[str]) -> tuple[dict[int, np.ndarray], dict[int, np.ndarray]]:
        """By length of a piece: which piece leaves each position (the last index: none), and its log probability."""
        n = len(words[0])
        codes = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(words), n)
        h = self._hashes(codes.astype(np.uint64))
        which, log_p, power = {}, {}, 1
        for length in range(1, min(n, max(self.by_length, default=1)) + 1):
            power = power * int(FACTOR) & (1 << 64) - 1
            found = np.full((len(words), n - length + 1), len(self.names))
            if length in self.by_length:
                hashes, own = self.by_length[length]
                part = h[:, length:] - h[:, : n - length + 1] * np.uint64(power)
                at = np.minimum(np.searchsorted(hashes, part), len(hashes) - 1)
                found = np.where(hashes[at] == part, own[at], found)
            if length > 1 and (found == len(self.names)).all():
                continue
            which[length], log_p[length] = found, self.log_p[found]
            if length == 1:
                spelt = found == len(self.names)
                values, index = np.unique(codes[spelt], return_inverse=True)
                cost = np.array([sum(self.plain.byte[x] for x in chr(v).encode("utf-8", "surrogatepass")) for v in values.tolist()])
                if len(values):
                    log_p[1][spelt] = cost[index]
        return which, log_p

    @staticmethod
    def _summed(terms: list[np.ndarray]) -> np.ndarray:
        most = np.maximum.reduce(terms)
        return most + np.log(sum(np.exp(t - most) for t in terms))

    def forward(self, log_p: dict[int, np.ndarray], n: int) -> list[np.ndarray]:
        total = [np.zeros(len(log_p[1]))]
        for b in range(1, n + 1):
            total.append(self._summed([total[b - k] + p[:, b - k] for k, p in log_p.items() if k <= b]))
        return total

    def log_marginals(self, words: list[str]) -> np.ndarray:
        return self.forward(self.edges(words)[1], len(words[0]))[-1]

    def expect(self, words: list[str], times: np.ndarray) -> np.ndarray:
        """Expected uses of each piece (the last one: of none) in `times` copies of the words."""
        which, log_p = self.edges(words)
        n = len(words[0])
        alpha, beta = self.forward(log_p, n), [np.zeros(len(words))]
        for a in range(n - 1, -1, -1):  # beta[0] is that of position a + 1
            beta.insert(0, self._summed([p[:, a] + beta[k - 1] for k, p in log_p.items() if a + k <= n]))
        ahead, behind = np.stack(alpha, axis=1), np.stack(beta, axis=1)
        uses = np.zeros(len(self.names) + 1)
        for k, p in log_p.items():
            share = np.exp(ahead[:, : n - k + 1] + p + behind[:, k:] - ahead[:, n:]) * times[:, None]
            uses += np.bincount(which[k].ravel(), share.ravel(), len(uses))
        return uses


def of_one_length(words: list[str]) -> Iterator[list[int]]:
    """Which words have the same length, ABREAST of them at most; those over SIDE_BY_SIDE one by one."""
    by_length: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        by_length.setdefault(len(word), []).append(k)
    for length, own in by_length.items():
        step = ABREAST if length <= SIDE_BY_SIDE else 1
        yield from (own[at : at + step] for at in range(0, len(own), step))


def key_of(word: bytes) -> bytes:
    """A word, or the digest of a long one (which no word is, as it holds a blank in front)."""
    return word if len(word) <= KEY_BYTES else b" " + hashlib.blake2b(word, digest_size=KEY_BYTES // 2).digest()


def vocabulary_prior(path: str) -> dict[str, float]:
    """Piece probabilities from a sentencepiece file's scores.

    Scores that fall by one from piece to piece are ranks, not logarithms; they count as such by 1 / (1 + rank), as
    word frequencies do. Other scores are natural logarithms. Byte pieces, which have no score, weigh as the rarest.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    known = [k for k in range(model.get_piece_size()) if not (model.is_control(k) or model.is_unknown(k) or model.is_byte(k) or model.is_unused(k))]
    score = {model.id_to_piece(k): model.get_score(k) for k in known}
    score = {p: s for p, s in score.items() if SPACE not in p[1:]}
    ranks = min(score.values()) < -1000
    weight = {p: 1 / (1 - s) if ranks else math.exp(s) for p, s in score.items()}
    rarest = min(weight.values())
    weight |= {f"<0x{b:02X}>": rarest / 256 for b in range(256)}
    total = sum(weight.values())
    return {p: w / total for p, w in weight.items()}


def count_words(docs: DataFrame, trained: str, text_col: str = "text") -> DataFrame:
    """word (its key), long (the word itself if that differs), n, c: how often each word stands in all documents and in those where column `trained` is true."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter[bytes], Counter[bytes]] = Counter(), Counter()

        def rows() -> pa.RecordBatch:
            words = [*(seen[1].keys() | seen[0].keys())]
            c = [seen[1][w] for w in words]
            columns = [words, [w if len(w) > KEY_BYTES else None for w in words], [seen[0][w] + x for w, x in zip(words, c, strict=True)], c]
            columns[0] = [key_of(w) for w in words]
            for x in seen:
                x.clear()
            return pa.record_batch([pa.array(x, t) for x, t in zip(columns, (pa.binary(), pa.binary(), pa.int64(), pa.int64()), strict=True)], names=["word", "long", "n", "c"])

        for batch in batches:
            for text, use in zip(as_bytes(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                seen[bool(use)].update(text.lower().split())
            if len(seen[0]) + len(seen[1]) > HELD_WORDS:
                yield rows()
        yield rows()

    found = docs.select(text_col, trained).mapInArrow(over_batches(work), "word binary, long binary, n long, c long")
    return found.groupBy("word").agg(F.first("long").alias("long"), F.sum("n").alias("n"), F.sum("c").alias("c"))


@dataclass(frozen=True)
class Totals:
    """tokens: of all training texts, ends included; words: distinct ones; ends: training texts; discount of a count."""

    tokens: int
    words: int
    ends: int
    discount: float

    def base(self, c: int) -> float:
        distinct = self.words + (self.ends > 0)
        return math.log10((c + 0.5) / (self.tokens + 0.5 * (distinct + 1)))

    def model(self, c: int, log_lattice: float) -> float:
        """log10 probability of a word seen c times whose lattice sums to exp(log_lattice)."""
        free = math.log(self.discount * self.words + 0.5) + log_lattice
        kept = max(c - self.discount, 0.0)
        log_p = free if not kept else max(math.log(kept), free) + math.log1p(math.exp(-abs(math.log(kept) - free)))
        return (log_p - math.log(self.tokens + 1)) / math.log(10)

    def end(self) -> float:
        return math.log10((self.ends + 0.5) / (self.tokens + 1))


def fit_pieces(words: DataFrame, prior: dict[str, float]) -> dict[str, float]:
    """Log probabilities after one pass of expected counts over all training words; the prior counts as one use a piece."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = Lattice({p: math.log(x) for p, x in prior.items()})
        lattice, counts, uses = SideBySide(plain), {}, 0.0
        for batch in batches:
            words, times = spelt(batch), batch.column(2).to_numpy().astype(float)
            for own in of_one_length(words):
                if len(words[own[0]]) <= SIDE_BY_SIDE:
                    uses = uses + lattice.expect([words[k] for k in own], times[own])
                else:
                    plain.expect(words[own[0]][1:], times[own[0]], counts)
        if not isinstance(uses, float):
            for piece, n in zip(lattice.names, uses.tolist(), strict=False):
                counts[piece] = counts.get(piece, 0.0) + n
        yield pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.float64())], names=["piece", "n"])

    found = words.filter("c > 0").select("word", "long", "c").mapInArrow(in_blocks(work, ROWS_ABREAST), "piece string, n double")
    seen = {r.piece: r.n for r in found.groupBy("piece").agg(F.sum("n").alias("n")).collect()}  # a row for each piece
    total = sum(seen.values()) + len(prior)
    return {p: math.log((seen.get(p, 0.0) + x * len(prior)) / total) for p, x in prior.items()}


#: Rows of words that a task works on at a time.
ROWS_ABREAST = 32_768


def spelt(batch: pa.RecordBatch) -> list[str]:
    """The words of rows word, long, as the lattice reads them."""
    return [SPACE + (long or word).decode("utf-8", "replace") for word, long in zip(as_bytes(batch.column(0)), batch.column(1).to_pylist(), strict=True)]


def score_words(words: DataFrame, totals: Totals, log_p: dict[str, float]) -> DataFrame:
    """word, n, c, base, model (log10 probabilities) of each word."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = Lattice(log_p)
        lattice = SideBySide(plain)
        for batch in batches:
            own_words, c = spelt(batch), batch.column(3).to_pylist()
            marginal = np.zeros(len(own_words))
            for own in of_one_length(own_words):
                long = len(own_words[own[0]]) > SIDE_BY_SIDE
                marginal[own] = plain.log_marginal(own_words[own[0]][1:]) if long else lattice.log_marginals([own_words[k] for k in own])
            columns = [[totals.base(x) for x in c], [totals.model(x, m) for x, m in zip(c, marginal.tolist(), strict=True)]]
            yield pa.record_batch([batch.column(0), batch.column(2), batch.column(3), *(pa.array(x, pa.float64()) for x in columns)], names=["word", "n", "c", "base", "model"])

    return words.select("word", "long", "n", "c").mapInArrow(in_blocks(work, ROWS_ABREAST), "word binary, n long, c long, base double, model double")


def score_documents(docs: DataFrame, vocabulary_path: str, trained: F.Column, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, trained, n_tokens, n_known, train_tokens, base_score, score of every whole text, learnt where `trained` holds.

    A null or empty text is an end alone. Without training texts the lattice keeps the vocabulary's weights and gives
    all words their probability. Rows stay one for one, repeated ids and null ids too; other columns are left out.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(id_col), F.col(text_col), trained.alias("trained"))
    words, counted = stored(count_words(given, "trained", text_col), "words")
    n, known, once, twice = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2)
    ).first()
    ends = given.filter("trained").count()
    totals = Totals(n + ends, known, ends, once / (once + 2 * twice) if once and twice else 0.5)
    log_p = fit_pieces(words, vocabulary_prior(vocabulary_path))
    scored, _ = stored(score_words(words, totals, log_p), "word-scores")
    remove(spark, counted)
    head = scored.orderBy(F.desc("n"), "word").limit(HEAD).collect()
    sent = spark.sparkContext.broadcast({bytes(r.word): (r.c > 0, r.base, r.model) for r in head})
    end_base, end_model = totals.base(ends), totals.end()
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, of = TaskContext.get().partitionId() << 40, sent.value
        for batch in batches:
            sums, tails = [], []
            for text in as_bytes(batch.column(1)):
                seen = Counter(text.lower().split())
                size = 1 + seen.total()
                known, base, model, tail = int(ends > 0), end_base, end_model, []
                for word, times in seen.items():
                    word = key_of(word)
                    if word in of:
                        k, b, m = of[word]
                        known += k * times
                        base += b * times
                        model += m * times
                    else:
                        tail.append({"word": word, "times": times})
                sums.append((first, size, known, base, model))
                first += 1
                tails.append(tail)
            numbers = [pa.array(c, t) for c, t in zip(zip(*sums, strict=True), (pa.int64(),) * 3 + (pa.float64(),) * 2, strict=True)]
            tail = pa.array(tails, pa.list_(pa.struct([("word", pa.binary()), ("times", pa.int64())])))
            yield pa.record_batch([batch.column(0), batch.column(2), *numbers, tail], names=[id_col, "trained", "row", "n", "known", "base", "model", "tail"])

    schema = f"`{id_col}` {kind}, trained boolean, row long, n long, known long, base double, model double, tail array<struct<word:binary,times:bigint>>"
    begun, _ = stored(given.mapInArrow(over_batches(work), schema), "document-words")
    rest = begun.select("row", F.explode("tail").alias("t")).select("row", "t.word", "t.times").join(scored, "word")
    added = rest.groupBy("row").agg(
        F.sum(F.col("times") * (F.col("c") > 0).cast("long")).alias("known_"),
        F.sum(F.col("times") * F.col("base")).alias("base_"),
        F.sum(F.col("times") * F.col("model")).alias("model_"),
    )
    plus = lambda c, zero: F.col(c) + F.coalesce(F.col(f"{c}_"), F.lit(zero))
    return begun.drop("tail").join(added, "row", "left").select(
        id_col, "trained", F.col("n").alias("n_tokens"), plus("known", 0).alias("n_known"), F.lit(totals.tokens).cast("long").alias("train_tokens"),
        plus("base", 0.0).alias("base_score"), plus("model", 0.0).alias("score"),
    )


def op10_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and model score of every document.

    A null, empty or blank text is one end token. Equal texts score alike; repeated rows and rows without an id stay, a
    null id counting as an empty text in the hold-out. An empty table gives no rows. Other columns are not looked at.
    """
    import public_tokenizers

    scored = score_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), remainder() != 1)
    return scored.select("doc_id", (~F.col("trained")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
