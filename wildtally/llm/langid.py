"""Language identification by a linear-chain conditional random field over the words of a text.

Each word is labelled with a language, so code-switched texts come apart. A word's potential sums the weights of its
affixes, character n-grams and, if it is in the lexicon of frequent words, of itself; learned transitions tie
neighbouring words. Forward-backward gives each word's label probabilities, exactly and over the whole text: segments
of a text are reduced to transfer matrices side by side, the matrices are chained, and segments are filled in.

The field is trained on the whole texts of a bounded sample: about SAMPLE_DOCS labelled documents of each language.
Texts of different documents are joined in pairs, so switching is seen in training. Only text is ever read to predict.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wildtally.llm.shared import over_batches, remainder, table

#: Labelled documents of each language that the field is trained on, about.
SAMPLE_DOCS = 250
#: Size of the hashed feature space, of the lexicon, and of a worker's memo of words.
BUCKETS, LEXICON, MEMO = 1 << 16, 4_000, 200_000
#: Least and most words of a segment; between them the root of the longest text, which keeps the steps few.
SEGMENT = (8, 256)
NO_LANGUAGE = "und"
#: Symbols of a word whose n-grams are held at a time.
PIECE = 20_000
#: Multiplier of the hash that places features in buckets.
FACTOR = np.uint32(0x9E3779B1)


def cores_of(words: pa.Array) -> pa.Array:
    """Words in lower case without what stands before their first letter and after the last; empty without a letter."""
    return pc.replace_substring_regex(pc.utf8_lower(words), r"^\PL+|\PL+$", "")


def bare(word: str) -> str:
    return cores_of(pa.array([word], pa.large_string()))[0].as_py()


def _buckets(tag: int, columns: Iterable[np.ndarray]) -> np.ndarray:
    """Buckets of runs of code points, given as a column for each place."""
    h = np.uint32(tag)
    for c in columns:
        h = (h ^ c) * FACTOR
        h ^= h >> np.uint32(15)
    return h >> np.uint32(32 - BUCKETS.bit_length() + 1)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _affixes(codes: np.ndarray, first: np.ndarray, size: np.ndarray) -> Iterator[np.ndarray]:
    """Buckets of the first three and four symbols and the last two, three and four of the words at these places."""
    for tag, long, back in ((4, 3, False), (5, 4, False), (6, 2, True), (7, 3, True), (8, 4, True)):
        begin, end = (np.maximum(first, first + size - long), first + size) if back else (first, np.minimum(first + size, first + long))
        yield _buckets(tag, (np.where(begin + k < end, codes[np.minimum(begin + k, len(codes) - 1)], 0).astype(np.uint32) for k in range(long)))


def _whole(word: str) -> int:
    return zlib.crc32(f"={word}".encode("utf-8", "replace")) % BUCKETS


def table_of(words: list[str], lexicon: frozenset[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words' affixes, character bigrams and trigrams and lexicon entries, and whose each is (an index of `words`, none empty)."""
    size = np.fromiter(map(len, words), np.int64, len(words))
    codes = _codes("^" + "$^".join(words) + "$")
    of = np.repeat(np.arange(len(words)), size + 2)
    two, three = of[1:] == of[:-1], of[2:] == of[:-2]
    listed = [k for k, w in enumerate(words) if w in lexicon]
    found = [
        (_buckets(2, (codes[:-1], codes[1:]))[two], of[:-1][two]), (_buckets(3, (codes[:-2], codes[1:-1], codes[2:]))[three], of[:-2][three]),
        *((b, np.arange(len(words))) for b in _affixes(codes, np.cumsum(size + 2) - size - 1, size)),
        (np.array([_whole(words[k]) for k in listed], np.uint32), np.array(listed, np.int64)),
    ]
    return np.concatenate([f[0] for f in found]).astype(np.int64), np.concatenate([f[1] for f in found])


def pieces(word: str, lexicon: frozenset[str]) -> Iterator[list[int]]:
    """Buckets of a word's affixes, n-grams and lexicon entry, at most about twice PIECE at a time."""
    framed = f"^{word}$"
    for at in range(0, len(framed) - 1, PIECE):
        codes = _codes(framed[at : at + PIECE + 2])
        found = [_buckets(2, (codes[:-1], codes[1:]))[:PIECE], _buckets(3, (codes[:-2], codes[1:-1], codes[2:]))[:PIECE]]
        if not at:
            ends = word if len(word) <= 8 else word[:4] + word[-4:]
            found += _affixes(_codes(ends), np.array([0]), np.array([len(ends)]))
            if word in lexicon:
                found.append(np.array([_whole(word)]))
        yield np.concatenate(found).tolist()


def features(word: str, lexicon: frozenset[str]) -> list[int]:
    """All buckets of a bare word."""
    return [f for piece in pieces(word, lexicon) for f in piece]


@dataclass
class Field:
    languages: list[str]
    lexicon: frozenset[str]
    weights: np.ndarray  # [bucket, language]
    transitions: np.ndarray  # [from, to], log
    memo: dict[str, int] = field(default_factory=dict)
    rows: np.ndarray | None = None

    def potentials(self, words: list[str]) -> np.ndarray:
        """For each distinct bare word its row in `rows` (potentials of the labels, the largest one); 0 for the empty word."""
        if self.rows is None or len(self.memo) > MEMO:
            self.memo, self.rows = {"": 0}, np.ones((1024, len(self.languages)), np.float32)
        at, new = len(self.memo), [w for w in words if w not in self.memo]
        while at + len(new) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.ones_like(self.rows)])
        score = np.zeros((len(new), len(self.languages)))
        short = [k for k, w in enumerate(new) if len(w) <= PIECE]
        if short:
            bucket, of = table_of([new[k] for k in short], self.lexicon)
            for label in range(len(self.languages)):
                score[short, label] = np.bincount(of, self.weights[:, label][bucket], len(short))
        for k, w in enumerate(new):
            if len(w) > PIECE:
                score[k] = sum(self.weights[piece].sum(axis=0, dtype=np.float64) for piece in pieces(w, self.lexicon))
        self.rows[at : at + len(new)] = np.exp(score - score.max(axis=1, initial=-np.inf, keepdims=True)) + FLOOR
        self.memo.update(zip(new, range(at, at + len(new)), strict=True))
        return np.fromiter(map(self.memo.__getitem__, words), np.int64, len(words))

    def predict(self, texts: pa.Array | list[str | None]) -> list[tuple[str, float, list[float]]]:
        """Language, its mean probability over words with letters, and that of all languages, of each text."""
        if isinstance(texts, list):
            texts = pa.array(texts, pa.string())
        share = np.zeros((len(texts), len(self.languages)))
        size = np.zeros(len(texts), np.int64)
        if self.languages and len(texts):
            words = pc.utf8_split_whitespace(texts.cast(pa.large_string()).fill_null(""))
            coded = words.flatten().dictionary_encode()
            cores = cores_of(coded.dictionary).dictionary_encode()
            at = self.potentials(cores.dictionary.to_pylist())[cores.indices.to_numpy()][coded.indices.to_numpy()]
            of = np.repeat(np.arange(len(texts)), pc.list_value_length(words).to_numpy())
            of, at = of[at > 0], at[at > 0]
            size = np.bincount(of, minlength=len(texts))
            if len(at):
                p, _ = chained(np.take(self.rows.T, at, axis=1), size, np.exp(self.transitions - self.transitions.max()))
                share = np.stack([np.bincount(of, x, len(texts)) for x in p], axis=1) / np.maximum(size, 1)[:, None]
        best = share.argmax(axis=1) if self.languages else size
        return [(self.languages[b], min(1.0, float(s[b])), s.tolist()) if n and self.languages else (NO_LANGUAGE, 0.0, s.tolist()) for b, s, n in zip(best, share, size, strict=True)]


#: Least potential of a label beside the best one.
FLOOR = 1e-12


def segments(size: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Words in a whole segment; of each segment (in the order of the texts) its first word, number of words, and text."""
    whole = int(np.clip(np.sqrt(size.max(initial=0)), *SEGMENT))
    count = -(-size // whole)
    owner = np.repeat(np.arange(len(size)), count)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    return whole, np.repeat(np.cumsum(size) - size, count) + place * whole, np.minimum(whole, size[owner] - place * whole), owner


def chained(e: np.ndarray, size: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities [label, word] of sequences that lie one after the other, `size` words each, and how often each label is expected to follow each other one [from, to].

    `e` holds potentials [label, word], `a` those of transitions [from, to]; a first word is entered from every label
    alike. Labels come before words in all arrays, so that each step is a few operations on long rows. Segments lie in
    order of their length, so a step works on those that still have a word.
    """
    labels, kind = len(a), e.dtype
    a = a.astype(kind)
    size = size[size > 0]
    whole, first, length, owner = segments(size)
    order = np.argsort(-length, kind="stable")
    rank = np.empty_like(order)
    rank[order] = np.arange(len(order))
    first, length = first[order], length[order]
    live = [int(np.searchsorted(-length, -t, "left")) for t in range(whole)]
    e = e / e.max(axis=0)
    at = [np.take(e, first[: live[t]] + t, axis=1) for t in range(whole)]
    begin = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])  # first segment of each text
    count = np.diff(np.r_[begin, len(owner)])
    enter, leave = np.full((labels, len(order)), 1 / labels, kind), np.full((labels, len(order)), 1 / labels, kind)
    if count.max(initial=1) > 1:
        moved = np.zeros((labels, labels, len(order)), kind)  # [to, from, segment]
        moved[np.arange(labels), np.arange(labels)] = 1
        for t in range(whole):
            n = live[t]
            step = (a.T @ moved[:, :, :n].reshape(labels, -1)).reshape(labels, labels, n) * at[t][:, None]
            moved[:, :, :n] = step / step.sum(axis=(0, 1)) if t % 4 == 3 else step
        moved /= moved.sum(axis=(0, 1))
        by_count = np.argsort(-count, kind="stable")
        begin, count = begin[by_count], count[by_count]
        for k in range(1, int(count[0])):  # texts in step, those with few segments drop out
            here = begin[: np.searchsorted(-count, -k, "left")] + k
            x = (moved[:, :, rank[here - 1]] * enter[None, :, rank[here - 1]]).sum(axis=1)
            enter[:, rank[here]] = x / x.sum(axis=0)
        for k in range(int(count[0]) - 2, -1, -1):
            here = begin[: np.searchsorted(-count, -(k + 1), "left")] + k
            x = (moved[:, :, rank[here + 1]] * leave[:, None, rank[here + 1]]).sum(axis=0)
            leave[:, rank[here]] = x / x.sum(axis=0)
    before, now = [], enter
    for t in range(whole):
        before.append(now[:, : live[t]])
        now = (a.T @ before[t]) * at[t]
        now /= now.sum(axis=0)
    p, follow, now = np.empty_like(e), np.zeros((labels, labels)), leave
    opening = np.zeros(len(order), bool)
    opening[rank[np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])]] = True
    for t in range(whole - 1, -1, -1):
        behind = at[t] * now[:, : live[t]]
        entered = a @ behind  # summed over the label here, for each label before
        mass = (before[t] * entered).sum(axis=0)
        p[:, first[: live[t]] + t] = (a.T @ before[t]) * behind / mass
        given = before[t] / mass
        if not t:
            given[:, opening[: live[t]]] = 0  # nothing comes before a text's first word
        follow += given @ behind.T
        now[:, : live[t]] = entered / entered.sum(axis=0)
    return p, follow * a


def marginals(emission: np.ndarray, size: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Label probabilities [word, label] from log potentials [word, label]."""
    e = np.exp(emission - emission.max(axis=1, keepdims=True)) + FLOOR
    return chained(np.ascontiguousarray(e.T), size, np.exp(transitions - transitions.max()))[0].T


def train(texts: list[tuple[str, list[str]]], turns: int = 40, seed: int = 5) -> Field:
    """The field from (language, words) of whole texts.

    Texts are joined in pairs, so switching is seen. Features and transitions follow the slope of the field's
    likelihood: expected less observed counts, of labels by word and of labels that follow each other.
    """
    languages = sorted({lang for lang, _ in texts})
    labels = len(languages)
    whole = cores_of(pa.array([w for _, words in texts for w in words], pa.large_string())).dictionary_encode()
    ends = np.cumsum([0, *(len(words) for _, words in texts)])
    core = whole.indices.to_numpy(zero_copy_only=False)
    names = whole.dictionary.to_pylist()
    empty = names.index("") if "" in names else -1
    cores = [(languages.index(lang), (x := core[a:b])[x != empty]) for (lang, _), a, b in zip(texts, ends, ends[1:], strict=False)]
    weights, transitions = np.zeros((BUCKETS, labels)), np.zeros((labels, labels))
    at = np.concatenate([x for _, x in cores] or [np.empty(0, np.int64)])
    seen = np.bincount(at, minlength=len(names))
    lexicon = frozenset(names[k] for k in sorted(range(len(names)), key=lambda k: (-seen[k], names[k]))[:LEXICON] if seen[k] > 1 and k != empty)
    if labels and len(at):
        order = np.random.default_rng(seed).permutation(len(cores))
        at = np.concatenate([cores[k][1] for k in order])
        goal = np.repeat([cores[k][0] for k in order], [len(cores[k][1]) for k in order])
        size = np.add.reduceat([len(cores[k][1]) for k in order], np.arange(0, len(order), 2))
        follows = np.ones(len(at), bool)
        follows[np.cumsum(size[size > 0]) - size[size > 0]] = False
        second = np.flatnonzero(follows)
        real = np.bincount(goal[second - 1] * labels + goal[second], minlength=labels**2).reshape(labels, labels)
        by_truth = np.stack([np.bincount(at[goal == k], minlength=len(names)) for k in range(labels)])
        flat, of = table_of(names, lexicon)
        used, flat = np.unique(flat, return_inverse=True)
        w, speed, t_speed = np.zeros((labels, len(used))), np.full((labels, len(used)), 1e-8), np.full((labels, labels), 1e-8)
        for _ in range(turns):
            score = np.stack([np.bincount(of, x[flat], len(names)) for x in w])
            e = (np.exp(score - score.max(axis=0)) + FLOOR).astype(np.float32)
            p, follow = chained(np.take(e, at, axis=1), size, np.exp(transitions - transitions.max()))
            off = np.stack([np.bincount(at, x, len(names)) for x in p]) - by_truth
            g = np.stack([np.bincount(flat, x[of], len(used)) for x in off]) / len(at) + 1e-6 * w
            t_g = (follow - real) / len(at) + 1e-6 * transitions
            speed += g * g
            t_speed += t_g * t_g
            w -= 0.3 * g / np.sqrt(speed)
            transitions = transitions - 0.1 * t_g / np.sqrt(t_speed)
        weights[used] = w.T
    return Field(languages, lexicon, weights.astype(np.float32), transitions)


def learn(docs: DataFrame, lang_col: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> Field:
    """The field of the documents' text and non-null language (their ids only draw the sample)."""
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[lang_col]: r["count"] for r in known.groupBy(lang_col).count().collect()}
    if not counts:
        return train([])
    share = F.create_map(*[F.lit(x) for k, n in sorted(counts.items()) for x in (k, min(1.0, SAMPLE_DOCS / n))])
    draw = F.pmod(F.xxhash64(F.lit(11), F.col(id_col)), F.lit(1_000_000)) / 1_000_000
    drawn = known.filter(draw < F.element_at(share, F.col(lang_col)))
    rows = drawn.select(lang_col, text_col).collect()
    return train(sorted((r[lang_col], r[text_col].split()) for r in rows))


def identify(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score of every whole text.

    Null, empty and letterless texts are `und` with score 0, as all are if the model has learnt no language. Rows stay
    one for one, repeated ids too; other columns are left out.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.predict(batch.column(1))
            yield pa.record_batch(
                [batch.column(0), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                names=[id_col, "lang_pred", "score"],
            )

    return docs.select(id_col, text_col).mapInArrow(over_batches(work), f"`{id_col}` {kind}, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Field, least: float = 0.3, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose text is in a known language: not `und`, mean probability `least` or more.

    All columns stay. If the model has learnt no language, all rows stay.
    """
    if not model.languages:
        return docs

    @F.pandas_udf("double")
    def score(text):  # noqa: ANN001, ANN202
        import pandas as pd

        found: list[float] = []
        for at in range(0, len(text), 256):
            found += [s if lang != NO_LANGUAGE else -1.0 for lang, s, _ in model.predict(pa.array(text.iloc[at : at + 256], pa.string()))]
        return pd.Series(found, dtype="float64")

    return docs.filter(score(F.col(text_col)) >= least)


def op2_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those that aren't held out.

    Null, empty and letterless texts are `und` with score 0. Of languages that tie the first by name counts. Repeated
    rows and rows without an id stay. Without labelled texts all are `und`; an empty table gives no rows. Texts and words
    of any length are read whole; other columns are not looked at.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = identify(docs, learn(docs.filter(remainder() != 0)))
    return found.select("doc_id", (remainder() == 0).alias("held_out"), "lang_pred", "score")
