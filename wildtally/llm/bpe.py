"""BPE encoding and decoding by content-defined chunk reuse.

A rolling hash over the last 16 bytes picks cut points right after white space, so equal passages fall into equal
chunks wherever they stand. Each worker process has the library encode a chunk once and keeps its ids; later documents
with the same chunk reuse them. Where two chunks meet, the words on both sides are encoded as one text. If that gives
other ids than the chunks end and begin with, the join is repaired: a window around it is encoded anew, and grows until
its outer words agree with what the chunks gave. The memo is bounded in memory and started anew when full, which
changes no result.

Most chunks are met once, but their words are not. Where the tokenizer's own file shows that no piece can reach across
white space (apart_at_blanks()), a new chunk is put together from its words, of which the library encodes those not met
before, and joins need no look: they stand at white space. Of the words those met lately are kept, again in bounded
memory; a new word's letters and the marks around them are looked up apart where the tokenizer parts them. Other tokenizers have whole chunks encoded and every join compared.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from wildtally.llm.shared import as_bytes, over_batches, table

WINDOW = 16
#: A white space ends a chunk when these bits of the hash before it are zero: 64 words on average. Shorter chunks recur
#: hardly more often and have twice the joins.
CUT_BITS = 6
#: Multiplier of the rolling hash.
FACTOR = 0x9E3779B1


#: Splits whose matches hold no white space; with the rest removed, no piece does.
SPLITS = ({"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}, {"type": "Whitespace"}, {"type": "WhitespaceSplit"})
#: Steps before a split that leave white space white and look at no character beyond it.
PLAIN = ({"type": "NFC"}, {"type": "Lowercase"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "})
#: Steps behind a split that work on each piece alone.
WITHIN = ({"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},)


#: Letters of ASCII and Latin-1 with ASCII marks (no apostrophe) around them: the first of SPLITS parts these, and the steps
#: before it change no more than the letters' case.
_MARK = r"([!-&(-/:-@\[-`{-~]*)"
#: Of a line: marks, letters, marks, or else the whole.
_MARKED = re.compile(f"^{_MARK}([A-Za-zÀ-ÖØ-öø-ÿ]+){_MARK}$|^(.*)$", re.MULTILINE)


def _steps(told: dict, name: str, inner: str) -> list[dict]:
    step = told.get(name)
    return [] if step is None else step[inner] if step["type"] == "Sequence" else [step]


def apart_at_blanks(written: str) -> bool:
    """Whether a tokenizer, from its JSON, gives a text the ids of its words (parted by ASCII white space) one behind the other.

    Only steps that are known to do so count; with any other, the answer is no.
    """
    told = json.loads(written)
    split = _steps(told, "pre_tokenizer", "pretokenizers")
    model = told["model"]
    return (
        all(x in PLAIN for x in _steps(told, "normalizer", "normalizers"))
        and split[:1] in [[x] for x in SPLITS]
        and all(x in WITHIN for x in split[1:])
        and model["type"] == "BPE"
        and not model.get("dropout")
        and not any(x["lstrip"] or x["rstrip"] or x["single_word"] or not x["content"] or any(c.isspace() for c in x["content"]) for x in told["added_tokens"])
    )


def cut_points(data: np.ndarray) -> np.ndarray:
    """Offsets at which chunks begin (but for the first): after an ASCII space that the rolling hash selects."""
    if len(data) <= WINDOW:
        return np.empty(0, np.int64)
    h = (data.astype(np.uint32) + np.uint32(1)) * np.uint32(FACTOR)
    span = 1
    while span < WINDOW:  # h covers `span` bytes; twice as many after each turn
        h = h.copy()
        h[span:] += h[:-span] * np.uint32(pow(FACTOR | 1, span, 1 << 32))
        span *= 2
    space = (data == 32) | ((data >= 9) & (data <= 13))
    at = np.flatnonzero(space[:-1] & (h[:-1] >> np.uint32(32 - CUT_BITS) == 0)) + 1
    return at[at > WINDOW]


def last_words(text: bytes, n: int) -> int:
    """Where the last n words begin, with the white space character before them."""
    at = len(text)
    for _ in range(n):
        at = len(text[:at].rstrip())
        word = text[:at].split()[-1:] if at <= 256 else text[at - 256 : at].split()[-1:]
        if not word:
            return 0
        start = at - len(word[0])
        if at > 256 and start == at - 256:  # a long word
            start = max(text.rfind(c, 0, at) for c in _BLANKS) + 1
        at = max(0, start - 1)
    return at


def first_words(text: bytes, n: int) -> int:
    """Where the first n words end."""
    at = 0
    for word in text.split(None, n)[:n]:
        at = text.index(word, at) + len(word)
    return at


def fits(before: bytes, window: bytes, after: bytes) -> bool:
    """Whether the ids of a window around a join are the last ones before it and the first ones behind it."""
    return any(before.endswith(window[:k]) and after.startswith(window[k:]) for k in range(4, len(window), 4))


_BLANKS = (b" ", b"\t", b"\n", b"\r", b"\v", b"\f")


class Lately:
    """Ids of strings, from `make` for those not met lately; about `most` bytes of memory."""

    def __init__(self, most: int, make: Callable[[list], list[bytes]]) -> None:
        self.most, self.make, self.held = most, make, 0
        self.known: dict[bytes | str, bytes] = {}
        self.older: dict[bytes | str, bytes] = {}  # met before the memo was last full

    def of(self, wanted: list) -> list[bytes]:
        """Ids of each of the strings."""
        if self.held > self.most // 2:
            self.older, self.known, self.held = self.known, {}, 0
        known = self.known
        found = list(map(known.get, wanted))
        if None in found:
            unmet = list({w for w, x in zip(wanted, found, strict=True) if x is None})
            back = list(map(self.older.get, unmet))
            new = [w for w, x in zip(unmet, back, strict=True) if x is None]
            if len(new) < len(unmet):
                known.update((w, x) for w, x in zip(unmet, back, strict=True) if x is not None)
            if new:
                known.update(zip(new, self.make(new), strict=True))
            self.held += sum(map(len, unmet)) + 160 * len(unmet)
            found = [known[w] if x is None else x for w, x in zip(wanted, found, strict=True)]
        return found


class ChunkEncoder:
    """Encodes UTF-8 texts as the tokenizers library does (no special tokens added, no truncation, no padding).

    `encoded` and `reused` count chunks, `repaired` joins whose ids were replaced, `whole` texts whose joins never
    agreed and that the library encoded as they are, `asked` texts (chunks, words or joins) that the library encoded.
    """

    def __init__(self, path: str, max_chunk_bytes: int = 32 << 20, max_word_bytes: int = 96 << 20) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # tasks share the machine already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        written = self.tokenizer.to_str()
        self.by_word = apart_at_blanks(written)
        told = json.loads(written)
        self.cores = self.by_word and SPLITS[0] in _steps(told, "pre_tokenizer", "pretokenizers") and bool(told["model"].get("end_of_word_suffix"))
        if self.cores:
            # for letters in their final case: parted at blanks, with the steps behind the split
            steps = [{"type": "WhitespaceSplit"}, *_steps(told, "pre_tokenizer", "pretokenizers")[1:]]
            self.bare = Tokenizer.from_str(json.dumps(told | {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": steps}, "added_tokens": [], "post_processor": None}))
            self.last = np.array([(self.tokenizer.id_to_token(i) or "").endswith(told["model"]["end_of_word_suffix"]) for i in range(self.tokenizer.get_vocab_size())])
        self.lowers = {"type": "Lowercase"} in _steps(told, "normalizer", "normalizers")
        self.added = [x["content"].encode() for x in told["added_tokens"]]
        self.max_chunk_bytes = max_chunk_bytes
        self.known: dict[bytes, bytes] = {}
        self.words_met = Lately(max_word_bytes * 3 // 8, self._from_cores)
        self.cores_met = Lately(max_word_bytes // 2, self._letters)
        self.others_met = Lately(max_word_bytes // 8, lambda pieces: self._library([x.encode() for x in pieces]))
        self.held = 0
        self.reused = self.encoded = self.repaired = self.whole = self.asked = 0
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.pieces = [self.tokenizer.id_to_token(i) for i in range(size)] if self.tokenizer.decoder is None else None

    def _library(self, texts: list[bytes]) -> list[bytes]:
        self.asked += len(texts)
        if len(texts) == 1:
            return [array("I", self.tokenizer.encode(texts[0].decode("utf-8", "replace"), add_special_tokens=False).ids).tobytes()]
        found = self.tokenizer.encode_batch_fast([x.decode("utf-8", "replace") for x in texts], add_special_tokens=False)
        return [array("I", x.ids).tobytes() for x in found]

    def _learn(self, texts: set[bytes]) -> None:
        new = list(texts - self.known.keys())
        for text, ids in zip(new, self._from_words(new) if self.by_word else self._library(new), strict=True):
            self.known[text] = ids
            self.held += len(text) + len(ids) + 200

    def _from_words(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts, from those of their words."""
        parts = [x.split() for x in texts]
        distinct = list(set().union(*parts))
        words = dict(zip(distinct, self.words_met.of(distinct), strict=True))
        return [b"".join([words[w] for w in p]) for p in parts]

    def _from_cores(self, words: list[bytes]) -> list[bytes]:
        """Ids of words, from those of their letters and of the marks around them where these are pieces of their own."""
        out: list[bytes] = []
        for at in range(0, len(words), 1 << 16):
            part = words[at : at + (1 << 16)]
            joined = b"\n".join(part)
            low = joined.lower()
            try:
                found = [] if not self.cores or any(x in joined or x in low for x in self.added) else _MARKED.findall(joined.decode())
            except UnicodeDecodeError:
                found = []
            if not found:
                out += self._library(part)
                continue
            before, core, after, whole = (list(map(itemgetter(k), found)) for k in range(4))
            if self.lowers:
                core = list(map(str.lower, core))
            self.cores_met.known[""] = b""  # of a whole word
            ids = (self.others_met.of(before), self.cores_met.of(core), self.others_met.of(after), self.others_met.of(whole))
            out += map(b"".join, zip(*ids, strict=True))
        return out

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters, encoded side by side as one text: each word's last piece alone ends as ends of words do."""
        found = []
        for at in range(0, len(words), 1 << 14):
            part = words[at : at + (1 << 14)]
            texts = [" ".join(part[k : k + 256]) for k in range(0, len(part), 256)]
            ids = np.concatenate([np.array(x.ids, np.uint32) for x in self.bare.encode_batch_fast(texts, add_special_tokens=False)])
            ends = (np.flatnonzero(self.last[ids]) + 1).tolist()
            if len(ends) == len(part) and ends[-1] == len(ids):
                self.asked += len(texts)
                coded = ids.astype("<u4").tobytes()
                found += [coded[4 * a : 4 * b] for a, b in zip([0, *ends], ends, strict=False)]
            else:
                found += self._library([x.encode() for x in part])
        return found

    def encode_column(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts of a string column one behind the other (null: none), and how many each text has."""
        if not self.by_word:
            found = self.encode(as_bytes(texts))
            return np.frombuffer(b"".join(found), "<u4"), np.array([len(x) // 4 for x in found], np.int64)
        split = pc.ascii_split_whitespace(texts.fill_null(""))
        coded = split.flatten().dictionary_encode()
        words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        found = self._from_cores(words)
        size = np.fromiter(map(len, found), np.int64, len(found)) // 4
        which = coded.indices.to_numpy()
        many = size[which]
        ends = np.concatenate([[0], np.cumsum(many)])
        kind = np.int32 if ends[-1] < 1 << 31 else np.int64
        at = np.repeat(((np.cumsum(size) - size)[which] - ends[:-1]).astype(kind), many)
        at += np.arange(len(at), dtype=kind)
        last = ends[np.cumsum(pc.list_value_length(split).to_numpy())]
        return np.frombuffer(b"".join(found), "<u4")[at], np.diff(last, prepend=0)

    def _ids(self, text: bytes) -> bytes:
        if text not in self.known:
            self._learn({text})
        return self.known[text]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        if self.held > self.max_chunk_bytes:
            self.known, self.held = {}, 0
        parts = []
        for text in texts:
            at = [0, *cut_points(np.frombuffer(text, np.uint8)).tolist(), len(text)]
            parts.append([text[a:b] for a, b in zip(at, at[1:], strict=False) if a < b])
        chunks = {c for p in parts for c in p}
        new = len(chunks - self.known.keys())
        self.encoded += new
        self.reused += sum(map(len, parts)) - new
        if self.by_word:
            self._learn(chunks)
            return [b"".join([self.known[c] for c in p]) for p in parts]
        ends = {c: (c[last_words(c, 1) :], c[: first_words(c, 1)]) for c in chunks}
        joins = {ends[a][0] + ends[b][1] for p in parts for a, b in zip(p, p[1:], strict=False)}
        self._learn(chunks | joins)
        return [self._joined(p, ends) if p else b"" for p in parts]

    def _joined(self, parts: list[bytes], ends: dict[bytes, tuple[bytes, bytes]]) -> bytes:
        """Ids of the chunks one behind the other, each join as the library encodes the words that meet there."""
        known, out, left = self.known, [], parts[0]
        ids = known[left]
        for right in parts[1:]:
            tail, after = ends[left][0] if left in ends else left[last_words(left, 1) :], known[right]
            window = tail + ends[right][1]
            if fits(ids, known.get(window) or self._ids(window), after):
                out.append(ids)
                left, ids = right, after
                continue
            repair = self._repair(left, ids, right, after)
            if repair is None:
                self.whole += 1
                return self._library([b"".join(parts)])[0]
            kept, left, ids = repair
            out.append(kept)
        return b"".join([*out, ids])

    def _repair(self, left: bytes, before: bytes, right: bytes, after: bytes) -> tuple[bytes, bytes, bytes] | None:
        """The ids of `left` that stay, and the rest of both chunks with its ids, encoded anew around the join.

        The window grows until its outermost words have the ids that they have alone and the chunks' own ids fit what
        the window leaves; None if it never does.
        """
        self.repaired += 1
        width = 2
        while True:
            a, b = last_words(left, width), first_words(right, width)
            window = left[a:] + right[:b]
            (ids,) = self._library([window])
            outer = self._ids(window[: first_words(window, 1)]), self._ids(window[last_words(window, 1) :])
            was, will = self._ids(left[a:]), self._ids(right[:b])
            if ids.startswith(outer[0]) and ids.endswith(outer[1]) and before.endswith(was) and after.startswith(will):
                return before[: len(before) - len(was)], left[a:] + right, ids + after[len(will) :]
            if not a and not right[b:].strip():
                return None
            width *= 2

    def _grown(self, left: bytes, right: bytes) -> bytes:
        """Ids of two neighbours together."""
        self._learn({left, right})
        repair = self._repair(left, self.known[left], right, self.known[right])
        return self._library([left + right])[0] if repair is None else repair[0] + repair[2]

    def decode(self, ids: bytes) -> str:
        """What the library's decode(ids, skip_special_tokens=False) gives."""
        numbers = array("I", ids)
        if self.pieces is None:
            return self.tokenizer.decode(numbers.tolist(), skip_special_tokens=False)
        return " ".join(map(self.pieces.__getitem__, numbers))


_ENCODERS: dict[tuple[str, int], ChunkEncoder] = {}


def encoder(path: str, max_word_bytes: int = 96 << 20) -> ChunkEncoder:
    """This process's encoder: later tasks of the worker find the chunks and words of earlier ones."""
    if (path, max_word_bytes) not in _ENCODERS:
        _ENCODERS[path, max_word_bytes] = ChunkEncoder(path, max_word_bytes=max_word_bytes)
    return _ENCODERS[path, max_word_bytes]


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, token_ids (array<int>), decoded: ids of every whole text and the text decoded from them.

    A null or empty text has no ids and decodes to an empty text; repeated rows stay; other columns are left out.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer_path)
        for batch in batches:
            ids = own.encode(as_bytes(batch.column(1)))
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([np.frombuffer(x, "<u4").astype(np.int32) for x in ids], pa.list_(pa.int32())),
                    pa.array([own.decode(x) for x in ids], pa.string()),
                ],
                names=[id_col, "token_ids", "decoded"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(over_batches(work, 64), f"`{id_col}` {kind}, token_ids array<int>, decoded string")


def token_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text, worked out where the ids are made.

    A null or empty text has no ids and decodes to an empty text; repeated rows stay; other columns are left out.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer_path)
        for batch in batches:
            ids = own.encode(as_bytes(batch.column(1)))
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                    pa.array([hashlib.sha256(own.decode(x).encode()).hexdigest() for x in ids], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        over_batches(work), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op7_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and digests of every document's ids and of the text decoded from them.

    A null or empty text has no ids. Repeated rows and rows without an id stay; an empty table gives no rows. Texts of any
    length are encoded whole; other columns are not looked at.
    """
    import public_tokenizers

    return token_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
