"""SentencePiece encoding and decoding by vectorised merge rounds.

A text is cut into words where no piece of the vocabulary reaches across (before a run of spaces, at a line end, between
characters that stand side by side in no piece), so a word's ids don't depend on its neighbours and each distinct word
of a batch is merged once. The words of a batch lie one behind the other in flat numpy arrays of symbols. A round finds
the least pair rank of each word, merges all its leftmost occurrences there at once, closes the gaps and drops words
without a pair, until none is left.

The library merges one pair at a time, the best score first and of equal scores the leftmost. Merging all occurrences of
a rank at once is the same unless a merge makes a pair of the same or a better rank, which then comes first. Pieces for
which the vocabulary allows that are known beforehand; of their occurrences only those merge in one round that stand too
far apart to meet (two pieces' length).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from wildtally.llm.shared import as_bytes, over_batches, table

SPACE = "▁"
_SPACE = SPACE.encode()
NO_RANK = np.int32(2**31 - 1)


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The positions start, start + 1, ... of each span, one span behind the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


class PieceRounds:
    """Encodes and decodes as the sentencepiece library does, without begin or end ids and without sampling.

    For BPE models that leave texts as they are but for spaces (identity normalisation); others raise ValueError.
    Words' ids are kept between batches in `max_kept_bytes` of memory and forgotten when it is full, which changes no
    result. `merged` counts distinct words that went through the rounds.
    """

    def __init__(self, path: str, max_kept_bytes: int = 48 << 20) -> None:
        from sentencepiece import sentencepiece_model_pb2 as format_

        model = format_.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        kinds = format_.ModelProto.SentencePiece
        known = {kinds.NORMAL, kinds.UNKNOWN, kinds.CONTROL, kinds.BYTE}
        spec = model.normalizer_spec
        plain = not spec.precompiled_charsmap and not spec.remove_extra_whitespaces and spec.escape_whitespaces
        if model.trainer_spec.model_type != format_.TrainerSpec.BPE or not plain or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only BPE models without normalisation can be read")
        if not model.trainer_spec.byte_fallback or any(p.type not in known for p in model.pieces):
            raise ValueError("only models with byte fallback and without user-defined pieces can be read")
        self.prefix = b" " if spec.add_dummy_prefix else b""
        self.size = len(model.pieces)
        pieces = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kinds.NORMAL}
        self._read_pairs(pieces, [p.score for p in model.pieces])
        self.byte_ids = np.zeros(256, np.int32)
        self.surface = np.empty(self.size, object)
        self.kind = np.zeros(self.size, np.int8)  # 1: begins with a space, 2: byte, 3: control
        for i, p in enumerate(model.pieces):
            self.surface[i] = p.piece.replace(SPACE, " ").encode()
            if p.type == kinds.BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
                self.surface[i], self.kind[i] = bytes([int(p.piece[3:5], 16)]), 2
            elif p.type == kinds.CONTROL:
                self.surface[i], self.kind[i] = b"", 3
            elif p.type == kinds.UNKNOWN:
                self.surface[i] = model.trainer_spec.unk_surface.encode()
            elif p.piece.startswith(SPACE):
                self.kind[i] = 1
        self.numbers = np.array([str(i).encode() for i in range(self.size)], object)
        self.max_kept_bytes = max_kept_bytes
        self.merged = 0
        self._forget()
        self.space_block = self._space_block()

    def _read_pairs(self, pieces: dict[str, int], scores: list[float]) -> None:
        """The pairs of symbols that make a piece, pieces' ranks, and what characters can stand side by side in one."""
        chars = sorted({c for p in pieces for c in p})
        symbols = pieces | {c: self.size + k for k, c in enumerate(c for c in chars if c not in pieces)}
        self.symbol_of = np.full(0x110000, -1, np.int32)
        for c in chars:
            self.symbol_of[ord(c)] = symbols[c]
        self.loose = np.array([ord(c) for c in chars if c not in pieces], np.int64)  # by symbol - size
        self.many = len(symbols) + self.size
        whole = sorted(pieces, key=lambda p: -scores[pieces[p]])
        ranks = {s: k for k, s in enumerate(sorted({scores[i] for i in pieces.values()}, reverse=True))}
        self.rank = np.full(self.many, NO_RANK, np.int32)
        pairs = {}
        for p in whole:
            self.rank[pieces[p]] = ranks[scores[pieces[p]]]
            for at in range(1, len(p)):
                a, b = symbols.get(p[:at]), symbols.get(p[at:])
                if a is not None and b is not None:
                    pairs[a * self.many + b] = pieces[p]
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_piece = np.array([pairs[k] for k in self.pair_keys], np.int32)
        first, second = self.pair_keys // self.many, self.pair_keys % self.many
        self.early = np.zeros(self.many, bool)  # of a merge into this piece a pair of the same or a better rank can come
        for part in (first, second):
            self.early[part[self.rank[self.pair_piece] <= self.rank[part]]] = True
        self.early[[symbols[c] for c in chars]] = False  # no merge makes a single character
        together = {(ord(a) << 21) | ord(b) for p in pieces for a, b in zip(p, p[1:], strict=False)}
        self.together = np.array(sorted(together), np.int64)
        self.longest = max(map(len, pieces))
        self.cut_at_spaces = not any(SPACE in p.lstrip(SPACE) for p in pieces)
        self.cut_at_lines = not any("\n" in p for p in pieces)
        self.space_run = max((len(p) for p in pieces if p == SPACE * len(p)), default=0)

    def _space_block(self) -> int:
        """The length in which a long run of spaces can be cut from the left, if the vocabulary merges runs that way."""
        n = self.space_run
        if n < 2:
            return 0
        runs = [b" " * k for k in range(2 * n, 4 * n)]
        ids, counts = self._rounds(runs, 0)
        at = np.cumsum(counts) - counts
        whole = self._rounds([b" " * n], 0)[0]
        if len(whole) != 1:
            return 0
        lists = [ids[a : a + c].tolist() for a, c in zip(at, counts, strict=True)]
        rest_ids, rest_counts = self._rounds([r[n:] for r in runs], 0)
        rest_at = np.cumsum(rest_counts) - rest_counts
        rest = [rest_ids[a : a + c].tolist() for a, c in zip(rest_at, rest_counts, strict=True)]
        return n if all(x == [int(whole[0]), *y] for x, y in zip(lists, rest, strict=True)) else 0

    def _pair(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What each pair of symbols makes (-1: nothing), and its rank."""
        keys = a.astype(np.int64) * self.many + b
        at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        made = np.where((self.pair_keys[at] == keys) & (a >= 0) & (b >= 0), self.pair_piece[at], -1)
        return made, np.where(made >= 0, self.rank[made], NO_RANK)

    def _rounds(self, words: list[bytes], space_block: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words, one word behind the other, and how many each has."""
        data = b"".join(words)
        raw = np.frombuffer(data, np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        n_chars = np.add.reduceat((raw & 0xC0) != 0x80, np.cumsum(lengths) - lengths).astype(np.int64)
        chars = np.frombuffer(data.decode().encode("utf-32-le"), np.uint32).astype(np.int64)
        chars[chars == 32] = ord(SPACE)
        begin = np.zeros(len(chars), bool)
        begin[np.cumsum(n_chars) - n_chars] = True
        side = (chars[:-1] << 21) | chars[1:]
        found = self.together[np.minimum(np.searchsorted(self.together, side), len(self.together) - 1)] == side
        begin[1:] |= ~found
        if space_block:
            self._cut_space_runs(chars, begin, space_block)
        sym = self.symbol_of[chars].astype(np.int64)
        sym[sym < 0] = -1 - chars[sym < 0]  # no piece has the character: minus one minus its code point
        at, sym = self._merged(sym, begin)
        word = np.repeat(np.arange(len(words)), n_chars)[at]
        return self._ids(sym, word, len(words))

    @staticmethod
    def _cut_space_runs(chars: np.ndarray, begin: np.ndarray, block: int) -> None:
        blank = np.flatnonzero(chars == ord(SPACE))
        if len(blank) < 2 * block:
            return
        first = np.flatnonzero((np.diff(blank, prepend=-2) != 1) | begin[blank])
        sizes = np.diff(np.append(first, len(blank)))
        for start, n in zip(blank[first[sizes >= 3 * block]].tolist(), sizes[sizes >= 3 * block].tolist(), strict=True):
            begin[start : start + n - 2 * block : block] = True

    def _merged(self, sym: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols after all merges, with the character at which each begins. `begin` marks where a word begins."""
        at = np.arange(len(sym))
        made, rank = np.full(len(sym), -1, np.int64), np.full(len(sym), NO_RANK, np.int32)
        inner = np.flatnonzero(~begin[1:])
        made[inner], rank[inner] = self._pair(sym[inner], sym[inner + 1])
        done_at, done_sym = [], []
        while len(sym):
            starts = np.flatnonzero(begin)
            sizes = np.diff(np.append(starts, len(sym)))
            least = np.minimum.reduceat(rank, starts)
            live = least < NO_RANK
            if not live.all():
                stay = np.repeat(live, sizes)
                done_at.append(at[~stay])
                done_sym.append(sym[~stay])
                at, sym, made, rank, begin = at[stay], sym[stay], made[stay], rank[stay], begin[stay]
                least, sizes = least[live], sizes[live]
                if not len(sym):
                    break
            word = np.repeat(np.arange(len(sizes)), sizes)
            here = np.flatnonzero(rank == least[word])
            here = here[self._together_now(here, at, word, made, len(sizes))]
            sym[here] = made[here]
            stay = np.ones(len(sym), bool)
            stay[here + 1] = False
            at, sym, made, rank, begin = at[stay], sym[stay], made[stay], rank[stay], begin[stay]
            new = here - np.arange(len(here))
            touched = np.concatenate([new, new[new > 0] - 1])
            last = np.append(begin[1:], True)[touched]
            made[touched[last]], rank[touched[last]] = -1, NO_RANK
            touched = touched[~last]
            made[touched], rank[touched] = self._pair(sym[touched], sym[touched + 1])
        at, sym = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (done_at, done_sym))
        order = np.argsort(at, kind="stable")
        return at[order], sym[order]

    def _together_now(self, here: np.ndarray, at: np.ndarray, word: np.ndarray, made: np.ndarray, n_words: int) -> np.ndarray:
        """Which of the pairs of least rank merge in this round: of pairs that share a symbol the left one; of pieces that bring early pairs the first, and those far from the one before."""
        index = np.arange(len(here))
        run = np.maximum.accumulate(np.where(np.diff(here, prepend=-2) != 1, index, 0))
        chosen = (index - run) % 2 == 0
        early = np.zeros(n_words, bool)
        early[word[here[self.early[made[here]]]]] = True
        if early.any():
            far = (np.diff(word[here], prepend=-1) != 0) | (np.diff(at[here], prepend=0) >= 2 * self.longest)
            chosen = np.where(early[word[here]], far, chosen)
        return chosen

    def _ids(self, sym: np.ndarray, word: np.ndarray, n_words: int) -> tuple[np.ndarray, np.ndarray]:
        """Symbols as ids: a character that is no piece becomes the ids of its UTF-8 bytes."""
        odd = np.flatnonzero((sym < 0) | (sym >= self.size))
        if len(odd):
            points = [int(-1 - s) if s < 0 else int(self.loose[s - self.size]) for s in sym[odd].tolist()]
            spelled = [self.byte_ids[np.frombuffer(chr(p).encode(), np.uint8)] for p in points]
            widths = np.ones(len(sym), np.int64)
            widths[odd] = [len(x) for x in spelled]
            ids = np.repeat(sym, widths)
            ends = np.cumsum(widths)
            ids[_spans((ends - widths)[odd], widths[odd])] = np.concatenate(spelled)
            sym, word = ids, np.repeat(word, widths)
        return sym.astype(np.int32), np.bincount(word, minlength=n_words)

    def _places(self, words: list[bytes]) -> np.ndarray:
        """The places of words in `pool_at` and `pool_n`, after rounds for those that are new."""
        if self.held > self.max_kept_bytes:
            self._forget()
        places = np.fromiter(map(self.kept.get, words, repeat(-1)), np.int64, len(words))
        new = np.flatnonzero(places < 0)
        if len(new):
            fresh = [words[k] for k in new.tolist()]
            ids, counts = self._rounds(fresh, self.space_block)
            before = len(self.pool_n)
            places[new] = before + np.arange(len(new))
            self.kept.update(zip(fresh, places[new].tolist(), strict=True))
            self.pool_at = np.append(self.pool_at, len(self.pool) + np.cumsum(counts) - counts)
            self.pool_n, self.pool = np.append(self.pool_n, counts), np.append(self.pool, ids)
            self.held += sum(map(len, fresh)) + 4 * len(ids) + 150 * len(fresh)
            self.merged += len(fresh)
        return places

    def _forget(self) -> None:
        self.kept: dict[bytes, int] = {}
        self.pool, self.pool_at, self.pool_n, self.held = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64), 0

    def _words(self, texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """The distinct words of texts, the words of all texts as numbers of these, and where each text's begin (and the last one's end)."""
        spaced = [self.prefix + (t.replace(_SPACE, b" ") if _SPACE in t else t) if t else b"" for t in texts]
        data = b"".join(spaced)
        raw = np.frombuffer(data, np.uint8)
        ends = np.cumsum([len(t) for t in spaced])
        begin = np.zeros(len(raw) + 1, bool)
        if self.cut_at_spaces and len(raw):
            blank = raw == 32
            begin[1:-1] = blank[1:] & ~blank[:-1]
        if self.cut_at_lines and len(raw):
            begin[:-1] |= raw == 10
        begin[np.append(0, ends)] = True
        starts = np.flatnonzero(begin)  # the last is the end of the data
        if len(starts) == 1:
            return [], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
        array = pa.Array.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)])
        told = array.dictionary_encode()
        return told.dictionary.to_pylist(), told.indices.to_numpy(), np.searchsorted(starts, np.append(0, ends))

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of UTF-8 texts."""
        words, codes, bounds = self._words(texts)
        if not words:
            return [np.zeros(0, np.int32)] * len(texts)
        places = self._places(words)[codes]
        at, n = self.pool_at[places], self.pool_n[places]
        return [self.pool[_spans(at[a:b], n[a:b])] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]

    def digits(self, ids: np.ndarray) -> bytes:
        """Ids in decimal, joined by commas."""
        return b",".join(self.numbers[ids].tolist())

    def decode(self, ids: np.ndarray) -> str:
        """What the library's decode(ids) gives: the first piece loses the space it begins with, bytes that are no UTF-8 become U+FFFD each."""
        ids = np.asarray(ids, np.int64)
        kinds = self.kind[ids]
        shown = np.flatnonzero(kinds != 3)
        lead = int(bool(self.prefix) and len(shown) > 0 and kinds[shown[0]] == 1)
        raw = self.surface[ids].tolist()
        if len(shown) == len(ids):
            return _text(b"".join(raw)[lead:])
        cuts = np.flatnonzero(kinds == 3).tolist()  # bytes on both sides of a control piece don't make a character
        parts = [_text(b"".join(raw[a:b])) for a, b in zip([0, *cuts], [*cuts, len(raw)], strict=True)]
        return "".join(parts)[lead:]


def _text(raw: bytes) -> str:
    """UTF-8 text; each byte that begins no valid character becomes U+FFFD alone."""
    try:
        return raw.decode()
    except UnicodeDecodeError:
        pass
    out, at = [], 0
    while at < len(raw):
        for width in (1, 2, 3, 4):
            try:
                out.append(raw[at : at + width].decode())
                at += width
                break
            except UnicodeDecodeError:
                continue
        else:
            out.append("�")
            at += 1
    return "".join(out)


_CODERS: dict[str, PieceRounds] = {}


def coder(path: str) -> PieceRounds:
    """This process's coder: later tasks of the worker find the words of earlier ones."""
    if path not in _CODERS:
        _CODERS[path] = PieceRounds(path)
    return _CODERS[path]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece_ids (array<int>), decoded: ids of every whole text and the text decoded from them.

    A null or empty text has no ids and decodes to an empty text; repeated rows and rows without an id stay; an empty
    table gives no rows; other columns are left out. A long text without a space is one word of many rounds, in memory
    proportional to its length.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(model_path)
        for batch in batches:
            ids = own.encode(as_bytes(batch.column(1)))
            yield pa.record_batch(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(map(own.decode, ids), pa.string())],
                names=[id_col, "piece_ids", "decoded"],
            )

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(over_batches(work, 64), f"`{id_col}` {kind}, piece_ids array<int>, decoded string")


def piece_digests(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of decimal ids joined by commas), decoded_sha256 (of the text decoded from the ids).

    Rows as in encode_documents, digested where the ids are made.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = coder(model_path)
        for batch in batches:
            found = own.encode(as_bytes(batch.column(1)))
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([len(ids) for ids in found], pa.int64()),
                    pa.array([hashlib.sha256(own.digits(ids)).hexdigest() for ids in found], pa.string()),
                    pa.array([hashlib.sha256(own.decode(ids).encode()).hexdigest() for ids in found], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select("doc_id", "text").mapInArrow(over_batches(work), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op11_piece_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length and digests of every document's SentencePiece ids and of the text decoded from them.

    A null or empty text has no ids. Repeated rows, rows without an id and very long texts are encoded whole; an empty
    table gives no rows; other columns are not looked at.
    """
    import public_tokenizers

    return piece_digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
