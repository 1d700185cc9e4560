"""SimHash near-duplicates, compared through tables of distances to reference fingerprints.

Every fingerprint has its Hamming distances to PIVOTS reference fingerprints worked out first. Two fingerprints that
differ in d bits differ by at most d in each of these distances, so a pair whose largest coordinate difference is over
the limit is discarded unseen; survivors are verified by counting differing bits.

Distances to references alone can't deal out work: on 64 random bits a coordinate spreads by 4, so two of three pairs
agree in it within 4. Tasks therefore get their fingerprints by an exact partition first: two fingerprints that differ
in at most 4 of 64 bits agree in at least 2 of 6 blocks (in at most 7 bits, in 3 of 10), so each goes to one cell for
each two (three) blocks, and linked ones meet in a cell. With more fingerprints the blocks are more and the keys longer,
so cells don't fill with strangers. A cell of more than `cell_rows` members is dealt out in parts that are connected
through common leaders, and only what they leave apart meets all parts. A cell returns a forest of its links, never all
pairs.

one_of_each() needs a similarity of 0.8 or more on five-word shingles. Its candidates are fingerprints of two-word
shingles within NEAR bits, compared as above, whose five-word fingerprints lie within NEAR_SECOND bits; every link is
verified by the exact similarity (wildtally.llm.resemblance). At 0.8 texts may lie further apart than any exact partition
reaches, so pairs that this leaves apart are proposed by MinHash, and verified likewise.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wildtally.llm.resemblance import connected, groups, in_tasks
from wildtally.llm.shared import as_bytes, cut, free_name, matching, over_batches, row_key, table

PIVOTS = np.random.default_rng(64).integers(0, 1 << 64, 16, np.uint64)
#: Strangers that a cell may hold on average before the partition takes longer keys.
STRANGERS = 64


def partition(bits: int, shared: int) -> tuple[tuple[int, ...], int]:
    """Widths of the blocks from the lowest bit, and how many of them two fingerprints within `bits` share at least."""
    short, wider = divmod(64, bits + shared)
    return tuple([short + 1] * wider + [short] * (bits + shared - wider)), shared


#: By most differing bits; more fingerprints than these are meant for share more blocks, see key_blocks().
PARTITIONS = {4: partition(4, 2), 7: partition(7, 3)}


def key_blocks(bits: int, count: int) -> tuple[tuple[int, ...], int]:
    """The partition for so many fingerprints: longer keys, and more of them, where strangers would crowd the cells. All are exact."""
    widest = min(b for b in PARTITIONS if b >= bits)
    shared = PARTITIONS[widest][1]
    while shared < 5 and count > STRANGERS << (64 * shared // (widest + shared)):
        shared += 1
    return partition(widest, shared)


SEED = 42
#: Differing bits of candidates of one_of_each(), by fingerprints of two-word and of five-word shingles.
NEAR, NEAR_SECOND = 4, 14


def fingerprint(data: bytes, words: int) -> int:
    """64 majority bits over the XXH64 of all shingles (ASCII lower case, ASCII white space); 0 without words."""
    found = data.lower().split()
    n = len(found)
    if not n:
        return 0
    if n <= words:
        return xxhash.xxh64_intdigest(b" ".join(found), SEED)
    text, size = b" ".join(found), np.fromiter(map(len, found), np.int64, n)
    end = np.cumsum(size + 1) - 1
    first, last = (end - size)[: n - words + 1].tolist(), end[words - 1 :].tolist()
    digest, one = xxhash.xxh64_digest, np.zeros(64, np.int64)
    for at in range(0, len(first), 1 << 16):
        hashes = b"".join([digest(text[a:b], SEED) for a, b in zip(first[at : at + (1 << 16)], last[at : at + (1 << 16)], strict=True)])
        rows = -(-len(hashes) // (8 * 255)) * 255
        bits = np.unpackbits(np.frombuffer(hashes.ljust(rows * 8, b"\0"), np.uint8)).reshape(-1, 255, 64)
        one += np.add.reduce(bits, axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(one * 2 > len(first)).tobytes(), "big")


def both_prints(data: bytes, found: np.ndarray) -> tuple[int, int]:
    """The fingerprint over two-word shingles, and the majority bits of the distinct five-word shingles' hashes, which are known."""
    one = np.unpackbits(found.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return fingerprint(data, 2), int.from_bytes(np.packbits(one * 2 > len(found)).tobytes(), "big") if len(found) else 0


def fingerprints(docs: DataFrame, words: int = 5, id_col: str = "doc_id", text_col: str = "text", second_words: int = 0) -> DataFrame:
    """id, fingerprint, second (64 bits as a long each; 0 without second_words) of every whole text; blank ones have 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(1))
            both = [np.array([fingerprint(x, n) if n else 0 for x in texts], np.uint64).view(np.int64) for n in (words, second_words)]
            yield pa.record_batch([batch.column(0), *map(pa.array, both)], names=[id_col, "fingerprint", "second"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(over_batches(work), f"`{id_col}` {kind}, fingerprint long, second long")


def cells(column: str, bits: int = 4, count: int = 0) -> F.Column:
    """The cells of one of `count` fingerprints: which blocks, and their bits. Two within `bits` of each other share a cell."""
    widths, shared = key_blocks(bits, count)
    shift = np.cumsum((0, *widths)).tolist()
    block = [F.shiftrightunsigned(column, shift[i]).bitwiseAND(F.lit((1 << w) - 1)) for i, w in enumerate(widths)]
    found = []
    for k, chosen in enumerate(combinations(range(len(widths)), shared)):
        cell = F.lit(k).cast("long")
        for i in chosen:
            cell = F.shiftleft(cell, max(widths)).bitwiseOR(block[i])
        found.append(cell)
    return F.array(*found)


class DistanceTable:
    """Fingerprints with their distances to all pivots, and second fingerprints that linked ones agree in likewise."""

    def __init__(self, prints: np.ndarray, second: np.ndarray | None = None, second_bits: int = 64) -> None:
        self.prints, self.second, self.second_bits = prints, second, second_bits
        self.far = np.bitwise_count(prints[:, None] ^ PIVOTS[None, :]).astype(np.int8)

    def linked(self, i: np.ndarray, j: np.ndarray, bits: int) -> np.ndarray:
        """Which of the pairs i[k], j[k] differ in `bits` bits at most."""
        keep = np.abs(self.far[i] - self.far[j]).max(axis=1, initial=0) <= bits
        at = np.flatnonzero(keep)
        keep[at] = np.bitwise_count(self.prints[i[at]] ^ self.prints[j[at]]) <= bits
        if self.second is not None:
            at = np.flatnonzero(keep)
            keep[at] = np.bitwise_count(self.second[i[at]] ^ self.second[j[at]]) <= self.second_bits
        return keep


def forest(table_: DistanceTable, bits: int, rows: int = 512) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect what the rows of one large cell connect: one for each row but the first of a component."""
    n = len(table_.prints)
    order = np.argsort(table_.far[:, 0], kind="stable")
    by_first, label = table_.far[order, 0].astype(np.int64), np.arange(n)
    for a in range(0, n, rows):
        top = min(a + rows, n)
        end = int(np.searchsorted(by_first, by_first[top - 1] + bits, "right"))  # the rest differ too much from pivot 0
        for b in range(a, end, rows):
            i, j = np.meshgrid(order[a:top], order[b : min(b + rows, end)], indexing="ij")
            i, j = i.ravel(), j.ravel()
            apart = label[i] != label[j]
            i, j = i[apart], j[apart]
            hit = table_.linked(i, j, bits)
            i, j = i[hit], j[hit]
            while len(i):
                low = np.minimum(label[i], label[j])
                np.minimum.at(label, label[i], low)
                np.minimum.at(label, label[j], low)
                while (label != label[label]).any():
                    label = label[label]
                apart = label[i] != label[j]
                i, j = i[apart], j[apart]
    at = np.flatnonzero(label != np.arange(n))
    yield at, label[at]


def cell_links(group: np.ndarray, prints: np.ndarray, bits: int, small: int = 32, second: np.ndarray | None = None, second_bits: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """Links (positions) within the groups of rows; rows of a group lie together."""
    start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    size = np.diff(np.r_[start, len(group)])
    table_, found = DistanceTable(prints, second, second_bits), []
    largest, of = np.repeat(size, size), np.repeat(np.arange(len(start)), size)
    for step in range(1, min(small, int(size.max(initial=1)))):
        i = np.flatnonzero((of[:-step] == of[step:]) & (largest[:-step] <= small))
        hit = table_.linked(i, i + step, bits)
        found.append((i[hit], i[hit] + step))
    for k in np.flatnonzero(size > small):
        a, b = start[k], start[k] + size[k]
        found += [(x + a, y + a) for x, y in forest(DistanceTable(prints[a:b], None if second is None else second[a:b], second_bits), bits)]
    return tuple(np.concatenate(x) if x else np.empty(0, np.int64) for x in zip(*found, strict=True)) or (np.empty(0, np.int64),) * 2


def linked(prints: DataFrame, bits: int = 4, second_bits: int = 64, cell_rows: int = 1024) -> DataFrame:
    """node, component of the nodes that have others with fingerprints within `bits` (up to 7), and second ones too.

    `prints` has a row for each node (long, distinct): node, fingerprint, second. A cell of more than `cell_rows` is
    dealt out in parts that are connected through common leaders; see wildtally.llm.resemblance.
    """
    if not 0 <= bits <= max(PARTITIONS):
        raise ValueError(f"the partitions are exact for up to {max(PARTITIONS)} bits")
    of = cells("fingerprint", bits, prints.count())
    full = prints.select(F.explode(of).alias("cell")).groupBy("cell").count().filter("count > 1").select("cell")
    met = cut(prints.select("node", "fingerprint", "second", F.explode(of).alias("cell")).join(full, "cell"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # the rows of a group not known to be complete

        def emit(rows: np.ndarray) -> pa.RecordBatch:
            x, y = (np.ascontiguousarray(rows[:, k]).view(np.uint64) for k in (3, 4))
            i, j = cell_links(rows[:, 0] * 31 + rows[:, 1], x, bits, second=y if second_bits < 64 else None, second_bits=second_bits)
            return pa.record_batch([pa.array(rows[i, 2]), pa.array(rows[j, 2])], names=["a", "b"])

        for batch in batches:
            rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(5)], axis=1)
            if not len(rows):
                continue
            change = np.flatnonzero((rows[1:, :2] != rows[:-1, :2]).any(axis=1)) + 1
            whole = held and (held[-1][-1, :2] != rows[0, :2]).any()
            if whole:
                yield emit(np.concatenate(held))
                held = []
            if len(change):
                yield emit(np.concatenate([*held, rows[: change[-1]]]))
                held, rows = [], rows[change[-1] :]
            held.append(rows)
        if held:
            yield emit(np.concatenate(held))

    def links(tasks: DataFrame) -> DataFrame:
        return in_tasks(tasks.select("cell", "task", "node", "fingerprint", "second"), "cell").mapInArrow(work, "a long, b long")

    return connected(met, "cell", F.lit(1), cell_rows, links)


def near_duplicates(docs: DataFrame, words: int = 5, bits: int = 4, id_col: str = "doc_id", text_col: str = "text", second_words: int = 0, second_bits: int = 64) -> DataFrame:
    """id, fingerprint (16 lower-case hex digits), component_id (smallest id reachable by links, itself included).

    With `second_words`, linked documents also lie within `second_bits` by a fingerprint over that many words. One row
    for each row of `docs`; other columns are left out. A null or blank text has fingerprint zero and links like any
    other. A null id keeps its row and is never a component_id, unless all ids of its component are null.
    """
    own = cut(fingerprints(docs, words, id_col, text_col, second_words))
    node = F.xxhash64("fingerprint", "second") if second_words else F.col("fingerprint")
    own = own.withColumn("node", node)
    least = cut(own.groupBy("node", "fingerprint", "second").agg(F.min(id_col).alias("first")))
    joined = linked(least.select("node", "fingerprint", "second"), bits, second_bits)
    labelled = cut(least.join(joined, "node", "left").select("node", "first", F.coalesce("component", "node").alias("root")))
    roots = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = labelled.join(roots, "root").select("node", "component_id")
    return own.join(classes, "node").select(id_col, F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of `docs` without near-duplicates (five-word shingle sets of Jaccard similarity 0.8 or more): of each group the row with the smallest doc_id stays.

    All columns stay. Rows without an id come last, so they stay where no row of their group has one; of equal rows
    one stays. Texts aren't shuffled, but for rows that are there more than once.
    """
    key = [free_name(docs, "_k1"), free_name(docs, "_k2")]
    whole = free_name(docs, "_key")
    named = docs.withColumn(whole, row_key()).withColumns({k: F.col(f"`{whole}`.k{n}") for n, k in enumerate(key, 1)}).drop(whole)
    order = F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id"), *key).alias("key")
    found = cut(groups(named.select(order, "text"), prints=both_prints, near=lambda prints: linked(prints, NEAR, NEAR_SECOND)))
    of = lambda df: df.select(*[f"key.{k}" for k in key])
    rest = matching(named, of(found.filter("key <> component_id")), "left_anti")
    repeated = cut(of(found.filter("key = component_id")).groupBy(*key).count().filter("count > 1").select(*key))
    if repeated.isEmpty():
        return rest.select(docs.columns)
    once = matching(rest, repeated, "left_semi").dropDuplicates(key)
    return matching(rest, repeated, "left_anti").unionByName(once).select(docs.columns)


def op9_simhash_pivots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document.

    Null, empty and blank texts have fingerprint zero and link like any other. A bit set in half the shingles is 0.
    Repeated rows and rows without an id stay. An empty table gives no rows. Other columns are not looked at;
    texts of any length are read whole.
    """
    return near_duplicates(table(spark, sf_dir, "documents"), words=4, bits=4)
