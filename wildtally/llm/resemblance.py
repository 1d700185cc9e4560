"""Groups of texts that resemble each other: Jaccard similarity of their sets of five-word shingles, verified exactly.

What a caller proposes (`near` of groups(): in the pipeline SimHash fingerprints compared through pivot tables) comes
first, and MinHash adds only what that leaves apart; both together are verified once. Every distinct set has HASHES
least hashes, dealt to bands of ROWS: sets that agree in a whole band share a cell, which two sets of similarity 0.8 miss with probability (1 - 0.8 ** 4) ** 16 = 0.0002. In a cell, sets
that agree in ALIKE of all hashes are tied (at 0.8, fewer agree with a probability of about 1e-7), so unlike texts that
share a passage don't grow into one. What ties connect is a candidate group.

Texts of candidate groups are brought together, and two are linked only if their shingle sets, compared in full, have
the similarity asked for. Groups are what such links connect.

Cells over CELL_ROWS members and groups over GROUP_SHINGLES shingles are dealt out in parts, each with the same LEADERS
members of the whole, so a crowd of near copies is connected through them and its rows are dealt once. Only members
that this leaves apart from the most common component are compared with all parts, so no pair is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wildtally.llm.components import components
from wildtally.llm.shared import SENT_KEYS, as_bytes, cut, over_batches

HASHES, ROWS, ALIKE = 64, 4, 32
CELL_ROWS, GROUP_SHINGLES, LEADERS = 512, 200_000, 8
FACTORS = np.random.default_rng(80).integers(0, 1 << 63, HASHES, np.uint64) * np.uint64(2) + np.uint64(1)
SEED = 42

#: Two 64-bit fingerprints of a text, given with its set of shingles.
Prints = Callable[[bytes, np.ndarray], tuple[int, int]]


def shingles(data: bytes, words: int = 5) -> np.ndarray:
    """Distinct XXH64 of all shingles (ASCII lower case, ASCII white space), ascending; a shorter text is one shingle."""
    found = data.lower().split()
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    text, size = b" ".join(found), np.fromiter(map(len, found), np.int64, n)
    if n <= words:
        return np.array([xxhash.xxh64_intdigest(text, SEED)], np.uint64)
    end = np.cumsum(size + 1) - 1
    first, last = (end - size)[: n - words + 1].tolist(), end[words - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(text[a:b], SEED) for a, b in zip(first, last, strict=True)), np.uint64, len(first)))


def sketch(hashes: np.ndarray) -> bytes:
    """The least of the hashes in HASHES orders, 32 bits each."""
    least = np.full(HASHES, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 2048):
        np.minimum(least, (hashes[None, at : at + 2048] * FACTORS[:, None]).min(axis=1), out=least)
    return (least >> np.uint64(32)).astype("<u4").tobytes()


def spread(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> np.ndarray:
    """For each of n things the first one that links connect it to; near(i, others) says which others i is linked to."""
    root, left = np.arange(n), np.arange(n)
    while len(left):
        first, left = int(left[0]), left[1:]
        queue = [first]
        while queue and len(left):
            hit = near(queue.pop(), left)
            if hit.any():
                root[left[hit]] = first
                queue += left[hit].tolist()
                left = left[~hit]
    return root


def tied(sketches: np.ndarray) -> np.ndarray:
    """Roots of sets whose sketches (rows) agree in ALIKE places or more."""
    return spread(len(sketches), lambda i, others: (sketches[others] == sketches[i]).sum(axis=1) >= ALIKE)


def resembling(sets: list[np.ndarray], least: float) -> np.ndarray:
    """Roots of sets (distinct hashes each) that pairs of Jaccard similarity `least` or more connect."""
    size = np.array([len(s) for s in sets], np.int64)
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    flat, of = flat.astype(np.int32), np.repeat(np.arange(len(sets), dtype=np.int32), size)
    start, held = np.r_[0, np.cumsum(size)], np.zeros(len(values), bool)
    rest = [flat, of, len(sets)]

    def near(i: int, others: np.ndarray) -> np.ndarray:
        if 2 * len(others) < rest[2]:  # the sets that are done needn't be looked through again
            open_ = np.zeros(len(sets), bool)
            open_[others] = True
            keep = open_[rest[1]]
            rest[:] = rest[0][keep], rest[1][keep], len(others)
        own = flat[start[i] : start[i + 1]]
        held[own] = True
        shared = np.bincount(rest[1][held[rest[0]]], minlength=len(sets))[others]
        held[own] = False
        return shared >= least * (size[i] + size[others] - shared) - 1e-9

    return spread(len(sets), near)


def in_groups(roots: Callable[[list[pa.RecordBatch]], np.ndarray]):
    """A mapInArrow function over rows sorted by their first two columns: a, b link each node (the third) to the first it is tied to.

    `roots` gets the rows of one group.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        name = None

        def emit() -> pa.RecordBatch:
            node = np.concatenate([b.column(2).to_numpy(zero_copy_only=False) for b in held])
            root = roots(held)
            at = np.flatnonzero(root != np.arange(len(root)))
            return pa.record_batch([pa.array(node[at]), pa.array(node[root[at]])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in (0, 1)], axis=1)
            starts = np.r_[0, np.flatnonzero((rows[1:] != rows[:-1]).any(axis=1)) + 1, len(rows)]
            for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                if held and tuple(rows[a]) != name:
                    yield emit()
                    held = []
                name = tuple(rows[a])
                held.append(batch.slice(a, b - a))
        if held:
            yield emit()

    return work


def parts_of(rows: DataFrame, group: str, weight: F.Column, limit: int) -> DataFrame | None:
    """group, parts, leaders (nodes) of groups that weigh more than `limit`, None if none does; `rows` has each member once: group, node.

    Leaders are least by as many random orders, each a minimum, so no group is gathered.
    """
    totals = cut(rows.groupBy(group).agg(F.ceil(F.sum(weight) / limit).cast("int").alias("parts")).filter("parts > 1"))
    if totals.isEmpty():
        return None
    least = [F.min(F.struct(F.xxhash64("node", F.lit(k)), "node"))["node"] for k in range(LEADERS)]
    return cut(rows.join(totals, group).groupBy(group, "parts").agg(F.array_distinct(F.array(*least)).alias("leaders")))


def first_round(rows: DataFrame, large: DataFrame | None, group: str) -> DataFrame:
    """`rows` with the column task: each in its own part, leaders in every part; groups not in `large` are one part."""
    if large is None:
        return rows.withColumn("task", F.lit(0))
    told = rows.join(large, group, "left")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    every = F.sequence(F.lit(0), F.col("parts") - 1)
    tasks = F.when(F.col("parts").isNull(), F.array(F.lit(0))).when(F.array_contains("leaders", F.col("node")), every).otherwise(F.array(own))
    return told.withColumn("task", F.explode(tasks)).drop("parts", "leaders")


def labels_of(rows: DataFrame, joined: DataFrame | None) -> DataFrame:
    """`rows` with label: the component of their node in `joined` (node, component), the node itself if it has none."""
    if joined is None:
        return rows.withColumn("label", F.col("node"))
    return rows.join(joined.withColumnRenamed("component", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))


def apart(rows: DataFrame, group: str) -> DataFrame:
    """The groups of `rows` (group, label) with members of different labels."""
    return rows.groupBy(group).agg(F.min("label").alias("_a"), F.max("label").alias("_b")).filter("_a <> _b").select(group)


def second_round(rows: DataFrame, large: DataFrame, group: str, joined: DataFrame, weight: F.Column, limit: int) -> DataFrame | None:
    """`rows` of large groups whose members `joined` (node, component) leaves in several components, with the column task: those apart from the group's most common component meet all. None if there are none."""
    member = labels_of(rows.join(large.select(group, "parts"), group), joined)
    common = member.groupBy(group, "label").count().groupBy(group).agg(F.max_by("label", F.struct("count", "label")).alias("main"))
    member = cut(member.join(common, group))
    rest = cut(member.filter("label <> main").groupBy(group).agg(F.ceil(F.sum(weight) / limit).cast("int").alias("others")))
    if rest.isEmpty():
        return None
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    both = member.join(rest, group)
    as_rest = both.filter("label <> main").withColumn("task", F.explode(F.transform(every("parts"), lambda p: p * F.col("others") + own("others"))))
    as_any = both.withColumn("task", F.explode(F.transform(every("others"), lambda q: own("parts") * F.col("others") + q)))
    return as_any.unionByName(as_rest).select(*rows.columns, "task").distinct()


def in_tasks(rows: DataFrame, group: str) -> DataFrame:
    return rows.repartition(group, "task").sortWithinPartitions(group, "task")


def sketches(docs: DataFrame, words: int, key: str, prints: Prints | None = None) -> DataFrame:
    """key, node (names the set of shingles), n (its size), sketch, fingerprint, second of every whole text; without `prints` the last two are 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(1))
            sets = [shingles(x, words) for x in texts]
            both = np.array([prints(x, s) if prints else (0, 0) for x, s in zip(texts, sets, strict=True)], np.uint64).reshape(-1, 2).view(np.int64)
            node = np.array([xxhash.xxh64_intdigest(s.tobytes(), SEED) for s in sets], np.uint64).view(np.int64)
            told = [pa.array(node), pa.array([len(s) for s in sets], pa.int64()), pa.array([sketch(s) for s in sets], pa.binary()), pa.array(both[:, 0]), pa.array(both[:, 1])]
            yield pa.record_batch([batch.column(0), *told], names=[key, "node", "n", "sketch", "fingerprint", "second"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "text").mapInArrow(over_batches(work), f"`{key}` {kind}, node long, n long, sketch binary, fingerprint long, second long")


def as_links(joined: DataFrame) -> DataFrame:
    """node, component as links a, b."""
    return joined.select(F.col("node").alias("a"), F.col("component").alias("b"))


def connected(rows: DataFrame, group: str, weight: F.Column, limit: int, links: Callable[[DataFrame], DataFrame], known: DataFrame | None = None) -> DataFrame:
    """node, component of all nodes that links within a group, or `known` (node, component), connect; `rows` has each member of a group once, `links` gives the links (a, b) within tasks of rows."""
    large = parts_of(rows, group, weight, limit)
    found = links(first_round(rows, large, group))
    joined = components(found if known is None else found.unionByName(as_links(known)))
    if large is None:
        return joined
    joined = cut(joined)
    more = second_round(rows, large, group, joined, weight, limit)
    return joined if more is None else components(as_links(joined).unionByName(links(more)))


def candidates(sets: DataFrame, cell_rows: int = CELL_ROWS, joined: DataFrame | None = None) -> DataFrame:
    """node, component: each candidate group; `sets` has a row for each node: node, sketch.

    With `joined` (node, component) its groups are connected, too; cells and groups that it has connected already are
    left out.
    """
    width = 4 * ROWS
    cells = F.array(*[F.xxhash64(F.lit(k), F.substring("sketch", k * width + 1, width)) for k in range(HASHES // ROWS)])
    member = labels_of(sets, joined).select("node", "label", F.explode(cells).alias("cell"))
    full = apart(member, "cell")
    met = cut(member.join(full, "cell").select("cell", "node"))

    def roots(held: list[pa.RecordBatch]) -> np.ndarray:
        return tied(np.frombuffer(b"".join(x for b in held for x in b.column(3).to_pylist()), "<u4").reshape(-1, HASHES))

    def links(tasks: DataFrame) -> DataFrame:
        rows = tasks.join(sets.select("node", "sketch"), "node").select("cell", "task", "node", "sketch")
        return in_tasks(rows, "cell").mapInArrow(in_groups(roots), "a long, b long")

    found = connected(met, "cell", F.lit(1), cell_rows, links, joined)
    if joined is None:
        return found
    found = cut(found)
    return found.join(apart(labels_of(found, joined), "component"), "component").select("node", "component")


def verified(docs: DataFrame, sets: DataFrame, proposed: DataFrame, least: float, words: int, key: str, group_shingles: int = GROUP_SHINGLES) -> DataFrame:
    """node, component: what pairs of similarity `least` or more connect within a proposed group (node, component).

    `sets` has a row for each node: node, n and first, the key of a row of `docs` with its text.
    """
    chosen = cut(proposed.withColumnRenamed("component", "group").join(sets, "node").select("group", "node", "n", F.col("first").alias(key)))

    def roots(held: list[pa.RecordBatch]) -> np.ndarray:
        return resembling([shingles(x, words) for b in held for x in as_bytes(b.column(3))], least)

    def links(tasks: DataFrame) -> DataFrame:
        wanted = cut(tasks.select(key, "node", "group", "task"))
        rows = docs.select(key, "text").join(F.broadcast(wanted) if wanted.count() <= SENT_KEYS else wanted, key)
        return in_tasks(rows.select("group", "task", "node", "text"), "group").mapInArrow(in_groups(roots), "a long, b long")

    return connected(chosen, "group", F.col("n"), group_shingles, links)


def groups(
    docs: DataFrame, key: str = "key", least: float = 0.8, words: int = 5, cell_rows: int = CELL_ROWS, group_shingles: int = GROUP_SHINGLES,
    prints: Prints | None = None, near: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """key, component_id (the smallest key that links of similarity `least` or more reach, itself included).

    One row for each row of `docs` (key, text); keys are non-null, and rows with the same key have the same text. Blank
    and null texts are alike. `near` proposes groups (node, component) from node, fingerprint, second, which `prints`
    makes; MinHash adds what they leave apart, and all groups are verified together.
    """
    own = cut(sketches(docs, words, key, prints))
    sets = own.groupBy("node").agg(F.min(F.struct(F.col(key), "n", "sketch", "fingerprint", "second")).alias("r"))
    sets = cut(sets.select("node", F.col(f"r.{key}").alias("first"), "r.n", "r.sketch", "r.fingerprint", "r.second"))
    if near:
        early = cut(near(sets.select("node", "fingerprint", "second")))
        late = cut(candidates(sets, cell_rows, early))
        proposed = early.join(late.select("node"), "node", "left_anti").unionByName(late)
    else:
        proposed = candidates(sets, cell_rows)
    joined = verified(docs, sets.select("node", "first", "n"), proposed, least, words, key, group_shingles)
    labelled = cut(sets.select("node", "first").join(joined, "node", "left").select("node", "first", F.coalesce("component", "node").alias("root")))
    roots = labelled.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = labelled.join(roots, "root").select("node", "component_id")
    return own.select(key, "node").join(classes, "node").select(key, "component_id")
