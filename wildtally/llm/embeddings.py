"""Near-duplicate vectors by lattice hashing.

In each of TABLES tables a vector is rotated at random into BLOCKS blocks of 8 dimensions, shifted, and each block is
decoded to the nearest point of the E8 lattice; the points of all blocks name its cell. The vector also enters
neighbouring cells, those of the lattice points nearest to it after its own, one block changed at a time. Vectors that
share a cell are compared by cosine in double precision. A pair is counted in the first cell that both share, so no
list of pairs is ever made: a cell returns counts for its members and a forest of links.

Equal vectors are one class, compared once and counted with their number. A cell of more than `cell_rows` classes is
dealt out as pairs of parts: n_links counts every pair, so every pair of a cell has to meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wildtally.llm.components import components
from wildtally.llm.shared import cut, heavy_first, over_batches, table

TABLES, BLOCKS, PROBES = 8, 3, 2
#: Lattice units for a distance of one between unit vectors after projection to a block, times sqrt(dimensions / 8).
SCALE = 1.65
#: Distinct vectors that are sent to every task with their results: at most 80 MB for 1,000 doubles each.
SENT_VECTORS = 10_000


def _shortest() -> np.ndarray:
    """The 240 shortest vectors of E8: two entries of one, or eight halves with an even number of minus signs."""
    found = []
    for i in range(8):
        for j in range(i):
            for a, b in ((1, 1), (1, -1), (-1, 1), (-1, -1)):
                found.append([a if k == i else b if k == j else 0.0 for k in range(8)])
    for signs in range(256):
        if bin(signs).count("1") % 2 == 0:
            found.append([-0.5 if signs >> k & 1 else 0.5 for k in range(8)])
    return np.array(found)


SHORTEST = _shortest()


def _nearest_even(x: np.ndarray) -> np.ndarray:
    """Nearest integer points with an even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    off = x[odd] - near[odd]
    worst = np.abs(off).argmax(axis=1)
    rows = np.arange(len(odd))
    near[odd, worst] += np.where(off[rows, worst] >= 0, 1.0, -1.0)
    return near


def nearest_points(x: np.ndarray) -> np.ndarray:
    """Nearest E8 point of each row: an even integer point, or one moved by a half in all coordinates."""
    whole, half = _nearest_even(x), _nearest_even(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(axis=1) < ((x - whole) ** 2).sum(axis=1)
    return np.where(closer[:, None], half, whole)


class LatticeTables:
    """The tables for vectors of one length."""

    def __init__(self, length: int, tables: int = TABLES, blocks: int = BLOCKS, probes: int = PROBES, scale: float = SCALE) -> None:
        rng = np.random.default_rng((8, length))
        self.probes = probes
        self.parts = []
        for _ in range(tables):
            turn = np.linalg.qr(rng.normal(size=(max(length, 8 * blocks), 8 * blocks)))[0][:length]
            shift = rng.uniform(0, 2, size=8 * blocks)
            names = rng.integers(0, 1 << 63, size=8 * blocks, dtype=np.int64) | 1
            self.parts.append((turn * scale * np.sqrt(max(length, 8) / 8), shift, names, rng.integers(0, 1 << 63, dtype=np.int64)))

    def cells(self, unit: np.ndarray) -> np.ndarray:
        """[vector, table * (1 + blocks * probes)]: own and neighbouring cells; the table is in the lowest bits."""
        out = []
        for k, (turn, shift, names, salt) in enumerate(self.parts):
            x = (unit @ turn + shift).reshape(len(unit), -1, 8)
            point = nearest_points(x.reshape(-1, 8)).reshape(x.shape)
            gain = (x - point) @ SHORTEST.T
            names = names.reshape(-1, 8)
            part = ((2 * point).astype(np.int64) * names).sum(axis=2, dtype=np.int64)  # wraps, as a hash may
            own = part.sum(axis=1, dtype=np.int64) + salt
            found = [own]
            step = (2 * SHORTEST).astype(np.int64)
            for b in range(x.shape[1]):
                best = np.argpartition(-gain[:, b], self.probes, axis=1)[:, : self.probes]
                found += [own + (step[best[:, q]] * names[b]).sum(axis=1, dtype=np.int64) for q in range(self.probes)]
            out += [_scattered(f) << np.int64(5) | np.int64(k) for f in found]
        return np.stack(out, axis=1)


def _scattered(x: np.ndarray) -> np.ndarray:
    y = x.astype(np.uint64)
    y = (y ^ y >> np.uint64(31)) * np.uint64(0x9E3779B97F4A7C15)
    return (y ^ y >> np.uint64(29)).astype(np.int64)


def usable(embedding: str) -> F.Column:
    """Whether a vector can link: not null, all components finite, not all zero."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _in_cells(classes: DataFrame) -> DataFrame:
    """rep, vector (unit, as bytes of doubles), weight, cells of each class."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, LatticeTables] = {}
        for batch in batches:
            vectors = [np.asarray(v, np.float64) for v in batch.column(1).to_pylist()]
            cells, units = [None] * len(vectors), [b""] * len(vectors)
            for length in {len(v) for v in vectors}:
                at = [k for k, v in enumerate(vectors) if len(v) == length]
                x = np.stack([vectors[k] for k in at])
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                if length not in tables:
                    tables[length] = LatticeTables(length)
                for k, c, u in zip(at, tables[length].cells(x), x, strict=True):
                    cells[k], units[k] = c, u.tobytes()
            columns = [batch.column(0), pa.array(units, pa.binary()), batch.column(2), pa.array(cells, pa.list_(pa.int64()))]
            yield pa.record_batch(columns, names=["rep", "vector", "weight", "cells"])

    return classes.select("rep", "embedding", "weight").mapInArrow(over_batches(work, 2048), "rep long, vector binary, weight long, cells array<long>")


def compare_cell(cell: int, task: int, parts: int, rep: np.ndarray, own: np.ndarray, unit: np.ndarray, weight: np.ndarray, cells: np.ndarray, least: float):
    """Of one cell (or a pair of its parts): how many vectors each class links with here first, and a forest of links."""
    n = len(rep)
    left, right = divmod(task, parts)
    a, b = np.flatnonzero(own == left), np.flatnonzero(own == right)
    near = unit[a] @ unit[b].T >= least
    near &= rep[a][:, None] != rep[b][None, :]
    i, j = np.nonzero(near)
    count = np.zeros(n, np.int64)
    if not len(i):
        return count, np.empty((0, 2), np.int64)
    values, index = np.unique(np.where(_order(cells) < _order(np.array([cell]))[0], cells, 0), return_inverse=True)
    index = index.reshape(cells.shape)
    holds = np.zeros((n, len(values)), np.float32)
    holds[np.arange(n)[:, None], index] = 1
    holds[:, values == 0] = 0
    first = near & (holds[a] @ holds[b].T == 0)
    count[a] += first.astype(np.int64) @ weight[b]
    if left != right:
        count[b] += first.T.astype(np.int64) @ weight[a]
    label = np.arange(n)
    i, j = a[i], b[j]
    while len(i):
        low = np.minimum(label[i], label[j])
        np.minimum.at(label, label[i], low)
        np.minimum.at(label, label[j], low)
        while (label != label[label]).any():
            label = label[label]
        apart = label[i] != label[j]
        i, j = i[apart], j[apart]
    at = np.flatnonzero(label != np.arange(n))
    return count, np.stack([rep[at], rep[label[at]]], axis=1)


#: Members of a group that are compared with those of all other such groups at once.
FEW = 32


def _order(cells: np.ndarray) -> np.ndarray:
    """Cells come in the order of their table, then of their number; a pair is counted in the first cell it shares."""
    return ((cells & 31).astype(np.uint64) << np.uint64(59)) | (cells.astype(np.uint64) >> np.uint64(5))


def few_links(cell: np.ndarray, group: np.ndarray, rep: np.ndarray, unit: np.ndarray, weight: np.ndarray, cells: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Of groups of FEW at most that lie one behind the other: how many vectors each row links with here first, and these links (rows)."""
    n, found = len(rep), []
    count = np.zeros(n, np.int64)
    for step in range(1, FEW):
        i = np.flatnonzero((group[:-step] == group[step:]) & (rep[:-step] != rep[step:])) if step < n else np.empty(0, np.int64)
        if step >= n or not len(i) and not (group[:-step] == group[step:]).any():
            break
        near = i[np.einsum("ij,ij->i", unit[i], unit[i + step]) >= least]
        for at in range(0, len(near), 2048):
            x, y = near[at : at + 2048], near[at : at + 2048] + step
            early = _order(cells[x]) < _order(cell[x])[:, None]
            shared = ((cells[x][:, :, None] == cells[y][:, None, :]).any(axis=2) & early).any(axis=1)
            x, y = x[~shared], y[~shared]
            np.add.at(count, x, weight[y])
            np.add.at(count, y, weight[x])
            found.append(np.stack([x, y], axis=1))
    return count, np.concatenate(found) if found else np.empty((0, 2), np.int64)


def linked_classes(classes: DataFrame, least: float, cell_rows: int = 4096) -> DataFrame:
    """a, b, n: rows with b are links between classes; rows without say that class a links with n further vectors."""
    held = cut(_in_cells(classes))
    member = held.select("rep", F.explode(F.array_distinct("cells")).alias("cell"))
    full = member.groupBy("cell").count().filter("count > 1").select("cell", F.ceil(F.col("count") / cell_rows).cast("int").alias("parts"))
    own = F.pmod(F.xxhash64("rep", "cell"), F.col("parts")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: F.least(q, F.col("own")) * F.col("parts") + F.greatest(q, F.col("own")))
    dealt = member.join(full, "cell").withColumn("own", own).select("rep", "cell", "parts", "own", F.explode(meets).alias("task"))
    rows = dealt.join(held, "rep").select("cell", "task", "parts", "own", "rep", "weight", "vector", "cells")

    def told(rep: np.ndarray, count: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
        some = np.flatnonzero(count)
        a, n = np.concatenate([rep[some], links[:, 0]]), np.concatenate([count[some], np.zeros(len(links), np.int64)])
        b = pa.concat_arrays([pa.nulls(len(some), pa.int64()), pa.array(links[:, 1], pa.int64())])
        return pa.record_batch([pa.array(a, pa.int64()), b, pa.array(n, pa.int64())], names=["a", "b", "n"])

    def compared(block: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        """Of rows that hold whole groups; vectors of one length at a time."""
        size = pc.binary_length(block.column(6)).to_numpy()
        for length in np.unique(size).tolist():
            same = block if (size == length).all() else block.filter(pa.array(size == length))
            cell, task, parts, own, rep, weight = (same.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(6))
            unit = np.frombuffer(b"".join(same.column(6).to_pylist()), np.float64).reshape(len(rep), -1)
            cells = same.column(7).flatten().to_numpy().reshape(len(rep), -1)
            begins = np.r_[True, (cell[1:] != cell[:-1]) | (task[1:] != task[:-1])]
            start = np.flatnonzero(begins)
            group, members = np.cumsum(begins), np.diff(np.r_[start, len(rep)])
            few = np.repeat((members <= FEW) & (parts[start] == 1), members)
            count, links = few_links(cell[few], group[few], rep[few], unit[few], weight[few], cells[few], least)
            yield told(rep[few], count, rep[few][links])
            for k in np.flatnonzero(~few[start] & (members > 1)):
                at = slice(start[k], start[k] + members[k])
                yield told(rep[at], *compare_cell(cell[start[k]], int(task[start[k]]), int(parts[start[k]]), rep[at], own[at], unit[at], weight[at], cells[at], least))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[pa.RecordBatch] = []  # rows of a group that may go on
        name = None
        for batch in batches:
            if not batch.num_rows:
                continue
            cell, task = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 1))
            change = np.flatnonzero((cell[1:] != cell[:-1]) | (task[1:] != task[:-1])) + 1
            if kept and name != (cell[0], task[0]):
                yield from compared(joined(kept))
                kept = []
            if len(change):
                yield from compared(joined([*kept, batch.slice(0, int(change[-1]))]))
                kept, batch = [], batch.slice(int(change[-1]))
            kept.append(batch)
            name = (cell[-1], task[-1])
        if kept:
            yield from compared(joined(kept))

    return rows.repartition("cell", "task").sortWithinPartitions("cell", "task").mapInArrow(work, "a long, b long, n long")


def joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """Batches as one."""
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def near_duplicate_vectors(vectors: DataFrame, least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept of every row.

    Vectors that are null, zero or hold a null or non-finite component, and rows without an id, link with nothing;
    such a row is its own component. Equal vectors link with each other. Vectors of different lengths never link. An
    id that stands on several different vectors takes part with each. Other columns are left out.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("embedding"))
    good = usable("embedding") & F.col("id").isNotNull()
    classes = cut(rows.filter(good).groupBy("embedding").agg(F.min("id").alias("rep"), F.count("*").alias("weight")))
    found = cut(linked_classes(classes, least))
    counts = found.filter("b IS NULL").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("others"))
    parts = components(found.filter("b IS NOT NULL").select("a", "b")).withColumnRenamed("node", "rep")
    told = classes.join(counts, "rep", "left").join(parts, "rep", "left").select(
        "embedding", "weight", (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id")
    )
    linked = heavy_first(rows.filter(good), cut(told), "embedding", "weight", SENT_VECTORS).select("id", "n_links", "component_id")
    alone = rows.filter(~good).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    both = linked.unionByName(alone)
    return both.select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op8_lattice_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector.

    Null, zero and non-finite vectors and rows without an id stand alone. Equal vectors link; the smallest id of a
    component is kept, all rows of it if it is repeated. An empty table gives no rows; other columns are not looked at.
    """
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"), 0.95)
