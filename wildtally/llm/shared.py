"""Helpers that all operators here use: reading tables, the shared folder, Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wildtally.storage import cut, fresh_path, remove, shared_folder, stored

__all__ = ["as_bytes", "bounded_sample", "cut", "free_name", "fresh_path", "heavy_first", "in_blocks", "matching", "over_batches", "remainder", "remove", "row_key", "shared_folder", "stored", "table"]

#: Rows that a Python function sees at a time; texts can be long, so batches are cut to this.
ROWS_AT_A_TIME = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Texts are long, so Spark hands Python at most 1,000 rows at a time from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def over_batches(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], rows: int = ROWS_AT_A_TIME):
    """A mapInArrow function that hands `work` slices of at most `rows` rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def slices() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, rows):
                    yield batch.slice(at, rows)

        yield from work(slices())

    return run


def in_blocks(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], rows: int):
    """A mapInArrow function that hands `work` blocks of `rows` rows or a batch more, for short rows that gain from company."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def blocks() -> Iterator[pa.RecordBatch]:
            held: list[pa.RecordBatch] = []
            for batch in batches:
                if batch.num_rows:
                    held.append(batch)
                if sum(b.num_rows for b in held) >= rows:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held = []
            if held:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()

        yield from work(blocks())

    return run


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def remainder(doc_id: str = "doc_id", by: int = 5) -> F.Column:
    """crc32 of the id as text, modulo `by` (null id: that of an empty text)."""
    return F.pmod(F.crc32(F.encode(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), "utf-8")), F.lit(by))


def bounded_sample(df: DataFrame, rows: int, key: str = "doc_id") -> DataFrame:
    """About `rows` rows (all if there are fewer), picked by a hash of `key`, so the same ones each time."""
    total = df.count()
    share = 1.0 if total <= rows else rows / total
    return df.filter(F.pmod(F.xxhash64(F.lit(7), F.col(key)), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))


def free_name(df: DataFrame, name: str) -> str:
    """The name, with underscores in front until no column of `df` is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


#: Keys that without() sends to every task; more are joined by a shuffle. At most about 100 MB in each executor.
SENT_KEYS = 1_000_000


def row_key(doc_id: str = "doc_id", text: str = "text") -> F.Column:
    """128 bits that name a row by its id and text, whether or not ids are null or repeated."""
    return F.struct(F.xxhash64(doc_id, text).alias("k1"), F.xxhash64(F.lit(1), text, doc_id).alias("k2"))


def matching(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """left_anti or left_semi join of `rows` with the distinct key columns of `keys`, which are counted first."""
    keys = cut(keys.distinct())
    return rows.join(F.broadcast(keys) if keys.count() <= SENT_KEYS else keys, keys.columns, how)


def heavy_first(rows: DataFrame, told: DataFrame, on: str, weight: str, most: int = SENT_KEYS) -> DataFrame:
    """Left join of `rows` to `told`, which has a row for each key `on`, and in `weight` how many of the rows have it.

    Up to `most` keys are sent to every task. Of more, those are sent that over 1 / `most` of the rows have, which can't
    be more than `most` either, and only rows with other keys are shuffled: so no task gets a large share of the rows,
    however many a key has. `weight` isn't in the result.
    """
    rest = told.drop(weight)
    held, total = told.agg(F.count("*"), F.coalesce(F.sum(weight), F.lit(0))).first()
    if held <= most:
        return rows.join(F.broadcast(rest), on, "left")
    heavy = told.filter(F.col(weight) > total / most)
    keys = F.broadcast(heavy.select(on))
    return rows.join(F.broadcast(heavy.drop(weight)), on).unionByName(rows.join(keys, on, "left_anti").join(told.join(keys, on, "left_anti").drop(weight), on, "left"))
