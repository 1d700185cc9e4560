"""A folder that photos keep coming to: each is worked on once, and failures are fed in again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from wildtally.sources.images import EXTENSIONS
from wildtally.sources.tables import RecordStore

#: Numbers of attempts that feed_again() makes begin here; those below are the stream's own batches.
AGAIN = 1_000_000_000


def stream_folder(
    spark: SparkSession, root: str, store: RecordStore, work: Callable[[DataFrame], DataFrame], checkpoint: str, files_a_batch: int = 10_000
) -> DataStreamWriter:
    """A writer that keeps `work` of each new image's rel_path in the store; start it with a trigger.

    What a batch gives is kept under the batch's number, so a batch that runs again after a crash replaces its own
    records and adds none. Only names and sizes are read by the stream; files are opened by `work`. Names that begin
    with _ or a dot and empty files are passed over, as by all of Spark's streams.
    """
    names = f"*.{{{','.join(e for x in EXTENSIONS for e in (x, x.upper()))}}}"
    rows = (
        spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", True).option("pathGlobFilter", names).option("maxFilesPerTrigger", files_a_batch).load(root)
    )
    base = root.rstrip("/").partition("://")[2] or root.rstrip("/")
    paths = rows.select(F.regexp_replace("path", rf"^.*?\Q{base}\E/", "").alias("rel_path"))

    def kept(batch: DataFrame, number: int) -> None:
        store.put(work(batch), number)

    return paths.writeStream.foreachBatch(kept).option("checkpointLocation", checkpoint)


def failures(store: RecordStore) -> DataFrame:
    """The key and n_failed (attempts that failed) of everything whose newest record is an error: what waits to be tried again."""
    counts = store.history().filter(F.col("error").isNotNull()).groupBy(store.key).agg(F.count("*").alias("n_failed"))
    return store.read().filter(F.col("error").isNotNull()).select(store.key).join(counts, store.key)


def feed_again(items: DataFrame, store: RecordStore, work: Callable[[DataFrame], DataFrame], most: int = 5) -> int:
    """Tries once more what failed fewer than `most` times; returns how many that were. `items` has the store's key and what `work` needs."""
    due = items.join(failures(store).filter(F.col("n_failed") < most).select(store.key), store.key, "left_semi")
    n = due.count()
    if n:
        last = store.history().agg(F.max("_attempt")).first()[0]
        store.put(work(due), max(AGAIN, last + 1))
    return n
