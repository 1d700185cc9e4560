"""What is new, what is still to do, and which record of a key counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def last_of_each(records: DataFrame, key: str, order: Column | str) -> DataFrame:
    """The last record of each key in the given order; records without a key are dropped."""
    newest = W.partitionBy(key).orderBy(F.desc(order) if isinstance(order, str) else order.desc())
    return records.filter(F.col(key).isNotNull()).withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def still_to_do(items: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """Items without a record, or whose last record is an error (records hold one row a key)."""
    return items.join(records.filter(F.col("error").isNull()).select(key), key, "left_anti")


def find_new_images(found: DataFrame, media: DataFrame) -> DataFrame:
    """Paths that aren't in the media table."""
    return found.select("rel_path").join(media.select("rel_path"), "rel_path", "left_anti").orderBy("rel_path")


def same_members(a: DataFrame, b: DataFrame, key: str) -> bool:
    """Whether two tables hold the same set of keys."""
    return a.join(b, key, "left_anti").isEmpty() and b.join(a, key, "left_anti").isEmpty()


def contiguous_runs(entries: DataFrame, start: Column, length: int) -> DataFrame:
    """For each camera its rows start..start+length in time order, and the rest of the sequence the last of them is in.

    `start` counts from 1 and may use column n (rows of the camera).
    """
    order = W.partitionBy("camera_id").orderBy("timestamp", "file_name")
    ranked = entries.filter(F.col("timestamp").isNotNull()).withColumn("place", F.row_number().over(order))
    ranked = ranked.withColumn("n", F.count("*").over(W.partitionBy("camera_id"))).withColumn("first", start)
    last = F.least(F.col("first") + length - 1, F.col("n"))
    open_ = F.max(F.when(F.col("place") == last, F.col("seq_id"))).over(W.partitionBy("camera_id"))
    inside = F.col("place").between(F.col("first"), last)
    tail = (F.col("place") > last) & (F.col("seq_id") == F.col("_open"))
    return ranked.withColumn("_open", open_).filter(inside | F.coalesce(tail, F.lit(False))).drop("n", "first", "_open")


def spaced(starts: Column, spacing: float) -> Column:
    """Of an ascending array, each value at least `spacing` after the last one kept."""
    keep = lambda acc, x: F.when((F.size(acc) == 0) | (x - F.try_element_at(acc, F.lit(-1)) >= spacing), F.concat(acc, F.array(x))).otherwise(acc)
    return F.aggregate(starts, F.array().cast("array<double>"), keep)
