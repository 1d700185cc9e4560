"""Benchmark decontamination: size-partitioned MinHash containment search, verified by exact shingle containment.

DataFrame operations only. Items (short) are searched inside documents (long), so the question is containment, not
resemblance. Items are partitioned by size into powers of two. An item's sketch is its SKETCH least shingle hashes;
of an item whose shingles are contained to 0.8, all SKETCH are missing from a document with probability under 3e-6.
A document large enough for a size class is a candidate where it holds a hash of an item's sketch, and candidates are
verified by counting the item's distinct shingles in the document.

An item of fewer words than a shingle has one shingle, all its words, and is looked for among the documents' runs of as
many words; that is done for the lengths that occur.

A document's shingles leave its row only where they occur in some item, so what is shuffled follows the overlap with
the benchmark and not the corpus. The items' shingles are broadcast up to BROADCAST_ROWS, counted first; beyond that
the same joins are shuffled. Shingles are compared as 64-bit hashes of their words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from wildtally.llm.shared import cut, free_name, matching, table

SKETCH = 8
#: 16 bytes a row: at most 32 MB in each executor.
BROADCAST_ROWS = 2_000_000


def word_array(text: F.Column) -> F.Column:
    """Lower-cased runs of letters and digits."""
    return F.split(F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), " ")


def shingle_hashes(words: F.Column, size: int) -> F.Column:
    """Hash of each run of `size` words; an empty array if there are fewer words."""
    starts = F.sequence(F.lit(0), F.size(words) - size)
    each = F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(size)]))
    return F.when(F.size(words) >= size, each).otherwise(F.array().cast("array<long>"))


def sized_shingles(words: F.Column, size: int) -> F.Column:
    """shingle_hashes() with their size, as structs length, hash."""
    return F.transform(shingle_hashes(words, size), lambda h: F.struct(F.lit(size).alias("length"), h.alias("hash")))


def item_shingles(items: DataFrame, size: int = 5, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item_id, length (words of a shingle: `size`, or those of a shorter item), hash, rank (1: least hash in a random order), n (distinct shingles), size_class (floor of log2 n)."""
    words = items.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("item_id"), word_array(F.col(text_col)).alias("words"))
    short = F.filter("words", lambda w: w != "")
    lengths = {k: F.size("words") >= k if k == size else (F.size("words") == k) & (F.size(short) == k) for k in range(1, size + 1)}
    whole = F.coalesce(*[F.when(test, sized_shingles(F.col("words"), k)) for k, test in lengths.items()])
    rows = words.select("item_id", F.explode(whole).alias("s")).select("item_id", "s.*").distinct()
    own = W.partitionBy("item_id")
    return rows.select(
        "item_id", "length", "hash",
        F.row_number().over(own.orderBy(F.xxhash64("hash"), "hash")).alias("rank"),
        F.count("*").over(own).alias("n"),
    ).withColumn("size_class", F.floor(F.log2("n")))


def contained(docs: DataFrame, items: DataFrame, size: int = 5, least: float = 0.8) -> DataFrame:
    """doc_id, doc_key, item_id, n_shared, n_shingles, containment: items of which a share of `least` or more of the
    distinct shingles stands in the document.

    doc_key is a hash of doc_id and text, so rows with a null or repeated doc_id keep apart where their texts differ;
    equal rows count once. An item of fewer than `size` words is found where its words stand side by side. Null and
    empty texts, and those without a letter or digit, have no shingle: as documents they hold nothing, as items they are
    found nowhere; items without an id are left out. Empty tables give no rows. Other columns are not looked at; texts
    of any length are read whole.
    """
    known = cut(item_shingles(items, size))
    small = known.count() <= BROADCAST_ROWS
    hint = F.broadcast if small else lambda x: x
    lengths = sorted(r.length for r in known.select("length").distinct().collect()) or [size]  # `size` numbers at most
    words = docs.select(F.col("doc_id"), F.xxhash64("doc_id", "text").alias("doc_key"), word_array(F.col("text")).alias("words"))
    runs = [shingle_hashes(F.col("words"), k) for k in lengths]
    each = words.select("doc_id", "doc_key", F.size("words").alias("n_words"), F.explode(F.concat(*runs) if len(runs) > 1 else runs[0]).alias("hash"))
    found = cut(each.join(hint(known.select("hash").distinct()), "hash", "left_semi").distinct())
    sketch = known.filter(F.col("rank") <= SKETCH).select("length", "hash", "item_id", "size_class")
    large_enough = F.col("n_words") - (F.col("length") - 1) >= least * F.pow(F.lit(2.0), F.col("size_class"))
    candidates = found.join(hint(sketch), "hash").filter(large_enough).select("doc_id", "doc_key", "item_id").distinct()
    wanted = candidates.join(hint(known.select("item_id", "hash", "n")), "item_id")
    shared = wanted.join(found.select("doc_key", "hash"), ["doc_key", "hash"], "left_semi")
    counted = shared.groupBy("doc_id", "doc_key", "item_id").agg(F.count("*").alias("n_shared"), F.first("n").alias("n_shingles"))
    return counted.withColumn("containment", F.col("n_shared") / F.col("n_shingles")).filter(F.col("n_shared") >= least * F.col("n_shingles"))


def without_contaminated(docs: DataFrame, items: DataFrame, size: int = 5, least: float = 0.8) -> DataFrame:
    """The rows of `docs` that hold no item; all columns, repeated rows and rows without an id stay as they are."""
    key = free_name(docs, "_doc_key")
    bad = contained(docs, items, size, least).select(F.col("doc_key").alias(key))
    return matching(docs.withColumn(key, F.xxhash64("doc_id", "text")), bad, "left_anti").select(docs.columns)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items that they hold.

    Items of any length are found, those under five words where their words stand side by side. Null and empty texts
    hold and are nothing; a document with several items has a row for each; equal rows count once. An empty table on either side gives no rows. Other columns are not looked at.
    """
    found = contained(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shared", "n_shingles", "containment")


OP5_SQL = r"""
WITH item_words AS (
  SELECT item_id, string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM benchmark
), doc_words AS (
  SELECT doc_id, string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM documents
), items AS (
  SELECT item_id, w, least(len(w), 5) AS length FROM item_words WHERE w[1] <> ''
), item_shingles AS (
  SELECT DISTINCT item_id, length, array_to_string(w[i : i + length - 1], ' ') AS shingle
  FROM (SELECT item_id, w, length, unnest(range(1, len(w) - length + 2)) AS i FROM items)
), doc_shingles AS (
  SELECT DISTINCT doc_id, length, array_to_string(w[i : i + length - 1], ' ') AS shingle
  FROM (SELECT doc_id, w, length, unnest(range(1, len(w) - length + 2)) AS i FROM doc_words CROSS JOIN (SELECT DISTINCT length FROM items))
), sizes AS (SELECT item_id, count(*) AS n_shingles FROM item_shingles GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_shingles) AS n_shingles, count(*) / any_value(n_shingles) AS containment
FROM doc_shingles JOIN item_shingles USING (length, shingle) JOIN sizes USING (item_id)
GROUP BY doc_id, item_id HAVING count(*) >= 0.8 * any_value(n_shingles)
"""
