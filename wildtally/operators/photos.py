"""Photos joined with what is known of their boxes and labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wildtally.functions.scalars import box_key
from wildtally.functions.taxonomy import UNRESOLVED
from wildtally.schemas import PHOTO_SPECIES, conform

FLAGS = ("decode_ok", "is_ir", "is_dark", "is_overexposed", "is_blurry", "is_near_duplicate")


def counted(boxes: DataFrame, count_conf: float) -> DataFrame:
    """Boxes sure enough to count (the limit included)."""
    return boxes.filter(F.col("conf") >= count_conf)


def box_counts(boxes: DataFrame, count_conf: float) -> DataFrame:
    """photo_id, n_animals, n_people, n_vehicles, max_animal_conf; other categories don't count."""
    of = lambda kind: F.count_if(F.col("category") == kind)
    return counted(boxes, count_conf).groupBy("photo_id").agg(
        of("animal").alias("n_animals"), of("person").alias("n_people"), of("vehicle").alias("n_vehicles"),
        F.max(F.when(F.col("category") == "animal", F.col("conf"))).alias("max_animal_conf"),
    )


def false_if_missing(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(False)).alias(column)


def build_photo_table(media: DataFrame, quality: DataFrame, boxes: DataFrame, runs: DataFrame, classifications: DataFrame, count_conf: float) -> DataFrame:
    """One row for each photo: media and quality columns, box counts, detection state and the label of its first box."""
    ran = runs.groupBy("photo_id").agg(F.bool_or(F.col("error").isNull()).alias("detected"), F.max("error").alias("detect_error"))
    top = classifications.groupBy("photo_id").agg(F.min_by("species", "box_idx").alias("species"))
    joined = media.join(quality, "photo_id", "left").join(box_counts(boxes, count_conf), "photo_id", "left").join(ran, "photo_id", "left").join(top, "photo_id", "left")
    changed: dict[str, Column] = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("n_animals", "n_people", "n_vehicles")}
    changed |= {c: false_if_missing(c) for c in (*FLAGS, "detected") if c in joined.columns}
    return joined.withColumns(changed)


def photo_species(boxes: DataFrame, classifications: DataFrame, count_conf: float) -> DataFrame:
    """photo_id, species, lineage, count, max_score over counted animal boxes; unlabelled ones count as unresolved."""
    animals = counted(boxes, count_conf).filter(F.col("category") == "animal").select("photo_id", "box_idx")
    labels = classifications.select("photo_id", "box_idx", "species", "lineage", "species_score")
    known = F.col("species").isNotNull()
    rows = animals.join(labels, ["photo_id", "box_idx"], "left").select(
        "photo_id", F.when(known, F.col("species")).otherwise(UNRESOLVED).alias("species"),
        F.when(known, F.col("lineage")).otherwise("").alias("lineage"), "species_score",
    )
    grouped = rows.groupBy("photo_id", "species", "lineage").agg(F.count("*").alias("count"), F.max("species_score").alias("max_score"))
    return conform(grouped, PHOTO_SPECIES)


def select_boxes(boxes: DataFrame, count_conf: float, per_photo: int) -> DataFrame:
    """Counted animal boxes with a box_key, the surest `per_photo` of each photo (ties by box_idx)."""
    surest = W.partitionBy("photo_id").orderBy(F.desc("conf"), "box_idx")
    animals = counted(boxes, count_conf).filter(F.col("category") == "animal")
    kept = animals.withColumn("_n", F.row_number().over(surest)).filter(F.col("_n") <= per_photo).drop("_n")
    return kept.withColumn("box_key", box_key(*map(F.col, ("photo_id", "x", "y", "w", "h"))))


def photos_with_boxes(selected: DataFrame) -> DataFrame:
    """photo_id, boxes: array<struct<box_idx, box_key, x, y, w, h>> in their order, so that an image is opened once."""
    box = F.struct("box_idx", "box_key", "x", "y", "w", "h")
    return selected.groupBy("photo_id").agg(F.sort_array(F.collect_list(box)).alias("boxes"))
