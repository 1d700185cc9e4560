"""Quality flags and near-duplicate groups of measured photos."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wildtally.functions.scalars import hamming, micros_between, rounded
from wildtally.operators import ranges
from wildtally.settings import Settings
from wildtally.storage import cut


def with_parents(frame: DataFrame, max_bits: int, window: int, max_gap_s: float) -> DataFrame:
    """`frame` with parent: the closest earlier photo of the camera, at most `window` back and `max_gap_s` before, whose
    hash differs by at most `max_bits`; null if there is none. Photos without a hash or a time have none and are none.

    A camera may lie in many ranges of time; the first photos of a range look back at the last ones of those before.
    """
    usable = F.col("dhash").isNotNull() & F.col("timestamp").isNotNull()
    order = ("timestamp", "rel_path")
    ranged = ranges.dealt(frame.filter(usable), "camera_id", order)
    seen = ranges.with_look_back(ranged, "camera_id", order, F.struct("photo_id", "timestamp", "dhash"), window, "_")

    def match(k: int) -> F.Column:
        e = F.col(f"_{k}")
        near = micros_between(e["timestamp"], F.col("timestamp")) <= max_gap_s * 1e6
        return F.when(near & (hamming(F.col("dhash"), e["dhash"]) <= max_bits), e["photo_id"])

    told = seen.withColumn("parent", F.coalesce(*map(match, range(1, window + 1)))).drop(*[f"_{k}" for k in range(1, window + 1)], ranges.RANGE)
    return told.unionByName(frame.filter(~usable).withColumn("parent", F.lit(None).cast(frame.schema["photo_id"].dataType)))


def near_duplicate_parents(frame: DataFrame, max_bits: int, window: int, max_gap_s: float) -> DataFrame:
    """photo_id, parent of the photos with a hash and a time."""
    hashed = frame.filter(F.col("dhash").isNotNull() & F.col("timestamp").isNotNull())
    return with_parents(hashed.select("photo_id", "camera_id", "timestamp", "rel_path", "dhash"), max_bits, window, max_gap_s).select("photo_id", "parent")


def roots_of(parents: DataFrame) -> DataFrame:
    """photo_id, root of the photos that have a parent: where its chain ends. Each round doubles how far they point."""
    points = cut(parents.filter("parent IS NOT NULL"))
    while True:
        on = points.select(F.col("photo_id").alias("parent"), F.col("parent").alias("further"))
        moved = points.join(on, "parent", "left").select("photo_id", F.coalesce("further", "parent").alias("parent"), F.col("further").isNotNull().alias("moved"))
        moved = cut(moved)
        points = moved.drop("moved")
        if moved.filter("moved").isEmpty():
            return points.withColumnRenamed("parent", "root")


def near_duplicate_groups(frame: DataFrame, max_bits: int = 6, window: int = 8, max_gap_s: float = 300.0) -> DataFrame:
    """`frame` with dup_group: the photo that its chain of near-duplicates begins with, itself if it has none."""
    roots = roots_of(near_duplicate_parents(frame, max_bits, window, max_gap_s))
    return frame.join(roots, "photo_id", "left").withColumn("dup_group", F.coalesce("root", "photo_id")).drop("root")


def photo_flags(frame: DataFrame, settings: Settings | None = None) -> DataFrame:
    """`frame` with is_ir, is_dark, is_overexposed, sharpness_rel, is_blurry, parent, is_near_duplicate.

    Sharpness is judged against the exact median of the camera's decoded photos of the same kind (infrared or not),
    and rounded before it is compared. A photo with a parent is a near-duplicate; that takes no chain to be followed.
    """
    s = settings or Settings()
    ok = F.col("decode_ok")
    flag = lambda test: F.coalesce(ok & test, F.lit(False))
    flagged = frame.withColumns({
        "is_ir": flag(F.col("ir_score") < s.infrared_below), "is_dark": flag(F.col("brightness") < s.dark_below),
        "is_overexposed": flag(F.col("brightness") > s.bright_above),
    })
    medians = ranges.medians(flagged.filter(ok), ["camera_id", "is_ir"], "sharpness", "_median")
    rel = rounded(F.col("sharpness") / F.when(F.col("_median") > 0, F.col("_median")), 4)
    judged = flagged.join(medians, ["camera_id", "is_ir"], "left").withColumn("sharpness_rel", F.when(ok, rel)).drop("_median")
    judged = judged.withColumn("is_blurry", flag(F.col("sharpness_rel") < s.blurred_below))
    tied = with_parents(judged, s.alike_bits, s.look_back, s.look_back_s)
    return tied.withColumn("is_near_duplicate", flag(F.col("parent").isNotNull()))


def add_flags(frame: DataFrame, settings: Settings | None = None) -> DataFrame:
    """photo_flags() with dup_group, the photo that a chain of near-duplicates begins with, in place of parent."""
    flagged = photo_flags(frame, settings)
    roots = roots_of(flagged.select("photo_id", "parent"))
    return flagged.join(roots, "photo_id", "left").withColumn("dup_group", F.coalesce("root", "photo_id")).drop("root", "parent")
