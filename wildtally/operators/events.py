"""Photos grouped into events by gaps in time, and labels reconciled within events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wildtally.functions.scalars import event_name, micros_between, seconds_between
from wildtally.functions.taxonomy import reconciled
from wildtally.operators import ranges
from wildtally.schemas import EVENT_SPECIES, EVENTS, conform
from wildtally.storage import cut

BY_TIME = ("timestamp", "rel_path")


def assign_events(photos: DataFrame, gap_s: float) -> DataFrame:
    """`photos` with event_id: `<camera>-e<number>`, null without a valid clock and a decoded image.

    A camera's photos are taken in time order (then path); a gap over `gap_s` starts an event, so gaps chain and a gap
    of exactly `gap_s` doesn't. A camera may lie in many ranges of time: begins are counted in each, and the ranges
    before add what they have.
    """
    eligible = F.coalesce(F.col("timestamp_valid") & F.col("decode_ok"), F.lit(False))
    ranged = ranges.dealt(photos.filter(eligible), "camera_id", BY_TIME)
    timed = ranges.with_previous(ranged, "camera_id", BY_TIME, "timestamp", "_before")
    gap = micros_between(F.col("_before"), F.col("timestamp")) / 1e6
    begun = timed.withColumn("_begins", F.when(gap.isNull() | (gap > gap_s), 1).otherwise(0))
    numbered = ranges.with_running_sum(begun, "camera_id", BY_TIME, "_begins", "_number")
    within = numbered.withColumn("event_id", event_name(F.col("camera_id"), F.col("_number"))).drop("_begins", "_before", "_number", ranges.RANGE)
    return within.unionByName(photos.filter(~eligible).withColumn("event_id", F.lit(None).cast("string")))


def resolve_labels(rows: DataFrame, most_animals: DataFrame) -> DataFrame:
    """Rows event_id, photo_id, species, lineage, ... with the labels of each event reconciled.

    The labels of an event are few (distinct taxa), so they are gathered into one array each; a name with two lineages
    keeps that of its last row by photo and lineage. Rows are read twice, so they are written: plans that need different
    columns share no shuffle, and would work the rows out twice.
    """
    rows = cut(rows)
    one = rows.groupBy("event_id", "species").agg(
        F.min(F.struct("photo_id", "lineage")).alias("first"), F.max_by("lineage", F.struct("photo_id", "lineage")).alias("lineage")
    )
    ranked = F.sort_array(F.collect_list(F.struct("first", "species", "lineage")))
    labels = F.transform(ranked, lambda x: F.struct(x["species"].alias("species"), x["lineage"].alias("lineage")))
    mixed = one.groupBy("event_id").agg(labels.alias("labels")).filter(F.size("labels") > 1).join(most_animals, "event_id")
    fold = mixed.select("event_id", reconciled(F.col("labels"), F.col("most") <= 1).alias("_fold"))
    told = rows.join(fold, "event_id", "left")
    to = F.get(F.filter("_fold", lambda m: m["species"] == F.col("species")), F.lit(0))
    told = told.withColumn("_to", to)
    return told.withColumns({
        "species": F.coalesce("_to.to_species", "species"), "lineage": F.when(F.col("_to.to_species").isNull(), F.col("lineage")).otherwise(F.col("_to.to_lineage")),
    }).drop("_fold", "_to")


def event_species(in_events: DataFrame, per_photo: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    """One row for each event and label: the most seen in one frame, never summed over frames.

    `whole` has event_id, camera_id, start and max_animals of each event, if they are known already.
    """
    rows = per_photo.join(in_events.select("photo_id", "event_id"), "photo_id")
    if whole is None:
        whole = in_events.groupBy("event_id").agg(F.max("n_animals").alias("max_animals"), F.min("camera_id").alias("camera_id"), F.min("timestamp").alias("start"))
    told = resolve_labels(rows, whole.select("event_id", F.col("max_animals").alias("most")))
    frames = told.groupBy("event_id", "photo_id", "species", "lineage").agg(F.sum("count").alias("count"), F.max("max_score").alias("max_score"))
    labels = frames.groupBy("event_id", "species", "lineage").agg(
        F.max("count").alias("max_count"), F.count("*").alias("n_photos"), F.max("max_score").alias("max_score")
    )
    return conform(labels.join(whole.select("event_id", "camera_id", "start"), "event_id"), EVENT_SPECIES)


def observation_type() -> F.Column:
    return F.when(F.col("n_animal_photos") > 0, "animal").when(F.col("has_person"), "person").when(F.col("has_vehicle"), "vehicle").otherwise("blank")


def events_of(photos: DataFrame) -> DataFrame:
    """One row for each event of photos with event_id, all but its labels."""
    in_events = photos.filter(F.col("event_id").isNotNull())
    # the best photo: most animals, then surest (missing last), then earliest
    best = F.struct((-F.col("n_animals")).alias("a"), F.col("max_animal_conf").isNull().alias("b"), (-F.col("max_animal_conf")).alias("c"), "timestamp", "rel_path")
    events = in_events.groupBy("event_id").agg(
        F.min("camera_id").alias("camera_id"), F.min("timestamp").alias("start"), F.max("timestamp").alias("end"),
        F.count("*").alias("n_photos"), F.count_if(F.col("n_animals") > 0).alias("n_animal_photos"), F.max("n_animals").alias("max_animals"),
        (F.max("n_people") > 0).alias("has_person"), (F.max("n_vehicles") > 0).alias("has_vehicle"), F.min_by("photo_id", best).alias("best_photo_id"),
    )
    return events.withColumns({"duration_s": seconds_between(F.col("start"), F.col("end")), "observation_type": observation_type()})


def with_primary(events: DataFrame, labels: DataFrame) -> DataFrame:
    """Events with their foremost label: most animals, then most photos, then surest (missing last)."""
    rank = F.struct((-F.col("max_count")).alias("a"), (-F.col("n_photos")).alias("b"), F.col("max_score").isNull().alias("c"), (-F.col("max_score")).alias("d"), "species")
    primary = labels.groupBy("event_id").agg(F.min_by(F.struct("species", "max_count"), rank).alias("p"))
    primary = primary.select("event_id", F.col("p.species").alias("species"), F.col("p.max_count").alias("species_count"))
    told = events.join(primary, "event_id", "left").withColumn("species_count", F.coalesce("species_count", F.lit(0)))
    return conform(told, EVENTS)


def build_events(photos: DataFrame, per_photo: DataFrame, gap_s: float, keep_labels: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Photos with event_id, events, event_species.

    Photos are read by all that follows, so they are written once; with `keep_labels` so is event_species, for those who
    use it beside the events.
    """
    photos = cut(assign_events(photos, gap_s))
    events = events_of(photos)
    labels = event_species(photos.filter(F.col("event_id").isNotNull()), per_photo, events)
    if keep_labels:
        labels = cut(labels)
    return photos, with_primary(events, labels), labels
