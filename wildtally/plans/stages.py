"""The stages from a photo folder to labelled boxes."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wildtally.functions import pixels, scalars, taxonomy
from wildtally.operators import incremental, models, photos
from wildtally.operators.quality import add_flags
from wildtally.schemas import CLASSIFICATIONS, DETECTION_RECORDS, DETECTIONS, LABEL_RECORDS, MEDIA, METRICS, QUALITY, RUNS, conform
from wildtally.settings import Settings
from wildtally.sources import images
from wildtally.sources.tables import SIDECAR, RecordStore, load_sidecar
from wildtally.storage import cut


def ingest(spark: SparkSession, root: str, valid_from: str = "2001-01-01", now: datetime | None = None) -> DataFrame:
    """The media table of a folder: camera and clock by the first source that has them, with that source's name."""
    headers = images.read_headers(images.image_paths(spark, root), root)
    try:
        side = load_sidecar(spark, f"{root}/{SIDECAR}")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        side = spark.createDataFrame([], "rel_path string, side_camera string, side_timestamp string")
    return media_frame(headers.join(side, "rel_path", "left"), valid_from, now)


def media_frame(rows: DataFrame, valid_from: str, now: datetime | None = None) -> DataFrame:
    clean = {c: scalars.cleaned(F.col(c)) for c in ("original", "date_time", "exif_make", "exif_model", "exif_serial")}
    rows = rows.withColumns(clean)
    parts = F.split("rel_path", "/")
    folder = F.when(F.size(parts) > 1, F.get(parts, F.lit(0)))
    make_model = F.nullif(F.concat_ws(" ", "exif_make", "exif_model"), F.lit(""))
    cameras = (("sidecar", F.col("side_camera")), ("folder", folder), ("exif", F.col("exif_serial")), ("exif", make_model), ("unknown", F.lit("unknown")))
    times = (("sidecar", "side_timestamp"), ("exif", "original"), ("exif_datetime", "date_time"))
    rows = rows.withColumn("_stamps", scalars.parse_timestamps(F.array(*[F.col(c) for _, c in times])))
    stamps = [(name, F.get("_stamps", F.lit(k))) for k, (name, _) in enumerate(times)]
    source = lambda options: F.coalesce(*[F.when(c.isNotNull(), F.lit(name)) for name, c in options])
    latest = F.lit(now).cast("timestamp_ntz") if now else F.localtimestamp()
    stamp = F.col("timestamp")
    valid = F.coalesce((stamp > F.lit(valid_from).cast("timestamp_ntz")) & (stamp <= latest + F.expr("interval 1 day")), F.lit(False))
    told = rows.withColumns({
        "photo_id": pixels.photo_id_for("rel_path"), "camera_id": F.coalesce(*[c for _, c in cameras]), "camera_source": source(cameras),
        "timestamp": F.coalesce(*[c for _, c in stamps]), "timestamp_source": F.coalesce(source(stamps), F.lit("none")),
    }).withColumn("timestamp_valid", valid)
    return conform(told, MEDIA).orderBy("camera_id", F.asc_nulls_last("timestamp"), "rel_path")


def quality_table(media: DataFrame, metrics: DataFrame, settings: Settings) -> DataFrame:
    """Media with measured metrics (one row a photo) into the quality table."""
    joined = media.select("photo_id", "camera_id", "timestamp", "rel_path", "readable").join(metrics, "photo_id", "left")
    ok = F.col("readable") & F.col("error").isNull() & F.col("dhash").isNotNull()
    error = F.when(F.col("readable"), F.col("error")).otherwise("unreadable")
    return conform(add_flags(joined.withColumns({"decode_ok": F.coalesce(ok, F.lit(False)), "quality_error": error}), settings), QUALITY)


def run_quality(spark: SparkSession, media: DataFrame, root: str, store: RecordStore, settings: Settings, batch: int = 10_000) -> DataFrame:
    """Measures readable photos without a good record, and only those, then flags all.

    Photos are dealt to rounds of about `batch` by a hash; the driver holds the paths of one round, and what a round
    measured is kept before the next begins.
    """
    todo = incremental.still_to_do(media.filter("readable"), store.read(), "photo_id").select("photo_id", "rel_path")
    rounds = -(-todo.count() // batch)
    if rounds:
        todo = cut(todo)
    place = F.pmod(F.xxhash64("photo_id"), F.lit(max(1, rounds)))
    for k in range(rounds):
        ids = {r.rel_path: r.photo_id for r in todo.filter(place == k).collect()}
        if ids:
            figures = images.measured_images(spark, root, list(ids), lambda rgb: pixels.measure(rgb, settings), pixels.METRICS)
            store.append(conform(figures.withColumn("photo_id", pixels.photo_id_for("rel_path")), METRICS))
    return quality_table(media, store.read(), settings)


def boxes_table(records: DataFrame) -> DataFrame:
    """A row for each cleaned box of good records, numbered by falling confidence."""
    boxes = records.filter("error IS NULL").select("photo_id", "model", F.posexplode(scalars.clean_boxes(F.col("boxes"))).alias("box_idx", "b"))
    return conform(boxes.select("photo_id", "box_idx", "b.category", "b.conf", *[F.get("b.bbox", F.lit(k)).alias(c) for k, c in enumerate("xywh")], "model"), DETECTIONS)


def runs_table(records: DataFrame) -> DataFrame:
    return conform(records.withColumn("n_boxes", F.coalesce(F.size("boxes"), F.lit(0))), RUNS)


def run_detect(media: DataFrame, quality: DataFrame, root: str, factory: Callable[[], models.Detector] | None, store: RecordStore, batch: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """Boxes and runs of all decoded photos; only those without a good record go through the detector.

    Photos are dealt to rounds of about `batch` by a hash, each kept before the next begins, so a crash loses one round.
    """
    decoded = media.join(quality.filter("decode_ok").select("photo_id"), "photo_id", "left_semi")
    todo = incremental.still_to_do(decoded, store.read(), "photo_id")
    rounds = -(-todo.count() // batch) if factory else 0
    place = F.pmod(F.xxhash64("photo_id"), F.lit(max(1, rounds)))
    for k in range(rounds):
        store.append(conform(models.detect(todo.filter(place == k), root, factory), DETECTION_RECORDS))
    records = store.read().join(decoded.select("photo_id"), "photo_id", "left_semi")
    return boxes_table(records), runs_table(records)


def classifications_table(selected: DataFrame, records: DataFrame, threshold: float) -> DataFrame:
    """One labelled row for each selected box; a box without a good record is unresolved."""
    joined = selected.select("photo_id", "box_idx", "box_key").join(records.drop("photo_id"), "box_key", "left")
    empty = lambda c, kind: F.coalesce(F.when(F.col("error").isNull(), F.col(c)), F.array().cast(kind))
    labels = taxonomy.scored_labels(empty("classes", "array<string>"), empty("scores", "array<double>"))
    scored = joined.withColumn("_labels", labels)
    called = scored.withColumn("_call", taxonomy.roll_up(F.col("_labels"), threshold))
    top = F.get("_labels", F.lit(0))
    pair = lambda x: F.concat(F.lit("["), F.to_json(F.array(x["name"])).substr(F.lit(2), F.length(F.to_json(F.array(x["name"]))) - 2), F.lit(", "), scalars.written(scalars.rounded_exactly(x["score"], 4), 4), F.lit("]"))
    told = called.withColumns({
        "species": F.col("_call.species"), "species_score": scalars.rounded_exactly(F.col("_call.score"), 4), "species_level": F.col("_call.level"), "lineage": F.col("_call.lineage"),
        "top1_label": top["name"], "top1_score": scalars.rounded_exactly(top["score"], 4), "top5_json": F.concat(F.lit("["), F.array_join(F.transform("_labels", pair), ", "), F.lit("]")),
    })
    return conform(told, CLASSIFICATIONS)


def run_classify(boxes: DataFrame, media: DataFrame, root: str, factory: Callable[[], models.Classifier] | None, store: RecordStore, settings: Settings) -> DataFrame:
    """Labels of selected boxes; keys hold the coordinates, so boxes that come out the same again keep their labels."""
    selected = photos.select_boxes(boxes, settings.count_conf, settings.boxes_per_photo)
    todo = incremental.still_to_do(selected, store.read(), "box_key")
    if factory and not todo.isEmpty():
        grouped = photos.photos_with_boxes(todo).join(media.select("photo_id", "rel_path"), "photo_id")
        store.append(conform(models.classify(grouped, root, factory), LABEL_RECORDS))
    return classifications_table(selected, store.read(), settings.species_threshold)
