"""Columns and types of the tables between stages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, LongType, StringType, StructField, StructType, TimestampNTZType

_TYPES = {"string": StringType(), "boolean": BooleanType(), "double": DoubleType(), "long": LongType(), "timestamp_ntz": TimestampNTZType()}
_TYPES |= {f"{k}s": ArrayType(v) for k, v in _TYPES.items()}
_TYPES["boxes"] = ArrayType(StructType([StructField("category", StringType()), StructField("conf", DoubleType()), StructField("bbox", ArrayType(DoubleType()))]))


def _schema(columns: str) -> StructType:
    """`name type, ...`; a plural type is an array."""
    return StructType([StructField(name, _TYPES[kind]) for name, kind in (c.split() for c in columns.split(", "))])


MEDIA = _schema(
    "photo_id string, rel_path string, camera_id string, camera_source string, timestamp timestamp_ntz, timestamp_source string, "
    "timestamp_valid boolean, width long, height long, file_bytes long, exif_make string, exif_model string, readable boolean, error string"
)
METRICS = _schema("photo_id string, sharpness double, brightness double, contrast double, ir_score double, dhash string, error string")
QUALITY = _schema(
    "photo_id string, decode_ok boolean, quality_error string, sharpness double, sharpness_rel double, brightness double, contrast double, "
    "ir_score double, dhash string, is_ir boolean, is_dark boolean, is_overexposed boolean, is_blurry boolean, dup_group string, is_near_duplicate boolean"
)
DETECTIONS = _schema("photo_id string, box_idx long, category string, conf double, x double, y double, w double, h double, model string")
RUNS = _schema("photo_id string, model string, n_boxes long, error string")
DETECTION_RECORDS = _schema(
    "photo_id string, model string, boxes boxes, error string"
)
LABEL_RECORDS = _schema("box_key string, photo_id string, model string, classes strings, scores doubles, error string")
CLASSIFICATIONS = _schema(
    "photo_id string, box_idx long, box_key string, species string, species_score double, species_level string, lineage string, "
    "top1_label string, top1_score double, top5_json string, model string, error string"
)
PHOTO_SPECIES = _schema("photo_id string, species string, lineage string, count long, max_score double")
EVENTS = _schema(
    "event_id string, camera_id string, start timestamp_ntz, end timestamp_ntz, duration_s double, n_photos long, n_animal_photos long, "
    "max_animals long, has_person boolean, has_vehicle boolean, observation_type string, species string, species_count long, best_photo_id string"
)
EVENT_SPECIES = _schema(
    "event_id string, camera_id string, start timestamp_ntz, species string, lineage string, max_count long, n_photos long, max_score double"
)
#: Photos have the columns of media and quality, and these.
PHOTO_EXTRAS = _schema(
    "n_animals long, n_people long, n_vehicles long, max_animal_conf double, detected boolean, detect_error string, species string"
)


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of the schema in its order, cast; a column that is missing is null."""

    def column(f) -> Column:  # noqa: ANN001
        return (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)

    return df.select(*map(column, schema.fields))
