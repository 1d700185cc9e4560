"""Other inputs and outputs: sidecar CSV, survey JSON, ground truth, record stores, published tables."""

from __future__ import annotations

import csv
import io
import itertools
import json
import os
import tempfile
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wildtally.errors import InputError
from wildtally.functions.scalars import cleaned
from wildtally.operators.incremental import last_of_each
from wildtally.sources.pieces import json_elements
from wildtally.storage import Files

SIDECAR = "metadata.csv"


def load_sidecar(spark: SparkSession, path: str) -> DataFrame:
    """rel_path, side_camera, side_timestamp; all text, of rows for one file the last. Without a file column: InputError."""
    rows = spark.read.option("header", True).option("inferSchema", False).option("nullValue", "\0").option("emptyValue", "").csv(path)
    names = {c.strip(): c for c in rows.columns}
    if "file" not in names:
        raise InputError("the sidecar has no column named file")
    text = lambda c: cleaned(F.col(f"`{names[c]}`")) if c in names else F.lit(None).cast("string")
    file = F.regexp_replace(F.regexp_replace(F.replace(text("file"), F.lit("\\"), F.lit("/")), r"/(\./)*", "/"), r"^(\./)+", "")
    told = rows.select(file.alias("rel_path"), text("camera_id").alias("side_camera"), text("timestamp").alias("side_timestamp"), F.monotonically_increasing_id().alias("_row"))
    return last_of_each(told, "rel_path", "_row").drop("_row")


#: Fields that name the camera and the time, the first that is set counts (fixed values).
CAMERA_FIELDS, TIME_FIELDS = ("location", "camera", "site"), ("datetime", "date_captured")


def parse_metadata(spark: SparkSession, path: str) -> DataFrame:
    """file_name, camera_id, timestamp, seq_id of camera-trap JSON, plain or in a zip; images without file or camera go.

    The document is read by pieces, so its size doesn't matter.
    """
    pieces = json_elements(spark, path)
    if problem := pieces.filter("error IS NOT NULL").head(1):
        raise InputError(f"metadata is not camera-trap JSON: {problem[0].error}")
    fields = ("file_name", *CAMERA_FIELDS, *TIME_FIELDS, "seq_id")
    image = pieces.filter("member = 'images'").select(F.from_json("value", ", ".join(f"{f} string" for f in fields)).alias("i")).select("i.*")
    first = lambda names: F.coalesce(*[F.nullif(F.col(n), F.lit("")) for n in names])
    told = image.select("file_name", first(CAMERA_FIELDS).alias("camera_id"), first(TIME_FIELDS).alias("timestamp"), F.nullif("seq_id", F.lit("")).alias("seq_id"))
    return told.filter(F.coalesce(F.col("file_name"), F.lit("")) != "").filter(F.col("camera_id").isNotNull())


#: What a ground truth holds of each image (by path), visit and camera.
TRUTH = {
    "images": "camera_id string, time string, camera_clock string, visit_id bigint, kind string, night boolean, blurred boolean, truncated boolean, "
    "objects array<struct<category:string,species:string,lineage:string,bbox:array<double>>>",
    "visits": "visit_id bigint, camera_id string, kind string, start string, species string, count bigint, n_photos bigint, valid_clock boolean",
    "cameras": "camera_id string, habitat map<string,double>, outage_days array<int>, unset_clock_days int, fog_day int",
}


def load_ground_truth(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Tables images, visits, cameras of a ground-truth JSON, which is read by pieces."""
    pieces = json_elements(spark, path)
    if problem := pieces.filter("error IS NOT NULL").head(1):
        raise InputError(f"the ground truth is not JSON: {problem[0].error}")
    parsed = {name: pieces.filter(F.col("member") == name).select(F.col("key").alias("rel_path"), F.from_json("value", schema).alias("x")).select("rel_path", "x.*") for name, schema in TRUTH.items()}
    return {name: rows if name == "images" else rows.drop("rel_path") for name, rows in parsed.items()}


class RecordStore:
    """Records of items done, appended as Parquet; of a key the newest attempt counts. Torn files of a crash aren't listed."""

    def __init__(self, spark: SparkSession, path: str, key: str, schema) -> None:  # noqa: ANN001
        self.spark, self.path, self.key, self.schema = spark, path, key, schema

    def _attempts(self) -> list[str]:
        files = Files(self.spark)
        return [n for n in files.names(self.path) if files.exists(f"{self.path}/{n}/_SUCCESS")]

    def history(self) -> DataFrame:
        """All records with _attempt, the number of the attempt that made them."""
        attempts = self._attempts()
        if not attempts:
            return self.spark.createDataFrame([], self.schema).withColumn("_attempt", F.lit(None).cast("long"))
        rows = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*[f"{self.path}/{n}" for n in attempts])
        return rows.withColumn("_attempt", F.regexp_extract(F.input_file_name(), r"/attempt=(\d+)/", 1).cast("long"))

    def read(self) -> DataFrame:
        return last_of_each(self.history(), self.key, "_attempt").select(*self.schema.names)

    def append(self, records: DataFrame) -> None:
        self.put(records, 1 + max((int(n.partition("=")[2]) for n in self._attempts()), default=0))

    def put(self, records: DataFrame, number: int) -> None:
        """The records as attempt `number`, in place of what a broken attempt of that number left."""
        records.write.mode("overwrite").parquet(f"{self.path}/attempt={number:06d}")


def json_lines(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """_row, x (the record, null if it is malformed, no object or without a key) of each line that isn't blank."""
    rows = spark.read.text(path).withColumn("_row", F.monotonically_increasing_id()).filter(F.trim("value") != "")
    told = rows.select("_row", F.from_json("value", schema).alias("x"))
    return told.withColumn("x", F.when(F.col(f"x.{key}").isNotNull(), F.col("x")))


def read_json_records(spark: SparkSession, path: str, key: str, schema: str) -> DataFrame:
    """Records of a JSON-lines file: malformed and keyless lines are dropped, of a key the last line counts."""
    told = json_lines(spark, path, key, schema).filter("x IS NOT NULL").select("x.*", "_row")
    return last_of_each(told, key, "_row").drop("_row")


def mended_json_records(spark: SparkSession, path: str, key: str, schema: str) -> int:
    """How many lines of the file are no record; if any, the file is written anew without them, as a crash may have torn the last."""
    Files(spark).recover(path)
    lines = json_lines(spark, path, key, schema)
    torn = lines.filter("x IS NULL").count()
    if torn:
        files, staging = Files(spark), f"{path}.mended"
        lines.filter("x IS NOT NULL").orderBy("_row").select(F.to_json("x").alias("value")).coalesce(1).write.mode("overwrite").text(staging)
        part = next(n for n in files.names(staging) if n.startswith("part-"))
        files.put(f"{staging}/{part}", path)
        files.delete(staging)
    return torn


def atomic_write_bytes(path: Path, data: bytes) -> None:
    """Written beside and moved into place, so a reader sees all or nothing."""
    path.parent.mkdir(parents=True, exist_ok=True)
    handle, name = tempfile.mkstemp(dir=path.parent, prefix=f".{path.name}.")
    try:
        with os.fdopen(handle, "wb") as file:
            file.write(data)
            file.flush()
            os.fsync(file.fileno())
        os.replace(name, path)
    except BaseException:
        Path(name).unlink(missing_ok=True)
        raise


def atomic_write_text(path: Path, text: str) -> None:
    atomic_write_bytes(path, text.encode())


def atomic_write_json(path: Path, value: object) -> None:
    atomic_write_text(path, json.dumps(value, indent=2, default=str) + "\n")


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Written as Parquet beside and moved into place; returns the table as read back. See Files for what a crash leaves."""
    spark = df.sparkSession
    files = Files(spark)
    df.write.mode("overwrite").parquet(f"{path}.new")
    files.recover(path)
    files.put(f"{path}.new", path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A table of write_table(), also if a crash left it aside."""
    Files(spark).recover(path)
    return spark.read.parquet(path)


def csv_text(df: DataFrame) -> Iterator[str]:
    """Lines of a small ordered table; null is empty, whole seconds are written without a fraction."""
    line = io.StringIO()
    writer = csv.writer(line, lineterminator="\n")
    for row in itertools.chain([df.columns], df.toLocalIterator()):
        writer.writerow(["" if v is None else str(v) for v in row])
        yield line.getvalue()
        line.seek(0)
        line.truncate()


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file; rows come to the driver a partition at a time and go on at once."""
    Files(df.sparkSession).write(path, csv_text(df))


def publish(spark: SparkSession, run: str, out: str) -> list[str]:
    """Copies the report, the charts and the summary CSVs of a run, and writes its events as one; returns the files."""
    files = Files(spark)
    inside = lambda folder, kind: [f"{folder}/{n}" for n in files.names(f"{run}/{folder}") if n.endswith(kind)]
    names = ["report.html", *inside("plots", ".svg"), *inside("summary", ".csv")]
    for name in names:
        files.write(f"{out}/{name}", [files.text(f"{run}/{name}")])
    write_csv(read_table(spark, f"{run}/events.parquet").orderBy("camera_id", "start", "event_id"), f"{out}/summary/events.csv")
    return [f"{out}/{n}" for n in (*names, "summary/events.csv")]
