"""Summary tables made from published events, line by line; WILDTALLY_PUBLISHED names the folder of the CSV files."""

import os

import pytest
from pyspark.sql import functions as F

from wildtally.operators import summaries
from wildtally.sources.tables import write_csv

FOLDER = os.environ.get("WILDTALLY_PUBLISHED", "")
TYPES = {
    "events": "event_id string, camera_id string, start timestamp_ntz, end timestamp_ntz, duration_s double, n_photos long, n_animal_photos long, max_animals long, has_person boolean, has_vehicle boolean, observation_type string, species string, species_count long, best_photo_id string",
    "camera_gaps": "camera_id string, gap_start timestamp_ntz, gap_end timestamp_ntz, gap_hours double",
}

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no folder of published tables is named")


def lines(name):
    with open(f"{FOLDER}/{name}.csv", encoding="utf-8", newline="") as file:
        return file.read().split("\n")


def written(df, path):
    write_csv(df, f"file://{path}")
    return path.read_bytes().decode().split("\n")


@pytest.fixture()
def events(spark):
    return spark.read.schema(TYPES["events"]).option("header", True).csv(f"file://{FOLDER}/events.csv")


@pytest.fixture()
def labels(events):
    """One label an event, as these tables have."""
    return events.filter("observation_type = 'animal'").withColumn("max_count", F.col("species_count"))


def test_events_are_written_as_they_were_read(events, tmp_path):
    assert written(events.orderBy("camera_id", "start", "event_id"), tmp_path / "e.csv") == lines("events")


def test_totals_and_hours(labels, tmp_path):
    assert written(summaries.species_totals(labels), tmp_path / "t.csv") == lines("species_totals")
    assert written(summaries.activity_by_hour(labels), tmp_path / "h.csv") == lines("activity_by_hour")


def test_labels_by_camera(spark, labels, tmp_path):
    health = spark.read.option("header", True).option("inferSchema", True).csv(f"file://{FOLDER}/camera_health.csv")
    assert written(summaries.species_by_camera(labels, health), tmp_path / "c.csv") == lines("species_by_camera")


def test_silences_and_counts_of_events(spark, events, tmp_path):
    gaps = spark.read.schema(TYPES["camera_gaps"]).option("header", True).csv(f"file://{FOLDER}/camera_gaps.csv")
    ends = gaps.select("camera_id", F.explode(F.array("gap_start", "gap_end")).alias("timestamp"), F.lit(True).alias("timestamp_valid"))
    assert written(summaries.camera_gaps(ends, 72.0), tmp_path / "g.csv") == lines("camera_gaps")
    rows = {r.split(",")[0]: r.split(",") for r in lines("camera_health")[1:] if r}
    head = lines("camera_health")[0].split(",")
    found = events.groupBy("camera_id").agg(F.count("*").alias("n_events"), F.count_if(F.col("observation_type") == "animal").alias("n_animal_events")).collect()
    assert {r.camera_id: (str(r.n_events), str(r.n_animal_events)) for r in found} == {c: (v[head.index("n_events")], v[head.index("n_animal_events")]) for c, v in rows.items()}
