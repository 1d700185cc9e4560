"""What several readers need is worked out and moved once."""

from pyspark.sql import functions as F

from wildtally.operators import events, summaries
from wildtally.plans import registry, rules

SMALL = "/root/testdata/sf0.001"


def test_detections_share_one_shuffle(spark):
    """Scores are made behind the window, so readers that need them move the same columns as those that don't."""
    plan = registry.A.classifications(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "round(" in plan and "round(" not in plan.split("l_extendedprice")[-1]
    assert "round(" not in plan[plan.rindex("Window [row_number()"):]


def test_overview_reads_flags_alone_and_photos_are_dealt_to_events_once(spark, monkeypatch):
    calls, assign = [], events.assign_events
    monkeypatch.setattr(events, "assign_events", lambda *a: calls.append(1) or assign(*a))
    monkeypatch.setattr(registry, "photo_table", None)
    assert registry.overview(spark, SMALL).count() == 1 and len(calls) == 1
    assert rules.graded_events(spark, SMALL).count() == 3 and len(calls) == 2


def test_totals_without_distinct_rows_of_a_label(spark):
    rows = [("a-e1", "a", "fox", "x", 2), ("a-e1", "a", "fox", "y", 3), ("a-e2", "a", "fox", "x", 1), ("b-e1", "b", "fox", "x", 4), ("b-e1", "b", "elk", "x", 1)]
    labels = spark.createDataFrame(rows, "event_id string, camera_id string, species string, lineage string, max_count long").withColumn("start", F.lit("2024-01-01").cast("timestamp_ntz"))
    totals = summaries.species_totals(labels)
    assert [tuple(r)[:4] for r in totals.collect()] == [("fox", 3, 2, 10), ("elk", 1, 1, 1)]
    assert "Expand" not in totals._jdf.queryExecution().optimizedPlan().toString()
