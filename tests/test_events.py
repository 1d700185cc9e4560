from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wildtally.operators import events, photos, quality, summaries
from wildtally.schemas import CLASSIFICATIONS, DETECTIONS, RUNS
from wildtally.settings import Settings

T0 = datetime(2026, 4, 6, 6)
PHOTO = "photo_id string, camera_id string, rel_path string, timestamp timestamp_ntz, timestamp_valid boolean, decode_ok boolean"


def shots(spark, rows):
    """rows: photo, camera, seconds, valid, decoded."""
    return spark.createDataFrame([(p, c, p, None if s is None else T0 + timedelta(seconds=s), v, d) for p, c, s, v, d in rows], PHOTO)


def ids(df):
    return {r.photo_id: r.event_id for r in df.select("photo_id", "event_id").collect()}


def test_gap_of_exactly_the_limit_joins(spark):
    rows = [("a", "c", 0, True, True), ("b", "c", 60, True, True), ("d", "c", 120, True, True), ("e", "c", 181, True, True), ("f", "k", 60, True, True)]
    found = ids(events.assign_events(shots(spark, reversed(rows)), 60))
    assert found == {"a": "c-e00001", "b": "c-e00001", "d": "c-e00001", "e": "c-e00002", "f": "k-e00001"}


def test_photos_left_out(spark):
    rows = [("a", "c", 0, False, True), ("b", "c", 1, True, False), ("d", "c", 2, True, True), ("e", "c", None, None, True)]
    assert ids(events.assign_events(shots(spark, rows), 60)) == {"a": None, "b": None, "d": "c-e00001", "e": None}
    assert ids(events.assign_events(shots(spark, []), 60)) == {}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.integers(0, 600), min_size=1, max_size=25), st.integers(1, 120))
def test_sessions_split_exactly_at_long_gaps(spark, seconds, gap):
    rows = [(f"p{k:03d}", "c", s, True, True) for k, s in enumerate(seconds)]
    found = ids(events.assign_events(shots(spark, rows), gap))
    order = sorted(rows, key=lambda r: (r[2], r[0]))
    for a, b in zip(order, order[1:], strict=False):
        assert (found[a[0]] == found[b[0]]) == (b[2] - a[2] <= gap)


def build(spark, frames, gap=60):
    """frames: photo, seconds, [(category, conf, species, lineage, score)]."""
    media = shots(spark, [(p, "c", s, True, True) for p, s, _ in frames]).drop("decode_ok")
    flags = ("is_ir", "is_dark", "is_overexposed", "is_blurry", "is_near_duplicate")
    q = spark.createDataFrame([(p, True) for p, _, _ in frames], "photo_id string, decode_ok boolean").withColumns({c: F.lit(False) for c in flags})
    boxes = [(p, k, b[0], b[1], 0.1, 0.1, 0.2, 0.2, "m") for p, _, bs in frames for k, b in enumerate(bs)]
    labels = [(p, k, f"{p}{k}", b[2], b[4], "x", b[3], None, None, None, None, None) for p, _, bs in frames for k, b in enumerate(bs) if b[2]]
    box_df, label_df = spark.createDataFrame(boxes, DETECTIONS), spark.createDataFrame(labels, CLASSIFICATIONS)
    runs = spark.createDataFrame([(p, "m", len(b), None) for p, _, b in frames], RUNS)
    whole = photos.build_photo_table(media, q, box_df, runs, label_df, 0.2)
    told, found, species = events.build_events(whole, photos.photo_species(box_df, label_df, 0.2), gap)
    return told, found, species


def animal(species, lineage, conf=0.9, score=0.8):
    return ("animal", conf, species, lineage, score)


def test_most_in_one_frame_counts(spark):
    deer = animal("deer", "m;c;f;g;d")
    told, found, species = build(spark, [("a", 0, [deer]), ("b", 1, [deer, deer]), ("c", 2, [deer, ("animal", 0.1, None, None, None)])])
    e = found.first()
    assert (e.n_photos, e.max_animals, e.species, e.species_count, e.best_photo_id, e.duration_s, e.observation_type) == (3, 2, "deer", 2, "b", 2.0, "animal")
    assert [(r.species, r.max_count, r.n_photos) for r in species.collect()] == [("deer", 2, 3)]
    assert {r.photo_id: r.n_animals for r in told.collect()} == {"a": 1, "b": 2, "c": 1}


def test_vague_labels_fold_and_two_species_stay(spark):
    _, _, species = build(spark, [("a", 0, [animal("deer", "m;c;f;g;d"), ("animal", 0.5, None, None, None)]), ("b", 1, [animal("f (family)", "m;c;f")])])
    assert [(r.species, r.max_count) for r in species.collect()] == [("deer", 2)]
    two = [("a", 0, [animal("deer", "m;c;f;g;d"), animal("fox", "m;k;f;g;x")]), ("b", 1, [animal("fox", "m;k;f;g;x")])]
    _, found, species = build(spark, two)
    assert {r.species for r in species.collect()} == {"deer", "fox"}
    assert found.first().species == "fox"


def test_single_animal_with_two_labels(spark):
    _, _, species = build(spark, [("a", 0, [animal("deer", "m;c;f;g;d")]), ("b", 1, [animal("fox", "m;k;f;g;x")])])
    assert [(r.species, r.lineage, r.max_count) for r in species.collect()] == [("m (class)", "m", 1)]


def test_observation_types(spark):
    frames = [("a", 0, []), ("b", 1000, [("person", 0.9, None, None, None), ("vehicle", 0.9, None, None, None)]), ("c", 2000, [("vehicle", 0.9, None, None, None)]), ("d", 3000, [("animal", 0.2, None, None, None)])]
    _, found, species = build(spark, frames)
    assert [r.observation_type for r in found.orderBy("start").collect()] == ["blank", "person", "vehicle", "animal"]
    assert [r.species for r in species.collect()] == ["animal (unresolved)"]


def test_select_boxes_caps_each_photo(spark):
    rows = [("p1", k, "animal", c, 0.1, 0.2, 0.3, 0.4, "m") for k, c in enumerate((0.9, 0.8, 0.7))] + [("p2", 0, "animal", 0.2, 0.1, 0.2, 0.3, 0.4, "m"), ("p2", 1, "animal", 0.19, 0.0, 0.0, 0.0, 0.0, "m"), ("p3", 0, "person", 0.9, 0.0, 0.0, 0.0, 0.0, "m")]
    kept = photos.select_boxes(spark.createDataFrame(rows, DETECTIONS), 0.2, 2)
    assert sorted((r.photo_id, r.box_idx) for r in kept.collect()) == [("p1", 0), ("p1", 1), ("p2", 0)]
    assert kept.filter("photo_id = 'p2'").first().box_key == "p2:0.1000,0.2000,0.3000,0.4000"


def test_near_duplicate_chain(spark):
    far, base = "ffffffffffffffff", 0
    prints = [(0, f"{base:016x}"), (10, f"{0b111111:016x}"), (20, far), (400, f"{base:016x}"), (710, far), (720, None), (730, f"{0b111111111111:016x}")]
    df = spark.createDataFrame([(f"p{k}", "c", f"p{k}", T0 + timedelta(seconds=s), h) for k, (s, h) in enumerate(prints, 1)], "photo_id string, camera_id string, rel_path string, timestamp timestamp_ntz, dhash string")
    found = {r.photo_id: r.dup_group for r in quality.near_duplicate_groups(df).collect()}
    assert found == {"p1": "p1", "p2": "p1", "p3": "p3", "p4": "p4", "p5": "p5", "p6": "p6", "p7": "p7"}
    chain = spark.createDataFrame([(f"q{k:02d}", "c", f"q{k:02d}", T0 + timedelta(seconds=k), f"{(1 << k) - 1:016x}") for k in range(40)], df.schema)
    assert {r.dup_group for r in quality.near_duplicate_groups(chain).collect()} == {"q00"}


def test_flags(spark):
    rows = [(f"p{k}", "c", f"p{k}", T0 + timedelta(hours=k), s, b, 50.0, None, True) for k, (s, b) in enumerate([(100.0, 120.0), (110.0, 10.0), (90.0, 240.0), (20.0, 120.0)])]
    df = spark.createDataFrame(rows, "photo_id string, camera_id string, rel_path string, timestamp timestamp_ntz, sharpness double, brightness double, ir_score double, dhash string, decode_ok boolean")
    found = {r.photo_id: r for r in quality.add_flags(df, Settings()).collect()}
    assert [found[p].is_blurry for p in sorted(found)] == [False, False, False, True]
    assert [found[p].is_dark for p in sorted(found)] == [False, True, False, False]
    assert [found[p].is_overexposed for p in sorted(found)] == [False, False, True, False]


def test_summaries_of_nothing(spark):
    _, found, species = build(spark, [("a", 0, [])])
    assert summaries.species_totals(species).collect() == []
    assert summaries.activity_by_hour(species).collect() == []


def test_gaps_and_effort(spark):
    told, found, species = build(spark, [("a", 0, []), ("b", 3600 * 60, [animal("deer", "m;c;f;g;d")]), ("d", 3600 * 84, [])])
    gaps = summaries.camera_gaps(told, 48)
    assert [(r.camera_id, r.gap_hours) for r in gaps.collect()] == [("c", 60.0)]
    health = summaries.camera_health(told, found, gaps)
    h = health.first()
    assert (h.n_gaps, h.span_days, h.effort_days, h.active_days, h.longest_silence_hours, h.n_events, h.n_animal_events) == (1, 3.5, 1.0, 3, 60.0, 3, 1)
    assert h.pct_empty == pytest.approx(66.7)
    assert [r.events_per_100_days for r in summaries.species_by_camera(species, health).collect()] == [100.0]
    grid = summaries.activity_by_hour(species).collect()
    assert len(grid) == 24 and sum(r.n_events for r in grid) == 1
    o = summaries.overview(told, found, species).first()
    assert (o.n_photos, o.n_events, o.n_blank_events, o.n_species, o.n_labels) == (3, 3, 2, 1, 1)
