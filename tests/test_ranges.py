"""Scans over a group that lies in many ranges against windows and sorted rows."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from wildtally.operators import events, quality, ranges

T0 = datetime(2026, 4, 6)
PARTS = 32


@pytest.fixture()
def many_ranges(spark, monkeypatch):
    """So many ranges, however few the rows."""
    monkeypatch.setattr(ranges, "GROUP_ROWS", 0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(PARTS))
    yield spark
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def photos(spark, n=3000):
    """One camera with nearly all photos, in bursts of near copies, and a few others; ties in time."""
    pick = random.Random(2)
    rows, second = [], 0
    for k in range(n):
        second += pick.choice([0, 0, 1, 2, 30, 60, 61, 400])
        print_ = pick.choice([0, 0, 3, 1 << 63, (1 << 40) - 1]) ^ pick.choice([0, 1, 7])
        rows.append((f"p{k:05d}", "hot" if k % 50 else f"c{k % 7}", f"{k}.png", T0 + timedelta(seconds=second), k % 11 != 0, k % 13 != 0, f"{print_:016x}" if k % 17 else None))
    return spark.createDataFrame(rows, "photo_id string, camera_id string, rel_path string, timestamp timestamp_ntz, timestamp_valid boolean, decode_ok boolean, dhash string")


def test_events_of_one_camera_in_many_tasks(many_ranges):
    df = photos(many_ranges)
    told = events.assign_events(df, 60)
    order = W.partitionBy("camera_id").orderBy("timestamp", "rel_path")
    usable = df.filter("timestamp_valid AND decode_ok").withColumn("gap", F.timestamp_diff("SECOND", F.lag("timestamp").over(order), F.col("timestamp")))
    number = F.sum(F.when(F.col("gap").isNull() | (F.col("gap") > 60), 1).otherwise(0)).over(order)
    want = {r.photo_id: f"{r.camera_id}-e{r.n:05d}" for r in usable.withColumn("n", number).collect()}
    assert {r.photo_id: r.event_id for r in told.collect() if r.event_id} == want
    dealt = ranges.dealt(df.filter("camera_id = 'hot'"), "camera_id", ["timestamp", "rel_path"])
    assert dealt.select(ranges.RANGE).distinct().count() == PARTS
    assert told.count() == df.count() and told.columns == [*df.columns, "event_id"]
    ranges.GROUP_ROWS = 1_000_000  # the fixture puts it back
    assert {r.photo_id: r.event_id for r in events.assign_events(df, 60).collect() if r.event_id} == want


def test_look_back_over_borders(many_ranges):
    df = photos(many_ranges, 1200)
    usable = F.col("dhash").isNotNull()
    order = W.partitionBy("camera_id", usable).orderBy("timestamp", "rel_path")
    seen = df.filter(usable).withColumns({f"b{k}": F.lag("photo_id", k).over(order) for k in range(1, 9)})
    dealt = ranges.dealt(df.filter(usable), "camera_id", ["timestamp", "rel_path"])
    told = ranges.with_look_back(dealt, "camera_id", ["timestamp", "rel_path"], F.col("photo_id"), 8, "b")
    columns = ["photo_id", *(f"b{k}" for k in range(1, 9))]
    assert sorted(map(tuple, told.select(columns).collect())) == sorted(map(tuple, seen.select(columns).collect()))
    by_camera = {}
    for r in sorted(df.filter(usable).collect(), key=lambda r: (r.timestamp, r.rel_path)):
        by_camera.setdefault(r.camera_id, []).append(r)
    want = {}
    for rows in by_camera.values():
        for k, r in enumerate(rows):
            near = (e.photo_id for e in reversed(rows[max(0, k - 8) : k]) if (r.timestamp - e.timestamp).total_seconds() <= 300 and bin(int(e.dhash, 16) ^ int(r.dhash, 16)).count("1") <= 6)
            want[r.photo_id] = next(near, None)
    parents = quality.with_parents(df, 6, 8, 300.0)
    assert {r.photo_id: r.parent for r in parents.collect()} == want | {r.photo_id: None for r in df.filter(~usable).collect()}


def test_groups_without_a_name_and_few_rows(many_ranges):
    rows = [(None, 1, 5), (None, 2, 6), ("a", 1, 7), (None, 3, 8)]
    dealt = ranges.dealt(many_ranges.createDataFrame(rows, "g string, t long, v long"), "g", ["t"])
    told = ranges.with_running_sum(ranges.with_previous(dealt, "g", ["t"], "v", "before"), "g", ["t"], "v", "sum")
    assert sorted((r.t, r.before, r.sum) for r in told.filter("g IS NULL").collect()) == [(1, None, 5), (2, 5, 11), (3, 6, 19)]
    assert ranges.with_previous(ranges.dealt(many_ranges.createDataFrame([], "g string, t long, v long"), "g", ["t"]), "g", ["t"], "v", "b").count() == 0


def test_medians_by_selection(spark):
    pick = random.Random(1)
    shapes = {
        "even": [pick.random() for _ in range(2000)], "odd": [pick.gauss(0, 1e9) for _ in range(1001)], "one value": [3.25] * 900, "two values": [1.0] * 500 + [2.0] * 500,
        "skewed": [0.0] * 700 + [10.0**pick.uniform(-300, 300) for _ in range(900)], "small": [5.0, 1.0, 9.0], "close": [1 + k * 2**-52 for k in range(600)], "negative": [-pick.expovariate(1) for _ in range(800)], "wide": [-1.7e308, 1.7e308] * 300,
    }
    rows = [(None if name == "odd" else name, v) for name, values in shapes.items() for v in values] + [("even", None), ("nothing", None)]
    pick.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, v double")
    want = {r.g: r.m for r in df.groupBy("g").agg(F.median("v").alias("m")).collect()}
    told = {r.g: r.m for r in ranges.medians(df, ["g"], "v", "m", sorted_rows=50).collect()}
    assert told == {k: v for k, v in want.items() if k != "nothing"}
    assert {r.g: r.m for r in ranges.medians(df, ["g"], "v", "m").collect()} == told


def test_tables_that_are_left_are_swept(spark):
    from wildtally import storage

    kept, path = storage.stored(spark.range(3), "kept")
    gone, other = storage.stored(spark.range(3), "gone")
    storage.remove(spark, other)
    files = storage.Files(spark)
    assert files.exists(path) and not files.exists(other) and path in storage._LEFT and other not in storage._LEFT
    held = dict(storage._LEFT)
    storage._LEFT.clear()
    storage._LEFT[path] = held.pop(path)
    storage.sweep()
    storage._LEFT.update(held)
    assert not files.exists(path)
