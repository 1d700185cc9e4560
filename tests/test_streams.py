"""Streams against batch: late photos, a stream that breaks off, photos that fail and then work."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from wildtally.operators import quality
from wildtally.sources.tables import RecordStore
from wildtally.streaming import feed_again, stream_folder, stream_near_duplicates
from wildtally.streaming.folder import failures

T0 = datetime(2026, 4, 6, 8)
PHOTO = "photo_id string, camera_id string, rel_path string, timestamp timestamp_ntz, timestamp_valid boolean, decode_ok boolean, dhash string"


def random_photos(n):
    pick = random.Random(5)
    rows, second = [], 0
    for k in range(n):
        second += pick.choice([1, 5, 60, 299, 301, 900])
        print_ = None if pick.random() < 0.1 else f"{pick.choice([0, 7, (1 << 64) - 1, 0xFF00FF00]) ^ pick.choice([0, 1, 6, 255]):016x}"
        rows.append((f"p{k:03d}", f"c{k % 2}", f"{k}.png", T0 + timedelta(seconds=second), True, True, print_))
    return rows


def test_late_photos_get_the_groups_of_the_batch(spark, tmp_path):
    rows = random_photos(60)
    want = {r.photo_id: r.dup_group for r in quality.near_duplicate_groups(spark.createDataFrame(rows, PHOTO)).collect()}
    want["t"] = "t"
    rows.append(("t", "c0", "t.png", None, False, True, "0" * 16))
    mixed = [r for at in range(0, len(rows), 10) for r in random.Random(at).sample(rows[at : at + 10], len(rows[at : at + 10]))]
    late = [("end", "z", "end.png", T0 + timedelta(days=3), True, True, "f" * 16), ("end2", "z", "end2.png", T0 + timedelta(days=9), True, True, "f" * 16)]
    for k, some in enumerate([mixed[at : at + 5] for at in range(0, len(mixed), 5)] + [[late[0]], [late[1]]]):
        spark.createDataFrame(some, PHOTO).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{k:03d}")
    source = spark.readStream.schema(spark.createDataFrame([], PHOTO).schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    q = stream_near_duplicates(source, late="5 hours").writeStream.format("memory").queryName("late").outputMode("append").option("checkpointLocation", f"{tmp_path}/c").start()
    q.processAllAvailable()
    left = q.lastProgress["stateOperators"][0]["numRowsTotal"]
    q.stop()
    told = {r.photo_id: r.dup_group for r in spark.table("late").collect()}
    assert told.pop("end") == "end" and told == want
    assert len(set(told.values())) < len(told)
    assert left == 1  # of all cameras only that of the last photo


SEEN = StructType([StructField("rel_path", StringType()), StructField("size", LongType()), StructField("error", StringType())])


def test_a_stream_that_breaks_off_keeps_each_photo_once(spark, tmp_path):
    (tmp_path / "in" / "a").mkdir(parents=True)
    for k in range(7):
        (tmp_path / "in" / "a" / f"{k}.JPG").write_bytes(b"x" * (k + 1))
    (tmp_path / "in" / "a" / "notes.txt").write_text("no image")
    store = RecordStore(spark, f"file://{tmp_path}/records", "rel_path", SEEN)
    fail = {"at": 1}

    def work(batch):
        return batch.select("rel_path", F.length("rel_path").cast("long").alias("size"), F.lit(None).cast("string").alias("error"))

    put = store.put

    def broken(records, number):
        put(records, number)
        if number == fail["at"]:
            raise OSError("broken off behind the write, before the batch is known to be done")

    store.put = broken
    start = lambda: stream_folder(spark, f"file://{tmp_path}/in", store, work, f"{tmp_path}/check", 3).trigger(availableNow=True).start()
    with pytest.raises(Exception, match="broken off"):
        start().awaitTermination()
    fail["at"] = None
    start().awaitTermination()
    assert sorted(r.rel_path for r in store.history().collect()) == [f"a/{k}.JPG" for k in range(7)]
    (tmp_path / "in" / "late.png").write_bytes(b"y")
    start().awaitTermination()
    assert sorted(r.rel_path for r in store.history().collect()) == [*(f"a/{k}.JPG" for k in range(7)), "late.png"]


def test_failures_are_fed_again(spark, tmp_path):
    store = RecordStore(spark, f"file://{tmp_path}/records", "rel_path", SEEN)
    items = spark.createDataFrame([("good",), ("twice",), ("never",)], "rel_path string")
    tries = {"n": 0}

    def work(rows):
        tries["n"] += 1
        bad = (F.col("rel_path") == "never") | ((F.col("rel_path") == "twice") & (F.lit(tries["n"]) <= 2))
        return rows.select("rel_path", F.lit(1).cast("long").alias("size"), F.when(bad, "cut").alias("error"))

    store.put(work(items), 0)
    counts = []
    while n := feed_again(items, store, work, most=4):
        counts.append(n)
    assert counts == [2, 2, 1]
    assert {r.rel_path: r.error for r in store.read().collect()} == {"good": None, "twice": None, "never": "cut"}
    assert [tuple(r) for r in failures(store).collect()] == [("never", 4)]
    assert store.history().filter("rel_path = 'twice' AND error IS NULL").count() == 1
    assert feed_again(items, RecordStore(spark, f"file://{tmp_path}/none", "rel_path", SEEN), work) == 0
