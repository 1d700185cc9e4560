"""The session and near-duplicate operators over a stream of photos."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wildtally.streaming.folder import feed_again, stream_folder

__all__ = ["feed_again", "stream_folder", "stream_near_duplicates", "stream_sessions"]


def stream_sessions(photos: DataFrame, gap_s: float, late: str = "1 hour") -> DataFrame:
    """camera_id, start, end, n_photos of sessions, once the watermark has passed them.

    Photos without a valid clock are filtered before the watermark; a gap of exactly `gap_s` joins, as in batch.
    """
    valid = photos.filter("timestamp_valid AND decode_ok").withColumn("_t", F.col("timestamp").cast("timestamp"))
    found = valid.withWatermark("_t", late).groupBy("camera_id", F.session_window("_t", f"{int(gap_s)} seconds").alias("w"))
    whole = found.agg(F.min("timestamp").alias("start"), F.max("timestamp").alias("end"), F.count("*").alias("n_photos"))
    return whole.select("camera_id", "start", "end", "n_photos")


#: Of a camera: photos that the watermark hasn't passed, and the last ones that it has.
_STATE = ", ".join(f"{kind}_{c}" for kind in ("open", "last") for c in ("ids array<string>", "paths array<string>", "times array<long>", "hashes array<string>", "groups array<string>"))


def stream_near_duplicates(photos: DataFrame, max_bits: int = 6, window: int = 8, max_gap_s: float = 300.0, late: str = "10 minutes") -> DataFrame:
    """photo_id, camera_id, dup_group, in whatever order photos come within `late` of each other.

    A photo waits until the watermark has passed its time; then it is held against the `window` photos of its camera
    before it. A camera's state goes once all its photos are passed and the last is too old to be looked back at. Photos
    without a hash or a time are groups of their own and wait for nothing. Photos later than `late` are left out, as
    Spark does.
    """
    reach = int(max_gap_s * 1e6)

    def work(key: tuple, batches: Iterator[pd.DataFrame], held) -> Iterator[pd.DataFrame]:  # noqa: ANN001
        waiting, last = [], []
        if held.exists:
            lists = held.get
            waiting, last = list(zip(*lists[:5], strict=True)), list(zip(*lists[5:], strict=True))
        for batch in batches:
            waiting += [(p, r, int(t), h, "") for p, r, t, h in batch[["photo_id", "rel_path", "micros", "dhash"]].itertuples(index=False)]
        passed = held.getCurrentWatermarkMs() * 1000
        waiting.sort(key=lambda w: (w[2], w[1]))
        rows = []
        while waiting and waiting[0][2] < passed:
            photo, path, moment, print_, _ = waiting.pop(0)
            alike = (g for _, _, t, h, g in reversed(last) if moment - t <= reach and (int(h, 16) ^ int(print_, 16)).bit_count() <= max_bits)
            group = next(alike, photo)
            last = [*last, (photo, path, moment, print_, group)][-window:]
            rows.append((photo, key[0], group))
        if not waiting and (not last or last[-1][2] + reach < passed):
            if held.exists:
                held.remove()
        else:
            empty = ([], [], [], [], [])
            held.update((*(map(list, zip(*waiting, strict=True)) if waiting else empty), *(map(list, zip(*last, strict=True)) if last else empty)))
            wake = (waiting[0][2] if waiting else last[-1][2] + reach) // 1000 + 1
            held.setTimeoutTimestamp(max(wake, passed // 1000 + 1))
        if rows:
            yield pd.DataFrame(rows, columns=["photo_id", "camera_id", "dup_group"])

    usable = F.col("dhash").isNotNull() & F.col("timestamp").isNotNull()
    moment = F.col("timestamp").cast("timestamp")
    timed = photos.filter(usable).select("photo_id", "camera_id", "rel_path", moment.alias("_t"), F.unix_micros(moment).alias("micros"), "dhash").withWatermark("_t", late)
    found = timed.groupBy("camera_id").applyInPandasWithState(work, "photo_id string, camera_id string, dup_group string", _STATE, "append", "EventTimeTimeout")
    return found.unionByName(photos.filter(~usable).select("photo_id", "camera_id", F.col("photo_id").alias("dup_group")))
