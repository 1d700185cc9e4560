"""A few whole sequences of a public camera-trap survey, downloaded with a limit and a cache."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path
from typing import Any
from urllib.parse import quote, urlsplit
from urllib.request import Request, urlopen

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wildtally.errors import InputError
from wildtally.functions import scalars
from wildtally.operators.incremental import contiguous_runs
from wildtally.sources.tables import SIDECAR, atomic_write_bytes, atomic_write_text, parse_metadata, write_csv
from wildtally.storage import located

#: Where the survey's description and images are, and how it asks to be named (fixed values).
METADATA_URL = "https://storage.googleapis.com/public-datasets-lila/caltechcameratraps/labels/caltech_camera_traps.json.zip"
IMAGES_URL = "https://storage.googleapis.com/public-datasets-lila/caltech-unzipped/cct_images/"
CREDIT = "Images: Caltech Camera Traps (LILA BC, https://lila.science/datasets/caltech-camera-traps), Community Data License Agreement, permissive variant.\n"
MOST_METADATA, MOST_IMAGE, WAIT_S = 512 << 20, 32 << 20, 60.0

Opener = Callable[..., Any]


def https_only(url: str) -> str:
    if urlsplit(url).scheme != "https":
        raise InputError(f"{url} isn't an https address")
    return url


def fetched(url: str, target: Path, most: int, opener: Opener = urlopen) -> bytes:
    """What the address holds, from `target` if it is there already; more than `most` bytes are an InputError."""
    if target.exists():
        return target.read_bytes()
    with opener(Request(https_only(url), headers={"User-Agent": "wildtally"}), timeout=WAIT_S) as source:
        data = source.read(most + 1)
    if len(data) > most:
        raise InputError(f"{url} is over {most} bytes")
    atomic_write_bytes(target, data)
    return data


def choose(entries: DataFrame, cameras: int, photos: int, seed: int) -> DataFrame:
    """camera_id, file_name, timestamp, place of `cameras` cameras: `photos` in time order from a drawn start, and the rest of the last sequence.

    Cameras with that many photos come first, in an order drawn from the seed; only if they are too few do others.
    """
    known = entries.filter(scalars.safe_file_name(F.col("file_name")).isNotNull() & F.col("timestamp").isNotNull())
    size = known.groupBy("camera_id").agg(F.count("*").alias("size"))
    drawn = size.orderBy((F.col("size") < photos), F.xxhash64(F.lit(seed), "camera_id")).limit(cameras).select("camera_id")
    luck = F.pmod(F.xxhash64(F.lit(seed), F.lit("start"), "camera_id"), F.greatest(F.col("n") - photos + 1, F.lit(1))) + 1
    return contiguous_runs(known.join(drawn, "camera_id", "left_semi"), luck, photos)


def fetch_sample(spark: SparkSession, out: str, cameras: int, photos: int, seed: int, opener: Opener = urlopen, base: tuple[str, str] = (METADATA_URL, IMAGES_URL)) -> int:
    """Writes images, sidecar and attribution into `out`; returns the number of images. An image that can't be had is left out."""
    folder, (metadata, images) = Path(out), base
    cache = folder / ".cache" / metadata.rpartition("/")[2]
    fetched(metadata, cache, MOST_METADATA, opener)
    told = choose(parse_metadata(spark, str(cache)), cameras, photos, seed)
    named = told.select("file_name", "timestamp", F.concat_ws("/", scalars.camera_folder(F.col("camera_id")), scalars.safe_file_name(F.col("file_name"))).alias("file"), "camera_id", "place")
    kept = []
    for r in named.orderBy("camera_id", "place").collect():  # cameras x photos rows
        try:
            fetched(images + quote(r.file_name), folder / r.file, MOST_IMAGE, opener)
        except (OSError, InputError):
            continue
        kept.append((r.file, r.camera_id, r.timestamp))
    if not kept:
        raise InputError("no image of the sample could be downloaded")
    write_csv(spark.createDataFrame(kept, "file string, camera_id string, timestamp string").orderBy("file"), f"{located(str(folder))}/{SIDECAR}")
    atomic_write_text(folder / "ATTRIBUTION.txt", CREDIT)
    return len(kept)

