"""Quality metrics of decoded images, as one Arrow function over Spark's image structs.

Images are shrunk by a triangle filter and hashes taken through a Lanczos filter, both widened by the factor of
reduction; other libraries round in between, so single bits of a hash may differ.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql.types import StringType
from pyspark.sql import functions as F

from wildtally.settings import Settings

try:
    import cv2
except ImportError:  # not needed
    cv2 = None

METRICS = "sharpness double, brightness double, contrast double, ir_score double, dhash string, error string"
HASH_SIDE = 8


@F.pandas_udf(StringType())
def photo_id_for(path: pd.Series) -> pd.Series:
    """BLAKE2b of the path, 8 bytes in hex."""
    return path.map(lambda p: None if p is None else hashlib.blake2b(p.encode(), digest_size=8).hexdigest())


def to_rgb(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """Height x width x 3 from the image source's BGR(A) or grey bytes."""
    flat = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    return np.repeat(flat, 3, axis=2) if channels == 1 else flat[:, :, 2::-1]


def oriented(rgb: np.ndarray, orientation: int) -> np.ndarray:
    """The image turned as EXIF orientation 1 to 8 says."""
    if orientation in (5, 6, 7, 8):
        rgb = rgb.transpose(1, 0, 2)
    flip_x, flip_y = orientation in (2, 3, 6, 7), orientation in (3, 4, 7, 8)
    return rgb[:: -1 if flip_y else 1, :: -1 if flip_x else 1]


def crop_strips(rgb: np.ndarray, top: float, bottom: float) -> np.ndarray:
    """Without the given shares at top and bottom, unless under 8 rows would stay."""
    h = len(rgb)
    a, b = int(h * top), h - int(h * bottom)
    return rgb[a:b] if b - a >= 8 else rgb


def triangle(x: np.ndarray) -> np.ndarray:
    return np.maximum(0, 1 - np.abs(x))


def lanczos(x: np.ndarray) -> np.ndarray:
    return np.where(np.abs(x) < 3, np.sinc(x) * np.sinc(x / 3), 0)


def _weights(size: int, to: int, kernel: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """[to, size] weights of the cells of a line in each of `to` cells."""
    scale = size / to
    centre = (np.arange(to) + 0.5) * scale
    w = kernel((np.arange(size) + 0.5 - centre[:, None]) / max(scale, 1.0))
    return w / w.sum(axis=1, keepdims=True)


def resized(grid: np.ndarray, rows: int, columns: int, kernel: Callable[[np.ndarray], np.ndarray] = triangle) -> np.ndarray:
    return np.clip(np.rint(_weights(grid.shape[0], rows, kernel) @ grid @ _weights(grid.shape[1], columns, kernel).T), 0, 255)


def shrink(rgb: np.ndarray, max_side: int) -> np.ndarray:
    h, w = rgb.shape[:2]
    scale = max_side / max(h, w)
    if scale >= 1:
        return rgb
    rows, columns = max(1, round(h * scale)), max(1, round(w * scale))
    return np.stack([resized(rgb[:, :, c].astype(np.float64), rows, columns) for c in range(3)], axis=2).astype(np.uint8)


def grey(rgb: np.ndarray) -> np.ndarray:
    r, g, b = (rgb[:, :, c].astype(np.float64) for c in range(3))
    return np.floor(0.299 * r + 0.587 * g + 0.114 * b + 0.5)


def laplacian_variance(grid: np.ndarray) -> float:
    """Population variance of each cell's four neighbours less four times itself; edges mirror."""
    p = np.pad(grid, 1, mode="reflect" if min(grid.shape) > 1 else "edge")
    around = sum((p[1 + a : p.shape[0] - 1 + a, 1 + b : p.shape[1] - 1 + b] for a, b in ((-1, 0), (1, 0), (0, -1), (0, 1))), np.zeros(grid.shape))
    return float(np.var(around - 4 * grid))


def sharpness(grid: np.ndarray) -> float:
    """laplacian_variance(), by OpenCV where it is installed: its kernel and its border are the same."""
    if cv2 is None or min(grid.shape) < 2:
        return laplacian_variance(grid)
    return float(cv2.Laplacian(grid.astype(np.float64), cv2.CV_64F).var())


def ir_score(rgb: np.ndarray) -> float:
    """Mean distance of red from green and green from blue; near zero in infrared."""
    c = rgb.astype(np.int16)
    return float(np.abs(np.diff(c, axis=2)).mean(axis=(0, 1)).sum())


def dhash(grid: np.ndarray) -> str:
    """64 bits in hex: whether each of 8 x 8 cells is brighter than the one to its left."""
    small = resized(grid, HASH_SIDE, HASH_SIDE + 1, lanczos)
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes().hex()


def measure(rgb: np.ndarray, settings: Settings) -> tuple[float, float, float, float, str]:
    small = shrink(crop_strips(rgb, settings.strip_top, settings.strip_bottom), settings.measured_side)
    grid = grey(small)
    return round(sharpness(grid), 3), round(float(grid.mean()), 3), round(float(grid.std()), 3), round(ir_score(small), 3), dhash(grid)


def measured(image: Column, orientation: Column, settings: Settings | None = None) -> Column:
    """struct METRICS of an image struct; an image that couldn't be decoded has an error and nothing else."""
    s = settings or Settings()

    @F.pandas_udf(METRICS)
    def work(images: pd.DataFrame, turned: pd.Series) -> pd.DataFrame:
        rows = []
        for data, h, w, c, turn in zip(images["data"], images["height"], images["width"], images["nChannels"], turned, strict=True):
            if not h > 0:  # also null
                rows.append((None, None, None, None, None, "unreadable"))
            else:
                rows.append((*measure(oriented(to_rgb(data, int(h), int(w), int(c)), int(turn or 1)), s), None))
        return pd.DataFrame(rows, columns=[c.split()[0] for c in METRICS.split(", ")])

    return work(image, orientation)
