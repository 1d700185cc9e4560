"""Small column functions: text, time, rounding, boxes, hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wildtally.functions.stamps import cleaned, parse_timestamp, parse_timestamps

__all__ = [
    "CATEGORIES", "box_key", "camera_folder", "category_name", "clean_boxes", "cleaned", "event_name", "hamming", "hex_halves", "iou", "is_night", "micros_between",
    "parse_timestamp", "parse_timestamps", "rounded", "rounded_exactly", "safe_file_name", "seconds_between", "written",
]


def rounded(value: Column, places: int) -> Column:
    """To `places` decimals: the scaled double to the nearest whole number, a half to the even one."""
    scale = 10.0**places
    return F.rint(value * scale) / scale


#: Splits a double into two halves of 26 bits (Dekker).
_HALVES = 134217729.0


def _halves(x: Column) -> tuple[Column, Column]:
    high = x * _HALVES - (x * _HALVES - x)
    return high, x - high


def rounded_exactly(value: Column, places: int) -> Column:
    """To `places` decimals by the double's exact value, which is a tie only if it lies exactly between; then to the even one.

    The scaled value is the sum of two doubles, its nearest and what that leaves out. The first decides unless it is a
    half, then the sign of the second does. Doubles too large for decimals, infinities and NaN stay.
    """
    scale = 10.0**places
    x = F.abs(value)
    near = x * scale
    (x_high, x_low), (s_high, s_low) = _halves(x), (F.lit(float(h)) for h in _split(scale))
    rest = ((x_high * s_high - near) + x_high * s_low + x_low * s_high) + x_low * s_low
    whole = F.floor(near).cast("double")
    part = near - whole
    up = (part > 0.5) | ((part == 0.5) & ((rest > 0) | ((rest == 0) & (whole % 2 == 1))))
    told = (whole + F.when(up, 1.0).otherwise(0.0)) / scale
    signed = F.when(value < 0, -told).otherwise(told)
    return F.when(F.isnan(value) | (x == 0) | (x >= 2.0**52 / scale), value).otherwise(signed)


def _split(x: float) -> tuple[float, float]:
    high = x * _HALVES - (x * _HALVES - x)
    return high, x - high


def written(value: Column, places: int) -> Column:
    """A number rounded to `places` decimals as text: no trailing zeros but the first decimal, no exponent for small numbers."""
    return F.regexp_replace(F.format_string(f"%.{places}f", value), r"(?<=\.\d{1,20}?)0+$", "")


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with their fraction, between times without zone."""
    return micros_between(start, end) / 1e6


def micros_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MICROSECOND", start, end)


def event_name(camera: Column, sequence: Column) -> Column:
    return F.concat(camera, F.lit("-e"), F.format_string("%05d", sequence))


def hex_halves(hash_: Column) -> tuple[Column, Column]:
    """Both 32-bit halves of 16 hex digits, as longs."""
    half = lambda at: F.conv(F.substring(hash_, at, 8), 16, 10).cast("long")
    return half(1), half(9)


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two 64-bit hashes in hex."""
    return sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(hex_halves(a), hex_halves(b), strict=True)), F.lit(0))


def clean_boxes(boxes: Column) -> Column:
    """Boxes array<struct<category, conf, bbox>> clamped to the image, rounded to 4 places, surest first (stable)."""
    unit = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))

    def fitted(b: Column, at: Column) -> Column:
        x, y, w, h = (F.get(b["bbox"], F.lit(k)) for k in range(4))
        x, y, w, h = unit(x), unit(y), F.least(unit(w), 1 - unit(x)), F.least(unit(h), 1 - unit(y))
        return F.struct((-rounded_exactly(b["conf"], 4)).alias("minus"), at.alias("at"), b["category"].alias("category"), F.array(*[rounded_exactly(v, 4) for v in (x, y, w, h)]).alias("bbox"))

    ordered = F.array_sort(F.transform(boxes, fitted))
    return F.transform(ordered, lambda b: F.struct(b["category"].alias("category"), (-b["minus"]).alias("conf"), b["bbox"].alias("bbox")))


def box_key(photo_id: Column, x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.format_string("%s:%.4f,%.4f,%.4f,%.4f", photo_id, x, y, w, h)


def iou(a: list[Column], b: list[Column]) -> Column:
    """Overlap of two boxes x, y, w, h as a share of what they cover together; 0 if they cover nothing."""
    wide = F.greatest(F.lit(0.0), F.least(a[0] + a[2], b[0] + b[2]) - F.greatest(a[0], b[0]))
    high = F.greatest(F.lit(0.0), F.least(a[1] + a[3], b[1] + b[3]) - F.greatest(a[1], b[1]))
    union = a[2] * a[3] + b[2] * b[3] - wide * high
    return F.when(union > 0, wide * high / union).otherwise(F.lit(0.0))


#: Detector category numbers (fixed values).
CATEGORIES = {"1": "animal", "2": "person", "3": "vehicle"}


def category_name(code: Column) -> Column:
    known = F.create_map(*[F.lit(x) for pair in CATEGORIES.items() for x in pair])
    return F.coalesce(F.try_element_at(known, code), F.lit("unknown"))


def camera_folder(camera_id: Column) -> Column:
    """`location_` and the id in lower case, other characters as one underscore; `unknown` if nothing is left."""
    slug = F.regexp_replace(F.regexp_replace(F.lower(camera_id), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.concat(F.lit("location_"), F.when(slug == "", F.lit("unknown")).otherwise(slug))


def safe_file_name(name: Column) -> Column:
    """The base name of a relative image path, or null if the path is unsafe or no image."""
    parts = F.split(name, "/")
    plain = ~name.contains("\\") & ~F.exists(parts, lambda p: p.isin("", ".", ".."))
    base = F.element_at(parts, -1)
    return F.when(plain & base.rlike(r"(?i)^[A-Za-z0-9_][A-Za-z0-9._ ()-]*\.(jpg|jpeg|png|tif|tiff)$"), base)


def is_night(moment: Column) -> Column:
    """Outside 06:30 to 19:30."""
    hour = F.hour(moment) + F.minute(moment) / 60.0
    return (hour < 6.5) | (hour >= 19.5)

