"""What a survey can be told: one table of options, which the command line and the stages read."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from datetime import date
from typing import Any, NamedTuple

#: Kinds of values: how a text becomes one, which ones are good, and what they are called.
KINDS: dict[str, tuple[Callable[[str], Any], Callable[[Any], bool], str]] = {
    "count": (int, lambda v: v > 0, "a positive whole number"),
    "whole": (int, lambda v: v >= 0, "a whole number from 0"),
    "amount": (float, lambda v: 0 < v < float("inf"), "a positive number"),
    "share": (float, lambda v: 0 <= v <= 1, "a number from 0 to 1"),
    "day": (lambda text: date.fromisoformat(text).isoformat(), lambda v: True, "a date like 2001-01-31"),
    "text": (str, lambda v: True, "a text"),
}


def parsed(kind: str, text: str) -> Any:
    """The value of a text; ValueError if it is none of that kind."""
    make, good, called = KINDS[kind]
    try:
        value = make(text)
    except ValueError:
        value = None
    if value is None or not good(value):
        raise ValueError(f"{text!r} is not {called}")
    return value


class Option(NamedTuple):
    name: str
    kind: str
    default: Any
    says: str
    flag: str = ""  # on the command line, if it is there


#: The defaults and flags are fixed values.
OPTIONS = (
    Option("strip_top", "share", 0.0, "share of the image's height that a strip at the top takes", "--strip-top"),
    Option("strip_bottom", "share", 0.0, "share of the image's height that a strip at the bottom takes", "--strip-bottom"),
    Option("measured_side", "count", 640, "images are shrunk to this longer side before they are measured"),
    Option("dark_below", "amount", 30.0, "mean brightness of dark photos"),
    Option("bright_above", "amount", 225.0, "mean brightness of overexposed photos"),
    Option("infrared_below", "amount", 4.0, "mean distance of the colour channels in infrared photos"),
    Option("blurred_below", "share", 0.35, "sharpness of blurred photos, as a share of the camera's median"),
    Option("alike_bits", "whole", 6, "differing hash bits of near-duplicates at most"),
    Option("look_back", "count", 8, "earlier photos that a photo is compared with"),
    Option("look_back_s", "amount", 300.0, "seconds between near-duplicates at most"),
    Option("count_conf", "share", 0.2, "confidence from which a box counts", "--count-conf"),
    Option("boxes_per_photo", "count", 10, "boxes of a photo that are classified"),
    Option("species_threshold", "share", 0.65, "score from which a label stands", "--species-threshold"),
    Option("event_gap_s", "amount", 60.0, "seconds without a photo that end an event", "--event-gap"),
    Option("silence_h", "amount", 48.0, "hours without a photo that count as a long silence", "--gap-hours"),
    Option("valid_from", "day", "2001-01-01", "clocks before this day are unset", "--valid-from"),
    Option("batch_photos", "count", 100_000, "photos that a model sees before its records are kept"),
    Option("title", "text", "Camera survey", "title of the report", "--title"),
)


class Settings(Mapping[str, Any]):
    """A value for each option, read as an attribute; unknown names are a TypeError."""

    def __init__(self, **changed: Any) -> None:
        defaults = {o.name: o.default for o in OPTIONS}
        if unknown := changed.keys() - defaults.keys():
            raise TypeError(f"unknown settings {sorted(unknown)}")
        self.__dict__.update(defaults | changed)

    def __getitem__(self, name: str) -> Any:
        return self.__dict__[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self.__dict__)

    def __len__(self) -> int:
        return len(self.__dict__)
