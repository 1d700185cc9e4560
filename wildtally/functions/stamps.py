"""Times as people and cameras write them, read by column expressions.

A text is read as six numbers in a camera's order first. Otherwise it is taken apart: the time of day with its half-day
mark and zone, then what is left as at most three parts of a date, of which month names and long numbers tell what they
are. Numbers alone are month, day, year unless the first can't be a month (then day first) or a day (then year first).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from wildtally.functions.taxonomy import stripped

MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")
_MONTH = "|".join(f"{m[:3]}(?:{m[3:]})?" if len(m) > 3 else m for m in MONTHS).replace("sep(?:tember)?", "sept?(?:ember)?")
#: yyyy:mm:dd hh:mm:ss, with dashes or slashes, and with a T behind dashes.
SIX_NUMBERS = r"(?i)^(\d{4})(?:(:)|(-)|(/))(\d{1,2})(?:\2|\3|\4)(\d{1,2})(?:\s+|(?<=-\d{1,2})t)(\d{1,2}):(\d{1,2}):([0-5]?\d)$"
_ZONE = r"(?:\s*(?:z|utc|gmt|[cew]et|[a-z]{1,2}[sd]t)(?![a-z]))?(?:\s*[+-]\d{1,2}(?::?\d{2})?(?!\d))?(?:\s*\((?:utc|gmt)\))?"
_HALF = r"(?:\s*([ap])\.?(?:m\.?)?(?![a-z]))?"
_CLOCK = rf"(?<![\d:.])(\d{{1,2}}):(\d{{1,2}})(?::(\d{{1,2}})(?:[.,](\d+))?)?(?![\d:]){_HALF}{_ZONE}"
_HALF_HOUR = rf"(?<![\d:.])(\d{{1,2}})\s*([ap])\.?m\.?(?![a-z]){_ZONE}"
_UNITS = r"(?<![\d:.])(\d{1,2})\s*h(?:ours?)?(?![a-z])(?:\s*(\d{1,2})\s*m(?:in(?:utes?)?)?(?![a-z])|(\d{2})(?!\d))?(?:\s*(\d{1,2})\s*s(?:ec(?:onds?)?)?(?![a-z]))?"
_WEEKDAY = r"\b(?:mon|tue|wed|thu|fri|sat|sun|tues|wednes|thur|thurs|satur)(?:day)?\b"
#: Words that stand between the parts of a date and say nothing (fixed values).
_FILLING = r"\b(?:at|on|and|of|ad|t|m)\b"


def cleaned(text: Column) -> Column:
    """Without NUL bytes and white space around it; null if nothing is left."""
    return F.nullif(stripped(F.replace(text, F.lit("\0"), F.lit(""))), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of a value that is worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _number(text: Column) -> Column:
    return text.try_cast("int")


def _made(year: Column, month: Column, day: Column, hour: Column, minute: Column, second: Column, fraction: Column | None = None) -> Column:
    """The time, or null if there is none such. `fraction`: digits behind the second, of which six count."""
    digits = F.rpad(F.substring(F.coalesce(fraction, F.lit("")), 1, 6), 6, "0") if fraction is not None else F.lit("0")
    seconds = (second.cast("decimal(16,6)") + _number(digits).cast("decimal(16,6)") / 1_000_000).cast("decimal(16,6)")
    sound = (year >= 1) & (year <= 9999) & (second < 60) & (minute < 60) & (hour < 24)
    return F.when(sound, F.try_make_timestamp_ntz(year, month, day, hour, minute, seconds))


def _six_numbers(text: Column) -> Column:
    part = lambda head: [_number(F.regexp_extract(head, SIX_NUMBERS, k)) for k in (1, 5, 6, 7, 8, 9)]
    return let(F.substring(text, 1, 19), lambda head: F.when(head.rlike(SIX_NUMBERS), _made(*part(head))))


def _month_of(token: Column) -> Column:
    """1 to 12 of a month's name, else 0."""
    at = F.array_position(F.array(*[F.lit(m[:3]) for m in MONTHS]), F.substring(token, 1, 3))
    return F.when(token.rlike(f"^(?:{_MONTH})$"), at.cast("int")).otherwise(0)


def _clock(text: Column) -> Column:
    """Struct: whether a time of day was found, the text without it, hour, minute, second and digits of the fraction."""
    kind = F.when(text.rlike(_CLOCK), 1).when(text.rlike(_HALF_HOUR), 2).when(text.rlike(_UNITS), 3).otherwise(0)
    return let(kind, lambda k: let(_clock_parts(text, k), _clock_numbers))


def _clock_parts(text: Column, kind: Column) -> Column:
    take = lambda pattern, k: F.nullif(F.regexp_extract(text, pattern, k), F.lit(""))
    of = lambda *options: F.coalesce(*[F.when(kind == n, c) for n, c in enumerate(options, 1) if c is not None])
    told = {
        "found": kind > 0, "rest": F.coalesce(of(*[F.regexp_replace(text, p, " ") for p in (_CLOCK, _HALF_HOUR, _UNITS)]), text),
        "hour": of(take(_CLOCK, 1), take(_HALF_HOUR, 1), take(_UNITS, 1)), "minute": of(take(_CLOCK, 2), None, F.coalesce(take(_UNITS, 2), take(_UNITS, 3))),
        "second": of(take(_CLOCK, 3), None, take(_UNITS, 4)), "half": of(take(_CLOCK, 5), take(_HALF_HOUR, 2)), "fraction": of(take(_CLOCK, 4)),
    }
    return F.struct(*[c.alias(n) for n, c in told.items()])


def _clock_numbers(told: Column) -> Column:
    number = lambda name: F.coalesce(_number(told[name]), F.lit(0))
    written, half = number("hour"), told["half"]
    hour = F.when(half.isNull(), written).when(written > 12, F.lit(99)).when(half == "p", written % 12 + 12).otherwise(written % 12)
    return F.struct(told["found"].alias("found"), told["rest"].alias("rest"), hour.alias("hour"), number("minute").alias("minute"), number("second").alias("second"), told["fraction"].alias("fraction"))


def _tokens(rest: Column) -> Column:
    """Numbers and words of a date; a number without separators is taken apart."""
    for pattern, by in (
        (r"(?<=^\d{8}[t ]?\d{2,6})(?:z|[+-]\d\d:?\d\d)$", ""), (r"(\d)(?:st|nd|rd|th)\b", "$1"), (_WEEKDAY, " "), (r"(?<=\d)(?=[a-z])|(?<=[a-z])(?=\d)", " "), (r"[\s,;.'/-]+", " "), (_FILLING, " "), (r"\s+", " "), (r"^ | $", ""),
        (r"^(\d{4})(\d\d)(\d\d)(\d{4}|\d{6})?(?= |$)", "$1 $2 $3 $4"), (r"^(\d\d)(\d\d)(\d\d)(?= |$)", "$1 $2 $3"), (r"\s+", " "), (r"^ | $", ""),
    ):
        rest = F.regexp_replace(rest, pattern, by)
    return F.filter(F.split(rest, " "), lambda t: t != "")


def _full_year(token: Column) -> Column:
    """Two digits are the nearest year that ends so, half a century at most."""
    now, short = F.year(F.current_date()), _number(token)
    near = now - now % 100 + short
    return F.when(F.length(token) > 2, short).when(near >= now + 50, near - 100).when(near < now - 50, near + 100).otherwise(near)


def _date(parts: Column) -> Column:
    """Struct year, month, day of one to three parts; a missing year is 1, a missing month or day the first."""
    names = F.transform(parts, _month_of)
    at = F.array_position(F.transform(names, lambda m: m > 0), F.lit(True))  # 1 to 3; 0: numbers alone
    told = F.struct(
        F.size(parts).alias("n"), at.alias("at"), F.array_max(names).alias("month"), F.transform(parts, F.length).alias("long"), F.transform(parts, _number).alias("number"),
        F.transform(parts, _full_year).alias("year"),
    )
    return let(told, _ordered)


def _ordered(told: Column) -> Column:
    n, at = told["n"], told["at"]
    get = lambda name, k: F.get(told[name], F.lit(k) if isinstance(k, int) else k)
    first, second = F.when(at == 1, 1).otherwise(0), F.when(at == 3, 1).otherwise(2)  # where the parts beside a month's name are
    long = lambda k: get("long", k) > 2
    over = lambda k, most: get("number", k) > most
    is_year = lambda k: long(k) | over(k, 31)
    named = at > 0
    year_ahead = long(first) | (~long(second) & F.when(at == 3, ~over(second, 31)).otherwise(over(first, 31)))
    kinds = [
        (named & (n == 3) & year_ahead, (get("year", first), told["month"], get("number", second))),
        (named & (n == 3), (get("year", second), told["month"], get("number", first))),
        (named & (n == 2) & is_year(first), (get("year", first), told["month"], F.lit(1))),
        (named & (n == 2), (F.lit(1), told["month"], get("number", first))),
        (named, (F.lit(1), told["month"], F.lit(1))),
        ((n == 3) & is_year(0), (get("year", 0), get("number", 1), get("number", 2))),
        ((n == 3) & over(0, 12), (get("year", 2), get("number", 1), get("number", 0))),
        (n == 3, (get("year", 2), get("number", 0), get("number", 1))),
        ((n == 2) & is_year(0), (get("year", 0), get("number", 1), F.lit(1))),
        ((n == 2) & is_year(1), (get("year", 1), get("number", 0), F.lit(1))),
        (n == 2, (F.lit(1), get("number", 0), get("number", 1))),
        ((n == 1) & (get("long", 0) == 4), (get("number", 0), F.lit(1), F.lit(1))),
    ]
    return F.coalesce(*[F.when(test, F.struct(*[c.alias(x) for c, x in zip(date, ("year", "month", "day"), strict=True)])) for test, date in kinds])


def _taken_apart(text: Column) -> Column:
    return let(F.lower(text), lambda lower: let(_clock(lower), lambda clock: let(_tokens(clock["rest"]), lambda tokens: _assembled(clock, tokens))))


def _assembled(clock: Column, tokens: Column) -> Column:
    n = F.size(tokens)
    late = F.get(tokens, F.lit(3))  # hh, hhmm or hhmmss behind a whole date
    timed = ~clock["found"] & (n == 4) & late.rlike(r"^(?:\d\d){1,3}$")
    two = lambda at: F.coalesce(_number(F.nullif(F.substring(late, at, 2), F.lit(""))), F.lit(0))
    known = F.forall(tokens, lambda t: t.rlike(rf"^(?:\d{{1,4}}|{_MONTH})$") | (timed & t.rlike(r"^\d{6}$")))
    parts = F.slice(tokens, 1, 3)
    one_name = F.size(F.filter(parts, lambda t: ~t.rlike(r"^\d+$"))) <= 1
    sound = known & one_name & ((n <= 3) | timed)
    today = F.current_date()
    now = F.struct(F.year(today).alias("year"), F.month(today).alias("month"), F.day(today).alias("day"))
    date = F.when(n > 0, _date(parts)).when(clock["found"], now)
    hour, minute, second = (F.when(timed, two(at)).otherwise(clock[name]) for at, name in ((1, "hour"), (3, "minute"), (5, "second")))
    return F.when(sound, let(date, lambda d: _made(d["year"], d["month"], d["day"], hour, minute, second, clock["fraction"])))


def parse_timestamps(values: Column) -> Column:
    """parse_timestamp() of each text of an array."""
    return F.transform(values, lambda v: parse_timestamp(v))


def parse_timestamp(value: Column) -> Column:
    """Wall-clock time of a text in one of many forms, its zone dropped; null if unset, unknown or no such time.

    A time of day alone is of today, a date without a year is of the year 1. Words for the present, quarters and weeks
    are not read.
    """
    return let(cleaned(value), lambda text: F.when(~F.startswith(text, F.lit("0000")), F.coalesce(_six_numbers(text), _taken_apart(text))))
