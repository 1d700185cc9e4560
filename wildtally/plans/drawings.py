"""Charts as SVG text, drawn from the small tables behind them: no plotting library is needed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from html import escape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wildtally.operators import charts

INK, GRID, BAR, QUIET = "#202822", "#d9dfd8", "#1b5e3e", "#c98b2b"


def tag(name: str, inside: str = "", **attributes: object) -> str:
    told = "".join(f' {k.rstrip("_").replace("_", "-")}="{escape(str(v))}"' for k, v in attributes.items())
    return f"<{name}{told}>{inside}</{name}>" if inside else f"<{name}{told}/>"


def words(text: object, x: float, y: float, anchor: str = "start", fill: str = INK) -> str:
    return tag("text", escape(str(text)), x=round(x, 1), y=round(y, 1), text_anchor=anchor, fill=fill)


def sheet(title: str, width: int, height: int, parts: Iterable[str]) -> str:
    body = words(title, 8, 18) + "".join(parts)
    return tag("svg", body, xmlns="http://www.w3.org/2000/svg", viewBox=f"0 0 {width} {height}", font_family="sans-serif", font_size=12) + "\n"


def bars(totals: DataFrame) -> str:
    """Events of the labels seen most."""
    rows = charts.top_labels(totals, charts.TOP_BARS).select("species", "n_events").collect()
    most = max((r.n_events for r in rows), default=1)
    parts = []
    for k, r in enumerate(rows):
        y, long = 30 + 22 * k, 380 * r.n_events / most
        parts += [words(r.species, 190, y + 13, "end"), tag("rect", x=198, y=y, width=round(long, 1), height=16, fill=BAR), words(r.n_events, 204 + long, y + 13)]
    return sheet("Events by label", 640, 40 + 22 * len(rows), parts)


def panels(activity: DataFrame, totals: DataFrame) -> str:
    """Share of each label's events by hour, a panel for each of the labels seen most."""
    rows = charts.hour_shares(activity, totals).orderBy("species", "hour").collect()
    names = list(dict.fromkeys(r.species for r in rows))
    most = max((r.percent for r in rows), default=1.0) or 1.0
    place = {n: (20 + 210 * (k % 3), 40 + 120 * (k // 3)) for k, n in enumerate(names)}
    parts = [words(n, x, y + 4) for n, (x, y) in place.items()]
    for r in rows:
        x, y = place[r.species]
        high = 80 * r.percent / most
        parts.append(tag("rect", x=x + 8 * r.hour, y=round(y + 92 - high, 1), width=7, height=round(high, 1), fill=BAR))
    parts += [words(f"{h} h", x + 8 * h, y + 106) for x, y in place.values() for h in (0, 12)]
    return sheet("Activity by hour, percent of a label's events", 660, 50 + 120 * -(-len(names) // 3), parts)


def grid(title: str, rows: list[str], columns: list[str], value: Mapping[tuple[str, str], int], marked: frozenset = frozenset(), size: tuple[int, int] = (64, 22), shown: bool = True) -> str:
    """Cells shaded by their value; marked ones in another colour."""
    most, (wide, high) = max(value.values(), default=1), size
    parts = [words(r, 112, 64 + high * k + high * 0.7, "end") for k, r in enumerate(rows)]
    parts += [tag("g", words(c, 0, 0), transform=f"translate({124 + wide * k + wide / 2:g} 56) rotate(-30)") for k, c in enumerate(columns)]
    for i, r in enumerate(rows):
        for k, c in enumerate(columns):
            n = value.get((r, c), 0)
            fill = QUIET if (r, c) in marked else charts.ramp_colour(n, most)
            x, y = 120 + wide * k, 64 + high * i
            parts.append(tag("rect", x=x, y=y, width=wide - 1, height=high - 1, fill=fill))
            if shown:
                parts.append(words(n, x + wide / 2, y + high * 0.7, "middle", charts.text_on(fill)))
    return sheet(title, 160 + wide * len(columns), 80 + high * len(rows), parts)


def heat(by_camera: DataFrame, totals: DataFrame) -> str:
    cells = charts.species_camera_cells(by_camera, totals).collect()
    names = [r.species for r in charts.top_labels(totals, charts.TOP_COLUMNS).collect()]
    return grid("Events by camera and label", sorted({r.camera_id for r in cells}), names, {(r.camera_id, r.species): r.n_events for r in cells})


def uptime(daily: DataFrame, gaps: DataFrame) -> str:
    """Photos of each camera and day; days within a long silence are marked."""
    cells = charts.uptime_calendar(daily, gaps).select("camera_id", F.date_format("date", "yyyy-MM-dd").alias("day"), "n_photos", "silent").collect()
    marked = frozenset((r.camera_id, r.day) for r in cells if r.silent)
    value = {(r.camera_id, r.day): r.n_photos for r in cells}
    return grid("Photos by camera and day", sorted({r.camera_id for r in cells}), sorted({r.day for r in cells}), value, marked, (16, 18), False)


#: Names of the chart files (fixed values) and the summaries each is drawn from.
CHARTS = {
    "events_per_species": (bars, ("species_totals",)),
    "activity_by_hour": (panels, ("activity_by_hour", "species_totals")),
    "species_by_camera": (heat, ("species_by_camera", "species_totals")),
    "camera_uptime": (uptime, ("daily_photos", "camera_gaps")),
}


def all_charts(tables: Mapping[str, DataFrame]) -> dict[str, str]:
    return {name: draw(*[tables[t] for t in needs]) for name, (draw, needs) in CHARTS.items()}
