"""The HTML report: figures, tables, charts and how it was made. The same tables give the same text."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from html import escape

from pyspark.sql import DataFrame

from wildtally.operators import charts
from wildtally.plans import drawings

#: What the tables hold.
CONTENT = {
    "media": "photos found, with camera, clock and file", "quality": "sharpness, light and near-duplicates of each photo",
    "detections": "boxes of each photo", "detection_runs": "photos that the detector has seen", "classifications": "labels of boxes",
    "photos": "photos with all that is known of them", "events": "photos close in time, as one sighting", "event_species": "labels of each event",
}


def cell(value: object) -> str:
    if value is None:
        return "–"
    if isinstance(value, bool):
        return "yes" if value else "no"
    if isinstance(value, int):
        return f"{value:,}"
    if isinstance(value, float):
        return f"{value:,.1f}" if abs(value) >= 10 else f"{value:.2f}"
    return escape(str(value))


def rows_table(columns: Iterable[str], rows: Iterable[Iterable[object]]) -> str:
    head = "".join(f"<th>{escape(c.replace('_', ' '))}</th>" for c in columns)
    body = "".join("<tr>" + "".join(f"<td{' class=n' if isinstance(v, (int, float)) else ''}>{cell(v)}</td>" for v in r) + "</tr>" for r in rows)
    return f"<table><thead><tr>{head}</tr></thead><tbody>{body}</tbody></table>" if body else "<p>None.</p>"


def html_table(df: DataFrame) -> str:
    """All rows of the table."""
    return rows_table(df.columns, df.collect())


def heat_rows(grid: DataFrame) -> str:
    """The hour grid as coloured cells."""
    rows = grid.orderBy("species").collect()
    most = max((v for r in rows for v in r[1:]), default=0)
    shade = lambda v: charts.ramp_colour(v, most)
    line = lambda r: f"<tr><th>{escape(r[0])}</th>" + "".join(f'<td style="background:{shade(v)};color:{charts.text_on(shade(v))}">{v}</td>' for v in r[1:]) + "</tr>"
    return f"<table>{''.join(map(line, rows))}</table>"


def render(title: str, figures: Mapping[str, object], tables: Mapping[str, DataFrame], events: DataFrame, rows: Mapping[str, int], config: Mapping) -> str:
    """`tables` are the ordered summaries, `rows` the length of each table of the run, `config` its version and settings."""
    tiles = "".join(f"<li><b>{cell(v)}</b> {escape(k.replace('_', ' '))}</li>" for k, v in figures.items())
    shown = {
        "Species": html_table(tables["species_totals"]),
        "Activity by hour": heat_rows(charts.hour_grid(tables["activity_by_hour"])),
        "Species by camera": html_table(tables["species_by_camera"]),
        "Cameras": html_table(tables["camera_health"]),
        "Long silences": html_table(tables["camera_gaps"]),
        "Largest sightings": html_table(charts.largest_sightings(events)),
        "Charts": "".join(drawings.all_charts(tables).values()),
        "Tables of this run": rows_table(("table", "rows", "content"), [(n, rows[n], CONTENT[n]) for n in CONTENT if n in rows]),
        "How it was made": rows_table(("setting", "value"), [("version", config.get("version")), *config.get("settings", {}).items()]),
    }
    sections = "".join(f"<h2>{escape(name)}</h2>{body}" for name, body in shown.items())
    return f"<!doctype html><html lang=en><meta charset=utf-8><title>{escape(title)}</title><h1>{escape(title)}</h1><ul>{tiles}</ul>{sections}</html>\n"
