"""How far a run is: a list of what happened to its stages, the last entry of a stage being its state."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from typing import Any

from wildtally.errors import InputError
from wildtally.storage import Files

#: The seven stages in their order, the tables and files of each, and its states (fixed values).
OUTPUTS = {
    "ingest": ("media.parquet",),
    "quality": ("quality.parquet", "records/quality"),
    "detect": ("detections.parquet", "detection_runs.parquet", "records/detect"),
    "classify": ("classifications.parquet", "records/classify"),
    "events": ("photos.parquet", "events.parquet", "event_species.parquet"),
    "summarize": ("summary",),
    "report": ("report.html", "plots"),
}
PENDING, BEGUN, DONE = "pending", "incomplete", "done"


def history(files: Files, path: str) -> list[dict[str, Any]]:
    files.recover(path)
    return json.loads(files.text(path)) if files.exists(path) else []


def enter(files: Files, path: str, entries: Iterable[tuple[str, str, Mapping[str, Any]]]) -> None:
    """Adds entries (stage, state, figures), all at once."""
    added = [{"stage": stage, "state": state, "figures": dict(figures)} for stage, state, figures in entries]
    known(e["stage"] for e in added)
    files.write_json(path, history(files, path) + added)


def known(stages: Iterable[str]) -> list[str]:
    """The stages in their order; InputError if one isn't a stage."""
    named = set(stages)
    if strange := named - OUTPUTS.keys():
        raise InputError(f"unknown stages {sorted(strange)}")
    return [s for s in OUTPUTS if s in named]


def standing(files: Files, path: str) -> dict[str, tuple[str, dict[str, Any]]]:
    """Of every stage its state and figures."""
    last = {e["stage"]: (e["state"], e["figures"]) for e in history(files, path)}
    return {stage: last.get(stage, (PENDING, {})) for stage in OUTPUTS}


def lines(files: Files, path: str) -> list[str]:
    """The states as text, a line for each stage."""
    return [f"{stage:10} {state:10} {', '.join(f'{k} {v}' for k, v in figures.items())}".rstrip() for stage, (state, figures) in standing(files, path).items()]
