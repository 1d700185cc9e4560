"""Command line: run, status, publish, fetch-sample, grade. Exit codes: 0 good, 1 a check failed, 2 bad input, 3 a package is missing."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable, Sequence
from typing import Any

from wildtally.errors import InputError, ModelDependencyError
from wildtally.settings import OPTIONS, Settings, parsed


def of_kind(kind: str) -> Callable[[str], Any]:
    def check(text: str) -> Any:
        try:
            return parsed(kind, text)
        except ValueError as error:
            raise argparse.ArgumentTypeError(str(error)) from error

    return check


#: Commands: what they do, and their arguments (name, kind, default; no default: required). Names and defaults are fixed values.
COMMANDS: dict[str, tuple[str, tuple[tuple[str, str, Any], ...]]] = {
    "run": ("run all stages over a photo folder", (("input", "text", ...), ("--out", "text", ...))),
    "status": ("show how far a run is", (("out", "text", ...),)),
    "grade": ("hold a run against the truth of its survey", (("input", "text", ...), ("--out", "text", ...))),
    "publish": ("copy a run's report, charts and summaries", (("out", "text", ...), ("--to", "text", ...))),
    "fetch-sample": ("download a few sequences of a public survey", (("out", "text", ...), ("--cameras", "count", 3), ("--photos", "count", 100), ("--seed", "whole", 7))),
}


def build_parser() -> argparse.ArgumentParser:
    from wildtally.plans.pipeline import library_version

    parser = argparse.ArgumentParser(prog="wildtally")
    parser.add_argument("--version", action="version", version=library_version())
    commands = parser.add_subparsers(dest="command", required=True)
    for name, (says, arguments) in COMMANDS.items():
        own = commands.add_parser(name, help=says)
        for argument, kind, default in arguments:
            given = {} if not argument.startswith("-") else {"required": True} if default is ... else {"default": default}
            own.add_argument(argument, type=of_kind(kind), **given)
        if name == "run":
            own.add_argument("--redo", action="append", default=[])
            for o in OPTIONS:
                if o.flag:
                    own.add_argument(o.flag, dest=o.name, type=of_kind(o.kind), default=o.default, help=o.says)
    return parser


def _run(args: argparse.Namespace) -> int:
    from wildtally.plans.pipeline import Pipeline
    from wildtally.session import spark_session

    told = Settings(**{o.name: getattr(args, o.name) for o in OPTIONS if o.flag})
    print(*Pipeline(spark_session(), args.input, args.out, told).run(args.redo), sep="\n")
    return 0


def _status(args: argparse.Namespace) -> int:
    from wildtally.plans import ledger
    from wildtally.session import spark_session
    from wildtally.storage import Files, located

    files, path = Files(spark_session()), f"{located(args.out)}/status.json"
    files.recover(path)
    if not files.exists(path):
        raise InputError(f"{args.out} holds no run")
    print(*ledger.lines(files, path), sep="\n")
    return 0


def _grade(args: argparse.Namespace) -> int:
    from wildtally.plans.grading import graded
    from wildtally.session import spark_session
    from wildtally.storage import located

    checks = graded(spark_session(), located(args.input), located(args.out)).collect()
    print(*(f"{'ok  ' if c.passed else 'FAIL'} {c.name}: {c.good} of {c.total}" for c in checks), sep="\n")
    return 0 if all(c.passed for c in checks) else 1


def _publish(args: argparse.Namespace) -> int:
    from wildtally.session import spark_session
    from wildtally.sources.tables import publish
    from wildtally.storage import located

    print(*publish(spark_session(), located(args.out), located(args.to)), sep="\n")
    return 0


def _fetch_sample(args: argparse.Namespace) -> int:
    from wildtally.session import spark_session
    from wildtally.sources import sample

    print(sample.fetch_sample(spark_session(), args.out, args.cameras, args.photos, args.seed), "photos")
    return 0


def main(argv: Sequence[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    try:
        return {"run": _run, "status": _status, "grade": _grade, "publish": _publish, "fetch-sample": _fetch_sample}[args.command](args)
    except InputError as error:
        print(f"error: {error}", file=sys.stderr)
        return 2
    except ModelDependencyError as error:
        print(f"error: {error}", file=sys.stderr)
        return 3


if __name__ == "__main__":
    sys.exit(main())
