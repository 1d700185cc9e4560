"""URL filters by a bit-parallel wildcard automaton.

All glob rules are packed side by side into the bits of a few 64-bit words, one bit for each symbol of a rule. One pass
over a canonical URL moves every rule at once: states shift to the next bit where the symbol fits (Shift-And), and a
state before a `*` stays alive on any symbol. Many URLs are simulated together, one row of words each.

The canonical form of a URL is a dot, its host, a separator outside the byte alphabet, and its path, so that a rule on
a host also covers its subdomains and can't begin inside a path.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from wildtally.llm.shared import over_batches, table

#: Symbols: the 256 bytes, and what stands between host and path.
BETWEEN = 256
STAR = -1


@dataclass(frozen=True)
class SiteRule:
    """Fits its host and all subdomains where the path starts with `path`."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path

    def symbols(self) -> list[int]:
        return [STAR, *f".{self.host}".encode(), BETWEEN, *self.path.encode(), STAR]


#: The rules of the contract (fixed values).
SITE_RULES = (
    SiteRule("allow", "com", "/"),
    SiteRule("block", "example.com", "/en/"),
    SiteRule("allow", "www.example.com", "/en/"),
    SiteRule("block", "net", "/es/"),
    SiteRule("block", "net", "/fr/"),
)
#: Globs on host|path that block where no site rule fits (`*` is any run of symbols, `|` the separator, which a `*` may span).
SPAM_GLOBS = ("*.cheap-pills.*|*", "*.casino-*|*", "*.free-bets.*|*", "*.spam-farm.*|*", "*.adult-*|*", "*.ads-*|*", "*.ads.*|*", "*|*/adclick/*", "*|*/doubleclick/*")


def glob_symbols(glob: str) -> list[int]:
    """Symbols of a glob: `*` any run, the first `|` the separator, all else itself."""
    host, bar, path = glob.partition("|")
    known = lambda text: [STAR if c == 42 else c for c in text.encode()]
    return [*known(host), *[BETWEEN] * len(bar), *known(path)]


class ShiftAnd:
    """All patterns (lists of symbols and STARs) in one multiword automaton; a pattern must fit the whole URL."""

    def __init__(self, patterns: Sequence[Sequence[int]]) -> None:
        bits = sum(1 + sum(x != STAR for x in p) for p in patterns)
        self.words = max(1, -(-bits // 64))
        one = lambda at: (at // 64, np.uint64(1) << np.uint64(at % 64))
        self.accepts = np.zeros((BETWEEN + 1, self.words), np.uint64)  # by symbol: states it may enter
        self.starts, self.stays = np.zeros(self.words, np.uint64), np.zeros(self.words, np.uint64)
        self.ends: list[tuple[int, np.uint64]] = []
        at = 0
        for p in patterns:
            for k in range(len(p) + 1):  # the state before p's next symbol is bit `at`
                if k == 0:
                    w, m = one(at)
                    self.starts[w] |= m
                if k == len(p):
                    break
                w, m = one(at)
                if p[k] == STAR:
                    self.stays[w] |= m
                else:
                    at += 1
                    w, m = one(at)
                    self.accepts[p[k], w] |= m
            self.ends.append(one(at))
            at += 1

    def fits(self, urls: Sequence[Sequence[int]]) -> np.ndarray:
        """[url, pattern]: whether the pattern fits the whole of the URL."""
        order = np.argsort([-len(u) for u in urls], kind="stable")
        size = np.array([len(urls[k]) for k in order], np.int64)
        state = np.tile(self.starts, (len(urls), 1))
        flat = np.concatenate([np.asarray(urls[k], np.int64) for k in order]) if len(urls) else np.empty(0, np.int64)
        first = np.cumsum(np.r_[0, size[:-1]]) if len(urls) else size
        for t in range(int(size.max(initial=0))):
            live = int(np.searchsorted(-size, -t, "left"))  # URLs longer than t come first
            d = state[:live]
            moved = d << np.uint64(1)
            moved[:, 1:] |= d[:, :-1] >> np.uint64(63)
            state[:live] = moved & self.accepts[flat[first[:live] + t]] | d & self.stays
        out = np.empty((len(urls), len(self.ends)), bool)
        for k, (w, m) in enumerate(self.ends):
            out[order, k] = state[:, w] & m != 0
        return out


def host_and_path(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no `://`."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((k for c in "?#" if (k := rest.find(c)) >= 0), default=len(rest))
    rest = rest[:end]
    host, slash, path = rest.partition("/")
    return host.translate(LOWER), slash + path


#: A-Z to a-z and nothing else.
LOWER = {c: c + 32 for c in range(65, 91)}


def judge(pages: DataFrame, rules: Sequence[SiteRule] = SITE_RULES, globs: Sequence[str] = SPAM_GLOBS, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict of every row.

    The longest site rule that fits (host and path counted together; of equally long ones the first listed) gives rule
    and verdict. Else rule is null and the verdict is block if one of the globs fits, allow if none does. A null or
    malformed URL has an empty host and path, fits no rule and is allowed. Repeated rows stay.
    """
    ranked = sorted(rules, key=lambda r: -len(r.name))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = ShiftAnd([*[r.symbols() for r in ranked], *map(glob_symbols, globs)])
        for batch in batches:
            parts = [host_and_path(u) for u in batch.column(1).to_pylist()]
            fits = automaton.fits([[46, *h.encode(), BETWEEN, *p.encode()] for h, p in parts])
            own, other = fits[:, : len(ranked)], fits[:, len(ranked) :].any(axis=1)
            best = np.where(own.any(axis=1), own.argmax(axis=1), -1) if ranked else np.full(len(parts), -1)
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array([h for h, _ in parts], pa.string()),
                    pa.array([p for _, p in parts], pa.string()),
                    pa.array([ranked[k].name if k >= 0 else None for k in best], pa.string()),
                    pa.array([ranked[k].verdict if k >= 0 else "block" if x else "allow" for k, x in zip(best, other, strict=True)], pa.string()),
                ],
                names=[id_col, "host", "path", "rule", "verdict"],
            )

    kind = pages.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, host string, path string, rule string, verdict string"
    return pages.select(id_col, url_col).mapInArrow(over_batches(work, 4096), schema)


def op6_url_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's url.

    A null, empty or malformed url has an empty host and path and is allowed. Of equally long rules the first listed
    counts. Repeated rows and rows without an id stay; an empty table gives no rows; other columns are not looked at.
    """
    return judge(table(spark, sf_dir, "pages"))


#: DuckDB's lower() is Unicode-wide, so A-Z alone are translated.
OP6_SQL = """
WITH cut AS (
  SELECT page_id, CASE WHEN url IS NOT NULL AND instr(url, '://') > 0
    THEN split_part(split_part(substr(url, instr(url, '://') + 3), '?', 1), '#', 1) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(CASE WHEN instr(rest, '/') > 0 THEN substr(rest, 1, instr(rest, '/') - 1) ELSE rest END,
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN instr(rest, '/') > 0 THEN substr(rest, instr(rest, '/')) ELSE '' END AS path FROM cut
), ruled AS (
  SELECT *, CASE
    WHEN ends_with('.' || host, '.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN ends_with('.' || host, '.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN ends_with('.' || host, '.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN ends_with('.' || host, '.com') AND starts_with(path, '/') THEN 'com/' END AS rule FROM parts
)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
  WHEN contains('.' || host, '.cheap-pills.') OR contains('.' || host, '.casino-') OR contains('.' || host, '.free-bets.')
    OR contains('.' || host, '.spam-farm.') OR contains('.' || host, '.adult-') OR contains('.' || host, '.ads-')
    OR contains('.' || host, '.ads.') OR contains(path, '/adclick/') OR contains(path, '/doubleclick/')
  THEN 'block' ELSE 'allow' END AS verdict FROM ruled
"""
