"""Personal data by fixed patterns and a skip-chain conditional random field.

The patterns give the base spans, which always stay. The field then labels every token with a digit or an @ as email,
ip, card, phone or none. Neighbouring tokens are joined in a chain, and skip edges join distant tokens that are equal
or alike (same letters and digits, same last digits, same local part of an address), each to the next one alike and
to the first one alike that a base span has of each kind, so edges grow with the tokens and a base span is one edge from
every mention in the document. Base tokens are observed; loopy message passing carries labels along the edges until no
message changes, and a token whose label then is sure gives a further span.

Weights of shapes, chain and skip edges are trained together by the slope of the field's likelihood, on the tokens of a
bounded sample of documents: the labels expected when a share of the base spans is hidden, less those expected when all
are seen, both by message passing. Of the hidden tokens half lose their shape too, so that edges must recover them.
Tokens that only a skip edge ties to a base span are left open in both, as they may well belong to it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wildtally.llm.shared import bounded_sample, over_batches, table

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)
#: Documents with tokens that the field is trained on, about; of their base spans the share that is hidden.
SAMPLE_DOCS, HIDDEN = 3_000, 0.5
#: Rounds of messages for each token at most, and the change of a message (log scale) that counts as none.
TURNS, SETTLED = 8, 1e-4
#: Rounds of messages in training, where a slope may be rough.
TRAIN_ROUNDS = 200

Span = tuple[str, int, int]

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A failed start within a run of digits fails at each later digit of it, so only its first is tried.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_MARK = re.compile(r"[0-9@]")
_TOKEN = re.compile(r"[^ \t\n\r\v\f]*")
_BLANK = " \t\n\r\v\f"


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[Span]:
    """Leftmost matches: the run of local characters before each @, if a domain follows."""
    free = 0
    at = text.find("@")
    while at >= 0:
        before = text[free:at]
        start = free + len(before.rstrip(_LOCAL))
        found = _DOMAIN.match(text, at + 1) if start < at else None
        free = found.end() if found else at + 1
        if found:
            yield "email", start, free
        at = text.find("@", free)


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns by start, then kind; offsets are code points, ends exclusive."""
    if not _MARK.search(text):
        return []
    spans = list(_emails(text)) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = m.group().replace(" ", "").replace("-", "")
            if 14 <= len(digits) <= 19 and luhn(digits):
                spans.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= sum(c.isdigit() for c in m.group()) <= 15:
                spans.append(("phone", m.start(), m.end()))
    return in_order(spans)


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def tokens(text: str) -> list[tuple[int, int]]:
    """Runs without white space that hold a digit or an @."""
    found, end = [], 0
    for m in _MARK.finditer(text):
        at = m.start()
        if at < end:
            continue
        start = end + max(text[end:at].rfind(c) for c in _BLANK) + 1
        end = _TOKEN.match(text, at).end()
        found.append((start, end))
    return found


def shape(token: str) -> str:
    """Digits as 9 with the length of their run up to 5, letters as a, others as they are; behind it the number of digits up to 20, and whether they pass Luhn if there are 14 to 19."""
    digits = "".join(c for c in token if "0" <= c <= "9")
    out = re.sub(r"[0-9]+", lambda m: "9" * min(5, len(m.group())), token)
    return f"{re.sub(r'[^\W\d_]+', 'a', out)}|{min(20, len(digits))}{'v' if 14 <= len(digits) <= 19 and luhn(digits) else ''}"


def _named(kind: str, value: str) -> str:
    """A key of bounded length that only equal values share."""
    return kind + (value if len(value) <= 40 else blake2b(value.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest())


def alike_keys(token: str) -> list[str]:
    """Tokens that share a key are joined by skip edges."""
    plain = re.sub(r"[\W_]+", "", token).lower()
    keys = [_named("w", plain)] if plain else []
    digits = re.sub(r"[^0-9]", "", token)
    if len(digits) >= 7:
        keys.append("d" + digits[-7:])
    local, mark, _ = token.lower().partition("@")
    if mark and len(local) >= 3:
        keys.append(_named("l", local.strip("<(\"'")))
    return keys


def features(pattern: str) -> list[str]:
    body, _, digits = pattern.rpartition("|")
    ends = f"^{body}$"
    counts = [f"n{c}{min(4, ends.count(c))}" for c in "9a.@-()+"]
    return [_named("=", pattern), f"d{digits}", *counts, *sorted({f"~{ends[k : k + 3]}" for k in range(len(ends) - 2)})]


@dataclass
class Graph:
    """One document's tokens, what the base spans say of them (-1: nothing), and the edges between them."""

    spans: list[tuple[int, int]]
    shapes: list[str]
    observed: np.ndarray
    chain: list[tuple[int, int]]
    skip: list[tuple[int, int]]
    #: Skip edges to observed tokens further away; training counts the others only, so a value said often weighs no more.
    far: list[tuple[int, int]] = field(default_factory=list)


def graph(text: str, base: list[Span]) -> Graph:
    spans, at = tokens(text), 0
    observed, last = np.full(len(spans), -1), {}
    chain, skip, shapes, keys = [], [], [], []
    first: dict[tuple[str, int], int] = {}  # observed token of a key and label
    cover = sorted((a, b, LABELS.index(k)) for k, a, b in base)
    for n, (a, b) in enumerate(spans):
        while at < len(cover) and cover[at][1] <= a:
            at += 1
        if at < len(cover) and cover[at][0] < b:
            observed[n] = cover[at][2]
        token = text[a:b]
        shapes.append(shape(token))
        if n and a - spans[n - 1][1] <= 2:
            chain.append((n - 1, n))
        keys.append(alike_keys(token))
        for key in keys[-1]:
            if key in last:
                skip.append((last[key], n))
            last[key] = n
            if observed[n] >= 0:
                first.setdefault((key, int(observed[n])), n)
    skip = dict.fromkeys(skip)
    far: dict[tuple[int, int], None] = {}
    for n in np.flatnonzero(observed < 0).tolist() if first else []:
        ends = {first[key, y] for key in keys[n] for y in range(len(LABELS)) if (key, y) in first}
        far.update(dict.fromkeys(e for m in sorted(ends) if (e := (min(m, n), max(m, n))) not in skip))
    return Graph(spans, shapes, observed, chain, list(skip), list(far))


def told(g: Graph) -> np.ndarray:
    """Which tokens teach what they are: not those that only skip edges tie to a base span, which may well belong to it."""
    tied = g.observed >= 0
    for i, j in [*g.skip, *reversed(g.skip)]:
        tied[i] = tied[j] = tied[i] or tied[j]
    return ~tied | (g.observed >= 0)


def passed(own: np.ndarray, a: np.ndarray, b: np.ndarray, pair: np.ndarray, rounds: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Log beliefs of all nodes, and messages (along the edges, then against them), after loopy message passing, damped and until no message changes.

    All messages are passed at once at first; then those whose sender has heard something new, so what a base span
    says reaches the far end of a long chain at the cost of the few messages under way. TURNS for each node bound the
    rounds, unless a number is given: damped by one half, news takes about two an edge.
    """
    into, out = np.concatenate([b, a]), np.concatenate([a, b])  # message k goes from out[k] to into[k]
    both = np.concatenate([pair, pair.transpose(0, 2, 1)])
    back = np.r_[len(a) : 2 * len(a), 0 : len(a)]
    message, belief = np.zeros((2 * len(a), own.shape[1])), own.copy()
    live = every = np.arange(2 * len(a))
    for _ in range((rounds or 100 + TURNS * len(own)) if len(a) else 0):
        given = belief[out[live]] - message[back[live]]
        new = np.logaddexp.reduce(given[:, :, None] + both[live], axis=1)
        step = 0.5 * (new - np.logaddexp.reduce(new, axis=1, keepdims=True) - message[live])
        message[live] += step
        np.add.at(belief, into[live], step)
        changed = live[np.abs(step).max(axis=1) > SETTLED]
        if len(changed):
            heard = np.zeros(len(own), bool)
            heard[into[changed]] = True
            again = heard[out]
            again[changed] = True
            live = np.flatnonzero(again)
        elif len(live) < len(every):
            live = every  # all once more, in case small changes have added up
        else:
            break
    return belief, message


def clamped(own: np.ndarray, observed: np.ndarray) -> np.ndarray:
    """Potentials with what is observed (-1: nothing)."""
    own, seen = own.copy(), observed >= 0
    own[seen] = -30.0
    own[seen, observed[seen]] = 0.0
    return own


def shares(log: np.ndarray) -> np.ndarray:
    """Probabilities from log potentials of each row (over all its other axes)."""
    flat = log.reshape(len(log), -1)
    return np.exp(flat - np.logaddexp.reduce(flat, axis=1, keepdims=True)).reshape(log.shape)


@dataclass(frozen=True)
class Field:
    """Log potentials: of features (rows of `weights`, the last one of any token), of labels met in a chain, of labels joined by a skip edge."""

    index: dict[str, int]
    weights: np.ndarray
    chain: np.ndarray
    skip: np.ndarray

    def unary(self, shapes: list[str]) -> np.ndarray:
        memo: dict[str, np.ndarray] = {}
        for s in set(shapes):
            known = [self.index[f] for f in features(s) if f in self.index]
            memo[s] = self.weights[known].sum(axis=0) + self.weights[-1]
        return np.array([memo[s] for s in shapes]).reshape(len(shapes), len(LABELS))

    def marginals(self, g: Graph) -> np.ndarray:
        """Label probabilities of all tokens."""
        alike = g.skip + g.far
        a, b = (np.array([e[k] for e in g.chain + alike], np.int64) for k in (0, 1))
        pair = np.concatenate([np.repeat(self.chain[None], len(g.chain), 0), np.repeat(self.skip[None], len(alike), 0)])
        return shares(passed(clamped(self.unary(g.shapes), g.observed), a, b, pair)[0])


def train(graphs: list[Graph], turns: int = 200, seed: int = 3) -> Field:
    """The field of all graphs at once; each turn follows the slope once (AdaGrad)."""
    size = len(LABELS)
    start = np.cumsum([0, *(len(g.shapes) for g in graphs)])
    shapes = [s for g in graphs for s in g.shapes]
    full = np.concatenate([np.where(told(g), np.maximum(g.observed, 0), -1) for g in graphs] or [np.empty(0, np.int64)])
    luck = np.random.default_rng(seed)
    hidden = luck.random(len(full)) < HIDDEN
    chains, skips = ([(i + o, j + o) for g, o in zip(graphs, start, strict=False) for i, j in edges(g)] for edges in (lambda g: g.chain, lambda g: g.skip))
    for _ in range(8):  # neighbours of one kind are one span, hidden as one
        for i, j in chains:
            if full[i] == full[j] > 0:
                hidden[j] = hidden[i]
    seen = np.where(hidden | (full == 0), -1, full)
    bare = hidden & (full > 0) & (luck.random(len(full)) < 0.5)
    patterns = {s: k for k, s in enumerate(dict.fromkeys(shapes))}
    index: dict[str, int] = {}
    rows = [[index.setdefault(f, len(index)) for f in features(s)] for s in patterns]
    flat, of = np.array([f for r in rows for f in r], np.int64), np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    which = np.where(bare, len(patterns), np.array([patterns[s] for s in shapes], np.int64)) if shapes else np.empty(0, np.int64)
    a, b = (np.array([e[k] for e in chains + skips], np.int64) for k in (0, 1))
    weights, chain, skip = np.zeros((len(index) + 1, size)), np.eye(size) * 0.5, np.eye(size) * 0.5
    speed = [np.full_like(x, 1e-6) for x in (weights, chain, skip)]
    for _ in range(turns if len(full) else 0):
        score = np.stack([np.bincount(of, weights[flat, y], len(patterns) + 1) for y in range(size)], axis=1) + weights[-1]
        pair = np.concatenate([np.repeat(chain[None], len(chains), 0), np.repeat(skip[None], len(skips), 0)])
        slopes = [np.zeros_like(x) for x in (weights, chain, skip)]
        for sign, observed in ((1, seen), (-1, full)):
            belief, message = passed(clamped(score[which], observed), a, b, pair, TRAIN_ROUNDS)
            p = shares(belief)
            by = np.stack([np.bincount(which, p[:, y], len(patterns) + 1) for y in range(size)], axis=1)
            slopes[0][:-1] += sign * np.stack([np.bincount(flat, by[of, y], len(index)) for y in range(size)], axis=1)
            slopes[0][-1] += sign * by.sum(axis=0)
            n = len(a)
            met = shares((belief[a] - message[n:])[:, :, None] + (belief[b] - message[:n])[:, None, :] + pair)
            slopes[1] += sign * met[: len(chains)].sum(axis=0)
            slopes[2] += sign * met[len(chains) :].sum(axis=0)
        slopes[2] = slopes[2] + slopes[2].T
        for x, slope, fast in zip((weights, chain, skip), slopes, speed, strict=True):
            slope = slope / len(full) + 1e-6 * x
            fast += slope**2
            x -= 0.3 * slope / np.sqrt(fast)
    return Field(index, weights, chain, skip)


def learn(docs: DataFrame, text_col: str = "text") -> Field:
    """The field of a bounded sample of the documents that have tokens; none give a field that adds nothing but what edges say."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [graph(t, base_spans(t)) for t in batch.column(0).to_pylist()]
            edges = lambda es: [n for e in es for n in e]
            columns = [[g.shapes for g in found], [g.observed.tolist() for g in found], [edges(g.chain) for g in found], [edges(g.skip) for g in found]]
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.record_batch([pa.array(c, pa.list_(k)) for c, k in zip(columns, kinds, strict=True)], names=["shapes", "observed", "chain", "skip"])

    marked = docs.select(text_col).filter(F.col(text_col).rlike("[0-9@]"))
    chosen = bounded_sample(marked, SAMPLE_DOCS, text_col)
    rows = chosen.mapInArrow(over_batches(work), "shapes array<string>, observed array<bigint>, chain array<bigint>, skip array<bigint>")
    pairs = lambda x: list(zip(x[::2], x[1::2], strict=True))
    graphs = [Graph([], list(r.shapes), np.array(r.observed, np.int64), pairs(r.chain), pairs(r.skip)) for r in rows.collect()]
    return train(sorted(graphs, key=lambda g: (g.shapes, g.observed.tolist())))


def all_spans(text: str, field: Field, sure: float = 0.8) -> tuple[list[Span], list[Span]]:
    """Base spans, and these with the field's: sure tokens that no base span touches, side by side ones as one."""
    base = base_spans(text)
    g = graph(text, base) if _MARK.search(text) else None
    if g is None or not (g.observed < 0).any():
        return base, base
    p = field.marginals(g)
    best = p.argmax(axis=1)
    added: list[Span] = []
    beside = {j: i for i, j in g.chain}
    joined = -1
    for n in np.flatnonzero((best > 0) & (g.observed < 0) & (p.max(axis=1) >= sure)).tolist():
        a, b = g.spans[n]
        core = text[a:b].strip(".,;:!?\"'<>[]{}")
        if not core:
            continue
        a = text.index(core, a)
        kind = LABELS[best[n]]
        piece = kind == "phone" or kind == "card" and sum(c.isdigit() for c in core) < 14  # a whole card is a span of its own
        if added and joined >= 0 and beside.get(n) == joined and added[-1][0] == kind and piece:
            added[-1] = (kind, added[-1][1], a + len(core))
        else:
            added.append((kind, a, a + len(core)))
        joined = n
    return base, in_order(base + added)


def find_personal_data(docs: DataFrame, field: Field, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, base (array of kind, start, end), spans (base and added) of every whole text.

    A null or empty text has none. Rows stay one for one, repeated ids too; other columns are left out.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    as_rows = lambda spans: [{"kind": k, "start": a, "end": b} for k, a, b in spans]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = [all_spans(t or "", field) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), *(pa.array([as_rows(x[k]) for x in both], span) for k in (0, 1))]
            yield pa.record_batch(columns, names=[id_col, "base", "spans"])

    sql = "array<struct<kind:string,start:bigint,end:bigint>>"
    return docs.select(id_col, text_col).mapInArrow(over_batches(work), f"`{id_col}` {kind}, base {sql}, spans {sql}")


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span (the first of those that overlap) put as its kind in angle brackets."""
    out, at = [], 0
    for kind, a, b in spans:
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
        at = max(at, b)
    return "".join([*out, text[at:]])


def mask_personal_data(docs: DataFrame, field: Field, text_col: str = "text") -> DataFrame:
    """All rows and columns of `docs`, personal data in the text masked; a null text stays null."""

    @F.pandas_udf("string")
    def mask(text):  # noqa: ANN001, ANN202
        return text.map(lambda t: None if t is None else masked(t, all_spans(t, field)[1]))

    return docs.withColumn(text_col, mask(F.col(text_col)))


def op3_pii_skip_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: counts and digest of the base spans, and all spans.

    A null or empty text has none. Spans that begin together come in the order of their kinds. Repeated rows and rows
    without an id stay. An empty table gives no rows. Other columns are not looked at; texts of any length are read whole.
    """
    docs = table(spark, sf_dir, "documents")
    found = find_personal_data(docs, learn(docs))
    of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    text = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    return found.select("doc_id", *map(of, KINDS), F.sha2(text("base"), 256).alias("base_sha256"), text("spans").alias("spans"))
