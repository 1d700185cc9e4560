"""Conversation structure repair: the cheapest edits that make the roles of a conversation `(s?(ua)+)?`.

A dynamic program over turns. A step is one macro edit: a run of at most two inserted turns (more only repeat a state)
and then what happens to the turn itself (keep, rerole, delete). Macro edits are words of a prefix-free code, `D`, `ID`,
`IID`, ..., in ASCII order, so two audits of equally many steps compare as their lists of code numbers do, and no audit
text is carried along: a layer has, for each state (the role that stands last), its cost, its rank among the layer's
states and a pointer to the state before. The audit is put together afterward by following the pointers.

Rows are dealt out by ranges of (conversation, turn), so a conversation of any length is cut into pieces that no task has
to hold together. A piece is summed up by costs and ranks from each state before it to each state behind it; the pieces'
sums are put one behind the other, which gives the state at each border, and every piece then finds its own part of the
audit. Only the digest of a whole repaired conversation, which is sequential, reads its rows in one task, as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wildtally.llm.shared import over_batches, remove, stored, table

#: Costs of edits (fixed values); a truncated turn that stays costs one more.
INSERT, REROLE, DELETE, CUT_SHORT = 2, 2, 3, 1
#: The role that stands last: none, system, user, assistant.
NONE, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
#: Macro edits in ASCII order.
CODES = sorted("I" * n + edit for n in range(3) for edit in "DKR")
FAR = 1 << 40

#: A turn as the program sees it: the initial of its role (x: any other), in upper case if it is truncated; D if it must go.
SYMBOLS = "suaxSUAXD"


def following(state: int) -> int:
    """The role that an inserted or reroled turn takes."""
    return ASSISTANT if state == USER else USER


def _moves(symbol: str) -> list[list[tuple[int, int, int]]]:
    """For each state the (code, cost, next state) of all macro edits."""
    out = []
    for state in range(4):
        own, at = [], state
        for run in range(3):
            at = following(at) if run else at
            paid, late = run * INSERT, CUT_SHORT * symbol.isupper()
            own.append((CODES.index("I" * run + "D"), paid + DELETE, at))
            if symbol != "D":
                own.append((CODES.index("I" * run + "R"), paid + REROLE + late, following(at)))
                kept = {"s": SYSTEM if at == NONE else None, "u": USER if at != USER else None, "a": ASSISTANT if at == USER else None}.get(symbol.lower())
                if kept is not None:
                    own.append((CODES.index("I" * run + "K"), paid + late, kept))
        out.append(own)
    return out


MOVES = {symbol: _moves(symbol) for symbol in SYMBOLS}
#: For each state what has to follow behind the last turn, and its cost.
TAILS = (("", 0), ("II", 2 * INSERT), ("I", INSERT), ("", 0))


@dataclass
class Layer:
    """Costs and ranks of the states; rank orders the audits that lead there."""

    cost: list[int] = field(default_factory=lambda: [FAR] * 4)
    rank: list[int] = field(default_factory=lambda: [0] * 4)


def entered(state: int) -> Layer:
    layer = Layer()
    layer.cost[state] = 0
    return layer


def step(layer: Layer, symbol: str) -> tuple[Layer, list[int], list[int]]:
    """The next layer, and for each of its states the state before and the code of the edit."""
    best: list[tuple[int, int, int, int] | None] = [None] * 4
    for state in range(4):
        if layer.cost[state] >= FAR:
            continue
        for code, paid, to in MOVES[symbol][state]:
            told = layer.cost[state] + paid, layer.rank[state], code, state
            if best[to] is None or told < best[to]:
                best[to] = told
    new, before, codes = Layer(), [0] * 4, [0] * 4
    for rank, to in enumerate(sorted((s for s in range(4) if best[s]), key=lambda s: best[s][1:3])):
        new.cost[to], new.rank[to] = best[to][0], rank
        codes[to], before[to] = best[to][2], best[to][3]
    return new, before, codes


def summed(symbols: str) -> tuple[list[int], list[int]]:
    """Costs and ranks of a piece from each state before it (4) to each behind it (4), one list behind the other."""
    costs, ranks = [], []
    for state in range(4):
        layer = entered(state)
        for symbol in symbols:
            layer = step(layer, symbol)[0]
        costs += layer.cost
        ranks += layer.rank
    return costs, ranks


def traced(symbols: str, enter: int, leave: int) -> str:
    """The least cheapest audit of a piece between two states, without what follows behind the last turn."""
    layer, pointers = entered(enter), bytearray()
    for symbol in symbols:
        layer, before, codes = step(layer, symbol)
        pointers += bytes(b << 4 | c for b, c in zip(before, codes, strict=True))
    found, state = [], leave
    for at in range(len(symbols) - 1, -1, -1):
        pointer = pointers[4 * at + state]
        found.append(CODES[pointer & 15])
        state = pointer >> 4
    return "".join(reversed(found))


def joined(pieces: list[tuple[list[int], list[int]]]) -> tuple[int, list[tuple[int, int]], str]:
    """Cost, the states before and behind each piece, and what follows behind the last turn."""
    layer, pointers = entered(NONE), []
    for costs, ranks in pieces:
        best: list[tuple[int, int, int, int] | None] = [None] * 4
        for i in range(4):
            for j in range(4):
                told = layer.cost[i] + costs[4 * i + j], layer.rank[i], ranks[4 * i + j], i
                if told[0] < FAR and (best[j] is None or told < best[j]):
                    best[j] = told
        layer = Layer()
        for rank, j in enumerate(sorted((s for s in range(4) if best[s]), key=lambda s: best[s][1:3])):
            layer.cost[j], layer.rank[j] = best[j][0], rank
        pointers.append([b[3] if b else 0 for b in best])
    cost, _, state = min((layer.cost[s] + TAILS[s][1], layer.rank[s], s) for s in range(4))
    tail, borders = TAILS[state][0], []
    for before in reversed(pointers):
        borders.append((before[state], state))
        state = before[state]
    return cost, borders[::-1], tail


class Remembered:
    """Results of a function of short texts, as many as `most`; then it begins anew."""

    def __init__(self, work: Callable, most: int = 50_000, length: int = 64) -> None:
        self.work, self.most, self.length, self.known = work, most, length, {}

    def __call__(self, symbols: str, *more: int):  # noqa: ANN204
        if len(symbols) > self.length:
            return self.work(symbols, *more)
        key = (symbols, *more)
        if key not in self.known:
            if len(self.known) >= self.most:
                self.known = {}
            self.known[key] = self.work(symbols, *more)
        return self.known[key]


def damaged(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text as damaged by the CRC-32 of `conv_id:turn`: of twenty rows one each is dropped, emptied, robbed of its sentence ends, repeated, made the user's. Nulls count as one space."""
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    kind = F.crc32(F.encode(name, "utf-8")) % 20
    role, text = (F.coalesce(F.col(c), F.lit(" ")) for c in ("role", "text"))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    rows = turns.filter(kind != 0).select("conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"), text.alias("text"), F.when(kind == 3, 2).otherwise(1).alias("times"))
    return rows.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("times")))).select("conv_id", "turn", "role", "text")


def placed(turns: DataFrame) -> tuple[DataFrame, str]:
    """The rows with `pos`, which puts them in order (conversation, turn with nulls first, role, digest of the text), and `piece`, the range that they fall in; and the path of the table.

    Equal rows are told apart by where they were read, so that no range has to hold all of them.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), F.monotonically_increasing_id().alias("read")
    ).withColumn("sha", F.unhex(F.sha2("text", 256)))
    order = ["conv_id", "turn", "role", "sha", "read"]
    sorted_ = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pos", F.monotonically_increasing_id())
    return stored(sorted_.drop("read").withColumn("piece", F.shiftright("pos", 33)), "turns")


def _same(a: DataFrame, b: DataFrame, columns: list[str]) -> Column:
    """Equality in which nulls are equal."""
    out = F.lit(True)
    for c in columns:
        out = out & a[c].eqNullSafe(b[c])
    return out


def judged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, pos, piece, initial, fault (blank, duplicate, truncated or null): a row's first fault."""
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    light = rows.select("conv_id", "turn", "pos", "piece", "role", "sha", F.substring("role", 1, 1).alias("initial"), last.alias("last"))
    group = ["conv_id", "role", "sha"]
    first = light.groupBy(*group).agg(F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    told = light.join(first, _same(light, first, group), "left").select(light["*"], first["first"])
    fault = F.when(F.col("last") == "", "blank").when(F.col("pos") > F.col("first"), "duplicate").when(~F.col("last").isin(".", "!", "?"), "truncated")
    return told.select("conv_id", "turn", "pos", "piece", "initial", fault.alias("fault"))


def _symbol(initial: str, fault: str | None) -> str:
    if fault in ("blank", "duplicate"):
        return "D"
    plain = initial if initial in ("s", "u", "a") else "x"
    return plain.upper() if fault else plain


def _runs(batches: Iterator[pa.RecordBatch], columns: list[str], key: int) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """Rows as tuples in runs of equal first `key` columns; a run's rows come one by one, and unread ones are passed over."""
    rows = (row for batch in batches for row in zip(*(batch.column(c).to_pylist() for c in columns), strict=True))
    row = next(rows, None)
    while row is not None:
        name = row[:key]

        def run() -> Iterator[tuple]:
            nonlocal row
            while row is not None and row[:key] == name:  # noqa: B023
                yield row[key:]
                row = next(rows, None)

        mine = run()
        yield name, mine
        for _ in mine:
            pass


def _in_rows(rows: Iterator[tuple], schema: pa.Schema, most: int = 1000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == most:
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def _arrow(df: DataFrame, **more: pa.DataType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_type

    return pa.schema([("conv_id", to_arrow_type(df.schema["conv_id"].dataType)), *more.items()])


_COUNTS = ("blank", "duplicate", "truncated")
_PIECE = "n_blank long, n_duplicate long, n_truncated long, illegal long, opens string, closes string, least_turn long, most_turn long, n_turns long, costs array<long>, ranks array<int>"


def piece_sums(rows: DataFrame) -> DataFrame:
    """One row for each piece of a conversation: its faults, its outermost initials and turns, and its costs and ranks between states."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = _arrow(
        rows, piece=pa.int64(), n_blank=pa.int64(), n_duplicate=pa.int64(), n_truncated=pa.int64(), illegal=pa.int64(), opens=pa.string(), closes=pa.string(),
        least_turn=pa.int64(), most_turn=pa.int64(), n_turns=pa.int64(), costs=pa.list_(pa.int64()), ranks=pa.list_(pa.int32()),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(summed)

        def sums() -> Iterator[tuple]:
            for (conv_id, piece), run in _runs(batches, ["conv_id", "piece", "turn", "initial", "fault"], 2):
                counts, illegal, symbols = dict.fromkeys(_COUNTS, 0), 0, []
                opens = closes = least = most = None
                n_turns = 0
                for turn, initial, fault in run:
                    if fault:
                        counts[fault] += 1
                    if opens is None:
                        opens = initial
                    elif closes + initial not in ("su", "ua", "au"):
                        illegal += 1
                    closes = initial
                    if turn is not None and turn != most:
                        least, most, n_turns = turn if least is None else least, turn, n_turns + 1
                    symbols.append(_symbol(initial, fault))
                yield conv_id, piece, *counts.values(), illegal, opens, closes, least, most, n_turns, *known("".join(symbols))

        yield from _in_rows(sums(), schema)

    dealt = rows.repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "pos")
    return dealt.mapInArrow(work, f"conv_id {kind}, piece long, {_PIECE}")


def decided(sums: DataFrame) -> DataFrame:
    """conv_id, piece, the states before and behind it; on a conversation's last piece also what follows, cost and faults of the whole."""
    kind = sums.schema["conv_id"].dataType.simpleString()
    columns = [c.split()[0] for c in _PIECE.split(", ")]
    schema = _arrow(
        sums, piece=pa.int64(), enter=pa.int32(), leave=pa.int32(), tail=pa.string(), gaps=pa.int64(), blank=pa.int64(), duplicate=pa.int64(), truncated=pa.int64(),
        illegal=pa.int64(), cost=pa.int64(),
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(lambda _, costs, ranks: joined([(costs, ranks)]))

        def choices() -> Iterator[tuple]:
            for (conv_id,), run in _runs(batches, ["conv_id", "piece", *columns], 1):
                pieces = [dict(zip(["piece", *columns], p, strict=True)) for p in run]  # as many as there are ranges at most
                told = [(p["costs"], p["ranks"]) for p in pieces]
                cost, borders, tail = known("", tuple(told[0][0]), tuple(told[0][1])) if len(told) == 1 else joined(told)
                illegal = sum(p["illegal"] for p in pieces) + sum(a["closes"] + b["opens"] not in ("su", "ua", "au") for a, b in zip(pieces, pieces[1:], strict=False))
                dated = [p for p in pieces if p["n_turns"]]
                twice = sum(a["most_turn"] == b["least_turn"] for a, b in zip(dated, dated[1:], strict=False))
                gaps = dated[-1]["most_turn"] - dated[0]["least_turn"] + 1 - sum(p["n_turns"] for p in dated) + twice if dated else 0
                whole = gaps, *(sum(p[f"n_{c}"] for p in pieces) for c in _COUNTS), illegal, cost
                for k, (p, (enter, leave)) in enumerate(zip(pieces, borders, strict=True)):
                    last = k == len(pieces) - 1
                    yield conv_id, p["piece"], enter, leave, tail if last else "", *(whole if last else [None] * 6)

        yield from _in_rows(choices(), schema)

    dealt = sums.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    told = "piece long, enter int, leave int, tail string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
    return dealt.mapInArrow(work, f"conv_id {kind}, {told}")


def piece_audits(rows: DataFrame, choices: DataFrame) -> DataFrame:
    """conv_id, piece, audit: each piece's part of the audit."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    schema = _arrow(rows, piece=pa.int64(), audit=pa.string())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Remembered(traced)

        def audits() -> Iterator[tuple]:
            for (conv_id, piece), run in _runs(batches, ["conv_id", "piece", "initial", "fault", "enter", "leave"], 2):
                _, tail, enter, leave = next(run)  # the choice comes first
                symbols = "".join(_symbol(initial, fault) for initial, fault, _, _ in run)
                yield conv_id, piece, known(symbols, enter, leave) + tail

        yield from _in_rows(audits(), schema)

    none = F.lit(None).cast("string")
    first = choices.select("conv_id", "piece", F.lit(-1).cast("long").alias("pos"), none.alias("initial"), F.col("tail").alias("fault"), "enter", "leave")
    then = rows.select("conv_id", "piece", "pos", "initial", "fault", F.lit(None).cast("int").alias("enter"), F.lit(None).cast("int").alias("leave"))
    dealt = first.unionByName(then).repartition("conv_id", "piece").sortWithinPartitions("conv_id", "piece", "pos")
    return dealt.mapInArrow(work, f"conv_id {kind}, piece long, audit string")


def edited(run: Iterator[tuple[int, str | None, str]]) -> Iterator[tuple[str, str | None, str]]:
    """(edit, role, text) of each edit of a conversation, from its rows (pos, role, text); ahead of a piece's rows comes its audit, with pos -1. A deleted turn has no role."""
    state, audit, at = NONE, "", 0
    for pos, role, text in run:
        while at < len(audit) and (pos < 0 or audit[at] == "I"):
            state = following(state)
            yield "I", ROLES[state], ""
            at += 1
        if pos < 0:
            audit, at = text, 0
            continue
        edit, at = audit[at], at + 1
        if edit == "D":
            yield "D", None, text
        elif edit == "R":
            state = following(state)
            yield "R", ROLES[state], text
        else:
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[0]]
            yield "K", role, text
    for _ in audit[at:]:
        state = following(state)
        yield "I", ROLES[state], ""


def _streamed(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """A conversation's rows in order in one task, each piece behind its audit."""
    first = audits.select("conv_id", "piece", F.lit(-1).cast("long").alias("pos"), F.lit(None).cast("string").alias("role"), F.col("audit").alias("text"))
    return first.unionByName(rows.select("conv_id", "piece", "pos", "role", "text")).repartition("conv_id").sortWithinPartitions("conv_id", "piece", "pos")


class Repair:
    """What `repair` gives: totals of each conversation (conv_id, gaps, blank, duplicate, truncated, illegal, cost) and its repaired turns."""

    def __init__(self, turns: DataFrame) -> None:
        self.rows, placed_path = placed(turns)
        marks, marks_path = stored(judged(self.rows), "turn-faults")
        self.choices, _ = stored(decided(piece_sums(marks)), "turn-choices")
        self.audits, _ = stored(piece_audits(marks, self.choices), "turn-audits")
        remove(turns.sparkSession, marks_path)
        self.totals = self.choices.filter("cost IS NOT NULL").drop("piece", "enter", "leave", "tail")

    def turns(self) -> DataFrame:
        """conv_id, place (from 0), edit (K, R or I), role, text of every turn that a repaired conversation has."""
        kind = self.rows.schema["conv_id"].dataType.simpleString()
        schema = _arrow(self.rows, place=pa.int64(), edit=pa.string(), role=pa.string(), text=pa.string())

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def lines() -> Iterator[tuple]:
                for (conv_id,), run in _runs(batches, ["conv_id", "pos", "role", "text"], 1):
                    yield from ((conv_id, k, *e) for k, e in enumerate(e for e in edited(run) if e[0] != "D"))

            yield from _in_rows(lines(), schema, 256)

        return _streamed(self.rows, self.audits).mapInArrow(over_batches(work), f"conv_id {kind}, place long, edit string, role string, text string")

    def digests(self) -> DataFrame:
        """conv_id, audit (the edits' initials), repaired_sha256 of the turns as `role:text`, joined by line ends; texts are read as a stream."""
        kind = self.rows.schema["conv_id"].dataType.simpleString()
        schema = _arrow(self.rows, audit=pa.string(), repaired_sha256=pa.string())

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def digests() -> Iterator[tuple]:
                for (conv_id,), run in _runs(batches, ["conv_id", "pos", "role", "text"], 1):
                    sha, audit, between = hashlib.sha256(), bytearray(), b""
                    for edit, role, text in edited(run):
                        audit += edit.encode()
                        if role is not None:
                            sha.update(between + f"{role}:{text}".encode())
                            between = b"\n"
                    yield conv_id, audit.decode(), sha.hexdigest()

            yield from _in_rows(digests(), schema)

        return _streamed(self.rows, self.audits).mapInArrow(over_batches(work), f"conv_id {kind}, audit string, repaired_sha256 string")


def repair(turns: DataFrame) -> Repair:
    """Repairs conversations, rows conv_id, turn, role, text in any order.

    A turn's first fault counts: blank (nothing but white space), duplicate (role and text came earlier), truncated
    (doesn't end in . ! or ?). Blank and duplicate turns are deleted; other edits keep, rerole, delete or insert turns
    at the least cost, of equal costs with the least audit. Null roles and texts count as one space; an empty role
    is no role that a turn can keep; turns without a number come first; turns of one number are ordered by role, then by the SHA-256 of the text; a null conv_id is a
    conversation of its own; other columns are not looked at; an empty table gives empty tables. A conversation of any
    length is repaired in pieces; texts of any length stay whole.
    """
    return Repair(turns)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, audit and digest of every conversation after its rows were damaged and repaired.

    Null roles and texts are one space, a null conv_id is a conversation; rows repeated in the table are duplicates of
    each other. A conversation that loses all its rows has zeros, an empty audit and the digest of an empty text. An
    empty table gives no rows; other columns are not looked at; long texts are read whole.
    """
    turns = table(spark, sf_dir, "conversations")
    done = repair(damaged(turns))
    ids, totals, digests = turns.select("conv_id").distinct(), done.totals, done.digests()
    rows = ids.join(totals, _same(ids, totals, ["conv_id"]), "left").join(digests, _same(ids, digests, ["conv_id"]), "left")
    counts = [F.coalesce(totals[c], F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    empty = F.coalesce(digests["repaired_sha256"], F.sha2(F.lit(""), 256))
    return rows.select(ids["conv_id"], *counts, F.coalesce(digests["audit"], F.lit("")).alias("audit"), empty.alias("repaired_sha256"))

