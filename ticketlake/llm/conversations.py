"""Repair of conversations: faults of messages and the cheapest edits that make the roles alternate."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from hashlib import sha256
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticketlake.llm import edit_lattice as lattice
from ticketlake.llm.common import arrow_batches, stored

# Rows and characters of a segment at most; longer conversations are several. Characters of one output batch.
SEGMENT, SEGMENT_CHARS, BATCH_CHARS = 256, 1 << 20, 4 << 20
SPACE = " \t\n\x0b\x0c\r"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}

_SEGMENT = "conv long, place long, open boolean, turns array<long>, roles array<string>, texts array<string>"
_RESULT = "conv long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, repaired_sha256 string"
_SOLVED = (
    "conv long, place long, rows long, initials string, first string, last string, low long, high long, turns long, "
    "blank long, duplicate long, truncated long, illegal long, costs array<long>, audits array<string>"
)


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text, gone) with the faults that the crc32 of "conversation:turn" (null: a space) modulo
    20 decides: 0 drops the row (`gone`), 1 empties its text, 2 takes out its `[.!?]`, 3 repeats it beside
    itself, 4 sets the role to user. Null roles and texts are a space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)])
    fault = F.crc32(key.cast("binary")) % 20
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    copies = F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.when(fault == 4, "user").otherwise(plain(role)).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(plain(text), ".!?", "")).otherwise(plain(text)).alias("text"),
        (fault == 0).alias("gone"),
        F.explode(copies).alias("copy"),
    ).drop("copy")


# ---------------------------------------------------------------- segments


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {
        "long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(), "binary": pa.binary(),
        "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string()),
    }
    fields = [f.strip().split(" ") for f in schema.split(",")]
    columns = list(zip(*rows, strict=True)) or [() for _ in fields]
    arrays = [pa.array(list(c), kinds[kind]) for c, (_, kind) in zip(columns, fields, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _mapped(schema: str, each: Callable[[Iterator[dict]], Iterator[tuple[int, tuple]]]):
    """For mapInArrow: `each` turns rows into (characters, row) pairs, which leave in bounded batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for size, row in each(r for b in batches for r in b.to_pylist()):
            rows.append(row)
            held += size
            if held >= BATCH_CHARS or len(rows) >= 4096:
                yield _batch(schema, rows)
                rows, held = [], 0
        yield _batch(schema, rows)

    return run


def _segmented(rows: Iterator[dict]) -> Iterator[tuple[int, tuple]]:
    """Sorted rows as segments. `open` ones may have others of their conversation: what is cut, and what stands
    first or last in the task's range."""
    held: list[dict] = []
    chars, nth, first, part = 0, 0, True, 0

    def segment(is_open: bool) -> tuple[int, tuple]:
        there = [r for r in held if not r["gone"]]
        lists = [[r[c] for r in there] for c in ("turn", "role", "text")]
        return chars + 64, (held[0]["conv"], (part << 32) + nth, is_open, *lists)

    conv_open = True
    for row in rows:
        part = row["part"]
        if held and row["conv"] != held[0]["conv"]:
            yield segment(first or conv_open)
            held, chars, nth, first, conv_open = [], 0, nth + 1, False, False
        elif len(held) >= SEGMENT or chars >= SEGMENT_CHARS:
            yield segment(True)
            held, chars, nth, conv_open = [], 0, nth + 1, True
        held.append(row)
        chars += len(row["text"])
    if held:
        yield segment(True)


def segments(rows: DataFrame) -> DataFrame:
    """The stored segments of (conv, turn, role, text, gone) rows: conversations in the order of turns (nulls first),
    cut into pieces. Rows of one turn stand in the order of role and SHA-256 of the text. One range shuffle:
    a long conversation spreads over several ranges."""
    keyed = rows.withColumns({"digest": F.sha2("text", 256), "nth": F.monotonically_increasing_id()})
    order = [F.col(c).asc_nulls_first() for c in ("conv", "turn", "role", "digest", "nth")]
    sorted_rows = keyed.repartitionByRange(*order).sortWithinPartitions(*order)
    slim = sorted_rows.select(
        "conv", "turn", "role", F.when(F.col("gone"), "").otherwise(F.col("text")).alias("text"), "gone",
        F.spark_partition_id().alias("part"),
    )
    return stored(slim.mapInArrow(_mapped(_SEGMENT, _segmented), _SEGMENT), "conversation-segments")


# ---------------------------------------------------------------- one segment


class Judged:
    """Faults and roles of a segment's rows."""

    def __init__(self, segment: dict, seen_before: list[str] = ()):
        self.roles, self.texts = segment["roles"], segment["texts"]
        self.initials = [r[:1] for r in self.roles]
        self.count = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        seen, before, symbols = set(), set(seen_before), []
        for role, text, initial in zip(self.roles, self.texts, self.initials, strict=True):
            bare = text.rstrip(SPACE)
            again = (role, text) in seen or (before and message_digest(role, text) in before)
            seen.add((role, text))
            fault = "blank" if not bare else "duplicate" if again else "truncated" if bare[-1] not in ".!?" else None
            if fault:
                self.count[fault] += 1
            symbols.append(lattice.symbol(initial, fault in ("blank", "duplicate"), fault == "truncated"))
        self.symbols = "".join(symbols)
        self.illegal = sum(p not in _LEGAL for p in zip(self.initials, self.initials[1:]))
        known = [t for t in segment["turns"] if t is not None]
        self.low, self.high, self.turns = min(known, default=None), max(known, default=None), len(set(known))

    def repaired(self, audit: str, state: int = lattice.EMPTY) -> list[tuple[str, str]]:
        """(role, text) of the messages that an audit leaves, from a state of the lattice."""
        out = []
        for row, role in lattice.replay(audit, self.initials, state)[0]:
            if role == "keep":
                out.append((self.roles[row], self.texts[row]))
            elif role:
                out.append((role, "" if row is None else self.texts[row]))
        return out


def message_digest(role: str, text: str) -> str:
    return sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()


def lines(messages: list[tuple[str, str]]) -> str:
    return "\n".join(f"{role}:{text}" for role, text in messages)


@lru_cache(1 << 15)
def _cheapest(symbols: str, start: int = lattice.EMPTY, ends: tuple[int, ...] = lattice.FINAL) -> tuple[int, str] | None:
    return lattice.cheapest(symbols, start, ends)


def _gaps(low: int | None, high: int | None, turns: int) -> int:
    return 0 if low is None else high - low + 1 - turns


def _resolved(rows: Iterator[dict]) -> Iterator[tuple[int, tuple]]:
    """Results of conversations that are one segment."""
    for segment in rows:
        judged = Judged(segment)
        cost, audit = _cheapest(judged.symbols)
        digest = sha256(lines(judged.repaired(audit)).encode()).hexdigest()
        gaps = _gaps(judged.low, judged.high, judged.turns)
        yield 256, (segment["conv"], gaps, *judged.count.values(), judged.illegal, cost, audit, digest)


# ---------------------------------------------------------------- conversations of several segments


def _digests(rows: Iterator[dict]) -> Iterator[tuple[int, tuple]]:
    for segment in rows:
        for digest in {message_digest(r, t) for r, t in zip(segment["roles"], segment["texts"], strict=True)}:
            yield 100, (segment["conv"], segment["place"], digest)


def _solved(rows: Iterator[dict]) -> Iterator[tuple[int, tuple]]:
    """Per segment the cheapest edits from each state to each state."""
    for segment in rows:
        judged = Judged(segment, segment["seen"] or [])
        ways = [_cheapest(judged.symbols, a, (b,)) or (-1, "") for a in lattice.STATES for b in lattice.STATES]
        there = judged.initials or [None]
        yield 16 * len(judged.symbols) + 500, (
            segment["conv"], segment["place"], len(judged.symbols), "".join(x or " " for x in judged.initials), there[0],
            there[-1], judged.low, judged.high, judged.turns, *judged.count.values(), judged.illegal,
            [c for c, _ in ways], [a for _, a in ways],
        )


class Fold:
    """Takes a conversation's solved segments in order and holds, per state, the cheapest edits so far.

    States that cannot come first any more are left out, and what the audits of the others have in common is
    put away, so that only short rests are compared.
    """

    def __init__(self, conv: int | None):
        self.conv, self.sums = conv, dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.low = self.high = self.last = None
        self.settled: list[str] = []
        self.open: dict[int, tuple[int, str]] = {lattice.EMPTY: (0, "")}
        self.pieces: list[tuple[int, int, str]] = []

    def add(self, s: dict) -> None:
        for name in self.sums:
            self.sums[name] += s[name]
        if s["low"] is not None:
            self.sums["turns"] -= s["low"] == self.high  # a turn that goes on behind the cut
            self.low, self.high = s["low"] if self.low is None else self.low, s["high"]
        if s["rows"]:
            self.sums["illegal"] += self.last is not None and (self.last, s["first"]) not in _LEGAL
            self.last = s["last"]
        after: dict[int, tuple[int, str]] = {}
        for state, (cost, audit) in self.open.items():
            for end in lattice.STATES:
                at = state * len(lattice.STATES) + end
                if s["costs"][at] >= 0:
                    way = cost + s["costs"][at], audit + s["audits"][at]
                    after[end] = min(after.get(end, way), way)
        self.open = _still_open(after)
        shared = commonprefix([a for _, a in self.open.values()])
        self.settled.append(shared)
        self.open = {q: (c, a[len(shared) :]) for q, (c, a) in self.open.items()}
        self.pieces.append((s["place"], s["rows"], s["initials"]))

    def end(self) -> tuple[tuple, list[tuple[int, int, str]]]:
        """The conversation's row but for the digest, and (place, state before it, audit) of each segment."""
        cost, rest = min(self.open[q] for q in lattice.FINAL if q in self.open)
        audit = "".join([*self.settled, rest])
        at, state, cut = 0, lattice.EMPTY, []
        for place, rows, initials in self.pieces:
            start, left = at, rows
            while at < len(audit) and (left or audit[at] == "I"):
                left -= audit[at] != "I"
                at += 1
            cut.append((place, state, audit[start:at]))
            state = lattice.replay(audit[start:at], initials, state)[1]
        counts = [self.sums[n] for n in ("blank", "duplicate", "truncated", "illegal")]
        return (self.conv, _gaps(self.low, self.high, self.sums["turns"]), *counts, cost, audit), cut


def _still_open(ways: dict[int, tuple[int, str]]) -> dict[int, tuple[int, str]]:
    """States from which the least cost may still be reached. The others allow all that such a state does, for
    at most so much more: two insert a message, three delete a row that it could have kept."""
    more = {
        lattice.EMPTY: {lattice.ASSISTANT: 3, lattice.USER: 5},
        lattice.SYSTEM: {lattice.ASSISTANT: 0, lattice.USER: 2},
        lattice.USER: {lattice.ASSISTANT: 2},
        lattice.ASSISTANT: {lattice.USER: 2},
    }
    return {
        q: way for q, way in ways.items()
        if not any(o in ways and way[0] > ways[o][0] + extra for o, extra in more[q].items())
    }


def _folded(rows: Iterator[dict]) -> Iterator[tuple[int, tuple]]:
    """Solved segments, sorted: one row a conversation (place null) and one a segment."""
    fold: Fold | None = None

    def ended() -> Iterator[tuple[int, tuple]]:
        summary, cut = fold.end()
        yield len(summary[-1]) + 100, (*summary, None, None, None)
        for place, state, audit in cut:
            yield len(audit) + 100, (fold.conv, *[None] * 7, place, state, audit)

    for segment in rows:
        if fold is None or segment["conv"] != fold.conv:
            if fold is not None:
                yield from ended()
            fold = Fold(segment["conv"])
        fold.add(segment)
    if fold is not None:
        yield from ended()


_FOLDED = "conv long, " + ", ".join(f"{c} long" for c in COUNTS) + ", audit string, place long, state int, piece string"


def _written(rows: Iterator[dict]) -> Iterator[tuple[int, tuple]]:
    for segment in rows:
        judged = Judged(segment)  # faults don't matter any more, the edits are given
        messages = judged.repaired(segment["piece"], segment["state"])
        text = lines(messages)
        yield len(text) + 64, (segment["conv"], segment["place"], len(messages), text)


def _hashed(rows: Iterator[dict]) -> Iterator[tuple[int, tuple]]:
    """One digest a conversation from its sorted pieces, which pass one by one."""
    conv, state, written = None, None, 0
    for piece in rows:
        if state is None or piece["conv"] != conv:
            if state is not None:
                yield 100, (conv, state.hexdigest())
            conv, state, written = piece["conv"], sha256(), 0
        if piece["messages"]:
            state.update(("\n" if written else "").encode() + piece["text"].encode())
            written += piece["messages"]
    if state is not None:
        yield 100, (conv, state.hexdigest())


def _in_order(df: DataFrame) -> DataFrame:
    return df.repartition("conv").sortWithinPartitions(F.col("conv").asc_nulls_first(), "place")


def _same(left: DataFrame, right: DataFrame, *more: str) -> Column:
    match = left["conv"].eqNullSafe(right["conv"])
    for c in more:
        match = match & (left[c] == right[c])
    return match


def _fold(pieces: DataFrame) -> DataFrame:
    """Stored: a row a conversation, whose place is null, and one a segment with its part of the audit."""
    schema = "conv long, place long, digest string"
    digests = pieces.mapInArrow(_mapped(schema, _digests), schema)
    first = F.min("place").over(Window.partitionBy("conv", "digest"))
    again = digests.withColumn("first", first).where("place > first")
    again = again.groupBy("conv", "place").agg(F.collect_list("digest").alias("seen"))
    known = pieces.join(again, _same(pieces, again, "place"), "left").select(
        pieces["conv"], pieces["place"], "turns", "roles", "texts", "seen"
    )
    solved = stored(known.mapInArrow(_mapped(_SOLVED, _solved), _SOLVED), "conversation-solved")
    return stored(_in_order(solved).mapInArrow(_mapped(_FOLDED, _folded), _FOLDED), "conversation-folded")


def _edited(pieces: DataFrame, folded: DataFrame) -> DataFrame:
    edits = folded.where("place is not null").select("conv", "place", "state", "piece")
    return pieces.join(edits, _same(pieces, edits, "place")).select(
        pieces["conv"], pieces["place"], "turns", "roles", "texts", "state", "piece"
    )


def _long_ones(pieces: DataFrame) -> DataFrame:
    """Results of conversations whose segments may be several."""
    folded = _fold(pieces)
    schema = "conv long, place long, messages long, text string"
    written = _edited(pieces, folded).mapInArrow(_mapped(schema, _written), schema)
    schema = "conv long, repaired_sha256 string"
    hashed = _in_order(written).mapInArrow(_mapped(schema, _hashed), schema)
    whole = folded.where("place is null")
    return whole.join(hashed, _same(whole, hashed)).select(whole["conv"], *COUNTS, "audit", "repaired_sha256")


def repair(rows: DataFrame, conv_id: str = "conv_id") -> DataFrame:
    """One row a conversation of (conv, turn, role, text, gone) rows: its faults, the cheapest edits and the
    SHA-256 of the repaired `role:text` lines.

    A row's first fault counts: blank (only space), duplicate (role and text seen earlier), truncated (the last
    character that isn't space is none of `.!?`). `gaps` are turns missing between the least and the greatest;
    `illegal` counts neighbours whose initials aren't su, ua or au. Edits are those of edit_lattice; blank and duplicate
    rows must go. `audit` has a letter an edit, the least in ASCII of the cheapest.

    Rows that are `gone` only name their conversation; one without others has zeros, an empty audit and the digest of
    the empty text. A null conversation is one of its own, null turns come first and have no part in gaps. Rows of one
    turn, also repeated ones, stand in the order of role and SHA-256 of the text. An empty table gives an empty
    result; other columns are ignored.

    Conversations are cut into segments of bounded size. One that lies in a single segment is solved there. Of the
    others each segment is solved from every state to every state, the results are folded in order, and the
    edits go back to the segments. Only the audit itself, a letter a row, is held whole; texts pass in pieces.
    """
    arrow_batches(rows.sparkSession)
    pieces = segments(rows)
    whole = pieces.where("not open").select("conv", "turns", "roles", "texts")
    short = whole.mapInArrow(_mapped(_RESULT, _resolved), _RESULT)
    long = _long_ones(pieces.where("open"))
    return short.unionByName(long).withColumnRenamed("conv", conv_id)


def repaired_messages(rows: DataFrame) -> DataFrame:
    """(conv, place, nth, role, text): the messages that remain, in the order of place and nth within a conversation."""
    arrow_batches(rows.sparkSession)
    pieces = segments(rows)
    schema = "conv long, place long, nth long, role string, text string"

    def written(segments: Iterator[dict], given: bool) -> Iterator[tuple[int, tuple]]:
        for s in segments:
            judged = Judged(s)
            audit, state = (s["piece"], s["state"]) if given else (_cheapest(judged.symbols)[1], lattice.EMPTY)
            for nth, (role, text) in enumerate(judged.repaired(audit, state)):
                yield len(text) + 64, (s["conv"], s["place"], nth, role, text)

    whole = pieces.where("not open").mapInArrow(_mapped(schema, lambda r: written(r, False)), schema)
    cut = pieces.where("open")
    edited = _edited(cut, _fold(cut))
    return whole.unionByName(edited.mapInArrow(_mapped(schema, lambda r: written(r, True)), schema))
