"""Structure repair of conversations by iterative-deepening A*.

A conversation should read ``(s?(ua)+)?`` by the first letters of its roles. Edits go over its
messages in order: keep one, give it another role, delete it, or insert an empty one. What
must follow depends only on what came last, so the letters of the edits (D, I, K, R) say all.
A depth-first search takes edits in that order under a cost bound, which grows to the least
cost that broke it; the first path that ends well is the cheapest and, of the cheapest, the
first in the alphabet. A table keeps, for every state that failed, what it is now known to
cost at least.

Messages are range-sorted by conversation and turn. A conversation that lies inside one task
and is short is repaired there and then. A longer one, or one cut by the end of a task, goes
on as segments of bounded size: the search prices every way through a segment, the prices are
added up from the end of the conversation, and with what remains to be paid after it each
segment is searched for its own part of the answer. Only a digest of the whole repaired text
has to run through a conversation in order, and it holds one segment at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from veclode.llm.common import BLOCK_BYTES, column, stored

# Messages in a segment; one of over BLOCK_BYTES of text ends early.
SEGMENT = 32
WHITE_SPACE = " \t\n\x0b\x0c\r"
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
# What came last: nothing, the system, the user, the assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
# By state: the letters that may be kept, and where an inserted or renamed message leads.
KEEPS = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
TURNS_TO = (USER, USER, ASSISTANT, USER)
ROLES = {USER: "user", ASSISTANT: "assistant"}
# Messages inserted after the last one, by state, and what they cost.
ENDS = (0, 2, 1, 0)
END_COSTS = tuple(INSERT * n for n in ENDS)
FAR = 1 << 60


def message_code(role: str, text: str, repeated: bool) -> str:
    """One letter for all that the search needs to know, in the order faults count.

    ``b`` blank and ``d`` duplicate have to go; else the role's first letter if it is s, u or
    a, ``o`` if not; a capital says that the text is truncated.
    """
    end = text.rstrip(WHITE_SPACE)
    if not end:
        return "b"
    if repeated:
        return "d"
    letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
    return letter if end[-1] in ".!?" else letter.upper()


def _least(code: str, started: bool) -> int:
    """What a message costs at least, whatever is around it."""
    if code in "bd":
        return DELETE
    kept = TRUNCATED if code.isupper() else 0
    fits = code.lower() in ("u", "a") or (code.lower() == "s" and not started)
    return min(DELETE, kept if fits else kept + REROLE)


def searcher(codes: str, exits: tuple[int, ...]) -> Callable[[int], tuple[int, str, int]]:
    """From a state: cost, edits and last state of the cheapest way over the messages.

    ``exits``: what remains to be paid in each state after the last message. What is known of
    failed states holds for every start and bound.
    """
    n = len(codes)
    floor = [[min(exits)] * (n + 1) for _ in range(2)]
    for started in (0, 1):
        for i in range(n - 1, -1, -1):
            floor[started][i] = floor[started][i + 1] + _least(codes[i], bool(started))
    known: dict[tuple[int, int, int], int] = {}
    path: list[str] = []
    last = START

    def go(i: int, state: int, inserted: int, left: int) -> int:
        """-1 if a way within ``left`` was found, else a bound above it."""
        nonlocal last
        place = (i, state, inserted)
        least = known.get(place) or floor[state != START][i]
        if least > left:
            return least
        if i == n:
            if exits[state] <= left:
                last = state
                return -1
            known[place] = exits[state]
            return exits[state]
        code = codes[i]
        edits = [("D", DELETE, i + 1, state, 0)]
        if inserted < 2:  # a third in a row leads back to where the first led
            edits.append(("I", INSERT, i, TURNS_TO[state], inserted + 1))
        if code not in "bd":
            extra = TRUNCATED if code.isupper() else 0
            kept = KEEPS[state].get(code.lower())
            if kept is not None:
                edits.append(("K", extra, i + 1, kept, 0))
            edits.append(("R", REROLE + extra, i + 1, TURNS_TO[state], 0))
        above = FAR
        for letter, cost, *then in edits:
            found = go(*then, left - cost)
            if found < 0:
                path.append(letter)
                return -1
            above = min(above, cost + found)
        known[place] = above
        return above

    def solve(start: int) -> tuple[int, str, int]:
        path.clear()
        bound = floor[start != START][0]
        while (found := go(0, start, 0, bound)) >= 0:
            bound = found
        return bound, "".join(reversed(path)), last

    return solve


@lru_cache(maxsize=1 << 16)
def search(codes: str) -> tuple[int, str, int]:
    """Cost, edits and last state of a whole conversation, but for what is added at its end."""
    return searcher(codes, END_COSTS)(START)


def prices(codes: str) -> list[int]:
    """Least cost from every state to every state (by rows), over one segment."""

    def possible(start: int, end: int) -> bool:
        if start == end or not codes:
            return start == end
        return end in (USER, ASSISTANT) or (start == START and end == SYSTEM and "s" in codes.lower())

    found = []
    for end in range(4):
        solve = searcher(codes, tuple(0 if s == end else FAR for s in range(4)))
        found.append([solve(s)[0] if possible(s, end) else FAR for s in range(4)])
    return [found[end][start] for start in range(4) for end in range(4)]


class Repair:
    """What is known of a conversation as its messages go by, in order."""

    def __init__(self, rows: bool):
        self.blank = self.duplicate = self.truncated = self.illegal = self.cost = 0
        self.turns = 0
        self.first = self.last = None
        self.before: str | None = None
        self.state = START
        self.audit: list[str] = []
        self.digest = hashlib.sha256()
        self.messages: list[tuple[int, str, str, str]] | None = [] if rows else None
        self.written = 0

    def _write(self, edit: str, role: str, text: str) -> None:
        self.digest.update(("\n" * (self.written > 0) + f"{role}:{text}").encode())
        if self.messages is not None:
            self.messages.append((self.written, edit, role, text))
        self.written += 1

    def _turn_to(self, edit: str, text: str) -> None:
        self.state = TURNS_TO[self.state]
        self._write(edit, ROLES[self.state], text)

    def add(self, turns: list, roles: list, texts: list, codes: str, edits: str) -> None:
        """The next messages, with the edits that repair them."""
        for turn, role, code in zip(turns, roles, codes):
            if turn is not None:
                self.turns += turn != self.last
                self.first = turn if self.first is None else self.first
                self.last = turn
            self.blank += code == "b"
            self.duplicate += code == "d"
            self.truncated += code.isupper()
            if self.before is not None:
                self.illegal += self.before + role[:1] not in ("su", "ua", "au")
            self.before = role[:1]
        self.audit.append(edits)
        at = 0
        for edit in edits:
            if edit == "I":
                self.cost += INSERT
                self._turn_to("I", "")
                continue
            role, text, code = roles[at], texts[at], codes[at]
            at += 1
            if edit == "D":
                self.cost += DELETE
                continue
            self.cost += TRUNCATED * code.isupper()
            if edit == "K":
                self.state = KEEPS[self.state][code.lower()]
                self._write("K", role, text)
            else:
                self.cost += REROLE
                self._turn_to("R", text)

    def end(self) -> tuple:
        for _ in range(ENDS[self.state]):
            self.audit.append("I")
            self.cost += INSERT
            self._turn_to("I", "")
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        counts = (gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.cost)
        return (*counts, "".join(self.audit), self.digest.hexdigest())


SUMMARY = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint,"
    " audit string, repaired_sha256 string"
)
MESSAGES = "messages array<struct<place:bigint,edit:string,role:string,text:string>>"
SEGMENTS = "segment bigint, turns array<bigint>, roles array<string>, texts array<string>"
NO_SUMMARY, NO_SEGMENT = (None,) * 8, (None,) * 4


def _schema(key: T.DataType, *fields: str) -> T.StructType:
    rest = T.StructType.fromDDL(", ".join(fields)).fields
    return T.StructType([T.StructField("key", key), *rest])


def _batches(rows: Iterator[tuple[tuple, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows, each with its weight in bytes, as batches; a batch of much text ends early."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*held), schema)]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    for row, weight in rows:
        held.append(row)
        size += weight
        if len(held) >= 4096 or size > BLOCK_BYTES:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(c.to_pylist() for c in batch.columns))


def _first_pass(messages: DataFrame, with_rows: bool) -> DataFrame:
    """Short whole conversations repaired, all others as segments. ``messages`` is sorted."""
    schema = _schema(messages.schema["key"].dataType, SUMMARY, MESSAGES, SEGMENTS)
    arrow = to_arrow_schema(schema)

    def parts(rows: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        number = TaskContext.get().partitionId() << 33
        turns, roles, texts = [], [], []
        size = 0

        def taken() -> tuple[int, tuple[list, list, list]]:
            nonlocal size
            out = size, (turns[:], roles[:], texts[:])
            size = 0
            for held in (turns, roles, texts):
                held.clear()
            return out

        def segment() -> tuple[tuple, int]:
            nonlocal number
            weight, held = taken()
            number += 1
            return (key, *NO_SUMMARY, None, number, *held), weight

        def repaired() -> tuple[tuple, int]:
            weight, held = taken()
            seen: set[tuple[str, str]] = set()
            codes = ""
            for message in zip(*held[1:]):
                codes += message_code(*message, message in seen)
                seen.add(message)
            repair = Repair(with_rows)
            repair.add(*held, codes, search(codes)[1])
            return (key, *repair.end(), repair.messages, *NO_SEGMENT), weight * with_rows

        key, whole, begun = None, False, False
        for of, turn, role, text, present in rows:
            if not begun:  # the first conversation may have begun in the task before
                key, begun = of, True
            elif of != key:
                yield repaired() if whole else segment()
                key, whole = of, True
            elif len(turns) >= SEGMENT or size > BLOCK_BYTES:
                yield segment()
                whole = False
            if present:
                turns.append(turn)
                roles.append(role)
                texts.append(text)
                size += len(text)
        if begun:  # the last one may go on in the next task
            yield segment()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _batches(parts(_rows(batches)), arrow)

    return messages.mapInArrow(run, schema)


def _with_codes(segments: DataFrame) -> DataFrame:
    """``key, segment, codes, costs`` of segments; a message's first place in its whole
    conversation is found by grouping digests, so that no task holds a conversation."""
    named = F.transform(
        F.arrays_zip("roles", "texts"),
        lambda m: F.sha2(
            F.concat(F.length(m["roles"]), F.lit(":"), m["roles"], m["texts"]).cast("binary"), 256
        ),
    )
    slim = segments.select("key", "segment", F.posexplode(named).alias("place", "digest"))
    first = F.min(F.struct("segment", "place")).alias("first")
    firsts = slim.groupBy("key", "digest").agg(first).select("first.*")
    # at most SEGMENT places
    listed = firsts.groupBy("segment").agg(F.collect_list("place").alias("places"))
    schema = _schema(segments.schema["key"].dataType, "segment bigint, codes string, costs array<bigint>")
    arrow = to_arrow_schema(schema)

    def coded(rows: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        for key, segment, roles, texts, places in rows:
            new = set(places or ())
            codes = "".join(
                message_code(role, text, i not in new)
                for i, (role, text) in enumerate(zip(roles, texts))
            )
            yield (key, segment, codes, prices(codes)), 300

    joined = segments.join(listed, "segment", "left")
    joined = joined.select("key", "segment", "roles", "texts", "places")
    return joined.mapInArrow(lambda batches: _batches(coded(_rows(batches)), arrow), schema)


def _by_conversation(df: DataFrame, *order) -> DataFrame:
    return df.repartition("key").sortWithinPartitions("key", *order)


def _remaining(coded: DataFrame) -> DataFrame:
    """``segment, exits``: what every state after a segment still costs, summed from the end."""
    schema = T.StructType.fromDDL("segment bigint, exits array<bigint>")
    arrow = to_arrow_schema(schema)

    def scan(rows: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        of, begun, exits = None, False, END_COSTS
        for key, segment, costs in rows:
            if not begun or key != of:
                of, begun, exits = key, True, END_COSTS
            yield (segment, exits), 40
            exits = tuple(min(costs[4 * s + e] + exits[e] for e in range(4)) for s in range(4))

    last_first = _by_conversation(coded.select("key", "segment", "costs"), F.desc("segment"))
    return last_first.mapInArrow(lambda batches: _batches(scan(_rows(batches)), arrow), schema)


def _with_edits(coded: DataFrame) -> DataFrame:
    """``segment, codes, edits``: a segment's part of the answer from each state before it."""
    schema = T.StructType.fromDDL("segment bigint, codes string, edits array<string>")
    arrow = to_arrow_schema(schema)

    def searched(rows: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        for segment, codes, exits in rows:
            solve = searcher(codes, tuple(exits))
            yield (segment, codes, [solve(state)[1] for state in range(4)]), 400

    joined = coded.join(_remaining(coded), "segment").select("segment", "codes", "exits")
    return joined.mapInArrow(lambda batches: _batches(searched(_rows(batches)), arrow), schema)


def _second_pass(segments: DataFrame, with_rows: bool) -> DataFrame:
    """Conversations in segments, repaired; messages are given out segment by segment."""
    coded = stored(_with_codes(segments))
    schema = _schema(segments.schema["key"].dataType, SUMMARY, MESSAGES)
    arrow = to_arrow_schema(schema)

    def repaired(rows: Iterator[tuple]) -> Iterator[tuple[tuple, int]]:
        of, repair = None, None
        for key, _, turns, roles, texts, codes, edits in rows:
            if repair is None or key != of:
                if repair is not None:
                    yield (of, *repair.end(), repair.messages), 1000
                of, repair = key, Repair(with_rows)
            repair.add(turns, roles, texts, codes, edits[repair.state])
            if with_rows:
                yield (of, *NO_SUMMARY, repair.messages), sum(map(len, texts))
                repair.messages = []
        if repair is not None:
            yield (of, *repair.end(), repair.messages), 1000

    joined = segments.join(_with_edits(coded), "segment")
    joined = joined.select("key", "segment", "turns", "roles", "texts", "codes", "edits")
    in_order = _by_conversation(joined, "segment")
    return in_order.mapInArrow(lambda batches: _batches(repaired(_rows(batches)), arrow), schema)


def _repaired(df: DataFrame, key: str, present: str | None, with_rows: bool) -> DataFrame:
    blank = lambda name: F.coalesce(column(df, name).cast("string"), F.lit(" "))
    messages = df.select(
        column(df, key).alias("key"),
        column(df, "turn").cast("bigint").alias("turn"),
        blank("role").alias("role"),
        blank("text").alias("text"),
        (F.lit(True) if present is None else column(df, present)).alias("present"),
        # lets even repeated rows be dealt to several tasks
        F.monotonically_increasing_id().alias("row"),
    )
    order = ["key", "turn", "role", "text", "row"]
    dealt = messages.repartitionByRange(*order).sortWithinPartitions(*order).drop("row")
    passed = stored(_first_pass(dealt, with_rows))
    segments = passed.where("segment IS NOT NULL").select("key", "segment", "turns", "roles", "texts")
    done = passed.where("segment IS NULL").drop("segment", "turns", "roles", "texts")
    return done.unionByName(_second_pass(segments, with_rows))


def repair_conversations(
    df: DataFrame, key: str = "conv_id", present: str | None = None
) -> DataFrame:
    """One row for each conversation: ``key``, counts of faults, ``cost``, ``audit`` and
    ``repaired_sha256``, the digest of the repaired ``role:text`` lines.

    ``df`` has ``key, turn, role, text``. Messages are taken by turn, null first, those of one
    turn by role and text. A message's first fault counts: blank, duplicate (same role and
    text seen before in the conversation), truncated (does not end in ``.``, ``!`` or ``?``).
    ``gaps`` are turns missing between the least and the greatest; ``illegal`` counts
    neighbours that may not follow each other. A null role or text is one space; rows of a
    null key are one conversation. Where ``present`` is false a row only makes its
    conversation known: one without messages has zeros, an empty audit and the digest of
    nothing. An empty table gives an empty table; other columns take no part.
    """
    rows = _repaired(df, key, present, False).where("audit IS NOT NULL").drop("messages")
    return rows.withColumnRenamed("key", key)


def repaired_messages(df: DataFrame, key: str = "conv_id", present: str | None = None) -> DataFrame:
    """The repaired conversations: ``key, place, edit, role, text``, one row for each message
    that stays (edit K), changes its role (R) or is inserted (I); places count from 0."""
    rows = _repaired(df, key, present, True)
    return rows.select(F.col("key").alias(key), F.inline("messages"))
