"""Repair of conversations: the cheapest edits after which roles take turns.

A conversation's rows become a signature, one letter a row: the role's initial (s, u, a; x for any
other), upper case if the text is cut off, or d if the row has to go. Legal are an empty
conversation, or an optional s followed by one or more ua. What it costs to repair the rest of a
conversation depends on the rest of its signature and on what the rows before it end in, no more.
So the signatures of all conversations are put in the order of their ends and read into an
automaton whose nodes are the distinct ends, shared by all conversations that end alike; costs and
edits are worked out once for each node and grammar state.

Long conversations are cut into chunks of rows, which tasks take in the order of the table, so
one conversation may hold any share of all rows. For a chunk the automaton gives the cheapest
edits from each state before it to each state after it; chunks are then chained from the last to
the first, which needs their few numbers and edits, not their texts.

The grammar's states are those of the rows before: none, s, u, a. Edits are written as K (keep),
R (give the role that is due, user or assistant), D (delete) and I (insert the role that is due).
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from orderloom.llm.common import ship
from orderloom.operators.lookups import sized
from orderloom.session import staged

CHUNK_ROWS = 1024
CHUNK_BYTES = 1 << 20  # of text; a longer text is a chunk of its own

# Costs of the edits, and what an unfinished text that stays adds.
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 2, 3, 2, 1

_BLANKS = " \t\n\x0b\x0c\r"
_ENDS = (".", "!", "?")
_LEGAL = {"su", "ua", "au"}

# States by what the rows before end in; the row that is due after each, and where it leads.
NONE, S, U, A = range(4)
STATES = (NONE, S, U, A)
_DUE = {NONE: U, S: U, U: A, A: U}
_KEPT = {"s": {NONE: S}, "u": {NONE: U, S: U, A: U}, "a": {U: A}}
_ROLE = {U: "user", A: "assistant"}
# Cost and edits that end a legal conversation after each state.
_CLOSING = {NONE: (0, ""), S: (2 * INSERT, "II"), U: (INSERT, "I"), A: (0, "")}


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with one row in five damaged, chosen by id and turn."""
    blank = F.lit(" ")
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), blank) for c in ("conv_id", "turn")])
    kind = F.crc32(name.cast("binary")) % 20
    rows = conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), kind.alias("kind"),
        *[F.coalesce(F.col(c), blank).alias(c) for c in ("role", "text")],
    )
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, 2).otherwise(1)
    kept = rows.where("kind <> 0").withColumn("copy", F.explode(F.sequence(F.lit(1), copies)))
    return kept.select("conv_id", "turn", role.alias("role"), text.alias("text"))


def turn_gaps(conversations: DataFrame, rows: DataFrame) -> DataFrame:
    """(conv_id, gaps) of every conversation: turns missing between the first and last of `rows`."""
    both = conversations.select("conv_id", F.lit(None).cast("long").alias("turn")).unionByName(rows.select("conv_id", "turn"))
    wide = [F.max("turn").cast("decimal(20,0)"), F.min("turn").cast("decimal(20,0)")]
    gaps = wide[0] - wide[1] + 1 - F.count_distinct("turn")
    return both.groupBy("conv_id").agg(F.coalesce(gaps.cast("long"), F.lit(0).cast("long")).alias("gaps"))


_CHUNK = (
    "conv_id long, chunk long, roles array<string>, texts array<string>, signature string, "
    "keys array<long>, illegal long, first string, last string"
)


def chunks(rows: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """The rows in order, by conversation and turn, as chunks numbered in that order.

    Rows of one turn are ordered by role, by the first letters of the text and by a hash of it.
    Equal rows may part at the border of two tasks, so they get a number that tells them apart.
    In `signature`, b is a blank row and d one whose role and text the chunk has before; `keys`
    has a hash of role and text for every row that is neither, null for the others.
    """
    order = ["conv_id", "turn", "role", F.substring("text", 1, 64), F.xxhash64("text"), "tie"]
    tied = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text", F.monotonically_increasing_id().alias("tie"))
    ordered = tied.repartitionByRange(*order).sortWithinPartitions(*order)

    def build(batches: Iterator[dict]) -> Iterator[dict]:
        number = TaskContext.get().partitionId() << 33
        held: _Chunk | None = None
        for row in batches:
            if held and (row["conv_id"] != held.conv_id or len(held.roles) >= chunk_rows or held.size >= chunk_bytes):
                yield held.row(number)
                number, held = number + 1, None
            held = held or _Chunk(row["conv_id"])
            held.add(row["role"], row["text"])
        if held:
            yield held.row(number)

    return _streamed(ordered.select("conv_id", "role", "text"), _CHUNK, build)


class _Chunk:
    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.roles: list[str] = []
        self.texts: list[str] = []
        self.letters: list[str] = []
        self.keys: list[int | None] = []
        self.seen: set[int] = set()
        self.size = 0

    def add(self, role: str, text: str) -> None:
        key = None
        shown = text.rstrip(_BLANKS)
        if not shown:
            letter = "b"
        else:
            key = xxhash.xxh64_intdigest(f"{role}\n{text}".encode()) - (1 << 63)
            if key in self.seen:
                letter, key = "d", None
            else:
                self.seen.add(key)
                letter = role[:1] if role[:1] in _KEPT else "x"
                letter = letter if shown.endswith(_ENDS) else letter.upper()
        self.roles.append(role)
        self.texts.append(text)
        self.letters.append(letter)
        self.keys.append(key)
        self.size += len(text)

    def row(self, number: int) -> dict:
        initials = [role[:1] or " " for role in self.roles]
        pairs = zip(initials, initials[1:])
        return {
            "conv_id": self.conv_id, "chunk": number, "roles": self.roles, "texts": self.texts,
            "signature": "".join(self.letters), "keys": self.keys,
            "illegal": sum(one + other not in _LEGAL for one, other in pairs),
            "first": initials[0], "last": initials[-1],
        }


def _streamed(df: DataFrame, schema: str, work: Callable[[Iterator[dict]], Iterator[dict]], held: int = 256) -> DataFrame:
    """The rows of each task, in their order, through a generator; `held` results a batch."""
    ship(df.sparkSession)
    result = StructType.fromDDL(schema)
    shape = to_arrow_schema(result)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for row in work(row for batch in parts for row in batch.to_pylist()):
            out.append(row)
            if len(out) >= held:
                yield pa.RecordBatch.from_pylist(out, schema=shape)
                out = []
        yield pa.RecordBatch.from_pylist(out, schema=shape)

    return df.mapInArrow(run, result)


def signatures(chunked: DataFrame) -> DataFrame:
    """The chunks without their texts, repeats of rows of earlier chunks marked too."""
    narrow = chunked.select("conv_id", "chunk", "signature", "illegal", "first", "last")
    several = staged(chunked.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "several-chunks")
    of_several = chunked.select("conv_id", "chunk", "keys").join(
        several.select(F.col("conv_id").alias("other")), F.col("conv_id").eqNullSafe(F.col("other")), "left_semi"
    )
    keys = of_several.select("conv_id", "chunk", F.posexplode("keys").alias("place", "key")).where("key IS NOT NULL")
    keys = staged(keys, "keys")
    seen = keys.groupBy("conv_id", "key").agg(F.min("chunk").alias("earliest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    seen = staged(seen.select(F.col("conv_id").alias("seen_in"), F.col("key").alias("seen"), "earliest"), "seen")
    again = keys.join(seen, F.col("conv_id").eqNullSafe(F.col("seen_in")) & (F.col("key") == F.col("seen")))
    places = again.where("chunk > earliest").groupBy("chunk").agg(F.collect_list("place").alias("places"))
    marked = F.aggregate(
        F.coalesce("places", F.array().cast("array<int>")), F.col("signature"),
        lambda text, place: F.overlay(text, F.lit("d"), place + 1, F.lit(1)),
    )
    return narrow.join(places, "chunk", "left").withColumn("signature", marked).drop("places")


# The automaton


def _least(*options: tuple[int, str, int] | None) -> tuple[int, str, int] | None:
    """The cheapest (cost, edit, next state), of equal ones that of the first letter."""
    return min((option for option in options if option is not None), default=None, key=lambda option: option[:2])


class Node:
    """The end of a signature from one letter on: per state before and state after it, the cost,
    the first edit and the state that this leads to; None where there is no way."""

    __slots__ = ("letter", "rest", "best")

    def __init__(self, letter: str, rest: Node | None):
        self.letter = letter
        self.rest = rest
        self.best = [self._ways(last) for last in STATES]

    def _ways(self, last: int) -> list[tuple[int, str, int] | None]:
        def after(state: int) -> int | None:
            if self.rest is None:
                return 0 if state == last else None
            found = self.rest.best[last][state]
            return None if found is None else found[0]

        def edit(cost: int, name: str, state: int | None) -> tuple[int, str, int] | None:
            rest = None if state is None else after(state)
            return None if rest is None else (cost + rest, name, state)

        def consumed(state: int) -> tuple[int, str, int] | None:
            gone = edit(DELETE, "D", state)
            if self.letter == "d":
                return gone
            more = CUT_OFF if self.letter.isupper() else 0
            stays = edit(KEEP + more, "K", _KEPT.get(self.letter.lower(), {}).get(state))
            return _least(gone, stays, edit(REROLE + more, "R", _DUE[state]))

        plain = [consumed(state) for state in STATES]

        def inserted(state: int, ways: list[tuple[int, str, int] | None]) -> tuple[int, str, int] | None:
            there = ways[_DUE[state]]
            return None if there is None else (INSERT + there[0], "I", _DUE[state])

        # Two rows inserted after u or a lead back to it, so one is the most there; two elsewhere.
        ways = list(plain)
        for state in (U, A):
            ways[state] = _least(plain[state], inserted(state, plain))
        for state in (NONE, S):
            ways[state] = _least(plain[state], inserted(state, ways))
        return ways

    def edits(self, state: int, last: int) -> str | None:
        """The best edits from the state before this end to the state after it."""
        node, out = self, []
        while node is not None:
            found = node.best[last][state]
            if found is None:
                return None
            _, name, state = found
            out.append(name)
            if name != "I":
                node = node.rest
        return "".join(out)


_COSTED = "letters string, costs array<int>, edits array<string>"


def costed(letters: DataFrame) -> DataFrame:
    """Costs and edits of each distinct signature in `letters`, for each state before (the slower
    index) and after; null where there is no way.

    Signatures come in the order of their ends, so those that end alike follow each other, and
    a task keeps just the nodes of one signature: the next one shares a run of them.
    """
    ordered = letters.select("letters", F.reverse("letters").alias("ends")).repartitionByRange("ends").sortWithinPartitions("ends")

    def build(rows: Iterator[dict]) -> Iterator[dict]:
        before, nodes = "", []
        for row in rows:
            ends = row["ends"]
            shared = 0
            while shared < min(len(ends), len(before)) and ends[shared] == before[shared]:
                shared += 1
            del nodes[shared:]
            for letter in ends[shared:]:
                nodes.append(Node(letter, nodes[-1] if nodes else None))
            before, node = ends, nodes[-1]
            ways = [(state, last) for state in STATES for last in STATES]
            costs = [node.best[last][state] for state, last in ways]
            yield {
                "letters": row["letters"],
                "costs": [None if found is None else found[0] for found in costs],
                "edits": [node.edits(state, last) for state, last in ways],
            }

    return _streamed(ordered, _COSTED, build)


_DECIDED = (
    "conv_id long, chunk long, chunks long, state int, audit string, leads boolean, "
    "blank long, duplicate long, truncated long, illegal long, cost long"
)


def decided(signed: DataFrame) -> DataFrame:
    """Per chunk, the state before it and its edits; the first chunk of a conversation also has
    the conversation's counts and cost."""
    letters = F.regexp_replace("signature", "b", "d")
    signed = staged(signed.withColumn("letters", letters), "signatures")
    tables = staged(costed(signed.select("letters").distinct()), "costs")
    whole = signed.join(tables, "letters")
    ordered = whole.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), F.desc("chunk"))

    def build(rows: Iterator[dict]) -> Iterator[dict]:
        held: list[dict] = []
        for row in rows:
            if held and row["conv_id"] != held[0]["conv_id"]:
                yield from _chained(held)
                held = []
            # Of a chunk only numbers and edits are here; the text of the edits is a result.
            held.append(row)
        if held:
            yield from _chained(held)

    return _streamed(ordered.drop("letters"), _DECIDED, build)


def _chained(backwards: list[dict]) -> Iterator[dict]:
    """The decisions for the chunks of one conversation, given from the last to the first."""
    rest = dict(_CLOSING)
    exits: list[dict[int, int]] = []
    for row in backwards:
        ahead, exit_of = {}, {}
        for state in STATES:
            ways = [
                (row["costs"][4 * state + last] + rest[last][0], row["edits"][4 * state + last] + rest[last][1], last)
                for last in STATES
                if row["costs"][4 * state + last] is not None and last in rest
            ]
            if ways:
                cost, edits, exit_of[state] = min(ways)
                ahead[state] = cost, edits
        rest = ahead
        exits.append(exit_of)
    forwards, state = backwards[::-1], NONE
    marks = "".join(row["signature"] for row in forwards)
    borders = zip(forwards, forwards[1:])
    totals = {
        "blank": marks.count("b"), "duplicate": marks.count("d"),
        "truncated": sum(map(str.isupper, marks)),
        "illegal": sum(row["illegal"] for row in forwards)
        + sum(one["last"] + other["first"] not in _LEGAL for one, other in borders),
        "cost": rest[NONE][0],
    }
    for number, (row, exit_of) in enumerate(zip(forwards, exits[::-1])):
        last = exit_of[state]
        closing = _CLOSING[last][1] if number == len(forwards) - 1 else ""
        yield {
            "conv_id": row["conv_id"], "chunk": row["chunk"], "chunks": len(forwards), "state": state,
            "audit": row["edits"][4 * state + last] + closing, "leads": number == 0,
            **(totals if number == 0 else dict.fromkeys(totals)),
        }
        state = last


def repaired(roles: list[str], texts: list[str], audit: str, state: int = NONE) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits of `audit`, from a state on."""
    new_roles, new_texts, at = [], [], 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        role, text = _ROLE[_DUE[state]], ""
        if edit != "I":
            role, text = roles[at] if edit == "K" else role, texts[at]
            at += 1
        state = _KEPT[role[0]][state]
        new_roles.append(role)
        new_texts.append(text)
    return new_roles, new_texts


_REPAIRED = "conv_id long, chunk long, roles array<string>, texts array<string>, chunks long, audit string"


def repaired_chunks(chunked: DataFrame, decisions: DataFrame) -> DataFrame:
    """The chunks after their edits: roles and texts that remain, in order, and the edits."""
    # The decisions have no texts; where they are small, the texts are not shuffled for them.
    chosen = sized(decisions.select("chunk", "chunks", "state", "audit"))
    both = chunked.select("conv_id", "chunk", "roles", "texts").join(chosen, "chunk")

    def build(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            roles, texts = repaired(row["roles"], row["texts"], row["audit"], row["state"])
            yield {**{k: row[k] for k in ("conv_id", "chunk", "chunks", "audit")}, "roles": roles, "texts": texts}

    return _streamed(both, _REPAIRED, build, held=32)


_HASHED = "conv_id long, audit string, repaired_sha256 string"


def _hashed(rows: Iterator[dict]) -> Iterator[dict]:
    """One row per conversation, of chunks that come in order."""
    conv_id, audit, digest, empty, any_rows = None, [], hashlib.sha256(), True, False
    for row in rows:
        if any_rows and row["conv_id"] != conv_id:
            yield {"conv_id": conv_id, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
            audit, digest, empty = [], hashlib.sha256(), True
        conv_id, any_rows = row["conv_id"], True
        audit.append(row["audit"])
        for role, text in zip(row["roles"], row["texts"]):
            digest.update(f"{'' if empty else chr(10)}{role}:{text}".encode())
            empty = False
    if any_rows:
        yield {"conv_id": conv_id, "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}


def digests(parts: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256) of the repaired chunks.

    A hash is of the whole conversation, so the chunks of one that has several meet in order in
    one task, which passes them on one by one.
    """
    order = [F.asc_nulls_first("conv_id"), F.asc("chunk")]
    single = _streamed(parts.where("chunks = 1"), _HASHED, lambda rows: (out for row in rows for out in _hashed(iter([row]))))
    several = parts.where("chunks > 1").repartition("conv_id").sortWithinPartitions(*order)
    return single.unionByName(_streamed(several, _HASHED, _hashed))


def repair(conversations: DataFrame, chunk_rows: int = CHUNK_ROWS, chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, DataFrame]:
    """The report, a row per conv_id, and the repaired conversations as chunks of rows.

    The report has gaps, blank, duplicate, truncated, illegal, cost (longs), audit and
    repaired_sha256 of every conv_id of the input, after the damage of `damaged`. Nulls: a null
    conv_id is a conversation like any other; null turns come first and count for no gap; a
    null role or text is one space, so the row is blank or of no known role, and so is an empty
    role. Repeated rows are duplicates of their first. A conversation that has no rows left has
    zeros, an empty audit and the hash of the empty text. Equal turns are ordered as `chunks`
    says. Other columns are ignored; an empty table gives no rows.
    """
    rows = damaged(conversations)
    chunked = staged(chunks(rows, chunk_rows, chunk_bytes), "conversation-chunks")
    decisions = staged(decided(signatures(chunked)), "decisions")
    counts = [name.split()[0] for name in _DECIDED.split(", ")[6:]]
    parts = repaired_chunks(chunked, decisions)
    found = decisions.where("leads").select(F.col("conv_id").alias("decided_id"), *counts)
    hashes = digests(parts).select(F.col("conv_id").alias("hashed_id"), "audit", "repaired_sha256")
    gaps = turn_gaps(conversations.select(F.col("conv_id").cast("long").alias("conv_id")), rows.withColumn("conv_id", F.col("conv_id").cast("long")))
    whole = gaps.join(found, F.col("conv_id").eqNullSafe(F.col("decided_id")), "left").join(
        hashes, F.col("conv_id").eqNullSafe(F.col("hashed_id")), "left"
    )
    nothing = hashlib.sha256().hexdigest()
    report = whole.select(
        "conv_id", "gaps", *[_or(F.col(name), F.lit(0).cast("long")).alias(name) for name in counts],
        _or(F.col("audit"), F.lit("")).alias("audit"), _or(F.col("repaired_sha256"), F.lit(nothing)).alias("repaired_sha256"),
    )
    return report, parts


def _or(column: Column, default: Column) -> Column:
    return F.coalesce(column, default)
