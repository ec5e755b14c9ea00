"""Conversation repair against a search over all edits, row by row."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
import xxhash

from orderloom.llm import conversations
from orderloom.llm.catalog import op12_conversation_repair

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string"
KEPT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
DUE = {"": "u", "s": "u", "u": "a", "a": "u"}


def signed_hash(text: str) -> int:
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


def damaged(rows):
    found = defaultdict(list)
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        found[conv] += [(turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    for held in found.values():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2][:64].encode(), signed_hash(r[2])))
    return found


def faults_of(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        shown = text.rstrip(BLANKS)
        cut = "truncated" if shown and shown[-1] not in ".!?" else None
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else cut)
        seen.add((role, text))
    return faults


def cheapest(rows, faults):
    """The edits of least cost and of these the least text, by taking up partial edits in order."""
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, at, state, out = heapq.heappop(heap)
        if at == len(rows) and state in ("", "a"):
            return cost, audit, out
        if (at, state) in done:
            continue
        done.add((at, state))
        due = DUE[state]
        name = {"u": "user", "a": "assistant"}[due]
        heapq.heappush(heap, (cost + 2, audit + "I", at, due, (*out, (name, ""))))
        if at < len(rows):
            (_, role, text), fault = rows[at], faults[at]
            heapq.heappush(heap, (cost + 3, audit + "D", at + 1, state, out))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                heapq.heappush(heap, (cost + 2 + more, audit + "R", at + 1, due, (*out, (name, text))))
                if role[:1] in KEPT[state]:
                    heapq.heappush(heap, (cost + more, audit + "K", at + 1, KEPT[state][role[:1]], (*out, (role, text))))


def brute_force(rows):
    for conv, held in damaged(rows).items():
        faults = faults_of(held)
        cost, audit, out = cheapest(held, faults)
        turns = [turn for turn, _, _ in held if turn is not None]
        initials = [role[:1] or " " for _, role, _ in held]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [faults.count(fault) for fault in ("blank", "duplicate", "truncated")]
        digest = hashlib.sha256("\n".join(f"{role}:{text}" for role, text in out).encode()).hexdigest()
        yield (conv, gaps, *counts, illegal, cost, audit, digest)


def same(report, rows):
    columns = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert report.columns == columns
    assert sorted(map(tuple, report.collect()), key=str) == sorted(brute_force(rows), key=str)


def messy(count, convs, seed):
    """Rows of conversations with nulls, unknown and empty roles, repeats and equal turns."""
    pick = random.Random(seed).choice
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None]
    texts = ["a.", "b!", "c", " ", "", None, "long?  ", "x\ny.", "ümläut ✓", "\x00."]
    return [(pick([None, *range(convs)]), pick([None, *range(12)]), pick(roles), pick(texts)) for _ in range(count)]


@pytest.mark.parametrize("chunk_rows, chunk_bytes", [(1024, 1 << 20), (2, 1 << 20), (3, 4), (1, 1)])
def test_equals_search_over_all_edits(spark, chunk_rows, chunk_bytes):
    rows = messy(1500, 150, chunk_rows)
    report, _ = conversations.repair(spark.createDataFrame(rows, SCHEMA), chunk_rows, chunk_bytes)
    same(report, rows)


def test_one_long_conversation(spark):
    rows = [(7, turn, role, text) for turn, (_, _, role, text) in enumerate(messy(700, 1, 5))]
    report, _ = conversations.repair(spark.createDataFrame(rows, SCHEMA).repartition(5), 16, 1 << 20)
    same(report, rows)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    same(op12_conversation_repair(spark, "/root/testdata/sf0.01"), rows)


def test_chunks_hold_the_repaired_rows(spark):
    rows = messy(300, 20, 9)
    _, parts = conversations.repair(spark.createDataFrame(rows, SCHEMA), 4)
    found = defaultdict(list)
    for part in sorted(parts.collect(), key=lambda r: r["chunk"]):
        found[part["conv_id"]] += list(zip(part["roles"], part["texts"]))
    for conv, held in damaged(rows).items():
        _, _, out = cheapest(held, faults_of(held))
        assert tuple(found[conv]) == out
        assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in out))


def test_nothing_left_empty_and_extra_columns(spark):
    dropped = next(k for k in range(1000) if zlib.crc32(f"{k}:1".encode()) % 20 == 0)
    rows = [(dropped, 1, "user", "gone.")]
    report, _ = conversations.repair(spark.createDataFrame(rows, SCHEMA))
    assert tuple(report.first()) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert conversations.repair(spark.createDataFrame([], SCHEMA))[0].collect() == []
    rows = messy(60, 6, 3)
    clashing = spark.createDataFrame(
        [(*row, 1, "K", "x", 2) for row in rows], SCHEMA + ", chunk long, audit string, signature string, n long"
    )
    same(conversations.repair(clashing)[0], rows)


def test_very_long_texts(spark):
    rows = [(1, turn, ("user", "assistant")[turn % 2], "word " * 300_000 + ("." if turn % 3 else "")) for turn in range(6)]
    same(conversations.repair(spark.createDataFrame(rows, SCHEMA))[0], rows)


def test_ends_shared_by_signatures_are_one_node(spark, monkeypatch):
    made = []
    plain = conversations.Node.__init__
    monkeypatch.setattr(conversations.Node, "__init__", lambda self, *args: (made.append(args[0]), plain(self, *args))[1])
    ends = sorted(word[::-1] for word in ["uaua", "aua", "sua", "ua", "xua"])
    before, nodes = "", []
    for end in ends:
        shared = len([1 for k in range(min(len(end), len(before))) if end[: k + 1] == before[: k + 1]])
        del nodes[shared:]
        for letter in end[shared:]:
            nodes.append(conversations.Node(letter, nodes[-1] if nodes else None))
        before = end
    assert len(made) == len({word[-k:] for word in ["uaua", "aua", "sua", "ua", "xua"] for k in range(1, len(word) + 1)})
