"""Best-fit packing with exact complements, planned on the histogram of piece lengths.

Pieces of one length are alike, so a plan over at most `capacity` lengths and their counts
fits the driver whatever the number of documents. Sums of one, two and three lengths are indexed:
a gap is looked up as a single length, then as a pair, then as a triple, and a combination that
fills it exactly is taken as often as its counts allow. What is left goes best-fit, longest first.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import batches, ship
from orderloom.llm.token_ids import default_file, encoder
from orderloom.session import staged

CAPACITY = 2048
END_ID = 0


@dataclass(frozen=True)
class Group:
    """`times` sequences, each of these (length, count) in order."""

    lengths: tuple[tuple[int, int], ...]
    times: int

    def filled(self) -> int:
        return sum(length * count for length, count in self.lengths)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[Group]:
    """Sequences that hold every piece of the histogram once, none over `capacity`."""
    left = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        left[length] = count
    groups = _complements(left, capacity)
    return groups + _best_fit(left, capacity)


class SumIndex:
    """Which lengths are there, indexed by the sums of one, two and three of them.

    For every sum there is a row of the pairs that make it up, by their longer part; it follows
    every change of what is there, so no pair is ever looked for. A triple is a length and a pair
    of the sum that is left.
    """

    def __init__(self, left: np.ndarray):
        self.left = left
        self.capacity = len(left) - 1
        self.pairs = np.zeros((len(left), len(left)), bool)
        for length in np.flatnonzero(left):
            self._enter(int(length))

    def take(self, length: int, count: int = 1) -> None:
        self._set(length, int(self.left[length]) - count)

    def give(self, length: int) -> None:
        self._set(length, int(self.left[length]) + 1)

    def _set(self, length: int, count: int) -> None:
        before = min(int(self.left[length]), 2)
        self.left[length] = count
        if min(count, 2) != before:
            self._enter(length)

    def _enter(self, length: int) -> None:
        """Put right the pairs that a length is part of."""
        others = np.flatnonzero(self.left[: self.capacity - length + 1])
        others = others[(others > 0) & (others != length)]
        self.pairs[others + length, np.maximum(others, length)] = self.left[length] > 0
        if 2 * length <= self.capacity:
            self.pairs[2 * length, length] = self.left[length] > 1

    def pair(self, total: int) -> tuple[int, int] | None:
        """Two lengths of this sum, the first the longer and as long as possible."""
        longer = total - int(self.pairs[total, total::-1].argmax())
        return (longer, total - longer) if self.pairs[total, longer] else None

    def filling(self, gap: int) -> tuple[int, ...] | None:
        """At most three lengths that add up to the gap, the longest first."""
        if not gap:
            return ()
        if self.left[gap]:
            return (gap,)
        pair = self.pair(gap)
        if pair:
            return pair
        longest = np.arange(gap - 2, (gap - 1) // 3, -1)
        longest = longest[self.left[longest] > 0]
        for length in longest[self.pairs[gap - longest].any(axis=1)].tolist():
            self.take(length)  # it is not there to be in the pair as well
            pair = self.pair(gap - length)
            self.give(length)
            if pair and pair[0] <= length:
                return (length, *pair)
        return None


def _complements(left: np.ndarray, capacity: int) -> list[Group]:
    index, groups = SumIndex(left), []
    for length in range(capacity, 0, -1):
        while left[length]:
            index.take(length)  # the piece whose gap is to be filled is not there to fill it
            filling = index.filling(capacity - length)
            index.give(length)
            if filling is None:
                break
            need = Counter((length, *filling))
            times = min(int(left[size]) // n for size, n in need.items())
            for size, n in need.items():
                index.take(size, n * times)
            groups.append(Group(tuple(sorted(need.items(), reverse=True)), times))
    return groups


def _best_fit(left: np.ndarray, capacity: int) -> list[Group]:
    """Each remaining piece, longest first, into the fullest sequence that has room for it."""
    open_groups: dict[int, list[Group]] = {}
    rooms: list[int] = []  # in order

    def put(group: Group) -> None:
        room = capacity - group.filled()
        if room not in open_groups:
            open_groups[room] = []
            insort(rooms, room)
        open_groups[room].append(group)

    for length in range(capacity, 0, -1):
        pieces = int(left[length])
        left[length] = 0
        while pieces:
            at = bisect_left(rooms, length)
            if at == len(rooms):
                group, each = Group((), pieces), min(pieces, capacity // length)
            else:
                room = rooms[at]
                group = open_groups[room].pop()
                if not open_groups[room]:
                    del open_groups[room], rooms[at]
                each = min(pieces, room // length)
            times = min(group.times, pieces // each)
            put(Group((*group.lengths, (length, each)), times))
            if group.lengths and group.times > times:
                put(Group(group.lengths, group.times - times))
            pieces -= times * each
    return [group for waiting in open_groups.values() for group in waiting]


def slots(groups: list[Group]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length, from which rank on its pieces go where: arrays of first rank, first
    sequence, place in the sequence, and pieces per sequence."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: Counter = Counter()
    sequence = 0
    for group in groups:
        place = 0
        for length, each in group.lengths:
            rows.setdefault(length, []).append((ranks[length], sequence, place, each))
            ranks[length] += each * group.times
            place += length * each
        sequence += group.times
    return {length: tuple(np.array(x, np.int64) for x in zip(*found)) for length, found in rows.items()}


def placed(
    length: np.ndarray, rank: np.ndarray, where: dict[int, tuple[np.ndarray, ...]]
) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and place there of pieces given by their length and rank in that length."""
    sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
    for size in np.unique(length):
        mine = np.flatnonzero(length == size)
        first, base, place, each = where[int(size)]
        slot = np.searchsorted(first, rank[mine], "right") - 1
        nth = rank[mine] - first[slot]
        sequence[mine] = base[slot] + nth // each[slot]
        offset[mine] = place[slot] + nth % each[slot] * size
    return sequence, offset


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole ones, after a first that may be shorter."""
    first = total % capacity or min(total, capacity)
    return [(0, first)] + [(at, capacity) for at in range(first, total, capacity)]


PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"
)


def pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int, added: bool = False) -> DataFrame:
    """The pieces of every document; `nth` counts those of one length within a task."""
    ship(docs.sparkSession)
    names = [x.split()[0] for x in PIECES.split(", ")]
    kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
    end = struct.pack("<I", end_id)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, part = encoder(tokenizer, added).encode_all, Counter(), TaskContext.get().partitionId()
        for batch in parts:
            rows = []
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode(batch.column(1))):
                ids += end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    rows.append((doc_id, k, start, length, crc, part, seen[length]))
                    seen[length] += 1
            columns = zip(*rows) if rows else [[] for _ in names]
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES)


def pack(
    docs: DataFrame,
    tokenizer: str | None = None,
    end_id: int = END_ID,
    capacity: int = CAPACITY,
    added: bool = False,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    Each document is its ids and `end_id`, so a null or empty text is a piece of one id.
    Repeated rows are packed each; a null doc_id stays null; other columns are ignored; an
    empty table has no pieces. Texts are read once and never shuffled. `added` is that of the
    encoder.
    """
    spark = docs.sparkSession
    made = staged(pieces(docs, tokenizer or default_file(), end_id, capacity, added), "pieces")
    histogram = made.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()
    where = spark.sparkContext.broadcast(slots(plan({x["length"]: x["n"] for x in histogram}, capacity)))
    # The rank of a piece in its length: those of earlier tasks, then its own count.
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        made.groupBy("part", "length")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    )
    ranked = made.join(bases, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("nth")).alias("rank")
    )

    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in (3, 5))
            sequence, offset = placed(length, rank, where.value)
            return dict(zip(KEPT, batch.columns)) | {"sequence_id": sequence, "offset": offset}

        return work

    return batches(ranked, RESULT, prepare)


RESULT = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
)
KEPT = ("doc_id", "piece", "start", "length", "ids_crc32")
