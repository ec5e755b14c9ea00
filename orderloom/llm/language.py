"""Language identification by cross-parsing entropy.

For each language a suffix automaton of sample text recognises every substring of it. A text is
parsed, for each language, into longest phrases that occur in the sample; a phrase points into
the sample, so phrases times log2 of the sample's length, per byte, is the code length that
the language gives the text. The language of the fewest normalised phrases wins.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.common import batches, is_residue, learnable, ship, texts
from orderloom.session import staged

HELD_MODULUS, HELD_RESIDUE = 5, 0
SAMPLE_DOCS = 96  # labelled documents per language that the automata are made of
SAMPLE_BYTES = 32 << 10  # of them, which fewer documents meet where they are long
SEGMENT = 256  # bytes of a text that are parsed side by side with the next ones
SURE_BYTES = 64  # the score does not grow with text beyond so many bytes
UNKNOWN = "und"
MIN_SCORE = 0.2  # fit of documents that the pipeline keeps
HALVED = 1 / 3  # the fit halves with each such share of code length above the usual one

_LETTER = re.compile(r"[^\W\d_]")
# Letters of the ASCII range stand for themselves, all else of it for a blank.
_CLASSES = np.array(
    [b if 0x61 <= b <= 0x7A or b >= 0x80 else b + 32 if 0x41 <= b <= 0x5A else 32 for b in range(256)], np.uint8
)


def normalised(text: str) -> np.ndarray:
    """Lower-case letters as bytes, everything else of ASCII as single blanks."""
    data = _CLASSES[np.frombuffer(text.lower().encode("utf-8", "surrogatepass"), np.uint8)]
    if len(data) < 2:
        return data
    blank = data == 32
    keep = ~blank
    keep[0] |= blank[0]
    keep[1:] |= blank[1:] & ~blank[:-1]
    return data[keep]


def suffix_automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions by state; state 0 is the start, and every substring is a path from it."""
    steps: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for byte in data:
        new = len(steps)
        steps.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and byte not in steps[state]:
            steps[state][byte] = new
            state = link[state]
        if state >= 0:
            target = steps[state][byte]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                copy = len(steps)
                steps.append(dict(steps[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                link[target] = link[new] = copy
                while state >= 0 and steps[state].get(byte) == target:
                    steps[state][byte] = copy
                    state = link[state]
        last = new
    return steps


@dataclass(frozen=True)
class Model:
    """Sample text per language, in order of their names, and the code length per byte that
    is usual for text of each; a language without one fits every text."""

    samples: tuple[tuple[str, bytes], ...]
    usual: tuple[float, ...] = ()


class Parser:
    """The automata of a model as tables from (state, byte class) to state.

    A table has at most 2 * sample bytes * 256 entries, whatever the corpus.
    """

    def __init__(self, model: Model) -> None:
        self.names = [name for name, _ in model.samples]
        self.usual = np.array(model.usual or [math.inf] * len(self.names))
        used = sorted({byte for _, data in model.samples for byte in data})
        # Class 0 pads segments; the next is any byte that no sample has.
        self.classes = np.ones(256, np.int64)
        self.classes[used] = np.arange(2, len(used) + 2)
        self.width = len(used) + 2
        self.bits = [math.log2(max(len(data), 2)) for _, data in model.samples]
        self.tables = []
        for _, data in model.samples:
            steps = suffix_automaton(data)
            table = np.full((len(steps), self.width), -1, np.int32)
            for state, moves in enumerate(steps):
                for byte, target in moves.items():
                    table[state, self.classes[byte]] = target
            table[:, 0] = np.arange(len(steps))  # padding changes nothing
            self.tables.append(table)

    def phrases(self, streams: list[np.ndarray]) -> np.ndarray:
        """Phrases of each text (rows) in each language (columns).

        Texts are parsed in segments, all of them a byte at a time, each as if a phrase began
        with it. Then the parse of each segment is carried on into the next, until it begins a
        phrase where that one's own parse does, from where on the two are the same. So the
        phrases are those of whole texts; only the last, which the text's end cuts, is not counted.
        """
        sizes = np.array([-(-len(x) // SEGMENT) for x in streams], np.int64)
        grid = np.zeros((int(sizes.sum()), SEGMENT), np.int64)
        flat = grid.reshape(-1)
        for data, at in zip(streams, (np.cumsum(sizes) - sizes) * SEGMENT):
            flat[at : at + len(data)] = self.classes[data]
        grid = np.ascontiguousarray(grid.T)
        owner = np.repeat(np.arange(len(streams)), sizes)
        out = np.zeros((len(streams), len(self.tables)))
        for k, table in enumerate(self.tables):
            breaks = np.empty(grid.shape, bool)
            state = np.zeros(grid.shape[1], np.int64)
            for place, symbol in enumerate(grid):
                state, breaks[place] = self._step(table, state, symbol)
            count, ends = breaks.sum(axis=0), state.copy()
            inner = np.flatnonzero(owner[1:] == owner[:-1]) + 1
            while len(inner):
                was = ends.copy()
                self._carry(table, grid, breaks, inner, state, ends, count)
                after = np.flatnonzero(ends != was) + 1
                after = after[after < len(owner)]
                inner = after[owner[after] == owner[after - 1]]
            out[:, k] = np.bincount(owner, weights=count, minlength=len(streams))
        return out

    def _step(self, table: np.ndarray, state: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The states after a byte, and where a phrase had to begin with it."""
        move = table.reshape(-1).take(state * self.width + symbol)
        stuck = move < 0
        return np.where(stuck, np.maximum(table[0], 0).take(symbol), move).astype(np.int64, copy=False), stuck

    def _carry(
        self,
        table: np.ndarray,
        grid: np.ndarray,
        breaks: np.ndarray,
        columns: np.ndarray,
        own: np.ndarray,
        ends: np.ndarray,
        count: np.ndarray,
    ) -> None:
        """Parse some segments from the states that the ones before end in, and put right their
        `count` and `ends`. `own` are the ends of the segments' own parses, with `breaks`."""
        state, carried = ends[columns - 1], np.zeros(len(columns), np.int64)
        for place in range(len(grid)):
            state, stuck = self._step(table, state, grid[place, columns])
            carried += stuck
            met = stuck & breaks[place, columns]
            if met.any():
                same = columns[met]
                count[same], ends[same] = breaks[place + 1 :, same].sum(axis=0) + carried[met], own[same]
                columns, state, carried = columns[~met], state[~met], carried[~met]
                if not len(columns):
                    return
        count[columns], ends[columns] = carried, state

    def judge(self, found: list[str]) -> list[tuple[str, float, float]]:
        """Language, score and fit of each text.

        The fit compares the code length with what is usual for the language, however many
        languages there are. A text shorter than `SURE_BYTES` is taken to be so long, as its few
        phrases tell nothing.
        """
        lettered = [bool(_LETTER.search(text)) for text in found]
        if not self.names:
            return [(UNKNOWN, 0.0, 0.0)] * len(found)
        streams = [normalised(text) if has else np.zeros(0, np.uint8) for text, has in zip(found, lettered)]
        length = np.array([max(len(x), 1) for x in streams])
        spent = self.phrases(streams) * np.array(self.bits)
        cost = spent / length[:, None]
        rows, best = np.arange(len(streams)), cost.argmin(axis=1)  # the first by name, where several are alike
        more = cost - cost[rows, best][:, None]
        score = 1 / np.exp2(-more * np.minimum(length, SURE_BYTES)[:, None]).sum(axis=1)
        ratio = spent[rows, best] / np.maximum(length, SURE_BYTES) / self.usual[best]
        fit = np.exp2(-np.maximum(ratio - 1, 0) / HALVED)
        return [
            (self.names[k], float(s), float(f)) if has else (UNKNOWN, 0.0, 0.0)
            for k, s, f, has in zip(best, score, fit, lettered)
        ]


def usual_cost(parts: list[bytes]) -> float:
    """Median code length per byte of the texts, by their bytes, each half of them parsed with
    the other; infinite where there are no two texts."""
    costs, sizes = [], []
    for known, other in ((parts[::2], parts[1::2]), (parts[1::2], parts[::2])):
        streams = [np.frombuffer(data, np.uint8) for data in other if data]
        if not streams or not any(known):
            continue
        half = Parser(Model((("", b" ".join(known)),)))
        sizes += [len(x) for x in streams]
        costs += (half.phrases(streams)[:, 0] * half.bits[0] / np.array(sizes[-len(streams) :])).tolist()
    if not costs:
        return math.inf
    order = np.argsort(costs)
    below = np.cumsum(np.array(sizes)[order])
    return costs[order[np.searchsorted(below, below[-1] / 2)]] or math.inf


@lru_cache(maxsize=1)
def parser(model: Model) -> Parser:
    return Parser(model)


def judged(found: list[str], model: Model, at_once: int = 4 << 20) -> list[tuple[str, float, float]]:
    """As `Parser.judge`, some megabytes of text at a time."""
    out, some, size = [], [], 0
    for text in found:
        some.append(text)
        size += len(text)
        if size >= at_once:
            out += parser(model).judge(some)
            some, size = [], 0
    return out + (parser(model).judge(some) if some else [])


def learn(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """At most `sample_docs` different labelled texts per language, each as a whole.

    Texts are picked by their hash, at a rate that follows the language's different texts, so
    copies count once and every language gets that many texts where it has them. A text that
    would make a language's sample longer than `sample_bytes` is passed over; where each is
    longer by itself, the shortest is taken. Rows without text, language or id and held-out
    rows are not learned from.
    """
    known = docs.where(F.col("text").isNotNull() & F.col("lang").isNotNull()).where(
        learnable(F.col("doc_id"), HELD_MODULUS, HELD_RESIDUE)
    )
    mark, doc_id = F.xxhash64("text"), F.col("doc_id").cast("long")
    # Texts do not move but those taken in the end: each is known by its hash and an id.
    different = staged(
        known.groupBy("lang", mark.alias("mark")).agg(
            F.min(doc_id).alias("first"), F.max(F.octet_length("text")).alias("size")
        ),
        "language-marks",
    )
    counts = {row["lang"]: row["n"] for row in different.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not counts:
        return Model(())
    grain = 1 << 30
    limits = F.create_map(
        *(F.lit(x) for lang, n in counts.items() for x in (lang, min(grain, grain * 6 * sample_docs // n)))
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("mark", F.lit(grain)), "mark"))
    picked = (
        different.where(F.pmod("mark", F.lit(grain)) < limits[F.col("lang")])
        .withColumn("place", place)
        .where(F.col("place") <= sample_docs)
    )
    found: dict[str, list] = {}
    for row in picked.orderBy("lang", "place").collect():
        found.setdefault(row["lang"], []).append(row)
    chosen = [row for rows in found.values() for row in _within(rows, sample_bytes)]
    names = ("told_lang", "told_mark", "told_id", "place")
    told = docs.sparkSession.createDataFrame(
        [(row["lang"], row["mark"], row["first"], row["place"]) for row in chosen],
        "told_lang string, told_mark long, told_id long, place int",
    )
    texts_of = (
        known.select("lang", "text", mark.alias("mark"), doc_id.alias("first"))
        .join(F.broadcast(told), F.expr("lang = told_lang AND mark = told_mark AND first = told_id"))
        .groupBy(*names)
        .agg(F.min("text").alias("text"))
    )
    samples: dict[str, list[bytes]] = {}
    for row in texts_of.orderBy("told_lang", "place").collect():
        samples.setdefault(row["told_lang"], []).append(normalised(row["text"]).tobytes())
    ordered = sorted(samples.items())
    return Model(
        tuple((name, b" ".join(parts)) for name, parts in ordered),
        tuple(usual_cost(parts) for _, parts in ordered),
    )


def _within(rows: list, most: int) -> list:
    """The rows that `most` bytes have room for, in their order, and at least the shortest."""
    taken, size = [], 0
    for row in rows:
        if size + row["size"] <= most:
            taken.append(row)
            size += row["size"]
    return taken or [min(rows, key=lambda row: (row["size"], row["place"]))]


RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


def identify(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every input row.

    The score is the chance of the language among those learned, at most so sure as
    `SURE_BYTES` bytes make it. A text that is null or has no letter is `und` with score 0, and
    so is every text where nothing was learned; ties go to the first language by name.
    Repeated rows are judged each; other columns are ignored.
    """
    told = docs.sparkSession.sparkContext.broadcast(model or learn(docs))

    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            found = judged(texts(batch.column(2)), told.value)
            return {
                "doc_id": batch.column(0),
                "held_out": batch.column(1),
                "lang_pred": [x[0] for x in found],
                "score": [x[1] for x in found],
            }

        return work

    held = is_residue(F.col("doc_id"), HELD_MODULUS, HELD_RESIDUE).alias("held")
    return batches(docs.select(F.col("doc_id").cast("long"), held, "text"), RESULT, prepare)


def identified(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """The rows whose text fits a language that was learned by `min_score` or more; all columns
    unchanged. Text of no known language does not fit the nearest one either; a short text
    stays, also where it could be of several. Null, empty and letterless texts are of none and
    go; repeated rows are judged alike."""
    ship(docs.sparkSession)
    told = docs.sparkSession.sparkContext.broadcast(learn(docs))
    at = docs.columns.index("text")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            found = judged(texts(batch.column(at)), told.value)
            keep = [name != UNKNOWN and fit >= min_score for name, _, fit in found]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
