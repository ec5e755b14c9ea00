"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A document's words are coded by the words of the benchmark; a pattern is a window of
consecutive item words. A table of word pairs tells how far the search may move on; where it
may not, the pair selects a bucket of patterns, which are compared word by word.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import batches, ship, texts
from orderloom.session import staged

WINDOW = 10
BLOCK_BYTES = 2 << 20  # benchmark text searched for at once

# Bytes of words: digits, letters (folded to lower case) and everything beyond ASCII.
_FOLD = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 32
    for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class PatternTable:
    """Shift and bucket tables for patterns of one length, given as tuples of word codes."""

    def __init__(self, length: int, patterns: set[tuple[int, ...]], span: int) -> None:
        self.length = length
        self.block = min(2, length)
        self.span = span
        self.farthest = length - self.block + 1
        self.shift: dict[int, int] = {}
        self.buckets: dict[int, set[tuple[int, ...]]] = defaultdict(set)
        for pattern in patterns:
            for end in range(self.block, length + 1):
                key = self._key(pattern, end - 1)
                left = length - end
                if left < self.shift.get(key, self.farthest):
                    self.shift[key] = left
            self.buckets[self._key(pattern, length - 1)].add(pattern)

    def _key(self, codes: tuple[int, ...] | list[int], at: int) -> int:
        return codes[at] if self.block == 1 else codes[at - 1] * self.span + codes[at]

    def ends(self, codes: list[int]) -> list[int]:
        """Positions at which some pattern ends."""
        length, span, block = self.length, self.span, self.block
        shift, farthest, buckets = self.shift.get, self.farthest, self.buckets
        found, at, n = [], length - 1, len(codes)
        while at < n:
            code = codes[at]
            if code < 0:  # in no pattern: nothing that holds this word can match
                at += length
                continue
            key = code if block == 1 else codes[at - 1] * span + code
            move = shift(key, farthest) if block == 1 or codes[at - 1] >= 0 else farthest
            if move:
                at += move
                continue
            if tuple(codes[at - length + 1 : at + 1]) in buckets[key]:
                found.append(at)
            at += 1
        return found


class Search:
    """All windows of a block of items, ready to be looked for in documents."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int) -> None:
        self.code: dict[bytes, int] = {}
        self.items: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for name, text in items:
            codes = tuple(self.code.setdefault(w, len(self.code)) for w in words_of(text))
            size = min(window, len(codes))
            for start in range(len(codes) - size + 1 if size else 0):
                self.items[codes[start : start + size]].update([name] if name is not None else [])
        by_length = defaultdict(set)
        for pattern in self.items:
            by_length[len(pattern)].add(pattern)
        span = max(len(self.code), 1)
        self.tables = [PatternTable(k, found, span) for k, found in sorted(by_length.items())]

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """Which words lie inside an occurrence, and the items that have one."""
        inside, names = np.zeros(len(words), bool), set()
        get = self.code.get
        codes = [get(word, -1) for word in words]
        for table in self.tables:
            for end in table.ends(codes):
                start = end - table.length + 1
                inside[start : end + 1] = True
                names |= self.items[tuple(codes[start : end + 1])]
        return inside, names


def blocks_of(benchmark: DataFrame, block_bytes: int) -> Iterator[tuple[list[tuple[str | None, str | None]], bool]]:
    """The items in blocks of about `block_bytes` of text, each once however often it is repeated,
    and whether the block is the last. A block is fetched when its turn comes."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").where(
        F.col("text").isNotNull()
    )
    items = staged(items.distinct(), "items")
    total = items.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    count = max(1, -(-total // block_bytes))
    slot = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    for k in range(count):
        yield [(row["item"], row["text"]) for row in items.where(slot == k).collect()], k == count - 1


_STATE = "doc_id long, n_words long, inside binary, items array<string>"
RESULT = "doc_id long, n_words long, n_hit long, n_items long, items array<string>"


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Words, words inside benchmark windows, and the items found, per input row.

    Documents are read once for each block of the benchmark; tables for one block are all a
    task holds. A null or empty text has no words; a null or wordless item never occurs; a
    window of an item without id marks words but names no item. Repeated documents are
    searched each, repeated items count once, other columns are ignored, an empty benchmark
    hits nothing.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col("doc_id").cast("long"),
        "text",
        F.lit(None).cast("binary").alias("inside"),
        F.array().cast("array<string>").alias("items"),
    )
    for items, last in blocks_of(benchmark, block_bytes):
        found = _searched(rows, spark.sparkContext.broadcast(items), window, keep_text=not last)
        rows = found if last else staged(found, "searched")
    return rows


def _searched(rows: DataFrame, items, window: int, keep_text: bool) -> DataFrame:
    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        search = Search(items.value, window)

        def work(batch: pa.RecordBatch) -> dict[str, object]:
            out: dict[str, list] = {"n_words": [], "inside": [], "n_hit": [], "items": []}
            for text, before, names in zip(
                texts(batch.column(1)), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            ):
                words = words_of(text)
                inside, found = search.hits(words)
                if before is not None:
                    inside |= np.unpackbits(np.frombuffer(before, np.uint8))[: len(words)].astype(bool)
                out["n_words"].append(len(words))
                out["n_hit"].append(int(inside.sum()))
                out["items"].append(sorted(found.union(names)))
                if keep_text:
                    out["inside"].append(np.packbits(inside).tobytes())
            out["n_items"] = [len(x) for x in out["items"]]
            return {"doc_id": batch.column(0), "text": batch.column(1), **out}

        return work

    schema = "doc_id long, text string, inside binary, items array<string>" if keep_text else RESULT
    return batches(rows, schema, prepare)


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows whose text holds no window of the benchmark, all columns unchanged.

    A null, empty or wordless text holds none and stays; repeated rows are judged each; an empty
    benchmark leaves all rows. Rows are read once for each block of the benchmark.
    """
    ship(docs.sparkSession)
    for items, last in blocks_of(benchmark, block_bytes):
        told = docs.sparkSession.sparkContext.broadcast(items)
        docs = _without(docs, told, window)
        docs = docs if last else staged(docs, "clean")
    return docs


def _without(docs: DataFrame, items, window: int) -> DataFrame:
    at = docs.columns.index("text")

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(items.value, window)
        for batch in parts:
            keep = [not search.hits(words_of(text))[0].any() for text in texts(batch.column(at))]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def digest(found: DataFrame) -> DataFrame:
    """The result of `decontaminate` with the items as one hash."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def brute_force(docs: list[tuple], items: list[tuple], window: int = WINDOW) -> list[tuple]:
    """The same by comparing every window with every position, for tests."""
    out = []
    for doc_id, text in docs:
        words = words_of(text)
        hit, names = set(), set()
        for name, item in items:
            mine = words_of(item)
            size = min(window, len(mine))
            for a in range(len(mine) - size + 1 if size else 0):
                for b in range(len(words) - size + 1):
                    if words[b : b + size] == mine[a : a + size]:
                        hit.update(range(b, b + size))
                        names.update([str(name)] if name is not None else [])
        joined = ",".join(sorted(names))
        out.append(
            (doc_id, len(words), len(hit), len(names), hashlib.sha256(joined.encode()).hexdigest(), bool(hit))
        )
    return out


SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents),
split AS (
  SELECT rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM docs),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
sized AS (SELECT item, words, least(10, len(words)) AS size FROM items WHERE len(words) > 0),
windows AS (
  SELECT DISTINCT item, size, array_to_string(words[s : s + size - 1], chr(32)) AS key
  FROM (SELECT item, words, size, unnest(range(1, len(words) - size + 2)) AS s FROM sized)),
sizes AS (SELECT DISTINCT size FROM windows),
spans AS (
  SELECT rid, s, size, array_to_string(words[s : s + size - 1], chr(32)) AS key
  FROM (SELECT rid, words, size, unnest(range(1, len(words) - size + 2)) AS s FROM split, sizes)),
found AS (SELECT rid, s, w.size, item FROM spans p JOIN windows w ON p.key = w.key AND p.size = w.size),
hit AS (
  SELECT rid, count(DISTINCT pos) AS n
  FROM (SELECT rid, unnest(range(s, s + size)) AS pos FROM found) GROUP BY rid),
named AS (
  SELECT rid, count(DISTINCT item) AS n, string_agg(item, ',' ORDER BY item) AS joined
  FROM (SELECT DISTINCT rid, item FROM found) GROUP BY rid)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(i.n, 0) AS BIGINT) AS n_items, sha256(coalesce(joined, '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AS contaminated
FROM split s LEFT JOIN hit h ON s.rid = h.rid LEFT JOIN named i ON s.rid = i.rid
"""
