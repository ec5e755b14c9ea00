"""Quality rules as a short-circuit cascade, ordered by rejections per cost on a sample."""

from __future__ import annotations

import re
import time
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.common import batches, ship, texts

MIN_WORDS = 50
REPEAT_WINDOW = 3
BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 2000
_WIDE = 1 << 21  # three codes below this fit one 64-bit key


class Facts:
    """What rules ask of one text; each measure is made when first asked for."""

    def __init__(self, text: str) -> None:
        self.text = text

    @cached_property
    def words(self) -> list[bytes]:
        return self.text.encode("utf-8", "surrogatepass").split()

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - sum(self.text.count(blank) for blank in BLANKS)

    @cached_property
    def n_symbols(self) -> int:
        return sum(self.text.count(symbol) for symbol in SYMBOLS)

    @cached_property
    def lines(self) -> list[str]:
        return [line for line in self.text.split("\n") if line.strip(BLANKS)]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        return repeated_words(self.words)

    @cached_property
    def n_lettered(self) -> int:
        return sum(map(bool, map(_LETTER.search, self.words)))


_LETTER = re.compile(rb"[A-Za-z\x80-\xff]")
_BULLET = ("-", "*", "•")
_ELLIPSIS = ("...", "…")


def repeated_words(words: list[bytes]) -> int:
    """Words inside windows of three words that occur twice or more in the text."""
    n = len(words)
    if n <= REPEAT_WINDOW:
        return 0
    code = {word: k for k, word in enumerate(dict.fromkeys(words))}
    codes = np.fromiter(map(code.__getitem__, words), np.int64, n)
    span = len(code)
    pairs = codes[:-2] * span + codes[1:-1]
    if span >= _WIDE:
        pairs = np.unique(pairs, return_inverse=True)[1]
    keys = pairs * span + codes[2:]
    ordered = np.sort(keys)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    hit = np.isin(keys, np.unique(again))
    inside = np.zeros(n, bool)
    for shift in range(REPEAT_WINDOW):
        inside[shift : shift + len(hit)] |= hit
    return int(inside.sum())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Facts], bool]


RULES = (
    Rule("symbol_share", lambda f: 10 * f.n_symbols > len(f.words)),
    Rule("duplicate_lines", lambda f: len(f.lines) >= 5 and 10 * f.n_dup_lines > 3 * len(f.lines)),
    Rule("word_length", lambda f: not 2 * len(f.words) <= f.word_chars <= 15 * len(f.words)),
    Rule("few_lettered_words", lambda f: 10 * f.n_lettered < 6 * len(f.words)),
    Rule(
        "bullet_lines",
        lambda f: 10 * sum(x.lstrip(BLANKS).startswith(_BULLET) for x in f.lines) > 9 * len(f.lines),
    ),
    Rule(
        "ellipsis_lines",
        lambda f: 10 * sum(x.rstrip(BLANKS).endswith(_ELLIPSIS) for x in f.lines) > 3 * len(f.lines),
    ),
    Rule("filler_text", lambda f: "lorem ipsum" in f.text),
)


def base_failed(facts: Facts) -> bool:
    n = len(facts.words)
    return n < MIN_WORDS or 100 * facts.n_repeat_words > 50 * n


def measured(docs: DataFrame, rules: tuple[Rule, ...] = RULES, rows: int = SAMPLE_ROWS) -> list[dict]:
    """Each rule's seconds and rejections on a sample of about `rows` documents.

    Every rule sees every sampled text on fresh facts, so its cost is what it takes alone.
    One row per rule and task is added up; the rules' names are the only keys.
    """
    ship(docs.sparkSession)
    total = docs.count()
    picked = docs.select("text").sample(min(1.0, rows / max(total, 1)), seed=7)

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected, seen = Counter(), Counter(), 0
        for batch in parts:
            for text in texts(batch.column(0)):
                seen += 1
                for rule in rules:
                    facts = Facts(text)
                    began = time.perf_counter()
                    rejected[rule.name] += rule.rejects(facts)
                    seconds[rule.name] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict(
            {
                "name": [rule.name for rule in rules],
                "seconds": [float(seconds[rule.name]) for rule in rules],
                "rejected": pa.array([int(rejected[rule.name]) for rule in rules], pa.int64()),
                "seen": pa.array([seen] * len(rules), pa.int64()),
            }
        )

    parts = picked.mapInArrow(run, "name string, seconds double, rejected long, seen long")
    sums = parts.groupBy("name").agg(*(F.sum(x).alias(x) for x in ("seconds", "rejected", "seen")))
    return [row.asDict() for row in sums.collect()]


def cascade_order(figures: list[dict], rules: tuple[Rule, ...] = RULES) -> tuple[Rule, ...]:
    """Rules by rejections per second, the best first; unmeasured ones last, in given order."""
    worth = {
        x["name"]: (x["rejected"] + 0.5) / max(x["seconds"], 1e-9) for x in figures if x["seen"]
    }
    return tuple(sorted(rules, key=lambda rule: -worth.get(rule.name, 0.0)))


def passes(facts: Facts, cascade: tuple[Rule, ...]) -> bool:
    return not any(rule.rejects(facts) for rule in cascade)


RESULT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
    "n_repeat_words long, base_failed boolean, kept boolean"
)


def quality_rules(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Measures and verdict of every document, one row per input row.

    A rule after the first that rejects is not evaluated. The order comes from a sample and
    changes the time only: a document is kept if no rule rejects it. A null or empty text has
    no words and fails the base; repeated rows are judged each; other columns are ignored.
    """
    cascade = cascade_order(measured(docs, rules), rules)

    def prepare() -> Callable[[pa.RecordBatch], dict[str, object]]:
        def work(batch: pa.RecordBatch) -> dict[str, object]:
            facts = [Facts(text) for text in texts(batch.column(1))]
            rows = [measures(x, cascade) for x in facts]
            columns = zip(*rows) if rows else [[] for _ in MEASURES]
            return {"doc_id": batch.column(0), **dict(zip(MEASURES, map(list, columns)))}

        return work

    return batches(docs.select(F.col("doc_id").cast("long"), "text"), RESULT, prepare)


MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "base_failed",
    "kept",
)


def measures(facts: Facts, cascade: tuple[Rule, ...]) -> tuple:
    failed = base_failed(facts)
    return (
        len(facts.words),
        facts.word_chars,
        facts.n_symbols,
        facts.n_dup_lines,
        facts.n_repeat_words,
        failed,
        not failed and passes(facts, cascade),
    )


SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
parts AS (
  SELECT rid, doc_id, text,
    regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    [x for x in string_split(text, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] AS lines
  FROM docs),
positions AS (
  SELECT rid, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS pos FROM parts),
windows AS (
  SELECT rid, pos, word || chr(32) || lead(word, 1) OVER w || chr(32) || lead(word, 2) OVER w AS key
  FROM positions WINDOW w AS (PARTITION BY rid ORDER BY pos)),
twice AS (
  SELECT rid, pos FROM (
    SELECT rid, pos, count(*) OVER (PARTITION BY rid, key) AS n FROM windows WHERE key IS NOT NULL)
  WHERE n > 1),
inside AS (
  SELECT rid, count(DISTINCT pos + shift) AS n
  FROM twice, (SELECT unnest([0, 1, 2]) AS shift) GROUP BY rid),
facts AS (
  SELECT p.rid, doc_id, text, words, lines, len(words) AS n_words,
    length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(i.n, 0) AS n_repeat_words
  FROM parts p LEFT JOIN inside i ON p.rid = i.rid),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM facts)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed
    AND 10 * n_symbols <= n_words
    AND (len(lines) < 5 OR 10 * n_dup_lines <= 3 * len(lines))
    AND word_chars BETWEEN 2 * n_words AND 15 * n_words
    AND 10 * len([x for x in words if regexp_matches(x, '[A-Za-z]|[^\x00-\x7F]')]) >= 6 * n_words
    AND 10 * len([x for x in lines if regexp_matches(x, '^[\x20\x09-\x0D]*[-*•]')]) <= 9 * len(lines)
    AND 10 * len([x for x in lines if regexp_matches(x, '(\.\.\.|…)[\x20\x09-\x0D]*$')]) <= 3 * len(lines)
    AND NOT contains(text, 'lorem ipsum') AS kept
FROM judged
"""
