"""Small tables for the tests, with columns whose names clash with the operators' own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
CLASHING = ", fp long, words string, score double, kept boolean, chunk long, part int, held string, block string"

PROSE = (
    "The committee met on Tuesday to discuss the new library. Most members agreed that the old "
    "building could not hold the growing collection any longer. A second meeting will follow in "
    "spring, when the architects have finished their drawings and the city has set its budget. "
    "Until then the books stay where they are, and readers may use the hall in the afternoon."
)


def documents(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """Rows of (doc_id, text) or more of the columns, and clashing columns after them."""
    whole = [tuple(row) + (None,) * (5 - len(row)) + (7, "w", 0.5, True, 3, 1, "h", "b") for row in rows]
    return spark.createDataFrame(whole, DOCS + CLASHING)


def edge_rows() -> list[tuple]:
    return [
        (1, None, "en"),
        (2, "", None),
        (3, " \n\t \x0b", "en"),
        (4, "word", "en"),
        (5, PROSE, "en", "s"),
        (5, PROSE, "en", "s"),
        (6, PROSE, None, None),
        (None, PROSE + " Without an id.", "en"),
        (None, None, None),
        (7, "12 34 !!! ### 56", "en"),
        (8, "long word, " * 40_000, "en"),
        (9, "naïve Ünïcödé — 漢字 \U0001f600 ﬁn\x00nul <|endoftext|>", "fr"),
        (10, "x" * 300_000, "en"),
        (11, "a  b\n\n c ", "en"),
    ]
