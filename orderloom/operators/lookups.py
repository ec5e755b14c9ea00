"""Joining order lines to lookup tables, broadcast only when the lookup is measured small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_ROWS = 1_000_000
MAX_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> bool:
    """Whether all of `df` is within both bounds.

    One aggregate counts rows and bytes, so a task passes on one row whatever it read; a
    search for row max_rows + 1 would send that many rows of every task to a single one.
    The size is that of the rows as text, with 16 bytes a field for what a row costs in a
    hash table, so a file that compresses well cannot pass for a small one.
    """
    widths = [F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) + 16 for name in df.columns]
    row_bytes = widths[0]
    for width in widths[1:]:
        row_bytes = row_bytes + width
    measured = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes.cast("long")).alias("bytes")).first()
    return measured["rows"] <= max_rows and (measured["bytes"] or 0) <= max_bytes


def sized(df: DataFrame, **bounds: int) -> DataFrame:
    """`df` with a broadcast hint if it was measured small, unchanged otherwise.

    Unhinted, the join shuffles both sides, and the adaptive skew join splits the part of a
    key that holds many of the rows.
    """
    return F.broadcast(df) if fits_broadcast(df, **bounds) else df


def enrich(lines: DataFrame, lookup: DataFrame, on: str, **bounds: int) -> DataFrame:
    """All lines, with the lookup's columns where its key matches and null elsewhere.

    The lookup's key must be unique, or lines would be repeated.
    """
    return lines.join(sized(lookup, **bounds), on, "left")
