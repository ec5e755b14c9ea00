"""What types the text of each field would fit, so that a feed that changes is noticed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.functions import is_date, is_date_time

# Every kind of text, and the kinds that a type has room for besides its own. A text that is
# nothing else is text; what no single narrower type has room for is text as well.
HOLDS = {
    "null": [],
    "integer": ["null"],
    "decimal": ["null", "integer"],
    "date": ["null"],
    "timestamp": ["null", "date"],
    "text": ["null", "integer", "decimal", "date", "timestamp"],
}

# Numbers as text. Integers of up to 18 digits fit a long.
_INTEGER = r"^[+-]?[0-9]{1,18}$"
_DECIMAL = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def kind_of(text: Column) -> Column:
    """The kind of a text: the narrowest type that it fits, without regard to blanks around it."""
    bare = F.trim(text)
    return (
        F.when(text.isNull(), "null")
        .when(bare.rlike(_INTEGER), "integer")
        .when(bare.rlike(_DECIMAL), "decimal")
        .when(is_date(bare), "date")
        .when(is_date_time(bare), "timestamp")
        .otherwise("text")
    )


def type_audit(lines: DataFrame, *columns: str) -> DataFrame:
    """(column, kind, line_count, column_type): how many texts of each kind a column holds, and
    the narrowest type with room for all of them.

    One pass, from which a task passes on a count for each column and kind; counts of parts of
    the lines add up to those of the whole. Kinds that a column does not hold have no row.
    """
    names = list(columns) or lines.columns
    cells = [F.struct(F.lit(name).alias("column"), F.col(f"`{name}`").alias("text")) for name in names]
    cell = lines.select(F.explode(F.array(*cells)).alias("cell"))
    kinds = cell.select("cell.column", kind_of(F.col("cell.text")).alias("kind"))
    counts = kinds.groupBy("column", "kind").agg(F.count(F.lit(1)).alias("line_count"))
    # A row per column from here on.
    of_column = counts.groupBy("column").agg(F.collect_list(F.struct("kind", "line_count")).alias("held"))
    held = F.transform("held", lambda each: each["kind"])
    room = [
        F.when(F.size(F.array_except(held, F.array(*[F.lit(each) for each in [kind, *HOLDS[kind]]]))) == 0, F.lit(kind))
        for kind in HOLDS
    ]
    typed = of_column.select("column", F.explode("held").alias("each"), F.coalesce(*room).alias("column_type"))
    return typed.select("column", "each.kind", "each.line_count", "column_type")
