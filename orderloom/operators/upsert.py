"""Replacing whole orders: rows whose key is in the staging set go, staging rows come in.

An order is replaced as a whole. A correction must therefore bring all lines of its order,
and staging must hold each line once.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.contracts import CURRENT, MONTH, RUN_DATE, SPANS
from orderloom.operators.lookups import fits_broadcast, sized
from orderloom.session import staged
from orderloom.sources.lake import PART, MonthParts

_SPREAD = "_spread"


class OrderKeys(NamedTuple):
    """The keys to replace, each once, in a written table of one column."""

    table: DataFrame
    few: bool

    @property
    def name(self) -> str:
        return self.table.columns[0]

    def side(self, **columns: Column) -> DataFrame:
        """The keys as one side of a join, broadcast when they were measured few."""
        rows = self.table.withColumns(columns) if columns else self.table
        return F.broadcast(rows) if self.few else rows


def staged_keys(staging: DataFrame, key: str = "order_id") -> OrderKeys:
    """The keys of `staging` without repeats.

    They are written because they are joined more than once, and because the adaptive skew
    join splits a hot key of the target only if the other side is shuffled as it was read:
    an aggregate that removes repeats must not stand in between.
    """
    keys = staged(staging.select(key).where(F.col(key).isNotNull()).distinct(), "keys")
    return OrderKeys(keys, fits_broadcast(keys))


def matched_rows(target: DataFrame, keys: OrderKeys) -> DataFrame:
    """Target rows an upsert of these keys would delete."""
    return target.join(keys.side(), keys.name, "left_semi")


def kept_rows(target: DataFrame, keys: OrderKeys) -> DataFrame:
    """Target rows an upsert leaves alone. Rows without a key match nothing and stay.

    Rows without a key would all be shuffled to one task, so they get a second join column
    that spreads them; it is 0 on every row that can match.
    """
    no_key = F.col(keys.name).isNull()
    tasks = int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.pmod(_row_hash(target, keys.name), F.lit(16 * tasks))
    left = target.withColumn(_SPREAD, F.when(no_key, spread).otherwise(0))
    # Worked out per row on the other side too: a constant would be taken out of the join key.
    right = keys.side(**{_SPREAD: F.when(no_key, -1).otherwise(0).cast("long")})
    return left.join(right, [keys.name, _SPREAD], "left_anti").select(target.columns)


def merged(target: DataFrame, staging: DataFrame, keys: OrderKeys) -> DataFrame:
    """The target after the upsert of `staging`. Columns are matched by name."""
    return kept_rows(target, keys).unionByName(staging)


def held_keys(target: DataFrame, keys: OrderKeys) -> DataFrame:
    """(key, order_year, order_month): the keys that rows of the target have, and in which months.

    The target is reduced to one row per order, month and task before it is shuffled, so the
    shuffle moves orders and not lines, and a hot order is one row.
    """
    return matched_rows(target.select(keys.name, *MONTH).distinct(), keys)


def matched_months(target: DataFrame, keys: OrderKeys) -> DataFrame:
    """The months that rows of these keys lie in."""
    return held_keys(target, keys).select(*MONTH).distinct()


_MONTH_BITS = 18  # months of ten thousand years
_MONTH_MASK = (1 << _MONTH_BITS) - 1


def mark_newest(lines: DataFrame) -> DataFrame:
    """The lines with `current`: whether they are of the newest run date that their order has, and
    `spans`: whether the current lines of their order are of more than one month.

    A later day's file replaces whole orders of an earlier one, in whatever order the two are
    taken in; lines without a run date are the oldest, and all files of a day count together.
    Day and month are packed into one number, so an order is one row of plain numbers in the
    aggregate. Only orders with several days or months are joined back; a hot order is one row
    on that side and can be split on the other. `lines` should be a written table and hold all
    lines of its orders.
    """
    return _marked(lines, lines.join(sized(_several_versions(lines)), "order_id", "left"))


def newest_by_month(lines: DataFrame, among: DataFrame) -> tuple[DataFrame, bool]:
    """`mark_newest` for writing by month, and whether the rows come laid out for that. `lines` may
    be those of some months, if `among` holds all lines of their orders.

    Orders that are too many to broadcast are first given the months they lie in. Then they meet
    their lines in the parts of months that these are written from, so the lines are shuffled once
    and not by order as well. Such rows have to be written inside `parts_joined`.
    """
    several = _several_versions(among)
    if fits_broadcast(several):
        return _marked(lines, lines.join(F.broadcast(several), "order_id", "left")), False
    there = staged(lines.select("order_id", *MONTH).distinct().join(several, "order_id"), "several-months")
    parts = MonthParts(lines, "order_id")
    rows, orders = parts.dealt(lines, *lines.columns), parts.repeated(there)
    return _marked(lines, rows.join(orders.hint("shuffle_hash"), [*MONTH, PART, "order_id"], "left")), True


def _several_versions(lines: DataFrame) -> DataFrame:
    """(order_id, newest, spans) of the orders of several days or months, written."""
    day, month = _day(), (F.col("order_year") * 12 + F.col("order_month") - 1).cast("long")
    at = F.shiftleft(day, _MONTH_BITS)
    orders = lines.groupBy("order_id").agg(
        F.max(at + month).alias("last"), F.max(at + (_MONTH_MASK - month)).alias("first"), F.min(day).alias("oldest")
    )
    newest = F.shiftright("last", _MONTH_BITS)
    latest = F.col("last").bitwiseAND(F.lit(_MONTH_MASK))
    earliest = _MONTH_MASK - F.col("first").bitwiseAND(F.lit(_MONTH_MASK))
    several = orders.select("order_id", "oldest", newest.alias("newest"), (latest != earliest).alias(SPANS))
    return staged(several.where((F.col("oldest") < F.col("newest")) | F.col(SPANS)).drop("oldest"), "several-versions")


def _marked(lines: DataFrame, joined: DataFrame) -> DataFrame:
    current = F.coalesce(_day() == F.col("newest"), F.lit(True)).alias(CURRENT)
    return joined.select(*lines.columns, current, F.coalesce(SPANS, F.lit(False)).alias(SPANS))


def _day() -> Column:
    return F.unix_date(F.coalesce(F.col(RUN_DATE), F.lit("0001-01-01").cast("date"))).cast("long")


def _row_hash(df: DataFrame, key: str) -> Column:
    return F.xxhash64(*[F.col(name) for name in df.columns if name != key] or [F.lit(0)])
