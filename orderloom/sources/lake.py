"""Writing and loading Parquet datasets under a contract."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.contracts import MONTH
from orderloom.functions import in_period
from orderloom.session import staged


def write_months(
    df: DataFrame, path: str, sort_by: Sequence[str] = (), mode: str = "overwrite", laid_out: bool = False
) -> None:
    """Write `df` under order_year=/order_month= directories.

    Rows of a month are brought together so that a month is few files, but by a rebalance
    rather than a plain repartition: a month with a third of all rows is then split over
    as many tasks as its size asks for, and small months share a task. Sorting inside the
    files by `sort_by` gives narrow min/max statistics for scans that filter on it. Rows that
    lie in `MonthParts` are `laid_out` as they are.
    """
    rows = df if laid_out else df.hint("rebalance", *MONTH)
    rows.sortWithinPartitions(*MONTH, *sort_by).write.mode(mode).partitionBy(*MONTH).parquet(path)


PART = "_part"
PART_ROWS = 1 << 20
_SLOTS = 1 << 12


class MonthParts:
    """Months in parts of about `PART_ROWS` rows by a hash of a key, so that what is worked out by
    month and key can be written by month where it was worked out, without another shuffle.

    The rows of a key in a month are in one part. Only where a 4096th of the keys has more rows
    in a month than a part should hold, these are dealt over all parts of the month by other columns.
    """

    def __init__(self, rows: DataFrame, *key: str):
        self.key = key
        sizes = rows.groupBy(*MONTH, self._slot().alias("slot")).agg(F.count(F.lit(1)).alias("n"))
        heavy = F.collect_list(F.when(F.col("n") > PART_ROWS, F.col("slot"))).alias("_heavy")
        parts = F.ceil(F.sum("n") / PART_ROWS).cast("int").alias("_parts")
        self.plan = staged(sizes.groupBy(*MONTH).agg(parts, heavy), "month-parts")

    def dealt(self, rows: DataFrame, *within: str) -> DataFrame:
        """The rows with their part, brought together by month and part. Those of too many to a part
        are told apart by `within`."""
        alone, dealt = F.xxhash64(*self.key), F.xxhash64(*self.key, *within)
        part = F.pmod(F.when(self._is_heavy(), dealt).otherwise(alone), self._count())
        return self._placed(rows, part)

    def repeated(self, rows: DataFrame) -> DataFrame:
        """Rows that go with those of their key, in each part where these may be."""
        everywhere = F.sequence(F.lit(0).cast("long"), self._count() - 1)
        alone = F.array(F.pmod(F.xxhash64(*self.key), self._count()))
        return self._placed(rows, F.explode(F.when(self._is_heavy(), everywhere).otherwise(alone)))

    def _slot(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(_SLOTS)).cast("int")

    def _count(self) -> Column:
        return F.coalesce("_parts", F.lit(1)).cast("long")

    def _is_heavy(self) -> Column:
        return F.coalesce(F.array_contains("_heavy", self._slot()), F.lit(False))

    def _placed(self, rows: DataFrame, part: Column) -> DataFrame:
        # A row for each month.
        placed = rows.join(F.broadcast(self.plan), MONTH, "left").select(*rows.columns, part.alias(PART))
        return placed.repartition(*MONTH, PART)


def write_plain(df: DataFrame, path: str, compact: bool = False) -> None:
    """Write an unpartitioned dataset, replacing what is there.

    `compact` is for what a filter leaves of many tasks: a shuffle of the few rows saves as
    many files as there were tasks. Anything else is written where it was computed.
    """
    rows = df.hint("rebalance") if compact else df
    rows.write.mode("overwrite").parquet(path)


def load_contract(spark: SparkSession, path: str, contract: T.StructType) -> DataFrame:
    """Read a dataset into the contract's columns, by name, in its order and types.

    Directory columns come back from the path. A null in a required column or a text over
    its length fails the load when it is read, in the same pass.
    """
    return conformed(spark.read.parquet(path), contract)


def conformed(df: DataFrame, contract: T.StructType) -> DataFrame:
    return df.select([_guarded(field).alias(field.name) for field in contract.fields])


def _guarded(field: T.StructField) -> Column:
    value = F.col(field.name).cast(field.dataType)
    max_length = field.metadata.get("max_length")
    if max_length:
        too_long = F.raise_error(F.lit(f"{field.name} is longer than {max_length}"))
        value = F.when(F.length(value) > max_length, too_long).otherwise(value)
    if field.metadata.get("required"):
        value = F.coalesce(value, F.raise_error(F.lit(f"{field.name} is null")))
    return value.cast(field.dataType)


def scan_period(df: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """Rows dated in [start, end); opens only the directories of those months."""
    return df.where(in_period(start, end))


def bucket_share(df: DataFrame, key: str, buckets: int) -> float:
    """The share of all rows that the fullest bucket of `key` would hold."""
    bucket = F.pmod(F.hash(F.col(key)), F.lit(buckets)).alias("bucket")
    sizes = df.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    full = sizes.agg((F.max("n") / F.sum("n")).alias("share")).first()
    return full["share"] or 0.0


def write_bucketed_table(
    df: DataFrame,
    table: str,
    path: str,
    key: str,
    buckets: int,
    sort_by: Sequence[str] = (),
    max_share: float | None = None,
) -> None:
    """Save `df` bucketed by `key`, so that joins and groups on it need no shuffle.

    One bucket is read by one task, whatever its size, and nothing later can split it. So
    the buckets are sized first, and it is an error when the fullest would hold more than
    `max_share` of the rows (default: four times an even share); such a table wants
    `write_ranged` instead.
    """
    limit = max_share if max_share is not None else 4.0 / buckets
    share = bucket_share(df, key, buckets)
    if share > limit:
        raise ValueError(f"a bucket of {key} would hold {share:.0%} of the rows, over {limit:.0%}")
    # The expression is the one bucketing uses, so a task writes few bucket files.
    bucket = F.pmod(F.hash(F.col(key)), F.lit(buckets))
    writer = df.repartition(buckets, bucket).write.bucketBy(buckets, key)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    writer.mode("overwrite").option("path", path).saveAsTable(table)


class Copartitioned(NamedTuple):
    """Tables that share a layout by key, with the keys that have several slots."""

    tables: dict[str, DataFrame]
    hot: DataFrame
    key: str

    def joined(self, lines: str, lookup: str) -> DataFrame:
        """The lines with the columns of their key's row; neither side is shuffled."""
        return self.tables[lines].join(self.tables[lookup], [self.key, SLOT])

    def totals(self, rows: DataFrame, by: Sequence[str], sums: Sequence[Column], again: Sequence[Column]) -> DataFrame:
        """`sums` of `rows` per key and the columns `by`, which are not shuffled: all rows of a key
        and slot are in one bucket. Where a key has several slots, there is a row per slot, and
        these few are summed up once more by `again`."""
        slots = rows.groupBy(self.key, SLOT, *by).agg(*sums)
        names = [name for name in slots.columns if name != SLOT]
        hot = F.broadcast(self.hot.select("hot_key"))
        same = F.col(self.key).eqNullSafe(F.col("hot_key"))
        alone = slots.join(hot, same, "left_anti").select(names)
        several = slots.join(hot, same, "left_semi").groupBy(self.key, *by).agg(*again)
        return alone.unionByName(several.select(names))


SLOT = "slot"


def write_copartitioned(
    lines: DataFrame, lookups: dict[str, DataFrame], path: str, key: str, buckets: int, name: str
) -> Copartitioned:
    """Save `lines` and tables with a row per key bucketed alike, so that they join and group by
    key as they lie.

    A bucket is one task's, so a key with more rows than an even share of a bucket gets slots,
    as many as it has shares: its lines are dealt over them by a hash of the whole line, and its
    row in each other table is repeated in every slot. There are fewer such keys than buckets.
    Null is a key like any other here, though in a join it finds nothing.
    """
    spark = lines.sparkSession
    hot = staged(_hot_keys(lines, key, buckets), "hot-keys")
    marked, same = F.broadcast(hot), F.col(key).eqNullSafe(F.col("hot_key"))
    dealt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in lines.columns]), F.size("slots")) + 1
    slot = F.when(F.col("slots").isNull(), 0).otherwise(F.element_at("slots", dealt.cast("int")))
    laid_out = {"lines": lines.join(marked, same, "left").select(*lines.columns, slot.alias(SLOT))}
    each = F.explode(F.coalesce("slots", F.array(F.lit(0))))
    for table, rows in lookups.items():
        laid_out[table] = rows.join(marked, same, "left").select(*rows.columns, each.alias(SLOT))
    for table, rows in laid_out.items():
        # The expression is the one bucketing uses, so a task writes few bucket files.
        bucket = F.pmod(F.hash(F.col(key), F.col(SLOT)), F.lit(buckets))
        writer = rows.repartition(buckets, bucket).write.bucketBy(buckets, key, SLOT).sortBy(key, SLOT)
        writer.mode("overwrite").option("path", f"{path}/{table}").saveAsTable(f"{name}_{table}")
    return Copartitioned({table: spark.table(f"{name}_{table}") for table in laid_out}, hot, key)


def _hot_keys(lines: DataFrame, key: str, buckets: int) -> DataFrame:
    """(hot_key, slots) of the keys with more rows than an even share of a bucket.

    The slots of all of them, one after another, are numbers whose hash falls in one bucket after
    another, so that no bucket gets many of them.
    """
    share = max(1, -(-lines.count() // buckets))
    sizes = lines.groupBy(F.col(key).alias("hot_key")).agg(F.count(F.lit(1)).alias("rows"))
    hot = sizes.where(F.col("rows") > share).withColumn("shares", F.ceil(F.col("rows") / F.lit(share)))
    hot = staged(hot, "heavy-keys")
    before = Window.orderBy("hot_key").rowsBetween(Window.unboundedPreceding, -1)
    first = F.coalesce(F.sum("shares").over(before), F.lit(0))
    wanted = hot.withColumn("first", first).select(
        "hot_key", F.explode(F.expr("sequence(first, first + shares - 1)")).alias("place")
    )
    wanted = wanted.withColumn("bucket", F.pmod("place", F.lit(buckets)).cast("int"))
    numbers = hot.select("hot_key", F.explode(F.sequence(F.lit(0), F.lit(40 * buckets))).alias(SLOT))
    falls = F.pmod(F.hash("hot_key", SLOT), F.lit(buckets)).alias("bucket")
    found = numbers.groupBy(F.col("hot_key").alias("same_key"), falls).agg(F.min(SLOT).alias(SLOT))
    both = wanted.join(found, F.col("hot_key").eqNullSafe(F.col("same_key")) & (wanted["bucket"] == found["bucket"]))
    return both.groupBy("hot_key").agg(F.sort_array(F.collect_set(SLOT)).alias("slots"))


def write_ranged(df: DataFrame, path: str, *order: str | Column) -> None:
    """Write `df` in this order over all files, for scans that filter on its first columns.

    Ranges are cut by the whole order, so a value with many rows is spread over tasks when
    the columns after it tell its rows apart.
    """
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("errorifexists").parquet(path)
