"""Ranks, top-k, month-over-month growth and customer quintiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.contracts import MONTH, TOTAL_MONEY
from orderloom.session import staged

# Fixed values of this package: which revenue quintiles make up each segment.
SEGMENTS = {"High": [1], "Mid": [2, 3], "Low": [4, 5]}


def rank_within(df: DataFrame, group: list[str], value: str, *key: str, name: str) -> DataFrame:
    """Rank with gaps inside each group, the highest `value` first; `key` tells its rows apart.

    No task sorts a group: rows are put in order over all tasks, and a row's rank is how far the
    first row of its value is from the first row of its group. Both are found by an aggregate, so
    groups and values of any number of rows are spread, and ties may lie in several tasks. Nulls
    in the group are a group, a null value comes last.
    """
    placed = with_position(df, *[F.asc(column) for column in group], F.desc(value), *[F.asc(column) for column in key])
    firsts = placed.groupBy(*group, value).agg(F.min("position").alias("first"))
    starts = firsts.groupBy(*group).agg(F.min("first").alias("start"))
    same_group = [F.col(f"here.{column}").eqNullSafe(F.col(f"there.{column}")) for column in group]
    ranks = firsts.alias("here").join(starts.alias("there"), same_group).select(
        *[F.col(f"here.{column}").alias(column) for column in [*group, value]],
        (F.col("first") - F.col("start") + 1).cast("int").alias(name),
    )
    same_value = [F.col(f"row.{column}").eqNullSafe(F.col(f"ranked.{column}")) for column in [*group, value]]
    both = placed.alias("row").join(ranks.alias("ranked"), same_value)
    return both.select(*[F.col(f"row.{column}").alias(column) for column in df.columns], name)


def top_products(performance: DataFrame, measure: str, k: int = 10) -> DataFrame:
    """The k products with the highest `measure`; ids break ties. Each task keeps only k."""
    order = [F.desc(measure), F.asc("product_id"), F.asc("category")]
    chosen = performance.select("product_id", "category", "total_revenue", "total_units_sold")
    return chosen.orderBy(*order).limit(k)


def top_products_by_month(product_months: DataFrame, k: int = 10) -> DataFrame:
    """The k best products of every month.

    The filter on row_number lets Spark cut each task's part of a month to k rows before
    the shuffle, so no task ever gathers a month's products.
    """
    best_first = Window.partitionBy(*MONTH).orderBy(F.desc("total_revenue"), "product_id", "category")
    return product_months.withColumn("position", F.row_number().over(best_first)).where(F.col("position") <= k)


def month_growth(monthly: DataFrame) -> DataFrame:
    """Revenue per month next to the month before it in the table, and the change in %.

    The month before is the previous row: where a month has no sales, the one before that.
    The window runs in one task over one row per calendar month.
    """
    months = monthly.groupBy(*MONTH).agg(F.sum("monthly_revenue").cast(TOTAL_MONEY).alias("total_revenue"))
    previous = F.lag("total_revenue").over(Window.orderBy(*MONTH))
    change = (F.col("total_revenue") - F.col("prev_month_revenue")).cast("double")
    base = F.nullif(F.col("prev_month_revenue"), F.lit(0)).cast("double")
    return (
        months.withColumn("prev_month_revenue", previous)
        .withColumn("mom_growth_pct", F.round(change / base * 100, 2))
        .orderBy(*MONTH)
    )


def with_position(df: DataFrame, *order: Column) -> DataFrame:
    """Add `position` (from 0) in the global order, and `total`, the number of rows.

    `order` must end in a unique key. A window without a partition would sort everything
    in one task; here the rows are range-partitioned and sorted, and the id that Spark
    numbers rows with is partition number and row number in one. The result is written,
    because the numbers only hold for one run of the sort. What is left is the number of
    rows in the partitions before: one row per partition, which is what is broadcast and
    what the window below runs over. Equal values do not pile up in a partition, since the
    unique key is part of the range.
    """
    numbered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("slot", F.monotonically_increasing_id())
    )
    rows = staged(numbered, "positions")
    part = F.shiftright("slot", 33)
    place = F.col("slot").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = rows.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = sizes.select(
        "part",
        F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"),
        F.sum("size").over(everything).alias("total"),
    )
    return (
        rows.withColumn("part", part)
        .join(F.broadcast(offsets), "part")
        .withColumn("position", F.col("before") + place)
        .drop("slot", "part", "before")
    )


def tile(position: Column, total: Column, tiles: int) -> Column:
    """The tile of a position when `total` rows are dealt into `tiles` even runs.

    The first total mod tiles runs are one row longer than the others.
    """
    runs = F.lit(tiles).cast("long")
    whole = F.call_function("div", total, runs)
    extra = F.pmod(total, runs)
    long_rows = extra * (whole + 1)
    in_long = F.call_function("div", position, whole + 1)
    in_short = extra + F.call_function("div", position - long_rows, F.nullif(whole, F.lit(0)))
    return (F.when(position < long_rows, in_long).otherwise(in_short) + 1).cast("int")


def customer_quintiles(rfm: DataFrame) -> DataFrame:
    """Customers with their revenue quintile, 1 being the highest."""
    placed = with_position(rfm, F.desc("monetary"), F.asc("customer_id"))
    quintile = tile(F.col("position"), F.col("total"), 5)
    return placed.select(
        "customer_id", "monetary", "frequency", "recency_days", quintile.alias("monetary_quintile")
    )


def high_value(quintiles: DataFrame) -> DataFrame:
    return quintiles.where(F.col("monetary_quintile") == 1)


def segments(quintiles: DataFrame) -> DataFrame:
    label = F.coalesce(
        *[F.when(F.col("monetary_quintile").isin(members), F.lit(name)) for name, members in SEGMENTS.items()]
    )
    return quintiles.withColumn("segment", label)


def by_value(quintiles: DataFrame) -> DataFrame:
    """Customers from highest to lowest revenue; a range-partitioned sort."""
    return quintiles.orderBy(F.desc("monetary"), F.asc("customer_id"))
