"""Aggregates over the fact table.

Every distinct count is exact, and none of them gathers a group in one task: Spark groups
by (group, counted id) first, so a month, category or product with a third of all rows is
spread over all tasks by the ids in it, and only one number per task and group is left for
the second shuffle.

One distinct count goes into the same aggregate as the sums. Where there are two, Spark
would repeat each row for each of them, and every repeated row would carry the buffers of
all the sums through the shuffle; there, sums and distinct counts are computed side by side,
each from its own narrow scan, and put together per group at the end. So pass a written
table rather than a plan that is dear to run.

The names avg/max/min_order_value are kept for comparability, but they are per order line.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.contracts import (
    CUSTOMER_RFM,
    CUSTOMER_STATES,
    DAILY_SALES,
    LINE_MONEY,
    MOMENT,
    MONTH,
    MONTHLY_REVENUE,
    PRICE,
    PRODUCT_PERFORMANCE,
    PRODUCT_STATES,
    SPANS,
    TOTAL_MONEY,
)
from orderloom.functions import exact_total, money
from orderloom.operators.ranking import rank_within
from orderloom.session import staged
from orderloom.sources.lake import PART, MonthParts


def _lines() -> Column:
    return F.count(F.lit(1)).alias("lines")


def _units() -> Column:
    return F.sum("quantity").alias("total_units_sold")


def _mean(total: str, lines: str, dtype) -> Column:
    return money(F.col(total) / F.col(lines), dtype)


def _distinct(fact: DataFrame, key: list[str], counted: str, name: str) -> DataFrame:
    return fact.groupBy(*key).agg(F.count_distinct(counted).alias(name))


def _side_by_side(key: list[str], *parts: DataFrame) -> DataFrame:
    """One row per group with the measures of all parts, which have the same groups.

    Grouping, unlike a join, also brings together groups whose key holds a null.
    """
    rows = reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), parts)
    measures = [name for name in rows.columns if name not in key]
    return rows.groupBy(*key).agg(*[F.max(name).alias(name) for name in measures])


def daily_sales(fact: DataFrame) -> DataFrame:
    """Sales per day and category."""
    key = [*MONTH, "order_day", "category"]
    sums = fact.groupBy(*key).agg(
        _units(),
        _lines(),
        exact_total("revenue").alias("total_revenue"),
        F.max("revenue").alias("max_order_value"),
        F.min("revenue").alias("min_order_value"),
    )
    days = _side_by_side(
        key,
        sums,
        _distinct(fact, key, "order_id", "total_orders"),
        _distinct(fact, key, "customer_id", "unique_customers"),
    )
    return days.withColumn("avg_order_value", _mean("total_revenue", "lines", LINE_MONEY)).select(DAILY_SALES.names)


def product_totals(fact: DataFrame, *more: Column) -> DataFrame:
    """Units, revenue, mean price and further measures per product and category."""
    sums = fact.groupBy("product_id", "category").agg(
        _units(),
        _lines(),
        exact_total("revenue").alias("total_revenue"),
        exact_total("unit_price").alias("price_sum"),
        *more,
    )
    return sums.withColumn("avg_unit_price", _mean("price_sum", "lines", PRICE)).drop("price_sum", "lines")


def product_performance(fact: DataFrame) -> DataFrame:
    """The product totals with the number of orders each product is in."""
    orders = F.count_distinct("order_id").alias("order_count")
    return product_totals(fact, orders).select(PRODUCT_PERFORMANCE.names)


def customer_value(fact: DataFrame) -> DataFrame:
    """Last order, number of orders and revenue per customer.

    One pass: an order is one customer's, so the rows that the distinct count leaves per
    task are few and their sums cost little.
    """
    return fact.groupBy("customer_id").agg(
        F.max("order_date").alias("last_order_date"),
        F.count_distinct("order_id").alias("frequency"),
        exact_total("revenue").alias("monetary"),
    )


def customer_rfm(fact: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Recency, frequency and revenue per customer, recency counted from `as_of`.

    Without `as_of`, the latest order date in the fact counts. That is also the latest of
    the customers' last orders, so the customers are written once and the date is looked up
    there, as a scalar subquery, instead of going through the fact a second time.
    """
    return with_recency(customer_value(fact), as_of)


def with_recency(customers: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    if as_of:
        latest = F.lit(as_of).cast(MOMENT)
    else:
        customers = staged(customers, "customers")
        latest = customers.agg(F.max("last_order_date")).scalar()
    recency = F.date_diff(latest, F.col("last_order_date"))
    return customers.withColumn("recency_days", recency).select(CUSTOMER_RFM.names)


# States of months, and what they add up to


def spanning(fact: DataFrame) -> Column:
    """Whether a line's order may span months: where that is not known, it may."""
    return F.col(SPANS) if SPANS in fact.columns else F.lit(True)


def _states(fact: DataFrame, key: list[str], *sums: Column) -> DataFrame:
    """Sums and the number of orders inside the month per group, and the ids of other orders.

    An order inside a month is in no other, so numbers of orders add up over months; of an order
    that spans months each has the id, which is counted once when they are put together.
    """
    inside = F.count_distinct(F.when(~spanning(fact), F.col("order_id"))).alias("orders")
    across = fact.where(spanning(fact)).select(*MONTH, *key, "order_id").distinct()
    return fact.groupBy(*MONTH, *key).agg(*sums, inside).unionByName(across, allowMissingColumns=True)


def _all_orders(name: str) -> Column:
    return (F.coalesce(F.sum("orders"), F.lit(0)) + F.count_distinct("order_id")).alias(name)


def product_states(fact: DataFrame) -> DataFrame:
    """What `product_performance` needs of each month.

    A month has about as many products as lines, so the lines are shuffled once, into the parts
    that the states are written from, and all sums are made there. A product with very many lines
    in a month has a row in each of the month's parts; orders are whole in a part, so these add up
    like those of months.
    """
    key = ["product_id", "category"]
    totals = [exact_total("revenue").alias("total_revenue"), exact_total("unit_price").alias("price_sum")]
    lines = fact.select(*MONTH, *key, "order_id", "quantity", "revenue", "unit_price", spanning(fact).alias(SPANS))
    dealt = MonthParts(lines, *key).dealt(lines, "order_id")
    return _states(dealt, [*key, PART], _units(), _lines(), *totals).select(PRODUCT_STATES.names)


def product_performance_of(states: DataFrame) -> DataFrame:
    totals = states.groupBy("product_id", "category").agg(
        *[F.sum(name).alias(name) for name in ["total_units_sold", "lines"]],
        *[exact_total(name).alias(name) for name in ["total_revenue", "price_sum"]],
        _all_orders("order_count"),
    )
    return totals.withColumn("avg_unit_price", _mean("price_sum", "lines", PRICE)).select(PRODUCT_PERFORMANCE.names)


def customer_states(fact: DataFrame) -> DataFrame:
    """What `customer_rfm` needs of each month."""
    last = F.max("order_date").alias("last_order_date")
    return _states(fact, ["customer_id"], last, exact_total("revenue").alias("monetary")).select(CUSTOMER_STATES.names)


def customer_rfm_of(states: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    customers = states.groupBy("customer_id").agg(
        F.max("last_order_date").alias("last_order_date"), _all_orders("frequency"), exact_total("monetary").alias("monetary")
    )
    return with_recency(customers, as_of)


def category_months(fact: DataFrame) -> DataFrame:
    """Revenue per month and category."""
    return fact.groupBy(*MONTH, "category").agg(exact_total("revenue").alias("monthly_revenue"))


def monthly_revenue(fact: DataFrame) -> DataFrame:
    """Revenue, orders and customers per month and category, ranked inside each month."""
    key = [*MONTH, "category"]
    months = _side_by_side(
        key,
        category_months(fact),
        _distinct(fact, key, "order_id", "total_orders"),
        _distinct(fact, key, "customer_id", "unique_customers"),
    )
    ranked = rank_within(months, MONTH, "monthly_revenue", "category", name="revenue_rank")
    return ranked.select(MONTHLY_REVENUE.names)


def product_months(fact: DataFrame) -> DataFrame:
    """Units and revenue per month, product and category."""
    return fact.groupBy(*MONTH, "product_id", "category").agg(
        _units(), exact_total("revenue").alias("total_revenue")
    )


def weekend_vs_weekday(fact: DataFrame) -> DataFrame:
    """Weekend sales next to weekday sales, in all and per day with sales."""
    key = ["is_weekend"]
    days = fact.groupBy(*key, F.to_date("order_date").alias("day")).agg(
        _units(), _lines(), exact_total("revenue").alias("revenue")
    )
    sums = days.groupBy(*key).agg(
        F.count(F.lit(1)).alias("trading_days"),
        F.sum("total_units_sold").alias("total_units_sold"),
        F.sum("lines").alias("lines"),
        exact_total("revenue").alias("total_revenue"),
    )
    sides = _side_by_side(
        key,
        sums,
        _distinct(fact, key, "order_id", "total_orders"),
        _distinct(fact, key, "customer_id", "unique_customers"),
    )
    return sides.withColumns(
        {
            "avg_order_value": _mean("total_revenue", "lines", LINE_MONEY),
            "revenue_per_day": _mean("total_revenue", "trading_days", TOTAL_MONEY),
        }
    ).drop("lines")


def discount_impact(fact: DataFrame) -> DataFrame:
    """What each discount level sold, and what it gave away."""
    gross = F.col("quantity").cast("decimal(10,0)") * F.col("unit_price")
    levels = fact.groupBy("discount").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.count_distinct("order_id").alias("total_orders"),
        _units(),
        money(F.sum(gross), TOTAL_MONEY).alias("gross_revenue"),
        exact_total("revenue").alias("net_revenue"),
    )
    given = (F.col("gross_revenue") - F.col("net_revenue")).cast(TOTAL_MONEY)
    share = given.cast("double") / F.nullif(F.col("gross_revenue"), F.lit(0)).cast("double")
    return levels.withColumns({"revenue_given_away": given, "given_away_pct": F.round(share * 100, 2)})
