"""Aggregates and rankings on hand-made rows, and sums that must agree with each other."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from orderloom.operators import kpis, ranking
from orderloom.sources import star_schema as star

FOLDER = "/root/testdata/sf0.001"
LINE = "order_id string, customer_id string, product_id string, category string, day string, quantity int, price string, discount string"


def facts(spark, rows):
    lines = spark.createDataFrame(rows, LINE).select(
        "order_id",
        "customer_id",
        "product_id",
        "category",
        F.to_date("day").cast("timestamp_ntz").alias("order_date"),
        "quantity",
        F.col("price").cast("decimal(10,2)").alias("unit_price"),
        F.col("discount").cast("decimal(5,2)").alias("discount"),
    )
    return star.as_fact(lines)


@pytest.fixture(scope="module")
def fact(spark):
    cached = star.fact(spark, FOLDER).cache()
    yield cached
    cached.unpersist()


@pytest.fixture(scope="module")
def two_priced(spark):
    return facts(
        spark,
        [
            ("o1", "c1", "p1", "Toys", "2025-01-04", 2, "10.00", "0"),
            ("o1", "c1", "p1", "Toys", "2025-01-04", 1, "20.01", "0.5"),
            ("o2", "c2", "p1", "Books", "2025-01-06", 1, "10.00", "1.5"),
            ("o3", "c1", "p2", None, "2025-03-06", 1, "15.00", None),
        ],
    )


def test_product_with_two_prices_and_categories(two_priced):
    rows = {(r["product_id"], r["category"]): r for r in kpis.product_performance(two_priced).collect()}
    toys = rows["p1", "Toys"]
    assert toys["avg_unit_price"] == Decimal("15.01") and toys["order_count"] == 1
    assert toys["total_revenue"] == Decimal("30.01") and toys["total_units_sold"] == 3
    assert rows["p1", "Books"]["total_revenue"] == Decimal("-5.00")
    assert ("p2", "UNKNOWN") in rows


def test_order_values_are_per_line(two_priced):
    day = kpis.daily_sales(two_priced).where("order_day = 4").first()
    assert (day["total_orders"], day["unique_customers"]) == (1, 1)
    assert (day["max_order_value"], day["min_order_value"]) == (Decimal("20.00"), Decimal("10.01"))
    assert day["avg_order_value"] == Decimal("15.01")


def test_growth_compares_with_the_previous_month_that_has_sales(two_priced):
    growth = ranking.month_growth(kpis.monthly_revenue(two_priced)).collect()
    assert [(r["order_month"], r["prev_month_revenue"]) for r in growth] == [(1, None), (3, Decimal("25.01"))]
    assert growth[1]["mom_growth_pct"] == -40.02


def test_growth_from_nothing_is_null(spark):
    fact = facts(
        spark,
        [
            ("o1", "c", "p", "x", "2025-01-01", 1, "10.00", "1"),
            ("o2", "c", "p", "x", "2025-02-01", 1, "10.00", "0"),
        ],
    )
    assert ranking.month_growth(kpis.monthly_revenue(fact)).collect()[1]["mom_growth_pct"] is None


def test_equal_revenue_shares_a_rank_and_leaves_a_gap(spark):
    rows = [(f"o{i}", "c", "p", name, "2025-01-01", 1, price, "0") for i, (name, price) in enumerate(
        [("a", "5.00"), ("b", "5.00"), ("c", "4.00")])]
    ranks = {r["category"]: r["revenue_rank"] for r in kpis.monthly_revenue(facts(spark, rows)).collect()}
    assert ranks == {"a": 1, "b": 1, "c": 3}


def test_weekend_days_are_saturday_and_sunday(spark):
    rows = [(f"o{i}", "c", "p", "x", f"2025-01-0{i}", 1, "1.00", "0") for i in range(1, 8)]
    sides = {r["is_weekend"]: r["total_orders"] for r in kpis.weekend_vs_weekday(facts(spark, rows)).collect()}
    assert sides == {True: 2, False: 5}


def test_days_add_up_to_months(fact):
    months = kpis.monthly_revenue(fact).select("order_year", "order_month", "category", "monthly_revenue")
    days = kpis.daily_sales(fact).groupBy("order_year", "order_month", "category").agg(
        F.sum("total_revenue").cast("decimal(18,2)").alias("monthly_revenue")
    )
    assert months.exceptAll(days).isEmpty() and days.exceptAll(months).isEmpty()


def test_products_and_customers_add_up_to_the_same(fact):
    by_product = kpis.product_performance(fact).agg(F.sum("total_revenue")).first()[0]
    by_customer = kpis.customer_value(fact).agg(F.sum("monetary")).first()[0]
    by_discount = kpis.discount_impact(fact).agg(F.sum("net_revenue")).first()[0]
    assert by_product == by_customer == by_discount == fact.agg(F.sum("revenue")).first()[0]


def test_recency_from_a_given_day(two_priced):
    rows = {r["customer_id"]: r["recency_days"] for r in kpis.customer_rfm(two_priced, dt.datetime(2025, 3, 10)).collect()}
    assert rows == {"c1": 4, "c2": 63}
    latest = {r["customer_id"]: r["recency_days"] for r in kpis.customer_rfm(two_priced).collect()}
    assert latest == {"c1": 0, "c2": 59}


@pytest.mark.parametrize("count", [1, 3, 4, 5, 6, 7, 11, 23, 500])
def test_quintiles_equal_the_built_in(spark, count):
    # Only three different amounts, so most rows are told apart by the id alone.
    customers = spark.range(count).select(
        F.format_string("c%05d", "id").alias("customer_id"),
        (F.col("id") % 3).cast("decimal(18,2)").alias("monetary"),
        F.lit(1).cast("long").alias("frequency"),
        F.lit(0).alias("recency_days"),
    )
    expected = F.ntile(5).over(Window.orderBy(F.desc("monetary"), "customer_id"))
    want = {(r["customer_id"], r["q"]) for r in customers.withColumn("q", expected).collect()}
    have = {(r["customer_id"], r["monetary_quintile"]) for r in ranking.customer_quintiles(customers).collect()}
    assert want == have


def test_quintiles_of_nobody(spark):
    nobody = spark.createDataFrame([], "customer_id string, monetary decimal(18,2), frequency long, recency_days int")
    assert ranking.customer_quintiles(nobody).isEmpty()


def test_segments_follow_quintiles(spark):
    tiles = spark.range(1, 6).select(F.col("id").cast("int").alias("monetary_quintile"))
    labels = [r["segment"] for r in ranking.segments(tiles).orderBy("monetary_quintile").collect()]
    assert labels == ["High", "Mid", "Mid", "Low", "Low"]
    assert ranking.high_value(tiles).count() == 1


def test_sorted_list_is_in_order(spark, fact):
    rows = ranking.by_value(ranking.customer_quintiles(kpis.customer_rfm(fact))).collect()
    assert rows == sorted(rows, key=lambda r: (-r["monetary"], r["customer_id"]))
    sizes = [sum(r["monetary_quintile"] == tile for r in rows) for tile in range(1, 6)]
    assert max(sizes) - min(sizes) <= 1


def test_top_products_breaks_ties_by_id(spark):
    rows = [(f"o{i}", "c", f"p{i}", "x", "2025-01-01", 1, "5.00", "0") for i in (3, 1, 2)]
    performance = kpis.product_performance(facts(spark, rows))
    assert [r["product_id"] for r in ranking.top_products(performance, "total_revenue", 2).collect()] == ["p1", "p2"]
    monthly = ranking.top_products_by_month(kpis.product_months(facts(spark, rows)), 2)
    assert {(r["product_id"], r["position"]) for r in monthly.collect()} == {("p1", 1), ("p2", 2)}
