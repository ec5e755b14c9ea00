"""What the plans must and must not contain."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql.readwriter import DataFrameWriter

from orderloom.operators import kpis, ranking
from orderloom.operators.upsert import merged, staged_keys
from orderloom.plans.catalog import all_queries
from orderloom.sources import star_schema as star
from orderloom.sources.lake import scan_period, write_months

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(setting, "-1")
    yield
    spark.conf.unset(setting)


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact") / "months")
    write_months(star.fact(spark, FOLDER), path, ("order_date", "category"))
    return path


@pytest.fixture
def written_plans(monkeypatch):
    """The plans of all tables written meanwhile: a query's last part does not show them."""
    plans = []
    write = DataFrameWriter.parquet

    def recorded(self, *args, **options):
        plans.append(plan(self._df))
        return write(self, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", recorded)
    return plans


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_no_python_and_no_cross_product(spark, written_plans, name):
    plans = [plan(all_queries()[name](spark, FOLDER)), *written_plans]
    for operator in ["EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin"]:
        assert not any(operator in text for text in plans)


def test_plans_of_staged_tables_are_seen(spark, written_plans):
    all_queries()["customer_quintiles"](spark, FOLDER)
    assert any("HashAggregate" in text for text in written_plans)


def test_period_opens_its_months_only(spark, written):
    scan = scan_period(spark.read.parquet(written), dt.date(1998, 1, 15), dt.date(1998, 4, 15))
    text = plan(scan.select("order_id"))
    assert "PartitionFilters: [" in text and "PartitionFilters: []" not in text
    assert "GreaterThanOrEqual(order_date" in text
    files = scan.select("_metadata.file_path").distinct().collect()
    months = {r["file_path"].split("order_year=")[1].rsplit("/", 1)[0] for r in files}
    assert months == {f"1998/order_month={m}" for m in (1, 2, 3, 4)}


def test_aggregates_read_their_columns_only(spark, written):
    text = plan(kpis.customer_value(spark.read.parquet(written)))
    schema = text.split("ReadSchema: ")[1].split(">")[0]
    assert "order_id" in schema and "unit_price" not in schema and "category" not in schema


def test_distinct_counts_group_by_the_counted_id_first(spark, written, written_plans):
    assert "Expand" not in plan(kpis.product_performance(spark.read.parquet(written)))
    kpis.monthly_revenue(spark.read.parquet(written))
    text = "\n".join(written_plans)
    shuffles = [line for line in text.splitlines() if "Exchange hashpartitioning(order_year" in line]
    for counted in ["order_id", "customer_id"]:
        assert any(counted in line for line in shuffles)
    assert "Expand" not in text


def test_top_k_keeps_k_rows_per_task(spark, written):
    fact = spark.read.parquet(written)
    assert "TakeOrderedAndProject" in plan(ranking.top_products(kpis.product_performance(fact), "total_revenue"))
    by_month = plan(ranking.top_products_by_month(kpis.product_months(fact)))
    before_shuffle = by_month.split("Exchange hashpartitioning(order_year")[1]
    assert "WindowGroupLimit" in before_shuffle


def test_quintiles_send_no_customers_to_one_task(spark, written):
    text = plan(ranking.customer_quintiles(kpis.customer_rfm(spark.read.parquet(written))))
    single = text.split("Exchange SinglePartition")
    assert len(single) == 2
    # What goes there has been counted per sorted part first, and reads the row numbers only.
    assert "partial_count(1)" in single[1] and "FileScan parquet [slot" in single[1]


def test_keyless_rows_are_spread_in_an_upsert(spark, written, monkeypatch, no_auto_broadcast):
    monkeypatch.setattr("orderloom.operators.upsert.fits_broadcast", lambda df: False)
    fact = spark.read.parquet(written)
    text = plan(merged(fact, fact, staged_keys(fact)))
    assert "SortMergeJoin [order_id" in text and "LeftAnti" in text
    assert any("hashpartitioning(order_id" in line and "_spread" in line for line in text.splitlines())


def test_few_keys_are_broadcast_in_an_upsert(spark, written, no_auto_broadcast):
    fact = spark.read.parquet(written)
    text = plan(merged(fact, fact, staged_keys(fact)))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_nothing_is_broadcast_by_size_alone(spark, no_auto_broadcast):
    assert "Broadcast" not in plan(star.fact(spark, FOLDER))
