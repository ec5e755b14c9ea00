"""The same queries on tables in which single keys hold a third of the rows.

Sizes are set so low that Spark treats the hot parts of joins as it would large ones.
"""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from orderloom.operators.upsert import kept_rows, staged_keys
from orderloom.session import staged
from orderloom.sources import star_schema as star
from tests.compare import duck, mismatch

FOLDER = "/root/testdata/sf0.01"
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
}
CHECKED = [
    "fact_orders",
    "daily_sales",
    "product_performance",
    "customer_rfm",
    "monthly_revenue",
    "top_products_by_month",
    "customer_quintiles",
    "weekend_vs_weekday",
    "discount_impact",
    "enrich_broadcast",
    "dq_report",
    "dq_duplicate_keys",
    "upsert_orders",
    "upsert_published",
    "contract_load",
    "incremental_ingest",
    "customer_copartitioned",
    "distinct_rollup",
]


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """A third of the lines on one order, a third on one product, a third of the orders
    with one customer, and a third of them in one month."""
    folder = str(tmp_path_factory.mktemp("skewed"))
    lines = star.table(spark, FOLDER, "lineitem")
    orders = star.table(spark, FOLDER, "orders")
    third = F.col("l_suppkey") % 3
    changed = {
        "lineitem": lines.withColumns(
            {
                "l_orderkey": F.when(third == 0, 7).otherwise(F.col("l_orderkey")),
                "l_partkey": F.when(third == 1, 11).otherwise(F.col("l_partkey")),
            }
        ),
        "orders": orders.withColumns(
            {
                "o_custkey": F.when(F.col("o_orderkey") % 3 == 0, 5).otherwise(F.col("o_custkey")),
                "o_orderdate": F.when(
                    F.col("o_orderkey") % 3 == 1,
                    F.make_timestamp_ntz(
                        F.lit(1999), F.lit(3), (F.col("o_orderkey") % 28 + 1).cast("int"), F.lit(0), F.lit(0), F.lit(0)
                    ),
                ).otherwise(F.col("o_orderdate")),
            }
        ),
    }
    for name in ["lineitem", "orders", "part", "customer", "nation"]:
        table = changed.get(name, star.table(spark, FOLDER, name))
        # Several files: a hot part of a join is split by the tasks that wrote it.
        table.repartition(8).write.parquet(f"{folder}/{name}.parquet")
    return folder


@pytest.fixture(scope="module")
def touchy(spark):
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    yield
    for key in SETTINGS:
        spark.conf.unset(key)


@pytest.mark.parametrize("name", CHECKED)
def test_skewed_tables_match_oracle(spark, skewed, touchy, name):
    result = contract.queries()[name](spark, skewed)
    assert mismatch(result, duck(skewed), contract.oracle_sql()[name]) is None


def test_hot_order_is_split_in_an_upsert_with_many_keys(spark, skewed, touchy):
    target = staged(star.fact(spark, skewed).repartition(8), "target")
    keys = staged_keys(target.where("order_month < 7"))._replace(few=False)
    kept = kept_rows(target, keys)
    rows = kept.collect()
    final = kept._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "SortMergeJoin(skew=true)" in final and "LeftAnti" in final
    assert len(rows) == target.where("order_month >= 7").count()


def test_hot_keys_of_both_joins_are_split(spark, skewed, touchy):
    fact = star.fact(spark, skewed)
    fact.collect()
    final = fact._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("SortMergeJoin(skew=true)") == 2
