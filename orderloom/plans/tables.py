"""The tables of a lake: where they lie, how the aggregates follow the fact, how they are read."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom import contracts
from orderloom.operators import kpis
from orderloom.operators.cleaning import accepted_with_origin, rejected
from orderloom.operators.quality import check_states, quality_report_of
from orderloom.session import staged
from orderloom.sources.lake import conformed, write_plain
from orderloom.sources.ledger import Ledger, file_months, month_set
from orderloom.sources.orders import OrderTable
from orderloom.sources.versions import MonthlyTable, WholeTable

# Tables of which a month depends on that month's lines alone. The states are what the tables of
# all time and the checks are put together from.
BY_MONTH = {
    "agg_daily_sales": (kpis.daily_sales, contracts.DAILY_SALES),
    "agg_monthly_revenue": (kpis.monthly_revenue, contracts.MONTHLY_REVENUE),
    "state_products": (kpis.product_states, contracts.PRODUCT_STATES),
    "state_customers": (kpis.customer_states, contracts.CUSTOMER_STATES),
    "state_checks": (check_states, contracts.CHECK_STATES),
}
# Those that come laid out by month.
LAID_OUT = {"state_products"}
# The others, each with the states it is made of and the columns its files are in the order of.
ALL_TIME = {
    "agg_product_performance": (
        "state_products",
        kpis.product_performance_of,
        contracts.PRODUCT_PERFORMANCE,
        ("total_revenue", "product_id", "category"),
    ),
    "agg_customer_rfm": (
        "state_customers",
        kpis.customer_rfm_of,
        contracts.CUSTOMER_RFM,
        ("monetary", "customer_id"),
    ),
}
# The columns of the fact with what each line is from.
_LINES = T.StructType(
    [field for field in contracts.STORED_ORDERS if field.name not in (contracts.CURRENT, contracts.SPANS)]
)


def fact_table(spark: SparkSession, lake: str) -> OrderTable:
    return OrderTable(spark, f"{lake.rstrip('/')}/fact_orders")


def ledger(spark: SparkSession, lake: str) -> Ledger:
    return Ledger(spark, f"{lake.rstrip('/')}/ledger")


def aggregate_table(spark: SparkSession, lake: str, name: str) -> MonthlyTable | WholeTable:
    path = f"{lake.rstrip('/')}/{name}"
    if name in BY_MONTH:
        return MonthlyTable(spark, path, BY_MONTH[name][1], laid_out=name in LAID_OUT)
    _, _, contract, order = ALL_TIME[name]
    return WholeTable(spark, path, contract, *order)


def load_aggregate(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """The stored rows of an aggregate, held to its contract."""
    table = aggregate_table(spark, lake, name)
    return conformed(table.read(), table.schema)


def load_landed(landed: DataFrame, files: DataFrame, lake: str, label: str, rebuild: bool = False) -> None:
    """Put assessed lines where they belong: refused ones to the rejects of this run, the others
    to the fact table, and bring all that follows the fact up to date.

    `files` are those the lines are from, as `Ledger.fresh` has them. The nightly job and the
    ingest of new files both go through here. Of every order the newest run date counts, and a
    file that was taken in before is replaced by what it holds now, so the same files give the
    same tables whichever job took them, in however many runs and in whatever order. The
    rejects of a run stay as that run's.
    """
    spark = landed.sparkSession
    write_plain(rejected(landed), f"{rejects_path(lake)}/run={label}", compact=True)
    lines = conformed(accepted_with_origin(landed), _LINES)
    table, taken = fact_table(spark, lake), ledger(spark, lake)
    none = F.array().cast("array<int>")
    found = files.select(contracts.FILE, "length", "modified", "again", F.col("months").alias("was"))
    found = found.join(file_months(lines), contracts.FILE, "left").withColumn("months", F.coalesce("months", none))
    found = staged(found, "file-months")
    if rebuild:
        table.rebuild(lines)
    else:
        # Until the lines are in, an entry names the months they may be in already as well.
        either = F.array_union("months", F.coalesce("was", none))
        taken.record(found.withColumn("months", either), done=False)
        before = found.where("again")
        if before.isEmpty():
            table.take(lines)
        else:
            table.take(lines, before, month_set(before.select(F.col("was").alias("months"))))
    write_aggregates(table, lake)
    taken.record(found, done=True, forget_others=rebuild)


def rejects_path(lake: str) -> str:
    return f"{lake.rstrip('/')}/rejects"


def load_rejects(spark: SparkSession, lake: str) -> DataFrame:
    """The refused lines of all runs, with the run each was refused in."""
    return spark.read.schema(f"{contracts.REJECTS.toDDL()}, run string").parquet(rejects_path(lake))


def write_aggregates(fact: MonthlyTable, lake: str) -> None:
    """Bring up to date what follows the fact: by month where months of the fact have changed,
    and the tables of all time, from the states of all months, if any has.

    Tables that do not depend on each other are worked out two at a time, so that the last tasks
    of one leave no cores idle, and what is shuffled for them is not on the disks all at once.
    Each is published by itself, whole.
    """

    def by_month(name: str) -> None:
        aggregate_table(fact.spark, lake, name).follow(fact, BY_MONTH[name][0])

    def all_time(name: str) -> None:
        states, compute, *_ = ALL_TIME[name]
        by_month(states)
        aggregate_table(fact.spark, lake, name).follow(aggregate_table(fact.spark, lake, states), compute)

    with ThreadPoolExecutor(2) as pool:
        jobs = [pool.submit(all_time, name) for name in ALL_TIME]
        jobs += [pool.submit(fact.mark)] if isinstance(fact, OrderTable) else []
        made_on_the_way = {states for states, *_ in ALL_TIME.values()}
        jobs += [pool.submit(by_month, name) for name in BY_MONTH if name not in made_on_the_way]
    for job in jobs:
        job.result()


def stored_report(spark: SparkSession, lake: str, as_of: dt.date) -> DataFrame:
    """The quality report on the fact, from the states of its months: no line is read for it."""
    return quality_report_of(aggregate_table(spark, lake, "state_checks").read(), as_of)
