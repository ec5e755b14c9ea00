"""Every operator as a query over the star-schema tables of one folder."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import contracts
from orderloom.contracts import FACT_ORDERS, RAW_ORDERS
from orderloom.functions import WIDE, calendar_fields, exact_total, normalized_id, parsed_date, parsed_quantity
from orderloom.operators import cleaning, kpis, ranking, rollup
from orderloom.operators.lookups import enrich
from orderloom.operators.profile import type_audit
from orderloom.operators.quality import duplicate_keys, quality_report
from orderloom.operators.upsert import matched_rows, merged, staged_keys
from orderloom.plans.nightly import run_nightly
from orderloom.plans.tables import fact_table, load_aggregate, load_rejects, stored_report
from orderloom.session import folder_exists, fresh_path, staged
from orderloom.sources import star_schema as star
from orderloom.sources.lake import (
    Copartitioned,
    load_contract,
    scan_period,
    write_copartitioned,
    write_months,
    write_ranged,
)
from orderloom.sources.order_files import listed_files, read_orders, schema_audit
from orderloom.sources.versions import MonthlyTable
from orderloom.streaming.arrivals import ingest_new_files

Query = Callable[[SparkSession, str], DataFrame]

# The day after the last order in the tables, and a load time to go with it.
AS_OF = dt.date(2001, 8, 2)
LOADED_AT = dt.datetime(2001, 8, 2, 2, 0, 0)
PERIOD = (dt.date(1998, 1, 15), dt.date(1998, 4, 15))

_CATALOG: dict[str, Query] = {}


def query(build: Query) -> Query:
    _CATALOG[build.__name__] = build
    return build


def all_queries() -> dict[str, Query]:
    return dict(_CATALOG)


def _raw(spark: SparkSession, folder: str) -> DataFrame:
    return star.text_lines(spark, folder).select(RAW_ORDERS.names)


# What queries of one session share, by application, folder, name and state of the tables.
_SHARED: dict[tuple, str] = {}


def _once(spark: SparkSession, folder: str, name: str, make: Callable[[str], None]) -> str:
    """The path of something written once from a folder's tables, by `make` if need be.

    It is made anew when one of the tables' files is another, or of another length or time.
    """
    tables = [f"{folder}/{table}.parquet" for table in ("orders", "lineitem", "part")]
    state = listed_files(spark, tables).select("path", "length", F.unix_micros("modified")).collect()
    key = spark.sparkContext.applicationId, folder, name, tuple(sorted(map(tuple, state)))
    if key not in _SHARED or not folder_exists(spark, _SHARED[key]):
        path = fresh_path(spark, name)
        make(path)
        _SHARED[key] = path
    return _SHARED[key]


def forget_shared(*names: str) -> None:
    """Let the next query that needs one of these make it, for measuring it by itself."""
    for key in [key for key in _SHARED if key[2] in names]:
        del _SHARED[key]


def _landed(spark: SparkSession, folder: str) -> DataFrame:
    """The assessed lines, written once. A filter on the reason, if it were pushed into the
    plan that finds it, would parse every field a second time."""
    assessed = cleaning.assess(_raw(spark, folder))
    path = _once(spark, folder, "landing", lambda path: assessed.write.parquet(path))
    return spark.read.schema(assessed.schema).parquet(path)


def _stored_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The fact as a lake holds it: joined and written once, then scanned by column."""
    fact = star.fact(spark, folder)
    path = _once(spark, folder, "fact", lambda path: fact.write.parquet(path))
    return spark.read.schema(fact.schema).parquet(path)


def _nightly(spark: SparkSession, folder: str) -> str:
    """The lake of two nights: the lines of the first layout, then those of the second."""

    def run(lake: str) -> None:
        lines = star.text_lines(spark, folder)
        for night in range(len(star.LAYOUTS)):
            files = fresh_path(spark, "order-files")
            of_night = lines.where(F.col("layout") == night).drop("layout")
            star.write_order_files(of_night, f"{files}/layout-{night}", night)
            loaded_at = LOADED_AT + dt.timedelta(days=night)
            run_nightly(spark, files, lake, loaded_at, AS_OF, full_rebuild=night == 0, gate=False)

    return _once(spark, folder, "lake", run)


def _loaded_fact(spark: SparkSession, folder: str) -> DataFrame:
    stamped = star.fact(spark, folder).withColumn("ingestion_ts", F.lit(LOADED_AT).cast(contracts.MOMENT))
    return stamped.select(FACT_ORDERS.names)


def _versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """The orders before a correction, and the correction as a written staging table."""
    lines = star.order_lines(spark, folder)
    before, after = star.as_fact(star.first_version(lines)), star.as_fact(star.corrected(lines))
    return before, staged(after, "staging")


# Cleaning


@query
def fact_orders(spark, folder):
    return star.fact(spark, folder)


@query
def clean_orders(spark, folder):
    return cleaning.accepted(_landed(spark, folder)).drop("ingestion_ts")


@query
def safe_cast_rejects(spark, folder):
    return cleaning.rejected(_landed(spark, folder)).drop(contracts.CORRUPT)


@query
def parse_order_date(spark, folder):
    text = F.col("order_date")
    return _raw(spark, folder).select("order_id", text.alias("date_text"), parsed_date(text).alias("order_date"))


@query
def date_enrichment(spark, folder):
    orders = star.table(spark, folder, "orders")
    fields = [value.alias(name) for name, value in calendar_fields(F.col("o_orderdate")).items()]
    return orders.select(
        F.col("o_orderkey").cast("string").alias("order_id"), F.col("o_orderdate").alias("order_date"), *fields
    )


@query
def normalize_ids(spark, folder):
    return _raw(spark, folder).select(
        "order_id",
        F.col("customer_id").alias("customer_text"),
        F.col("product_id").alias("product_text"),
        normalized_id(F.col("customer_id")).alias("customer_id"),
        normalized_id(F.col("product_id")).alias("product_id"),
    )


@query
def null_defaults(spark, folder):
    typed = _raw(spark, folder).withColumn("discount", F.col("discount").try_cast("double"))
    return cleaning.with_defaults(typed).select("order_id", "product_id", "discount", "category")


@query
def drop_null_critical(spark, folder):
    return cleaning.drop_incomplete(_raw(spark, folder))


@query
def positive_filter(spark, folder):
    typed = _raw(spark, folder).select(
        "order_id",
        "product_id",
        parsed_quantity(F.col("quantity")).alias("quantity"),
        F.col("unit_price").try_cast(WIDE).alias("unit_price"),
    )
    return cleaning.positive_lines(typed)


# Aggregates


@query
def daily_sales(spark, folder):
    return kpis.daily_sales(_stored_fact(spark, folder))


@query
def product_performance(spark, folder):
    return kpis.product_performance(_stored_fact(spark, folder))


@query
def customer_rfm(spark, folder):
    return kpis.customer_rfm(star.fact(spark, folder))


@query
def monthly_revenue(spark, folder):
    return kpis.monthly_revenue(_stored_fact(spark, folder))


@query
def weekend_vs_weekday(spark, folder):
    return kpis.weekend_vs_weekday(_stored_fact(spark, folder))


@query
def discount_impact(spark, folder):
    return kpis.discount_impact(_stored_fact(spark, folder))


# Rankings


@query
def mom_growth(spark, folder):
    return ranking.month_growth(kpis.category_months(star.fact(spark, folder)))


@query
def top_products_revenue(spark, folder):
    return ranking.top_products(kpis.product_totals(star.fact(spark, folder)), "total_revenue")


@query
def top_products_units(spark, folder):
    return ranking.top_products(kpis.product_totals(star.fact(spark, folder)), "total_units_sold")


@query
def top_products_by_month(spark, folder):
    return ranking.top_products_by_month(kpis.product_months(star.fact(spark, folder)))


@query
def customer_quintiles(spark, folder):
    return ranking.customer_quintiles(customer_rfm(spark, folder))


@query
def high_value_customers(spark, folder):
    return ranking.high_value(customer_quintiles(spark, folder))


@query
def rfm_segments(spark, folder):
    return ranking.segments(customer_quintiles(spark, folder))


@query
def sorted_customer_list(spark, folder):
    return ranking.by_value(customer_quintiles(spark, folder))


# Lookups


@query
def enrich_broadcast(spark, folder):
    products = star.table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"), "p_name", "p_brand", "p_size"
    )
    nations = star.table(spark, folder, "nation").select("n_nationkey", "n_name")
    customers = star.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        "c_mktsegment",
        F.col("c_nationkey").alias("n_nationkey"),
    )
    lines = star.fact(spark, folder).select("order_id", "product_id", "customer_id", "category", "quantity", "revenue")
    with_customer = enrich(enrich(lines, products, "product_id"), customers, "customer_id")
    return enrich(with_customer, nations, "n_nationkey").drop("n_nationkey")


# Quality


@query
def dq_report(spark, folder):
    return quality_report(star.fact(spark, folder), AS_OF)


@query
def dq_duplicate_keys(spark, folder):
    return duplicate_keys(star.fact(spark, folder), "order_id")


@query
def dq_type_audit(spark, folder):
    return type_audit(_raw(spark, folder))


@query
def dq_ingest_audit(spark, folder):
    files = fresh_path(spark, "order-files")
    star.write_order_files(star.text_lines(spark, folder), files)
    return cleaning.ingest_audit(cleaning.assess(read_orders(spark, files)))


# Lake


@query
def upsert_orders(spark, folder):
    before, staging = _versions(spark, folder)
    return merged(before, staging, staged_keys(staging))


@query
def upsert_matched(spark, folder):
    before, staging = _versions(spark, folder)
    return matched_rows(before, staged_keys(staging))


@query
def upsert_published(spark, folder):
    before, staging = _versions(spark, folder)
    orders = MonthlyTable(spark, fresh_path(spark, "orders"), before.schema)
    orders.replace(before)
    orders.upsert(staging)
    return orders.read()


@query
def contract_load(spark, folder):
    path = fresh_path(spark, "fact")
    write_months(_loaded_fact(spark, folder), path, ("order_date", "category"))
    return load_contract(spark, path, FACT_ORDERS)


@query
def partitioned_roundtrip(spark, folder):
    path = fresh_path(spark, "daily")
    write_months(daily_sales(spark, folder), path, ("order_day",))
    return load_contract(spark, path, contracts.DAILY_SALES)


@query
def pruned_month_scan(spark, folder):
    path = fresh_path(spark, "fact")
    write_months(star.fact(spark, folder), path, ("order_date", "category"))
    period = scan_period(spark.read.parquet(path), *PERIOD)
    return period.select("order_id", "product_id", "order_date", "order_year", "order_month", "revenue")


@query
def csv_roundtrip_scan(spark, folder):
    files = fresh_path(spark, "order-files")
    star.write_order_files(star.text_lines(spark, folder), files)
    scanned = read_orders(spark, files)
    return scanned.select(*RAW_ORDERS.names, F.col(contracts.CORRUPT).isNotNull().alias("is_corrupt"))


@query
def dq_schema_audit(spark, folder):
    files = fresh_path(spark, "order-files")
    star.write_order_files(star.text_lines(spark, folder), files)
    # How many files Spark writes is its own affair; that of their folders is not.
    return schema_audit(spark, files).drop("files")


@query
def incremental_ingest(spark, folder):
    files, lake, checkpoint = (fresh_path(spark, label) for label in ["arrivals", "lake", "progress"])
    lines = star.order_lines(spark, folder)
    write_first_day(lines, files)
    ingest_new_files(spark, files, lake, checkpoint)
    write_second_day(lines, files)
    ingest_new_files(spark, files, lake, checkpoint)
    ingest_new_files(spark, files, lake, checkpoint)
    return fact_table(spark, lake).read().drop("ingestion_ts")


@query
def incremental_catchup(spark, folder):
    """Both versions of the orders are there, a day apart, before the first ingest."""
    files, lake, checkpoint = (fresh_path(spark, label) for label in ["arrivals", "lake", "progress"])
    lines = star.order_lines(spark, folder)
    write_first_day(lines, files)
    write_second_day(lines, files)
    ingest_new_files(spark, files, lake, checkpoint)
    return fact_table(spark, lake).read().drop("ingestion_ts")


@query
def late_correction(spark, folder):
    """The correction is taken in before the day that it corrects arrives."""
    files, lake, checkpoint = (fresh_path(spark, label) for label in ["arrivals", "lake", "progress"])
    lines = star.order_lines(spark, folder)
    write_second_day(lines, files)
    ingest_new_files(spark, files, lake, checkpoint)
    write_first_day(lines, files)
    ingest_new_files(spark, files, lake, checkpoint)
    return fact_table(spark, lake).read().drop("ingestion_ts")


@query
def redelivered_file(spark, folder):
    """Files of the even orders are delivered again under their names, with other orders in them."""
    files, lake, checkpoint = (fresh_path(spark, label) for label in ["arrivals", "lake", "progress"])
    lines = star.order_lines(spark, folder)
    even = F.col("order_id").cast("long") % 2 == 0
    first = star.first_version(lines)
    count = star.delivered_files(spark, folder)
    star.deliver(star.as_text(first.where(~even)), f"{files}/20010801/odd", count)
    star.deliver(star.as_text(first.where(even)), f"{files}/20010801/even", count)
    ingest_new_files(spark, files, lake, checkpoint)
    star.deliver(star.as_text(star.corrected(lines).where(even)), f"{files}/20010801/even", count, layout=1)
    ingest_new_files(spark, files, lake, checkpoint)
    return fact_table(spark, lake).read().drop("ingestion_ts")


def write_first_day(lines: DataFrame, files: str) -> None:
    star.write_order_files(star.as_text(star.first_version(lines)), f"{files}/20010801")


def write_second_day(lines: DataFrame, files: str) -> None:
    """The correction, in a folder of the day after."""
    star.write_order_files(star.as_text(star.corrected(lines)), f"{files}/20010802", layout=1)


@query
def customer_copartitioned(spark, folder):
    """Revenue per customer and segment from a fact and a customer table that lie alike."""
    laid_out = copartitioned_by_customer(spark, folder)
    revenue = exact_total("revenue").alias("total_revenue")
    return laid_out.totals(
        laid_out.joined("lines", "customers"),
        ["c_mktsegment"],
        [F.count(F.lit(1)).alias("line_count"), revenue],
        [F.sum("line_count").alias("line_count"), exact_total("total_revenue").alias("total_revenue")],
    )


def copartitioned_by_customer(spark: SparkSession, folder: str, buckets: int = 16) -> Copartitioned:
    customers = star.table(spark, folder, "customer").select(
        F.col("c_custkey").cast("string").alias("customer_id"), "c_mktsegment"
    )
    lines = star.fact(spark, folder).select("customer_id", "order_id", "product_id", "quantity", "revenue")
    path = fresh_path(spark, "by-customer")
    name = "by_customer_" + path.rsplit("-", 1)[1]
    return write_copartitioned(lines, {"customers": customers}, path, "customer_id", buckets, name)


@query
def distinct_rollup(spark, folder):
    """Orders and customers per day, month and year, the latter two from the days' bitmaps."""
    fact = _stored_fact(spark, folder)
    levels = {"day": ["order_year", "order_month", "order_day"], "month": ["order_year", "order_month"], "year": ["order_year"]}
    counts = []
    for id_name, name in [("order_id", "total_orders"), ("customer_id", "unique_customers")]:
        numbers = rollup.numbered(rollup.first_days(fact, id_name), id_name)
        days = staged(rollup.id_bitmaps(fact, numbers, id_name, *levels["day"]), "day-bitmaps")
        for level, key in levels.items():
            bitmaps = days if level == "day" else rollup.rolled_up(days, *key)
            counts.append(rollup.counted(bitmaps, name, *key).withColumn("level", F.lit(level)))
    rows = reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), counts)
    measures = [F.max(name).alias(name) for name in ["total_orders", "unique_customers"]]
    return rows.groupBy("level", *levels["day"]).agg(*measures)


@query
def keyed_layout_scan(spark, folder):
    """Lines of a range of customers from a fact laid out by customer."""
    path = fresh_path(spark, "fact-by-customer")
    write_ranged(star.fact(spark, folder), path, "customer_id", "order_date", "order_id", "product_id")
    lines = spark.read.parquet(path).where("customer_id >= '10' AND customer_id < '12'")
    return lines.select("customer_id", "order_id", "product_id", "order_date", "revenue")


# The nightly job's tables


@query
def nightly_rebuild(spark, folder):
    return load_aggregate(spark, _nightly(spark, folder), "agg_monthly_revenue")


@query
def nightly_daily(spark, folder):
    return load_aggregate(spark, _nightly(spark, folder), "agg_daily_sales")


@query
def nightly_products(spark, folder):
    return load_aggregate(spark, _nightly(spark, folder), "agg_product_performance")


@query
def nightly_customers(spark, folder):
    return ranking.customer_quintiles(load_aggregate(spark, _nightly(spark, folder), "agg_customer_rfm"))


@query
def nightly_growth(spark, folder):
    return ranking.month_growth(load_aggregate(spark, _nightly(spark, folder), "agg_monthly_revenue"))


@query
def nightly_top_products(spark, folder):
    return ranking.top_products(load_aggregate(spark, _nightly(spark, folder), "agg_product_performance"), "total_revenue")


@query
def nightly_rejects(spark, folder):
    return load_rejects(spark, _nightly(spark, folder)).drop(contracts.CORRUPT, "run")


@query
def dq_incremental(spark, folder):
    """The report from the states that the nights have kept up, which reads no line of the fact."""
    return stored_report(spark, _nightly(spark, folder), AS_OF)


@query
def dq_gate(spark, folder):
    """The checks that would stop the nightly job."""
    return quality_report(fact_table(spark, _nightly(spark, folder)).read(), AS_OF).where("NOT passed")
