"""Datasets on disk: layout, contracts, upserts, checks, and the jobs that tie them together."""

from __future__ import annotations

import datetime as dt
import glob
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from orderloom import contracts
from orderloom.operators import kpis
from orderloom.operators.lookups import enrich, fits_broadcast
from orderloom.operators.quality import QualityError, duplicate_keys, enforce, quality_report
from orderloom.operators.upsert import matched_months, matched_rows, merged, staged_keys
from orderloom.plans.catalog import write_first_day, write_second_day
from orderloom.plans.nightly import run_nightly
from orderloom.plans.tables import (
    aggregate_table,
    fact_table,
    load_aggregate,
    load_rejects,
    write_aggregates,
)
from orderloom.session import fresh_path, shared_folder
from orderloom.sources import star_schema as star
from orderloom.sources.lake import (
    bucket_share,
    load_contract,
    scan_period,
    write_bucketed_table,
    write_months,
    write_ranged,
)
from orderloom.sources.versions import LISTS_KEPT, MonthlyTable, PublishError, WholeTable
from orderloom.streaming.arrivals import batch_label, ingest_new_files
from tests.test_kpis import facts
from tests.test_order_files import DAYS, write_day

FOLDER = "/root/testdata/sf0.001"


def orders(spark, *rows):
    """Rows of (order, day, version) as facts; the version is the quantity."""
    return facts(spark, [(order, "c", "p", "x", day, version, "1.00", "0") for order, day, version in rows])


def content(df):
    return sorted((r["order_id"], r["order_year"], r["order_month"], r["quantity"]) for r in df.collect())


@pytest.fixture
def fact(spark):
    return star.fact(spark, FOLDER)


# Upsert

CASES = {
    "replace": ([("A", "2025-01-01", 1)], [("A", "2025-01-02", 2)], [("A", 2025, 1, 2)]),
    "insert": ([("A", "2025-01-01", 1)], [("B", "2025-01-01", 1)], [("A", 2025, 1, 1), ("B", 2025, 1, 1)]),
    "moved": ([("C", "2025-02-01", 1)], [("C", "2025-03-01", 2)], [("C", 2025, 3, 2)]),
    "fewer lines": ([("A", "2025-01-01", 1), ("A", "2025-01-01", 2)], [("A", "2025-01-01", 1)], [("A", 2025, 1, 1)]),
    "month kept": (
        [("A", "2025-01-01", 1), ("B", "2025-02-01", 1), ("C", "2025-02-01", 1)],
        [("C", "2025-04-01", 2)],
        [("A", 2025, 1, 1), ("B", 2025, 2, 1), ("C", 2025, 4, 2)],
    ),
}


@pytest.mark.parametrize("before, after, expected", CASES.values(), ids=CASES)
def test_upsert(spark, tmp_path, before, after, expected):
    target, staging = orders(spark, *before), orders(spark, *after)
    assert content(merged(target, staging, staged_keys(staging))) == expected

    table = MonthlyTable(spark, str(tmp_path), target.schema)
    assert table.read().isEmpty()
    table.replace(target)
    table.upsert(staging)
    assert content(table.read()) == expected
    table.upsert(staging)
    assert content(table.read()) == expected


def test_rows_without_key_stay(spark):
    target = orders(spark, (None, "2025-01-01", 1), ("A", "2025-01-01", 1))
    staging = orders(spark, (None, "2025-01-01", 2), ("A", "2025-01-01", 3))
    keys = staged_keys(staging)
    assert sorted(r["quantity"] for r in merged(target, staging, keys).collect()) == [1, 2, 3]
    assert [r["order_id"] for r in matched_rows(target, keys).collect()] == ["A"]


@pytest.mark.parametrize("few", [True, False])
def test_months_to_rewrite_do_not_depend_on_the_number_of_keys(spark, few):
    target = orders(
        spark, ("A", "2024-12-01", 1), ("B", "2025-01-01", 1), ("C", "2025-02-01", 1), ("D", "2024-11-30", 1), ("D", "2025-01-02", 1)
    )

    def months(*names):
        keys = staged_keys(orders(spark, *[(name, "2030-01-01", 1) for name in names]))._replace(few=few)
        return {(r["order_year"], r["order_month"]) for r in matched_months(target, keys).collect()}

    assert months("A") == {(2024, 12)}
    assert months("A", "C", "Z") == {(2024, 12), (2025, 2)}
    assert months("D") == {(2024, 11), (2025, 1)}
    assert months("Z") == set()


def test_upsert_with_many_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("orderloom.operators.upsert.fits_broadcast", lambda df: False)
    for before, after, expected in CASES.values():
        target, staging = orders(spark, *before), orders(spark, *after)
        table = MonthlyTable(spark, f"{tmp_path}/{len(glob.glob(f'{tmp_path}/*'))}", target.schema)
        table.replace(target)
        table.upsert(staging)
        assert content(table.read()) == expected


def test_upsert_compares_lines_with_held_keys_only(spark, tmp_path, monkeypatch):
    """Keys that are new to the table, however many, do not make it shuffle its lines."""
    target = orders(spark, ("A", "2025-01-01", 1), ("B", "2025-02-01", 1), ("C", "2025-02-01", 1))
    staging = orders(spark, ("A", "2025-02-01", 3), *[(f"N{k}", "2025-02-01", k) for k in range(50)])
    table, compared = MonthlyTable(spark, str(tmp_path), target.schema), []
    monkeypatch.setattr("orderloom.sources.versions.merged", lambda rows, new, keys: compared.append(keys) or merged(rows, new, keys))
    table.replace(target)
    assert table.upsert(staging) == {(2025, 1), (2025, 2)}
    assert [tuple(r) for r in compared[0].table.collect()] == [("A",)]
    assert content(table.read()) == content(merged(target, staging, staged_keys(staging)))


def test_merge_is_by_name(spark):
    target, staging = orders(spark, ("A", "2025-01-01", 1)), orders(spark, ("B", "2025-01-01", 2))
    shuffled, keys = staging.select(*reversed(staging.columns)), staged_keys(staging)
    assert content(merged(target, shuffled, keys)) == content(merged(target, staging, keys))


def test_upsert_leaves_other_months_files_alone(spark, tmp_path):
    target = orders(spark, ("A", "2025-01-01", 1), ("B", "2025-02-01", 1), ("C", "2025-03-01", 1))
    table = MonthlyTable(spark, str(tmp_path), target.schema)
    table.replace(target)
    before = table.live()[1]
    table.upsert(orders(spark, ("B", "2025-03-01", 2)))
    version, after = table.live()
    assert version == 2
    assert after[2025, 1] == before[2025, 1] and (2025, 2) not in after and after[2025, 3] != before[2025, 3]


def test_aggregates_are_refreshed_for_touched_months_only(spark, tmp_path):
    fact = MonthlyTable(spark, f"{tmp_path}/fact_orders", orders(spark, ("A", "2025-01-01", 1)).schema)
    fact.replace(orders(spark, ("A", "2025-01-01", 1), ("B", "2025-02-01", 1)))
    write_aggregates(fact, str(tmp_path))
    daily = MonthlyTable(spark, f"{tmp_path}/agg_daily_sales", contracts.DAILY_SALES)
    before = daily.live()[1]
    touched = fact.upsert(orders(spark, ("B", "2025-03-01", 5)))
    assert touched == {(2025, 2), (2025, 3)}
    write_aggregates(fact, str(tmp_path))
    after = daily.live()[1]
    assert after.keys() == {(2025, 1), (2025, 3)} and after[2025, 1] == before[2025, 1]
    assert {r["total_units_sold"] for r in daily.read().collect()} == {1, 5}


def test_reader_keeps_its_version_while_another_is_published(spark, tmp_path):
    table = MonthlyTable(spark, str(tmp_path), orders(spark, ("A", "2025-01-01", 1)).schema)
    table.replace(orders(spark, ("A", "2025-01-01", 1)))
    opened = table.read()
    table.replace(orders(spark, ("B", "2025-01-01", 2)))
    assert content(opened) == [("A", 2025, 1, 1)] and content(table.read()) == [("B", 2025, 1, 2)]


def test_failed_write_is_never_seen(spark, tmp_path):
    good = orders(spark, ("A", "2025-01-01", 1))
    table = MonthlyTable(spark, str(tmp_path), good.schema)
    table.replace(good)
    broken = good.withColumn("quantity", F.raise_error(F.lit("boom")).cast("int"))
    with pytest.raises(PySparkException):
        table.upsert(broken)
    assert content(table.read()) == [("A", 2025, 1, 1)]


def test_a_taken_version_is_refused(spark, tmp_path):
    rows = orders(spark, ("A", "2025-01-01", 1))
    one, other = (MonthlyTable(spark, str(tmp_path), rows.schema) for _ in range(2))
    one.replace(rows)
    with pytest.raises(PublishError):
        other.published.publish(1, [])
    assert content(other.read()) == [("A", 2025, 1, 1)]


def test_old_lists_are_removed(spark, tmp_path):
    table = MonthlyTable(spark, str(tmp_path), orders(spark, ("A", "2025-01-01", 1)).schema)
    for version in range(1, LISTS_KEPT + 6):
        table.published.publish(version, [[2025, 1, f"b{version}"]])
    assert len(glob.glob(f"{tmp_path}/published/*.json")) == LISTS_KEPT
    assert table.live() == (LISTS_KEPT + 5, {(2025, 1): f"b{LISTS_KEPT + 5}"})


def test_whole_table_survives_a_failed_write(spark, tmp_path):
    rows = spark.range(5).selectExpr("cast(id as string) as k", "id as n")
    table = WholeTable(spark, str(tmp_path), rows.schema, "n")
    assert table.read().isEmpty()
    table.replace(rows)
    with pytest.raises(PySparkException):
        table.replace(rows.withColumn("n", F.raise_error(F.lit("boom")).cast("long")))
    assert [r["n"] for r in table.read().collect()] == [4, 3, 2, 1, 0]


# Layout and contracts


def test_directory_columns_come_back_in_contract_order(spark, fact, tmp_path):
    daily = kpis.daily_sales(fact)
    write_months(daily, str(tmp_path))
    loaded = load_contract(spark, str(tmp_path), contracts.DAILY_SALES)
    assert loaded.columns == contracts.DAILY_SALES.names
    assert [f.dataType for f in loaded.schema] == [f.dataType for f in contracts.DAILY_SALES]
    assert loaded.exceptAll(daily).isEmpty() and loaded.count() == daily.count()


@pytest.mark.parametrize("bad", [{"order_id": None}, {"order_id": "x" * 51}, {"category": "y" * 101}])
def test_contract_violation_fails_the_load(spark, tmp_path, bad):
    rows = orders(spark, ("A", "2025-01-01", 1)).withColumn("ingestion_ts", F.lit(None).cast("timestamp_ntz"))
    for name, value in bad.items():
        rows = rows.withColumn(name, F.lit(value).cast("string"))
    rows.write.parquet(f"{tmp_path}/t")
    with pytest.raises(PySparkException):
        load_contract(spark, f"{tmp_path}/t", contracts.FACT_ORDERS).collect()


def test_missing_column_fails_the_load(spark, tmp_path):
    orders(spark, ("A", "2025-01-01", 1)).drop("revenue").write.parquet(f"{tmp_path}/t")
    with pytest.raises(PySparkException):
        load_contract(spark, f"{tmp_path}/t", contracts.FACT_ORDERS)


def test_hot_month_is_split_over_tasks(spark, tmp_path):
    rows = spark.range(200_000).select(
        F.lit(2025).alias("order_year"),
        F.when(F.col("id") % 10 == 0, 2).otherwise(1).alias("order_month"),
        F.sha2(F.col("id").cast("string"), 256).alias("order_id"),
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "1m")
    try:
        write_months(rows, str(tmp_path))
    finally:
        spark.conf.unset(setting)
    hot = glob.glob(f"{tmp_path}/order_year=2025/order_month=1/*.parquet")
    cold = glob.glob(f"{tmp_path}/order_year=2025/order_month=2/*.parquet")
    assert len(hot) >= 4 > len(cold)
    assert spark.read.parquet(str(tmp_path)).count() == 200_000


def test_bucketed_table_groups_without_shuffle(spark, fact, tmp_path):
    write_bucketed_table(fact, "keyed_fact", f"{tmp_path}/t", "customer_id", 8, ("order_date",))
    table = spark.table("keyed_fact")
    totals = table.groupBy("customer_id").agg(F.sum("revenue").alias("r"))
    assert "Exchange" not in totals._jdf.queryExecution().executedPlan().toString()
    assert table.count() == fact.count()
    spark.sql("drop table keyed_fact")


def test_hot_key_is_not_bucketed(spark, tmp_path):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), "id"
    )
    assert bucket_share(rows, "k", 16) > 1 / 3
    with pytest.raises(ValueError):
        write_bucketed_table(rows, "hot_rows", f"{tmp_path}/t", "k", 16, ("id",))
    write_ranged(rows, f"{tmp_path}/r", "k", "id")
    assert spark.read.parquet(f"{tmp_path}/r").count() == 3000


def test_period_is_half_open_and_crosses_years(spark, fact):
    start, end = dt.date(1997, 11, 20), dt.date(1998, 2, 1)
    expected = fact.where((F.col("order_date") >= F.lit(start)) & (F.col("order_date") < F.lit(end)))
    found = scan_period(fact, start, end)
    assert found.count() == expected.count() > 0


# Lookups


def test_lookup_is_broadcast_only_within_bounds(spark, fact):
    lookup = fact.select("product_id", F.lit("n").alias("name")).distinct()
    assert fits_broadcast(lookup)
    assert not fits_broadcast(lookup, max_rows=10)
    assert not fits_broadcast(lookup, max_bytes=100)
    lines = fact.select("order_id", "product_id")
    small = enrich(lines, lookup, "product_id")
    large = enrich(lines, lookup, "product_id", max_rows=10)
    assert "ResolvedHint (strategy=broadcast)" in large_plan(small)
    assert "strategy=broadcast" not in large_plan(large)
    assert small.exceptAll(large).isEmpty() and small.count() == large.count() == fact.count()


def test_measuring_a_lookup_passes_on_one_row_per_task(spark):
    measured = spark.range(0, 1000, 1, 4).agg(F.count(F.lit(1)))
    assert "partial_count" in measured._jdf.queryExecution().executedPlan().toString()
    assert fits_broadcast(spark.range(1000), max_rows=1000) and not fits_broadcast(spark.range(1001), max_rows=1000)


def large_plan(df):
    return df._jdf.queryExecution().analyzed().toString()


def test_unmatched_line_keeps_nulls(spark):
    lines = spark.createDataFrame([("p1", 1), ("p9", 2)], "product_id string, n int")
    lookup = spark.createDataFrame([("p1", "ring")], "product_id string, name string")
    assert {(r["n"], r["name"]) for r in enrich(lines, lookup, "product_id").collect()} == {(1, "ring"), (2, None)}


# Quality


def test_report_and_gate(spark):
    fact = facts(
        spark,
        [
            ("A", "c", "p", "x", "2025-01-05", 1, "1.00", "0"),
            ("A", "c", "p", "x", "2025-01-04", 1, "1.00", "1.5"),
            (None, "c", "p", "x", "2025-01-04", 1, "1.00", "0"),
            (None, "c", "p", "x", "2025-01-04", 1, "1.00", "0"),
        ],
    )
    report = quality_report(fact, dt.date(2025, 1, 6))
    rows = {r["check"]: (r["observed"], r["passed"]) for r in report.collect()}
    assert rows == {
        "rows_yesterday": (1, True),
        "null_keys": (2, False),
        "negative_revenue": (1, False),
        "duplicate_keys": (2, False),
    }
    assert duplicate_keys(fact, "order_id").count() == 2
    with pytest.raises(QualityError) as error:
        enforce(report)
    assert all(name in str(error.value) for name in ["null_keys", "negative_revenue", "duplicate_keys"])
    assert "rows_yesterday" not in str(error.value)


def test_report_on_another_key_and_on_nothing(spark):
    fact = facts(spark, [("A", "c", p, "x", "2025-01-05", 1, "1.00", "0") for p in ("p1", "p2")])
    report = quality_report(fact, dt.date(2025, 1, 6), "order_id", "product_id")
    enforce(report)
    empty = {r["check"]: (r["observed"], r["passed"]) for r in quality_report(fact.limit(0), dt.date(2025, 1, 6)).collect()}
    assert empty["rows_yesterday"] == (0, False) and empty["duplicate_keys"] == (0, True)


# Jobs

AGGREGATES = {
    "agg_daily_sales": kpis.daily_sales,
    "agg_monthly_revenue": kpis.monthly_revenue,
    "agg_product_performance": kpis.product_performance,
    "agg_customer_rfm": kpis.customer_rfm,
}


def test_nightly_job(spark, tmp_path):
    files, lake = tmp_path / "files", str(tmp_path / "lake")
    for day, lines in DAYS.items():
        write_day(files, day, lines)
    loaded_at = dt.datetime(2025, 1, 6, 2)
    result = run_nightly(spark, str(files), lake, loaded_at, dt.date(2025, 1, 6), gate=False)
    assert (result.audit["input_rows"], result.audit["kept_rows"], result.audit["corrupt_rows"]) == (13, 7, 2)
    checks = {r["check"]: r["observed"] for r in result.report.collect()}
    assert checks == {"rows_yesterday": 4, "null_keys": 0, "negative_revenue": 1, "duplicate_keys": 1}
    fact = fact_table(spark, lake).read()
    assert fact.count() == 7
    assert load_rejects(spark, lake).count() == 6
    monthly = load_aggregate(spark, lake, "agg_monthly_revenue")
    assert monthly.agg(F.sum("monthly_revenue")).first()[0] == Decimal("66.47")
    for name in ["agg_daily_sales", "agg_product_performance", "agg_customer_rfm"]:
        assert not load_aggregate(spark, lake, name).isEmpty()

    # A later run with a correction of A2 only, upserted; the aggregates follow.
    later = tmp_path / "later"
    write_day(later, dt.date(2025, 1, 6), ["A2,c2,p1,2025-02-04,3,9.99,0.0,Toys"])
    run_nightly(spark, str(later), lake, loaded_at + dt.timedelta(days=1), dt.date(2025, 1, 7), gate=False)
    fact = fact_table(spark, lake).read()
    assert load_rejects(spark, lake).count() == 6  # a clean night leaves the rejects of the others
    assert content(fact.where("order_id = 'A2'")) == [("A2", 2025, 2, 3)] and fact.count() == 7
    for name, compute in AGGREGATES.items():
        stored, fresh = load_aggregate(spark, lake, name), compute(fact)
        assert stored.exceptAll(fresh).isEmpty() and stored.count() == fresh.count()
    with pytest.raises(QualityError):
        enforce(quality_report(fact, dt.date(2025, 1, 7)))


def test_incremental_ingest_takes_each_file_once(spark, tmp_path):
    files, lake, progress = tmp_path / "files", str(tmp_path / "lake"), str(tmp_path / "progress")
    table = fact_table(spark, lake)
    days = list(DAYS.items())
    write_day(files, *days[0])
    ingest_new_files(spark, str(files), lake, progress)
    assert table.read().count() == 2 and table.live()[0] == 1
    write_day(files, *days[1])
    ingest_new_files(spark, str(files), lake, progress)
    assert table.read().count() == 7 and table.live()[0] == 2
    ingest_new_files(spark, str(files), lake, progress)
    assert table.live()[0] == 2
    assert load_rejects(spark, lake).count() == 6
    # The same orders in a new file replace themselves.
    write_day(files, dt.date(2025, 1, 7), days[1][1])
    ingest_new_files(spark, str(files), lake, progress)
    assert table.read().count() == 7
    # The aggregates followed, and nothing staged is left.
    for name, compute in AGGREGATES.items():
        stored, fresh = load_aggregate(spark, lake, name), compute(table.read())
        assert stored.exceptAll(fresh).isEmpty() and stored.count() == fresh.count()


def test_jobs_leave_nothing_staged(spark, tmp_path):
    write_day(tmp_path / "files", *list(DAYS.items())[0])

    def staged_files():
        return set(glob.glob(f"{shared_folder(spark)}/**/*.parquet", recursive=True))

    before = staged_files()
    run_nightly(spark, str(tmp_path / "files"), str(tmp_path / "lake"), dt.datetime(2025, 1, 6), dt.date(2025, 1, 6), gate=False)
    ingest_new_files(spark, str(tmp_path / "files"), str(tmp_path / "lake"), str(tmp_path / "progress"))
    assert staged_files() <= before


def test_missed_nights_give_the_same_as_every_night(spark, tmp_path):
    """One order with a correction a day later: night by night, both at once, and rebuilt."""
    first, second = dt.date(2025, 1, 1), dt.date(2025, 1, 2)
    lines = {first: ["o1,c,p,2025-01-01,2,10.00,0,x", "o2,c,p,2025-01-01,1,10.00,0,x"], second: ["o1,c,p,2025-01-01,5,10.00,0,x"]}
    results = []
    for way in ["nightly", "at once", "rebuilt"]:
        files, lake, progress = (str(tmp_path / f"{way}-{x}") for x in ("files", "lake", "progress"))
        for day in (first, second):
            write_day(files, day, lines[day])
            if way == "nightly":
                ingest_new_files(spark, files, lake, progress)
        if way == "at once":
            ingest_new_files(spark, files, lake, progress)
        if way == "rebuilt":
            run_nightly(spark, files, lake, dt.datetime(2025, 1, 3), second, full_rebuild=True, gate=False)
        results.append(content(fact_table(spark, lake).read()))
        assert load_aggregate(spark, lake, "agg_monthly_revenue").first()["monthly_revenue"] == Decimal("60.00")
    assert results == [[("o1", 2025, 1, 5), ("o2", 2025, 1, 1)]] * 3


def test_rebuild_of_two_days_is_the_upsert(spark, tmp_path):
    files, lake = fresh_path(spark, "files"), str(tmp_path / "lake")
    lines = star.order_lines(spark, FOLDER)
    write_first_day(lines, files)
    write_second_day(lines, files)
    run_nightly(spark, files, lake, dt.datetime(2001, 8, 2), dt.date(2001, 8, 2), full_rebuild=True, gate=False)
    staging = star.as_fact(star.corrected(lines))
    expected = merged(star.as_fact(star.first_version(lines)), staging, staged_keys(staging))
    found = fact_table(spark, lake).read().drop("ingestion_ts")
    assert found.exceptAll(expected).isEmpty() and found.count() == expected.count()


def test_too_long_a_text_is_refused_in_both_ways(spark, tmp_path):
    files = tmp_path / "files"
    write_day(files, dt.date(2025, 1, 1), [f"o1,{'c' * 51},p,2025-01-01,2,10.00,0,x", "o2,c,p,2025-01-01,2,10.00,0,x"])
    run_nightly(spark, str(files), str(tmp_path / "a"), dt.datetime(2025, 1, 3), dt.date(2025, 1, 2), gate=False)
    ingest_new_files(spark, str(files), str(tmp_path / "b"), str(tmp_path / "progress"))
    for lake in ("a", "b"):
        assert [r["reason"] for r in load_rejects(spark, str(tmp_path / lake)).collect()] == ["long_customer_id"]
        assert fact_table(spark, str(tmp_path / lake)).read().count() == 1


def test_products_and_customers_are_stored_in_order(spark, tmp_path):
    fact = MonthlyTable(spark, f"{tmp_path}/fact_orders", star.fact(spark, FOLDER).schema)
    fact.replace(star.fact(spark, FOLDER))
    write_aggregates(fact, str(tmp_path))
    for name, column in [("agg_product_performance", "total_revenue"), ("agg_customer_rfm", "monetary")]:
        amounts = [r[column] for r in aggregate_table(spark, str(tmp_path), name).read().collect()]
        assert amounts == sorted(amounts, reverse=True) and len(amounts) > 50


def test_labels_tell_streams_apart():
    labels = [batch_label(path, 0) for path in ("/a/progress", "/b/progress", "/a/progress/")]
    assert labels[0] == labels[2] != labels[1]


@pytest.mark.parametrize("fails", ["before publishing", "after publishing"])
def test_failed_batch_is_taken_again(spark, tmp_path, monkeypatch, fails):
    files, lake, progress = tmp_path / "files", str(tmp_path / "lake"), str(tmp_path / "progress")
    for day, lines in DAYS.items():
        write_day(files, day, lines)
    publish = MonthlyTable._publish

    def broken(self, version, live):
        if fails == "after publishing":
            publish(self, version, live)
        raise RuntimeError("lost")

    table = fact_table(spark, lake)
    with monkeypatch.context() as patch:
        patch.setattr(MonthlyTable, "_publish", broken)
        with pytest.raises(Exception, match="lost"):
            ingest_new_files(spark, str(files), lake, progress)
    assert table.read().count() == (7 if fails == "after publishing" else 0)
    ingest_new_files(spark, str(files), lake, progress)
    assert table.read().count() == 7
    assert load_rejects(spark, lake).count() == 6
