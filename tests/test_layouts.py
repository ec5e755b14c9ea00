"""Tables that lie by key, counts that roll up, ranks over many tasks, and what text fields hold."""

from __future__ import annotations

import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from orderloom.operators import rollup
from orderloom.operators.profile import HOLDS, type_audit
from orderloom.operators.ranking import rank_within
from orderloom.plans.catalog import copartitioned_by_customer
from orderloom.sources.headers import first_lines
from orderloom.sources.lake import SLOT, write_copartitioned
from orderloom.sources.order_files import listed_files, paths_of, read_orders, schema_audit
from tests.test_kpis import facts

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    setting = "spark.sql.autoBroadcastJoinThreshold"
    spark.conf.set(setting, "-1")
    yield
    spark.conf.unset(setting)


# Shared layout


def test_join_and_group_by_customer_without_an_exchange(spark, no_auto_broadcast):
    laid_out = copartitioned_by_customer(spark, FOLDER)
    joined = laid_out.joined("lines", "customers")
    per_slot = joined.groupBy("customer_id", SLOT, "c_mktsegment").agg(F.sum("revenue").alias("revenue"))
    assert "SortMergeJoin" in plan(per_slot) and "Exchange" not in plan(per_slot)
    totals = laid_out.totals(joined, ["c_mktsegment"], [F.count(F.lit(1)).alias("n")], [F.sum("n").alias("n")])
    shuffles = [line for line in plan(totals).splitlines() if "Exchange hashpartitioning" in line]
    # Only of the few rows that keys with several slots have left.
    assert len(shuffles) == 1


@pytest.mark.parametrize("buckets", [4, 16])
def test_hot_and_missing_keys_are_dealt_over_buckets(spark, tmp_path, no_auto_broadcast, buckets):
    lines = spark.range(9000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 3 = 1 THEN cast(id % 500 AS string) END AS k", "id AS line", "1L AS amount"
    )
    lookup = spark.createDataFrame([("hot", "h"), (None, "n"), *[(str(k), str(k % 7)) for k in range(600)]], "k string, label string")
    laid_out = write_copartitioned(lines, {"names": lookup}, str(tmp_path), "k", buckets, f"dealt_{buckets}")
    sizes = laid_out.tables["lines"].groupBy(F.pmod(F.hash("k", SLOT), F.lit(buckets)).alias("b")).count().collect()
    assert max(row["count"] for row in sizes) < 2 * 9000 / buckets
    assert laid_out.tables["lines"].count() == 9000
    totals = laid_out.totals(
        laid_out.joined("lines", "names"), ["label"], [F.sum("amount").alias("n")], [F.sum("n").cast("long").alias("n")]
    )
    expected = lines.join(lookup, "k").groupBy("k", "label").agg(F.sum("amount").alias("n"))
    assert sorted(map(tuple, totals.collect())) == sorted(map(tuple, expected.collect()))
    alone = laid_out.totals(laid_out.tables["lines"], [], [F.sum("amount").alias("n")], [F.sum("n").cast("long").alias("n")])
    assert {row["k"]: row["n"] for row in alone.where("k IS NULL OR k = 'hot'").collect()} == {None: 3000, "hot": 3000}


def test_shared_layout_of_nothing(spark, tmp_path):
    lines = spark.createDataFrame([], "k string, amount long")
    laid_out = write_copartitioned(lines, {"names": spark.createDataFrame([("a", "b")], "k string, label string")}, str(tmp_path), "k", 2, "dealt_none")
    assert laid_out.joined("lines", "names").collect() == []


# Counts that roll up


def test_counts_of_days_roll_up(spark):
    pick = random.Random(3)
    rows = [
        (f"o{pick.randrange(300)}", f"c{pick.randrange(20)}", "p", "x", str(dt.date(2024, 11, 1) + dt.timedelta(pick.randrange(120))), 1, "1.00", "0")
        for _ in range(2000)
    ]
    fact = facts(spark, rows)
    numbers = rollup.numbered(rollup.first_days(fact, "order_id"), "order_id")
    assert sorted(row["number"] for row in numbers.collect()) == list(range(1, numbers.count() + 1))
    days = rollup.id_bitmaps(fact, numbers, "order_id", "order_year", "order_month", "order_day")
    for key in (["order_year", "order_month"], ["order_year"], []):
        found = rollup.counted(rollup.rolled_up(days, *key), "n", *key)
        expected = fact.groupBy(*key).agg(F.count_distinct("order_id").alias("n"))
        assert sorted(map(tuple, found.collect())) == sorted(map(tuple, expected.collect()))


def test_numbers_stay_when_ids_are_added(spark):
    before = facts(spark, [(f"o{k}", "c", "p", "x", "2025-01-05", 1, "1.00", "0") for k in range(5)])
    after = before.unionByName(facts(spark, [(o, "c", "p", "x", "2025-01-01", 1, "1.00", "0") for o in ("n1", "n2", "o1")]))
    first = rollup.numbered(rollup.first_days(before, "order_id"), "order_id")
    second = rollup.numbered(rollup.first_days(after, "order_id"), "order_id", first)
    one, other = ({row["order_id"]: row["number"] for row in df.collect()} for df in (first, second))
    assert other.items() >= one.items() and {other["n1"], other["n2"]} == {6, 7}


def test_ids_beyond_a_bucket(spark):
    firsts = spark.range(70_000).selectExpr("cast(id AS string) AS order_id", "date'2025-01-01' AS first")
    numbers = rollup.numbered(firsts, "order_id")
    rows = firsts.select("order_id", F.lit(1).alias("day"))
    bitmaps = rollup.id_bitmaps(rows.unionByName(rows), numbers, "order_id", "day")
    assert bitmaps.count() == 3 and rollup.counted(bitmaps, "n", "day").first()["n"] == 70_000


# Ranks


@pytest.mark.parametrize("partitions", ["8", "3"])
def test_ranks_over_many_tasks(spark, partitions):
    """A group of most rows, a value that a third of them share, nulls in group and value."""
    pick = random.Random(5)
    rows = [(pick.choice(["big", "big", "big", "small", None]), pick.choice([7, 7, None, *range(50)]), k) for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, k int")
    was = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = rank_within(df, ["g"], "v", "k", name="r").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", was)
    order = lambda v: (v is not None, v or 0)
    counts = Counter((g, order(v)) for g, v, _ in rows)
    expected = [(g, v, k, 1 + sum(n for (h, w), n in counts.items() if h == g and w > order(v))) for g, v, k in rows]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, expected))


def test_no_window_over_a_group(spark):
    df = spark.createDataFrame([("g", 1, 1)], "g string, v int, k int")
    text = plan(rank_within(df, ["g"], "v", "k", name="r"))
    assert "windowspecdefinition(g" not in text


# Fields


def test_types_of_texts(spark):
    cells = {
        "all_null": [None, None], "ids": ["007", " 12 "], "price": ["1", "2.50"], "power": ["1e300", "-.5"],
        "day": ["2025-01-05", None], "moment": ["2025-01-05", "2025-01-05 10:00:00"], "mixed": ["1", "2025-01-05"],
        "words": ["x", "2"], "blank": ["", "1"], "long": ["1234567890123456789", "1"], "no_day": ["2025-02-30", None],
    }
    lines = spark.createDataFrame(list(zip(*cells.values())), ", ".join(f"{name} string" for name in cells))
    found = type_audit(lines).collect()
    types = {row["column"]: row["column_type"] for row in found}
    assert types == {
        "all_null": "null", "ids": "integer", "price": "decimal", "power": "decimal", "day": "date", "moment": "timestamp",
        "mixed": "text", "words": "text", "blank": "text", "long": "decimal", "no_day": "text",
    }
    assert {(row["kind"], row["line_count"]) for row in found if row["column"] == "day"} == {("date", 1), ("null", 1)}
    assert all(sum(row["line_count"] for row in found if row["column"] == name) == 2 for name in cells)
    assert type_audit(lines.limit(0)).collect() == [] and set(HOLDS["text"]) | {"text"} == set(HOLDS)


def test_types_come_in_one_pass(spark):
    text = plan(type_audit(spark.createDataFrame([("1", "x")], "a string, b string")))
    assert "partial_count(1)" in text and "Expand" not in text and text.count("Scan") == 1


def test_first_lines_of_many_files(spark, tmp_path):
    """Tasks stop after the first line, whatever follows; blank lines before it do not count."""
    body = "\n".join(["1,2,3"] * 200_000)
    for k in range(12):
        (tmp_path / f"{k}.csv").write_text(f"{chr(10) * (k % 3)}a,b{k % 2}, c \n{body}\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "blank.csv").write_text("\n \n")
    paths = paths_of(listed_files(spark, str(tmp_path)))
    assert len(paths) == 13  # a file without bytes is not listed
    found = {file.rsplit("/", 1)[1]: header for file, header in first_lines(spark, paths).items()}
    assert found == {f"{k}.csv": ("a", f"b{k % 2}", "c") for k in range(12)}


def test_schema_audit_counts_lines_and_folders(spark, tmp_path):
    header = "order_id,customer_id,product_id,order_date,quantity,unit_price,discount,category"
    for folder, name, first, lines in [("a", "1", header, 3), ("a", "2", header + ",extra", 2), ("b", "3", header + ",extra", 4)]:
        (tmp_path / folder).mkdir(exist_ok=True)
        (tmp_path / folder / f"{name}.csv").write_text("\n".join([first, *["x"] * lines, "", ""]))
    found = schema_audit(spark, str(tmp_path)).collect()
    assert [tuple(row) for row in found] == [(header + ",extra", 2, 2, 6, "extra", "extra")]
    assert read_orders(spark, str(tmp_path)).count() == 9


def test_paths_with_blanks(spark, tmp_path):
    (tmp_path / "a b").mkdir()
    header = "order_id,customer_id,product_id,order_date,quantity,unit_price,discount,category"
    (tmp_path / "a b" / "c d.csv").write_text(f"{header}\no,c,p,2025-01-01,1,1.00,,\n")
    rows = read_orders(spark, str(tmp_path)).collect()
    assert [row["order_id"] for row in rows] == ["o"]
    assert listed_files(spark, str(tmp_path)).first()["file"] == rows[0]["file"]
