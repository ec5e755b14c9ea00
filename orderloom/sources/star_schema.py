"""Order lines from a star schema of orders, lineitem, part and customer tables.

One join gives typed lines for the fact table; `text_lines` gives the same lines as the
text an order file would hold, with faults in known places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.contracts import DISCOUNT, FACT_ORDERS, MOMENT, PRICE, RAW_ORDERS
from orderloom.functions import calendar_fields, net_revenue
from orderloom.operators.cleaning import positive_lines, with_defaults
from orderloom.session import fresh_path, hadoop_path, shuffles_removed, staged


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def joined_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Every line with its order and product.

    No side is hinted: Spark broadcasts a table it measures as small and shuffles the
    others, splitting a hot order or product where one part of the join outgrows the rest.
    """
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    parts = table(spark, folder, "part")
    # Cast where there is one row per product, not one per line.
    parts = parts.withColumn("p_retailprice", F.col("p_retailprice").cast(PRICE))
    return lines.join(parts, lines["l_partkey"] == parts["p_partkey"]).join(
        orders, lines["l_orderkey"] == orders["o_orderkey"]
    )


def order_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Typed lines under the names of the order model, plus the order's status."""
    return joined_lines(spark, folder).select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("o_orderdate").cast(MOMENT).alias("order_date"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("p_retailprice").alias("unit_price"),
        F.col("l_discount").cast(DISCOUNT).alias("discount"),
        F.col("o_orderstatus").alias("status"),
    )


def as_fact(lines: DataFrame) -> DataFrame:
    """Typed lines to fact columns, all but the load time. Ids made of digits need no trimming."""
    clean = with_defaults(positive_lines(lines))
    derived = {
        **calendar_fields(F.col("order_date")),
        "revenue": net_revenue(F.col("quantity"), F.col("unit_price"), F.col("discount")),
    }
    names = [name for name in FACT_ORDERS.names if name != "ingestion_ts"]
    return clean.select(*[derived.get(name, F.col(name)).alias(name) for name in names])


def fact(spark: SparkSession, folder: str) -> DataFrame:
    return as_fact(order_lines(spark, folder))


def corrected(lines: DataFrame) -> DataFrame:
    """A later version of the open and pending orders among `lines`.

    Pending orders (P) come back one month later with one more unit per line; open ones (O)
    are as they were. To a table of pending and filled orders the first are replacements
    that change month, the second are new.
    """
    pending = F.col("status") == "P"
    moved = F.add_months(F.to_date("order_date"), 1).cast(MOMENT)
    return lines.where(F.col("status").isin("O", "P")).withColumns(
        {
            "order_date": F.when(pending, moved).otherwise(F.col("order_date")),
            "quantity": F.when(pending, F.col("quantity") + 1).otherwise(F.col("quantity")),
        }
    )


def first_version(lines: DataFrame) -> DataFrame:
    """The pending and filled orders: what is there before `corrected` arrives."""
    return lines.where(F.col("status").isin("F", "P"))


def as_text(lines: DataFrame) -> DataFrame:
    """Typed lines as the text of an order file."""
    text = {
        "order_date": F.date_format("order_date", "yyyy-MM-dd"),
        **{name: F.col(name).cast("string") for name in ["quantity", "unit_price", "discount"]},
    }
    return lines.select(*[text.get(name, F.col(name)).alias(name) for name in RAW_ORDERS.names])


def text_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All lines as order-file text, with one kind of fault per rule, placed by the keys."""
    lines = joined_lines(spark, folder)
    order, product, supplier = F.col("l_orderkey"), F.col("l_partkey"), F.col("l_suppkey")
    number = F.col("l_linenumber")
    quantity = F.col("l_quantity").cast("int").cast("string")
    price = F.col("p_retailprice").cast("string")
    discount = F.col("l_discount").cast(DISCOUNT).cast("string")
    customer = F.concat(F.lit(" c"), F.col("o_custkey").cast("string"), F.lit("  "))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")

    def every(key: Column, step: int) -> Column:
        return key % step == 0

    text = {
        "order_id": F.when(~every(order, 53), F.concat(F.lit("o"), order.cast("string"))),
        "customer_id": F.when(every(order, 19), F.lit("   ")).when(~every(order, 11), customer),
        "product_id": F.concat(F.lit(" p"), product.cast("string"), F.when(every(product, 89), F.repeat(F.lit("0"), 51)).otherwise("")),
        "order_date": F.when(every(order, 13), F.lit("bad-date"))
        .when(every(order, 47), F.concat(day, F.lit(" 13:45:00")))
        .otherwise(day),
        "quantity": F.when(every(product, 17), F.lit("x"))
        .when(every(product, 23), F.concat(F.lit("-"), quantity))
        .when(every(product, 29), F.concat(quantity, F.lit(".7")))
        .otherwise(quantity),
        "unit_price": F.when(every(supplier, 31), F.lit("0.00"))
        .when(every(supplier, 37), F.lit("n/a"))
        .when(every(supplier, 47), F.lit("0.001"))
        .when(every(supplier, 59), F.lit("0.00001"))
        .when(every(supplier, 61), F.lit("123456789012"))
        .otherwise(price),
        "discount": F.when(number == 2, F.lit("abc"))
        .when(number == 4, F.lit("0.125"))
        .when(number == 7, F.lit("1.50"))
        .when((number == 5) & every(order, 7), F.lit("1000"))
        .when((number == 6) & every(order, 7), F.lit("1000000"))
        .when((number == 6) & every(order, 5), F.lit("1e300"))
        .when(number != 1, discount),
        "category": F.when(number != 3, F.when(every(product, 97), F.repeat(F.lit("x"), 101)).otherwise(F.col("p_type"))),
    }
    return lines.select(
        *[text[name].alias(name) for name in RAW_ORDERS.names],
        # Trailing fields the line ends without; it lacks its price when two fields short.
        F.when(~every(order, 2), 0).when(every(supplier, 43), 3).when(every(supplier, 41), 2).otherwise(0).alias("fields_cut"),
        # Orders of odd numbers come in files of the other layout.
        (order % 2).cast("int").alias("layout"),
    )


# Column orders of order files; the second has a column that the order model does not know.
LAYOUTS = [
    RAW_ORDERS.names,
    ["country", "order_date", "category", "discount", "unit_price", "quantity", "product_id", "customer_id", "order_id"],
]


def write_order_files(lines: DataFrame, path: str, layout: int = 0) -> None:
    """Write text lines as CSV files with a header, one directory per month.

    With a column `layout`, each line goes to files of that layout, else all to those of the
    given one. With a column `fields_cut`, that many trailing fields are left off a line. The
    lines are joined by hand for this, and written as a single column under the header's text.
    """
    if "layout" in lines.columns:
        lines = staged(lines, "text-lines")
        for k in range(len(LAYOUTS)):
            write_order_files(lines.where(F.col("layout") == k).drop("layout"), f"{path}/layout-{k}", k)
        return
    arrival = F.coalesce(F.regexp_replace(F.substring("order_date", 1, 7), "-", ""), F.lit("none"))
    out = lines.select(_joined(lines, layout), arrival.alias("arrival"))
    with shuffles_removed(lines.sparkSession):
        out.hint("rebalance", "arrival").write.partitionBy("arrival").options(**_PLAIN).csv(path)


# A separator that occurs nowhere, so that the commas of a line stay as they are.
_PLAIN = {"header": "true", "sep": "\u0001", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _joined(lines: DataFrame, layout: int) -> Column:
    """The text of each line in a layout, under the name of that layout's header."""
    names = LAYOUTS[layout]
    cut = F.col("fields_cut") if "fields_cut" in lines.columns else F.lit(0)
    text = {name: F.coalesce(F.col(name), F.lit("")) for name in RAW_ORDERS.names}
    fields = F.array(*[text.get(name, F.lit("Elsewhere")) for name in names])
    whole = F.slice(fields, F.lit(1), F.lit(len(names)) - cut)
    return F.array_join(whole, ",").alias(",".join(names))


ORDERS_A_FILE = 250_000


def delivered_files(spark: SparkSession, folder: str) -> int:
    """In how many files to deliver the orders of a folder: four at least, more for many orders, as
    a file is written by one task."""
    return max(4, -(-table(spark, folder, "orders").count() // ORDERS_A_FILE))


def deliver(lines: DataFrame, folder: str, files: int = 4, layout: int = 0) -> None:
    """Put text lines into `folder` as files of fixed names, over those of an earlier delivery.
    The lines of an order are in one file."""
    spark = lines.sparkSession
    written = fresh_path(spark, "delivery")
    with shuffles_removed(spark):
        lines.repartition(files, "order_id").select(_joined(lines, layout)).write.options(**_PLAIN).csv(written)
    system, source = hadoop_path(spark, written)
    _, target = hadoop_path(spark, folder)
    system.mkdirs(target)
    for status in system.listStatus(source):
        name = status.getPath().getName()
        if name.startswith("part-"):
            _, place = hadoop_path(spark, f"{folder}/orders-{int(name[5:10])}.csv")
            system.delete(place, False)
            system.rename(status.getPath(), place)
