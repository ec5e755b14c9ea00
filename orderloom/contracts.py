"""Table contracts: column names, types, NOT NULL and length rules.

Money is decimal throughout. Timestamps carry no zone, as in the warehouse tables they
describe, so no result depends on the session time zone. Totals are wider than a warehouse
would declare them (18 digits, still a single long in Spark): a month of one category can
pass 10^12 at the volumes this package is meant for, and a cast that overflows stops a job.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(10, 2)
DISCOUNT = T.DecimalType(5, 2)
LINE_MONEY = T.DecimalType(12, 2)
TOTAL_MONEY = T.DecimalType(18, 2)
MOMENT = T.TimestampNTZType()

CORRUPT = "_corrupt_record"
# The day a line's file is of, and the file.
RUN_DATE = "run_date"
FILE = "file"
# Whether a line is of the newest version of its order.
CURRENT = "current"
# Whether an order has current lines in more than one month.
SPANS = "spans"

# The fields a line cannot do without.
CRITICAL = ["order_id", "customer_id", "product_id", "order_date", "quantity", "unit_price"]
# Fixed value: the category of a line that names none.
NO_CATEGORY = "UNKNOWN"


def _column(name, dtype, required=False, max_length=None):
    metadata = {"required": required}
    if max_length:
        metadata["max_length"] = max_length
    # Spark reads files as nullable whatever the schema says; `required` is enforced on load.
    return T.StructField(name, dtype, True, metadata)


def _id(name, required=False):
    return _column(name, T.StringType(), required, 50)


def _category():
    return _column("category", T.StringType(), max_length=100)


def _int(name):
    return _column(name, T.IntegerType())


def _count(name):
    return _column(name, T.LongType())


def _total(name):
    return _column(name, TOTAL_MONEY)


RAW_ORDERS = T.StructType(
    [T.StructField(name, T.StringType()) for name in CRITICAL + ["discount", "category"]]
)

FACT_ORDERS = T.StructType(
    [
        _id("order_id", required=True),
        _id("customer_id", required=True),
        _id("product_id", required=True),
        _category(),
        _column("order_date", MOMENT, required=True),
        _int("order_year"),
        _int("order_month"),
        _int("order_day"),
        _int("order_quarter"),
        _column("is_weekend", T.BooleanType()),
        _int("quantity"),
        _column("unit_price", PRICE),
        _column("discount", DISCOUNT),
        _column("revenue", LINE_MONEY),
        _column("ingestion_ts", MOMENT),
    ]
)

# What the fact table holds besides: where a line is from, and the older versions of orders.
STORED_ORDERS = T.StructType(
    [
        *FACT_ORDERS.fields,
        _column(RUN_DATE, T.DateType()),
        _column(FILE, T.StringType()),
        _column(CURRENT, T.BooleanType()),
        _column(SPANS, T.BooleanType()),
    ]
)

DAILY_SALES = T.StructType(
    [
        _int("order_year"),
        _int("order_month"),
        _int("order_day"),
        _category(),
        _count("total_orders"),
        _count("unique_customers"),
        _count("total_units_sold"),
        _total("total_revenue"),
        _column("avg_order_value", LINE_MONEY),
        _column("max_order_value", LINE_MONEY),
        _column("min_order_value", LINE_MONEY),
    ]
)

PRODUCT_PERFORMANCE = T.StructType(
    [
        _id("product_id"),
        _category(),
        _count("total_units_sold"),
        _total("total_revenue"),
        _count("order_count"),
        _column("avg_unit_price", PRICE),
    ]
)

CUSTOMER_RFM = T.StructType(
    [
        _id("customer_id"),
        _column("last_order_date", MOMENT),
        _count("frequency"),
        _total("monetary"),
        _int("recency_days"),
    ]
)

MONTHLY_REVENUE = T.StructType(
    [
        _int("order_year"),
        _int("order_month"),
        _category(),
        _total("monthly_revenue"),
        _count("total_orders"),
        _count("unique_customers"),
        _int("revenue_rank"),
    ]
)

# What is kept per month so that months can be added up. Of orders inside a month there are
# counts; an order that spans months has a row of its own in each, with nothing but its id.
PRODUCT_STATES = T.StructType(
    [
        _int("order_year"),
        _int("order_month"),
        _id("product_id"),
        _category(),
        _count("total_units_sold"),
        _count("lines"),
        _total("total_revenue"),
        _total("price_sum"),
        _count("orders"),
        _id("order_id"),
    ]
)

CUSTOMER_STATES = T.StructType(
    [
        _int("order_year"),
        _int("order_month"),
        _id("customer_id"),
        _column("last_order_date", MOMENT),
        _total("monetary"),
        _count("orders"),
        _id("order_id"),
    ]
)

CHECK_STATES = T.StructType(
    [
        _int("order_year"),
        _int("order_month"),
        _column("day", T.DateType()),
        _column("spanning_key", T.ArrayType(T.StringType())),
        _count("lines"),
        _count("null_keys"),
        _count("negative_revenue"),
        _count("duplicate_keys"),
    ]
)

REJECTS = T.StructType(
    list(RAW_ORDERS.fields)
    + [T.StructField(CORRUPT, T.StringType()), T.StructField("reason", T.StringType())]
)

MONTH = ["order_year", "order_month"]
