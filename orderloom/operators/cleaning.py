"""From text lines to typed order lines, with every line that fails kept and explained."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.contracts import (
    CORRUPT,
    CRITICAL,
    DISCOUNT,
    FACT_ORDERS,
    FILE,
    MOMENT,
    NO_CATEGORY,
    PRICE,
    RAW_ORDERS,
    REJECTS,
    RUN_DATE,
)
from orderloom.functions import (
    WIDE,
    blank,
    calendar_fields,
    is_number,
    net_revenue,
    normalized_id,
    or_zero,
    parsed_date,
    parsed_quantity,
)

# Revenue is computed on these before price and discount are rounded to the contract, so a
# discount of 0.125 takes off an eighth and not thirteen hundredths.
FINE_PRICE = T.DecimalType(13, 4)
FINE_DISCOUNT = T.DecimalType(12, 6)


def drop_incomplete(raw: DataFrame) -> DataFrame:
    """Leave out lines with a null in any critical field."""
    return raw.na.drop(subset=CRITICAL)


def incomplete() -> Column:
    missing = [F.col(name).isNull() for name in CRITICAL]
    condition = missing[0]
    for each in missing[1:]:
        condition = condition | each
    return condition


def positive_lines(typed: DataFrame) -> DataFrame:
    """Lines with quantity and price above zero; null is not above zero."""
    return typed.where((F.col("quantity") > 0) & (F.col("unit_price") > 0))


def with_defaults(typed: DataFrame) -> DataFrame:
    """No discount means zero, no category means UNKNOWN."""
    return typed.withColumns(
        {
            "discount": or_zero(F.col("discount"), typed.schema["discount"].dataType),
            "category": F.coalesce("category", F.lit(NO_CATEGORY)),
        }
    )


def assess(raw: DataFrame, ingestion_ts: Column | None = None) -> DataFrame:
    """Type every line, derive the fact columns and name the reason when it must be refused.

    One row out per row in. `reason` is null for a good line; `raw` holds the original text
    of a refused one and is null otherwise, so it costs nothing to store for the others.
    Text that does not parse gives null and a reason, never a failed job. A discount that is
    no number counts as none given; a number too large for the contract is refused, and so is
    a price that the contract would store as zero, or a text longer than its column.
    """
    source = {name: F.col(name) for name in RAW_ORDERS.names}
    source[CORRUPT] = F.col(CORRUPT) if CORRUPT in raw.columns else F.lit(None).cast("string")

    origin = {RUN_DATE: "date", FILE: "string"}
    parsed = raw.select(
        *[(F.col(name) if name in raw.columns else F.lit(None)).cast(kind).alias(name) for name, kind in origin.items()],
        F.struct(*[value.alias(name) for name, value in source.items()]).alias("raw"),
        F.col("order_id"),
        normalized_id(F.col("customer_id")).alias("customer_id"),
        normalized_id(F.col("product_id")).alias("product_id"),
        F.coalesce("category", F.lit(NO_CATEGORY)).alias("category"),
        parsed_date(F.col("order_date")).alias("order_date"),
        parsed_quantity(F.col("quantity")).alias("quantity"),
        F.col("unit_price").try_cast(WIDE).try_cast(FINE_PRICE).alias("fine_price"),
        F.when(is_number(F.col("discount")), F.col("discount").try_cast(WIDE).try_cast(FINE_DISCOUNT))
        .otherwise(F.lit(0).cast(FINE_DISCOUNT))
        .alias("fine_discount"),
        (~is_number(F.col("discount"))).alias("discount_defaulted"),
        F.col("category").isNull().alias("category_defaulted"),
    )
    fact = {
        **{name: F.col(name) for name in ["order_id", "customer_id", "product_id", "category"]},
        "order_date": F.col("order_date"),
        **calendar_fields(F.col("order_date")),
        "quantity": F.col("quantity"),
        "unit_price": F.col("fine_price").try_cast(PRICE),
        "discount": F.col("fine_discount").try_cast(DISCOUNT),
        "revenue": net_revenue(F.col("quantity"), F.col("fine_price"), F.col("fine_discount")),
        "ingestion_ts": (F.lit(None) if ingestion_ts is None else ingestion_ts).cast(MOMENT),
    }
    typed = parsed.select(
        *[fact[name].alias(name) for name in FACT_ORDERS.names],
        "raw",
        *origin,
        "discount_defaulted",
        "category_defaulted",
    )
    return typed.withColumn("reason", _reason()).withColumns(
        {
            "is_corrupt": F.col(f"raw.{CORRUPT}").isNotNull(),
            "is_incomplete": F.col("reason").startswith("missing_"),
            "raw": F.when(F.col("reason").isNotNull(), F.col("raw")),
        }
    )


def _reason() -> Column:
    """The first rule a line breaks, as text; null when it breaks none."""
    rules = {f"missing_{name}": F.col(f"raw.{name}").isNull() for name in CRITICAL}
    rules |= {f"blank_{name}": blank(F.col(name)) for name in ["order_id", "customer_id", "product_id"]}
    rules |= {
        f"long_{field.name}": F.length(field.name) > field.metadata["max_length"]
        for field in FACT_ORDERS
        if "max_length" in field.metadata
    }
    price = F.col("raw.unit_price")
    rules |= {f"bad_{name}": F.col(name).isNull() for name in ["order_date", "quantity"]}
    rules |= {
        "bad_unit_price": ~is_number(price),
        "quantity_not_positive": F.col("quantity") <= 0,
        "unit_price_not_positive": price.try_cast("double") <= 0,
        "unit_price_out_of_range": F.col("unit_price").isNull() | (F.col("unit_price") <= 0),
        "discount_out_of_range": F.col("discount").isNull(),
        "revenue_out_of_range": F.col("revenue").isNull(),
    }
    return F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in rules.items()])


def accepted(assessed: DataFrame) -> DataFrame:
    return assessed.where(F.col("reason").isNull()).select(FACT_ORDERS.names)


def accepted_with_origin(assessed: DataFrame) -> DataFrame:
    """Good lines with the day and the file they are from."""
    return assessed.where(F.col("reason").isNull()).select(*FACT_ORDERS.names, RUN_DATE, FILE)


def rejected(assessed: DataFrame) -> DataFrame:
    refused = assessed.where(F.col("reason").isNotNull())
    return refused.select("raw.*", "reason").select(REJECTS.names)


def audit_measures() -> dict[str, Column]:
    """Counts over assessed lines; plain sums, so they can also ride along on a write."""
    flags = {
        "kept_rows": F.col("reason").isNull(),
        "rejected_rows": F.col("reason").isNotNull(),
        "incomplete_rows": F.col("is_incomplete"),
        "corrupt_rows": F.col("is_corrupt"),
        "discount_defaulted_rows": F.col("discount_defaulted"),
        "category_defaulted_rows": F.col("category_defaulted"),
    }
    counts = {"input_rows": F.count(F.lit(1))}
    counts |= {
        name: F.coalesce(F.sum(F.coalesce(flag, F.lit(False)).cast("long")), F.lit(0))
        for name, flag in flags.items()
    }
    return counts


def ingest_audit(assessed: DataFrame) -> DataFrame:
    """One row per audit count, all from one pass."""
    measures = audit_measures()
    counts = assessed.agg(*[value.alias(name) for name, value in measures.items()])
    return counts.unpivot([], list(measures), "metric", "row_count")
