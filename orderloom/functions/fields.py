"""Column expressions for order lines. All are built-in, so they stay in generated code."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderloom.contracts import LINE_MONEY, MOMENT, TOTAL_MONEY

# The text form of a date, and the weekend in Spark's numbering (Sunday is 1).
DATE_TEXT = "yyyy-MM-dd"
WEEKEND = [1, 7]

# Digits enough that a number which does not fit is no price, discount or quantity of any contract.
WIDE = T.DecimalType(38, 18)
_DATE_TIME = r"^\d{4}-\d{2}-\d{2}[ T]\d{2}:\d{2}:\d{2}$"


def parsed_date(text: Column) -> Column:
    """Text to timestamp; null when it is neither a date nor a date with a time of day.

    Neither goes through a type that has a zone, so the session zone cannot shift a day.
    """
    with_time = F.when(text.rlike(_DATE_TIME), text).try_cast(MOMENT)
    return F.coalesce(F.try_to_date(text, DATE_TEXT).cast(MOMENT), with_time)


def is_date(text: Column) -> Column:
    return F.coalesce(F.try_to_date(text, DATE_TEXT).isNotNull(), F.lit(False))


def is_date_time(text: Column) -> Column:
    return F.when(text.rlike(_DATE_TIME), text).try_cast(MOMENT).isNotNull()


def is_number(text: Column) -> Column:
    """Whether the text is a number, of whatever size; false for null."""
    return text.try_cast("double").isNotNull()


def parsed_quantity(text: Column) -> Column:
    """Text to whole number, cutting a fraction off; null when it is no number.

    A direct cast of '2.7' to int gives null, hence the step through decimal.
    """
    return text.try_cast(WIDE).try_cast("int")


def normalized_id(text: Column) -> Column:
    return F.upper(F.trim(text))


def blank(text: Column) -> Column:
    return F.trim(text) == ""


def or_zero(number: Column, dtype: T.DecimalType) -> Column:
    return F.coalesce(number, F.lit(0).cast(dtype))


def net_revenue(quantity: Column, unit_price: Column, discount: Column) -> Column:
    """Line revenue after discount, to the cent; null when it does not fit the contract.

    Exact: with price (13,4) and discount (12,6) the product needs just the 38 digits there are.
    """
    gross = quantity.cast(T.DecimalType(10, 0)) * unit_price
    return F.round(gross * (F.lit(1) - discount), 2).try_cast(LINE_MONEY)


def money(amount: Column, dtype: T.DecimalType) -> Column:
    return F.round(amount, 2).cast(dtype)


def exact_total(name: str) -> Column:
    """Sum of an amount with two decimals, as an aggregate.

    Added up as whole cents: a long is updated in place, where a decimal of more than 18
    digits is made anew for every row.
    """
    cents = (F.col(name) * 100).cast("bigint")
    return (F.sum(cents).cast(T.DecimalType(20, 0)) * F.lit(Decimal("0.01"))).cast(TOTAL_MONEY)


def calendar_fields(moment: Column) -> dict[str, Column]:
    return {
        "order_year": F.year(moment),
        "order_month": F.month(moment),
        "order_day": F.dayofmonth(moment),
        "order_quarter": F.quarter(moment),
        "is_weekend": F.dayofweek(moment).isin(WEEKEND),
    }


def in_period(start: dt.date, end: dt.date) -> Column:
    """order_date in [start, end), with the year/month conditions that prune directories.

    A condition on order_date alone reaches the file statistics but not the directory
    names, so the same period is stated on the partition columns as well.
    """
    last = end - dt.timedelta(days=1)
    year, month = F.col("order_year"), F.col("order_month")
    not_before = (year > start.year) | ((year == start.year) & (month >= start.month))
    not_after = (year < last.year) | ((year == last.year) & (month <= last.month))
    moment = F.col("order_date")
    since = F.lit(start).cast(MOMENT)
    until = F.lit(end).cast(MOMENT)
    return not_before & not_after & (moment >= since) & (moment < until)
