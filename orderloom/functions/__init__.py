from orderloom.functions.fields import (
    WIDE,
    blank,
    calendar_fields,
    exact_total,
    in_period,
    is_date,
    is_date_time,
    is_number,
    money,
    net_revenue,
    normalized_id,
    or_zero,
    parsed_date,
    parsed_quantity,
)

__all__ = [
    "WIDE",
    "blank",
    "calendar_fields",
    "exact_total",
    "in_period",
    "is_date",
    "is_date_time",
    "is_number",
    "money",
    "net_revenue",
    "normalized_id",
    "or_zero",
    "parsed_date",
    "parsed_quantity",
]
