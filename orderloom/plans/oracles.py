"""The same queries as DuckDB SQL, written apart from the Spark code, to check it against.

Sums of decimals are exact in both engines. Averages are not (DuckDB averages in double),
so the expected average is worked out in whole cents, rounding half up. Results are cast to
the types of the contracts.
"""

from __future__ import annotations

# Typed lines from the star schema.
LINES = """
lines as (
  select cast(o_orderkey as varchar) as order_id, cast(o_custkey as varchar) as customer_id,
         cast(l_partkey as varchar) as product_id, p_type as category, o_orderdate as order_date,
         cast(l_quantity as integer) as quantity, cast(p_retailprice as decimal(10,2)) as unit_price,
         cast(l_discount as decimal(5,2)) as discount, o_orderstatus as status
  from lineitem, orders, part
  where l_orderkey = o_orderkey and l_partkey = p_partkey
)"""

FACT_COLUMNS = (
    "order_id, customer_id, product_id, category, order_date, order_year, order_month, order_day, "
    "order_quarter, is_weekend, quantity, unit_price, discount, revenue"
)

_CALENDAR = """
  cast(extract(year from {0}) as integer) as order_year,
  cast(extract(month from {0}) as integer) as order_month,
  cast(extract(day from {0}) as integer) as order_day,
  cast(extract(quarter from {0}) as integer) as order_quarter,
  extract(dow from {0}) in (0, 6) as is_weekend"""


def _fact(name: str, source: str) -> str:
    """A CTE `name` with the fact columns of the typed lines in `source`."""
    return f"""
{name} as (
  select order_id, customer_id, product_id, category, order_date, {_CALENDAR.format("order_date")},
         quantity, unit_price, discount,
         cast(round(cast(quantity as decimal(10,0)) * unit_price * (1 - discount), 2) as decimal(12,2)) as revenue
  from {source} where quantity > 0 and unit_price > 0
)"""


FACT = f"with {LINES}, {_fact('fact', 'lines')}"

# Two versions of the orders, and what the second does to the first.
VERSIONS = f"""with {LINES},
later as (
  select * replace (
    case when status = 'P' then cast(cast(order_date as date) + interval 1 month as timestamp) else order_date end as order_date,
    case when status = 'P' then quantity + 1 else quantity end as quantity)
  from lines where status in ('O', 'P')
),
earlier as (select * from lines where status in ('F', 'P')),
{_fact("target", "earlier")}, {_fact("staging", "later")},
after_upsert as (
  select {FACT_COLUMNS} from target t
  where not exists (select 1 from staging s where s.order_id = t.order_id)
  union all
  select {FACT_COLUMNS} from staging
)"""

# The faulty text lines, as an order file would hold them.
TEXT = """
text as (
  select case when l_orderkey % 53 <> 0 then 'o' || l_orderkey end as order_id,
         case when l_orderkey % 19 = 0 then '   ' when l_orderkey % 11 <> 0 then ' c' || o_custkey || '  ' end as customer_id,
         ' p' || l_partkey || case when l_partkey % 89 = 0 then repeat('0', 51) else '' end as product_id,
         case when l_orderkey % 13 = 0 then 'bad-date'
              when l_orderkey % 47 = 0 then strftime(o_orderdate, '%Y-%m-%d') || ' 13:45:00'
              else strftime(o_orderdate, '%Y-%m-%d') end as order_date,
         case when l_partkey % 17 = 0 then 'x' when l_partkey % 23 = 0 then '-' || cast(l_quantity as integer)
              when l_partkey % 29 = 0 then cast(l_quantity as integer) || '.7'
              else cast(cast(l_quantity as integer) as varchar) end as quantity,
         case when l_suppkey % 31 = 0 then '0.00' when l_suppkey % 37 = 0 then 'n/a'
              when l_suppkey % 47 = 0 then '0.001' when l_suppkey % 59 = 0 then '0.00001'
              when l_suppkey % 61 = 0 then '123456789012'
              else cast(cast(p_retailprice as decimal(10,2)) as varchar) end as unit_price,
         case when l_linenumber = 2 then 'abc' when l_linenumber = 4 then '0.125' when l_linenumber = 7 then '1.50'
              when l_linenumber = 5 and l_orderkey % 7 = 0 then '1000'
              when l_linenumber = 6 and l_orderkey % 7 = 0 then '1000000'
              when l_linenumber = 6 and l_orderkey % 5 = 0 then '1e300'
              when l_linenumber <> 1 then cast(cast(l_discount as decimal(5,2)) as varchar) end as discount,
         case when l_linenumber <> 3 then case when l_partkey % 97 = 0 then repeat('x', 101) else p_type end end as category,
         case when l_orderkey % 2 = 1 then 0 when l_suppkey % 43 = 0 then 3 when l_suppkey % 41 = 0 then 2 else 0 end as fields_cut,
         l_orderkey % 2 as layout
  from lineitem, orders, part
  where l_orderkey = o_orderkey and l_partkey = p_partkey
)"""

# The lines as a scan of the files gives them: cut fields are null.
SCANNED = f"""{TEXT},
scanned as (
  select order_id, customer_id, product_id, order_date, quantity,
         case when fields_cut < 3 then unit_price end as unit_price,
         case when fields_cut < 2 then discount end as discount,
         case when fields_cut < 1 then category end as category,
         fields_cut > 0 as is_corrupt
  from text
)"""


def _assessed(source: str) -> str:
    return f"""
parsed as (
  select *, upper(trim(customer_id)) as customer, upper(trim(product_id)) as product,
         coalesce(try_strptime(order_date, '%Y-%m-%d'), try_strptime(order_date, '%Y-%m-%d %H:%M:%S')) as moment,
         try_cast(trunc(try_cast(quantity as decimal(38,18))) as integer) as units,
         try_cast(unit_price as double) as number, try_cast(discount as double) is null as no_discount,
         try_cast(unit_price as decimal(13,4)) as price,
         case when try_cast(discount as double) is null then 0 else try_cast(discount as decimal(12,6)) end as given
  from {source}
),
assessed as (
  select *,
    try_cast(round(cast(units as decimal(10,0)) * price * (1 - given), 2) as decimal(12,2)) as revenue,
    case when order_id is null then 'missing_order_id' when customer_id is null then 'missing_customer_id'
         when product_id is null then 'missing_product_id' when order_date is null then 'missing_order_date'
         when quantity is null then 'missing_quantity' when unit_price is null then 'missing_unit_price'
         when trim(order_id) = '' then 'blank_order_id' when customer = '' then 'blank_customer_id'
         when product = '' then 'blank_product_id'
         when length(order_id) > 50 then 'long_order_id' when length(customer) > 50 then 'long_customer_id'
         when length(product) > 50 then 'long_product_id' when length(category) > 100 then 'long_category'
         when moment is null then 'bad_order_date'
         when units is null then 'bad_quantity' when number is null then 'bad_unit_price'
         when units <= 0 then 'quantity_not_positive' when number <= 0 then 'unit_price_not_positive'
         when try_cast(price as decimal(10,2)) is null or cast(price as decimal(10,2)) <= 0 then 'unit_price_out_of_range'
         when given is null or abs(given) >= 999.995 then 'discount_out_of_range' end as reason
  from parsed
),
clean as (
  select order_id, customer as customer_id, product as product_id, coalesce(category, 'UNKNOWN') as category,
         moment as order_date, {_CALENDAR.format("moment")}, units as quantity,
         cast(price as decimal(10,2)) as unit_price, cast(given as decimal(5,2)) as discount, revenue
  from assessed where reason is null
)"""


def _total(amount: str) -> str:
    return f"cast(sum({amount}) as decimal(18,2))"


def _mean(amount: str, dtype: str, per: str = "count(*)") -> str:
    cents = f"cast(sum({amount}) * 100 as bigint)"
    return f"cast(sign({cents}) * ((2 * abs({cents}) + {per}) // (2 * {per})) / 100.0 as {dtype})"


MONTHLY = f"""
monthly as (
  select order_year, order_month, category, {_total("revenue")} as monthly_revenue,
         count(distinct order_id) as total_orders, count(distinct customer_id) as unique_customers
  from {{0}} group by all
),
ranked as (
  select *, cast(1 + (select count(*) from monthly o where o.order_year = m.order_year
    and o.order_month = m.order_month and o.monthly_revenue > m.monthly_revenue) as integer) as revenue_rank
  from monthly m
)"""

DAILY = f"""
select order_year, order_month, order_day, category, count(distinct order_id) as total_orders,
       count(distinct customer_id) as unique_customers, cast(sum(quantity) as bigint) as total_units_sold,
       {_total("revenue")} as total_revenue, {_mean("revenue", "decimal(12,2)")} as avg_order_value,
       max(revenue) as max_order_value, min(revenue) as min_order_value
from fact group by order_year, order_month, order_day, category"""

PRODUCTS = f"""
products as (
  select product_id, category, cast(sum(quantity) as bigint) as total_units_sold,
         {_total("revenue")} as total_revenue, count(distinct order_id) as order_count,
         {_mean("unit_price", "decimal(10,2)")} as avg_unit_price
  from fact group by product_id, category
)"""

RFM = f"""
rfm as (
  select customer_id, max(order_date) as last_order_date, count(distinct order_id) as frequency,
         {_total("revenue")} as monetary,
         cast(date_diff('day', max(order_date), (select max(order_date) from fact)) as integer) as recency_days
  from fact group by customer_id
),
quintiles as (
  select customer_id, monetary, frequency, recency_days,
         cast(ntile(5) over (order by monetary desc, customer_id) as integer) as monetary_quintile
  from rfm
)"""

_TOP = "select product_id, category, total_revenue, total_units_sold from products order by {0} desc, product_id, category limit 10"


# What the nightly job makes of the lines: clean ones as its fact.
NIGHTLY = f"with {SCANNED}, {_assessed('scanned')}, fact as (select * from clean)"

_CHECKS = """seen as (
  select 'rows_yesterday' as "check", count(*) as observed, 1 as threshold, '>=' as op from fact
    where cast(order_date as date) = date '2001-08-02' - 1
  union all select 'null_keys', count(*), 0, '=' from fact where order_id is null
  union all select 'negative_revenue', count(*), 0, '=' from fact where revenue < 0
  union all select 'duplicate_keys', count(*), 0, '=' from
    (select order_id from fact group by order_id having count(*) > 1)),
report as (
  select "check", observed, cast(threshold as bigint) as threshold, op,
         case op when '>=' then observed >= threshold else observed = threshold end as passed
  from seen)"""

_GROWTH = f"""months as (
  select order_year, order_month, {_total("revenue")} as total_revenue from fact group by all
), pairs as (
  select *, lag(total_revenue) over (order by order_year, order_month) as prev_month_revenue from months)
select *, round(cast(total_revenue - prev_month_revenue as double)
                / cast(nullif(prev_month_revenue, 0) as double) * 100, 2) as mom_growth_pct
from pairs order by order_year, order_month"""

_OTHER_LAYOUT = "country,order_date,category,discount,unit_price,quantity,product_id,customer_id,order_id"
_FIELDS = "order_id customer_id product_id order_date quantity unit_price discount category".split()
_MOVED = "order_id customer_id product_id order_date unit_price discount category".split()


def all_oracles() -> dict[str, str]:
    upsert = f"{VERSIONS} select * from after_upsert"
    return {
        "fact_orders": f"{FACT} select * from fact",
        "clean_orders": f"with {TEXT}, {_assessed('text')} select * from clean",
        "safe_cast_rejects": f"""with {TEXT}, {_assessed('text')}
            select order_id, customer_id, product_id, order_date, quantity, unit_price, discount, category, reason
            from assessed where reason is not null""",
        "parse_order_date": f"""with {TEXT}
            select order_id, order_date as date_text,
                   coalesce(try_strptime(order_date, '%Y-%m-%d'), try_strptime(order_date, '%Y-%m-%d %H:%M:%S')) as order_date
            from text""",
        "date_enrichment": f"""
            select cast(o_orderkey as varchar) as order_id, o_orderdate as order_date, {_CALENDAR.format("o_orderdate")}
            from orders""",
        "normalize_ids": f"""with {TEXT}
            select order_id, customer_id as customer_text, product_id as product_text,
                   upper(trim(customer_id)) as customer_id, upper(trim(product_id)) as product_id from text""",
        "null_defaults": f"""with {TEXT}
            select order_id, product_id, coalesce(try_cast(discount as double), 0) as discount,
                   coalesce(category, 'UNKNOWN') as category from text""",
        "drop_null_critical": f"""with {TEXT}
            select order_id, customer_id, product_id, order_date, quantity, unit_price, discount, category from text
            where order_id is not null and customer_id is not null and product_id is not null
              and order_date is not null and quantity is not null and unit_price is not null""",
        "positive_filter": f"""with {TEXT}, typed as (
              select order_id, product_id, try_cast(trunc(try_cast(quantity as decimal(38,18))) as integer) as quantity,
                     try_cast(unit_price as decimal(38,18)) as unit_price from text)
            select * from typed where quantity > 0 and unit_price > 0""",
        "daily_sales": f"{FACT} {DAILY}",
        "product_performance": f"{FACT}, {PRODUCTS} select * from products",
        "customer_rfm": f"{FACT}, {RFM} select * from rfm",
        "monthly_revenue": f"{FACT}, {MONTHLY.format('fact')} select * from ranked",
        "weekend_vs_weekday": f"""{FACT}
            select is_weekend, count(distinct order_id) as total_orders, count(distinct customer_id) as unique_customers,
                   count(distinct cast(order_date as date)) as trading_days,
                   cast(sum(quantity) as bigint) as total_units_sold, {_total("revenue")} as total_revenue,
                   {_mean("revenue", "decimal(12,2)")} as avg_order_value,
                   {_mean("revenue", "decimal(18,2)", "count(distinct cast(order_date as date))")} as revenue_per_day
            from fact group by is_weekend""",
        "discount_impact": f"""{FACT}, bands as (
              select discount, count(*) as line_count, count(distinct order_id) as total_orders,
                     cast(sum(quantity) as bigint) as total_units_sold,
                     {_total("cast(quantity as decimal(10,0)) * unit_price")} as gross_revenue,
                     {_total("revenue")} as net_revenue
              from fact group by discount)
            select *, cast(gross_revenue - net_revenue as decimal(18,2)) as revenue_given_away,
                   round(cast(gross_revenue - net_revenue as double) / cast(gross_revenue as double) * 100, 2) as given_away_pct
            from bands""",
        "mom_growth": f"{FACT}, {_GROWTH}",
        "top_products_revenue": f"{FACT}, {PRODUCTS} {_TOP.format('total_revenue')}",
        "top_products_units": f"{FACT}, {PRODUCTS} {_TOP.format('total_units_sold')}",
        "top_products_by_month": f"""{FACT}, sold as (
              select order_year, order_month, product_id, category, cast(sum(quantity) as bigint) as total_units_sold,
                     {_total("revenue")} as total_revenue
              from fact group by all)
            select *, cast(row_number() over (partition by order_year, order_month
                        order by total_revenue desc, product_id, category) as integer) as position
            from sold qualify position <= 10""",
        "customer_quintiles": f"{FACT}, {RFM} select * from quintiles",
        "high_value_customers": f"{FACT}, {RFM} select * from quintiles where monetary_quintile = 1",
        "rfm_segments": f"""{FACT}, {RFM}
            select *, case monetary_quintile when 1 then 'High' when 2 then 'Mid' when 3 then 'Mid' else 'Low' end as segment
            from quintiles""",
        "sorted_customer_list": f"{FACT}, {RFM} select * from quintiles order by monetary desc, customer_id",
        "enrich_broadcast": f"""{FACT}
            select order_id, product_id, customer_id, category, quantity, revenue, p_name, p_brand, p_size, c_mktsegment, n_name
            from fact left join part on cast(p_partkey as varchar) = product_id
              left join customer on cast(c_custkey as varchar) = customer_id
              left join nation on n_nationkey = c_nationkey""",
        "dq_report": f"{FACT}, {_CHECKS} select * from report",
        "dq_duplicate_keys": f"""{FACT}
            select order_id, count(*) as line_count from fact group by order_id having count(*) > 1""",
        "dq_ingest_audit": f"""with {SCANNED}, {_assessed('scanned')}
            select 'input_rows' as metric, count(*) as row_count from assessed
            union all select 'kept_rows', count(*) from assessed where reason is null
            union all select 'rejected_rows', count(*) from assessed where reason is not null
            union all select 'incomplete_rows', count(*) from assessed where starts_with(reason, 'missing_')
            union all select 'corrupt_rows', count(*) from assessed where is_corrupt
            union all select 'discount_defaulted_rows', count(*) from assessed where no_discount
            union all select 'category_defaulted_rows', count(*) from assessed where category is null""",
        "upsert_orders": upsert,
        "upsert_published": upsert,
        "incremental_ingest": upsert,
        "incremental_catchup": upsert,
        "late_correction": upsert,
        "redelivered_file": f"""{VERSIONS}
            select {FACT_COLUMNS} from target where cast(order_id as bigint) % 2 = 1
            union all select {FACT_COLUMNS} from staging where cast(order_id as bigint) % 2 = 0""",
        "upsert_matched": f"""{VERSIONS}
            select {FACT_COLUMNS} from target where order_id in (select order_id from staging)""",
        "contract_load": f"{FACT} select *, timestamp '2001-08-02 02:00:00' as ingestion_ts from fact",
        "partitioned_roundtrip": f"{FACT} {DAILY}",
        "pruned_month_scan": f"""{FACT}
            select order_id, product_id, order_date, order_year, order_month, revenue from fact
            where order_date >= date '1998-01-15' and order_date < date '1998-04-15'""",
        "csv_roundtrip_scan": f"with {SCANNED} select * from scanned",
        "dq_schema_audit": f"""with {TEXT}, written as (
              select count(distinct replace(substr(order_date, 1, 7), '-', '')) as folders, count(*) as lines
              from text where layout = 1 having count(*) > 0)
            select '{_OTHER_LAYOUT}' as file_group, folders, lines, "column",
                   case "column" when 'country' then 'extra' else 'moved' end as finding
            from written, (select unnest({[*_MOVED, 'country']}) as "column")""",
        "dq_type_audit": f"""with {TEXT}, cells as (
              unpivot (select {", ".join(f"coalesce({name}, chr(0)) as {name}" for name in _FIELDS)} from text)
              on {", ".join(_FIELDS)} into name "column" value cell),
            kinds as (
              select "column", case when cell = chr(0) then 'null'
                when regexp_full_match(trim(cell), '[+-]?[0-9]{{1,18}}') then 'integer'
                when regexp_full_match(trim(cell), '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)([eE][+-]?[0-9]+)?') then 'decimal'
                when try_strptime(trim(cell), '%Y-%m-%d') is not null then 'date'
                when try_strptime(trim(cell), '%Y-%m-%d %H:%M:%S') is not null then 'timestamp' else 'text' end as kind
              from cells),
            counted as (select "column", kind, count(*) as line_count from kinds group by all),
            held as (select "column", list_filter(list(kind), lambda k: k <> 'null') as kinds from counted group by "column")
            select "column", kind, line_count,
                   case when len(kinds) = 0 then 'null' when len(kinds) = 1 then kinds[1]
                        when list_has_all(['integer', 'decimal'], kinds) then 'decimal'
                        when list_has_all(['date', 'timestamp'], kinds) then 'timestamp' else 'text' end as column_type
            from counted join held using ("column")""",
        "customer_copartitioned": f"""{FACT}
            select customer_id, c_mktsegment, count(*) as line_count, {_total("revenue")} as total_revenue
            from fact, customer where cast(c_custkey as varchar) = customer_id group by all""",
        "distinct_rollup": f"""{FACT}
            select 'day' as level, order_year, order_month, order_day, count(distinct order_id) as total_orders,
                   count(distinct customer_id) as unique_customers from fact group by all
            union all select 'month', order_year, order_month, null, count(distinct order_id), count(distinct customer_id)
              from fact group by all
            union all select 'year', order_year, null, null, count(distinct order_id), count(distinct customer_id)
              from fact group by all""",
        "keyed_layout_scan": f"""{FACT}
            select customer_id, order_id, product_id, order_date, revenue from fact
            where customer_id >= '10' and customer_id < '12'""",
        "nightly_rebuild": f"{NIGHTLY}, {MONTHLY.format('fact')} select * from ranked",
        "nightly_daily": f"{NIGHTLY} {DAILY}",
        "nightly_products": f"{NIGHTLY}, {PRODUCTS} select * from products",
        "nightly_customers": f"{NIGHTLY}, {RFM} select * from quintiles",
        "nightly_growth": f"{NIGHTLY}, {_GROWTH}",
        "nightly_top_products": f"{NIGHTLY}, {PRODUCTS} {_TOP.format('total_revenue')}",
        "nightly_rejects": f"""with {SCANNED}, {_assessed('scanned')}
            select order_id, customer_id, product_id, order_date, quantity, unit_price, discount, category, reason
            from assessed where reason is not null""",
        "dq_incremental": f"{NIGHTLY}, {_CHECKS} select * from report",
        "dq_gate": f"{NIGHTLY}, {_CHECKS} select * from report where not passed",
    }
