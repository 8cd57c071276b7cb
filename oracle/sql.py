"""DuckDB SQL with the expected result of each registered query.

Written from the meaning of each operator, not generated from the Spark code:
the bookings are derived from the test tables in SQL, then cleaned and
aggregated with window functions and plain joins.
"""

from __future__ import annotations

RAW_COLUMNS = """
booking_id booking_date checkin_date checkout_date nights booking_status booking_channel
booking_source is_cancelled cancellation_date cancellation_reason customer_id first_name
last_name full_name email phone birth_date gender country_customer city_customer address
postal_code language_preference loyalty_level_customer registration_date marketing_consent
hotel_id hotel_name country city hotel_type star_rating total_rooms hotel_facilities
nearby_attractions latitude longitude website room_type rooms_booked adults children infants
special_requests promotion_code total_price room_price tax_amount service_fee paid_amount
discount_amount payment_status payment_method
""".split()

RAW = """
lines as (
  select *, cast(o_orderdate as date) as day, cast(l_quantity as integer) as qty,
    cast(cast(l_extendedprice as decimal(18,2))
      - case when l_linenumber % 2 = 0 then 50000 else 0 end as decimal(18,2)) as price
  from lineitem
  join orders on l_orderkey = o_orderkey
  join supplier on l_suppkey = s_suppkey
  join nation on s_nationkey = n_nationkey
  join region on n_regionkey = r_regionkey
  join customer on o_custkey = c_custkey
),
raw as (
  select
    case when l_orderkey % 101 = 7 then null else l_orderkey || '-' || l_linenumber end as booking_id,
    case when l_partkey % 67 = 2 then null when l_partkey % 59 = 1 then '0000-00-00'
      else cast(day - cast(l_partkey % 30 as integer) as varchar) end as booking_date,
    case when l_partkey % 61 = 3 then '0000-00-00' else cast(day as varchar) end as checkin_date,
    cast(day + (qty - 2 + case when l_partkey % 47 = 5 then 365 else 0 end) as varchar) as checkout_date,
    case when l_partkey % 53 = 0 then '.5' when l_partkey % 53 = 1 then '2.9' else qty || '.0' end as nights,
    case when l_linenumber = 7 then 'no show'
      when o_orderstatus = 'F' then case when l_orderkey % 5 = 0 then 'CNF' else 'cnf' end
      when o_orderstatus = 'P' then 'Pending' else 'canceled' end as booking_status,
    o_orderpriority as booking_channel,
    l_linestatus as booking_source,
    case l_returnflag when 'R' then 'True' when 'A' then 'False' end as is_cancelled,
    case when l_returnflag = 'R' then cast(cast(l_shipdate as date) as varchar) end as cancellation_date,
    case when l_returnflag = 'R' then 'reason ' || (l_partkey % 3) end as cancellation_reason,
    'C' || o_custkey as customer_id,
    'Customer' as first_name,
    cast(o_custkey as varchar) as last_name,
    '  ' || replace(c_name, '#', '  # ') || ' ' as full_name,
    'c' || o_custkey || '@example.com' as email,
    '+' || (o_custkey * 7) as phone,
    cast(null as varchar) as birth_date,
    case when o_custkey % 2 = 0 then 'F' else 'M' end as gender,
    'NATION_' || c_nationkey as country_customer,
    'CITY_' || c_nationkey as city_customer,
    cast(null as varchar) as address,
    cast(o_custkey % 9973 as varchar) as postal_code,
    case when o_custkey % 3 = 0 then 'en' else 'de' end as language_preference,
    c_mktsegment as loyalty_level_customer,
    cast(null as varchar) as registration_date,
    case when o_custkey % 4 = 0 then 'yes' else 'no' end as marketing_consent,
    'H' || l_suppkey as hotel_id,
    case when l_orderkey % 107 = 4 then null else ' ' || s_name || ' ' end as hotel_name,
    case when s_nationkey = 24 then null else lower(r_name) || ' ' end as country,
    case when l_partkey % 97 = 6 then null when l_partkey % 89 = 8 then ''
      else case s_nationkey when 0 then 'Amsterdam' when 1 then 'London' when 2 then ' london '
        when 3 then 'Paris' when 4 then 'Berlin' when 5 then 'barcelona' when 6 then 'Rome'
        when 7 then 'Vienna' when 8 then 'Prague' else n_name end end as city,
    case when l_suppkey % 3 = 0 then 'resort' else 'city hotel' end as hotel_type,
    cast(l_suppkey % 5 + 1 as varchar) as star_rating,
    cast(l_suppkey * 10 + 50 as varchar) as total_rooms,
    cast(null as varchar) as hotel_facilities,
    cast(null as varchar) as nearby_attractions,
    (l_suppkey % 90) || '.5' as latitude,
    (l_suppkey % 180) || '.25' as longitude,
    'https://h' || l_suppkey || '.example.com' as website,
    case l_linenumber when 1 then 'sngl' when 2 then ' dbl' when 3 then 'Suite' when 4 then 'TWIN'
      when 5 then '2' when 6 then 'king' end as room_type,
    '1' as rooms_booked,
    case when l_partkey % 41 = 0 then 'x' else cast(qty % 3 + 1 as varchar) end as adults,
    (qty % 2) || '.0' as children,
    case when l_partkey % 10 = 0 then '1' end as infants,
    case when l_partkey % 6 = 0 then 'late,' || chr(10) || '"quiet" room' end as special_requests,
    case when l_linestatus = 'F' and l_partkey % 9 = 0 then 'P9' end as promotion_code,
    case when l_orderkey % 103 = 9 then null when l_partkey % 83 = 11 then 'abc'
      else cast(price as varchar) end as total_price,
    cast(price as varchar) as room_price,
    cast(cast(price * cast(l_tax as decimal(4,2)) as decimal(22,4)) as varchar) as tax_amount,
    case when l_linestatus = 'F' then case when l_partkey % 7 = 0 then '12.50' else '0.00' end end as service_fee,
    cast(cast(price * (cast(1 as decimal(4,2)) - cast(l_discount as decimal(4,2))) as decimal(22,4)) as varchar) as paid_amount,
    cast(cast(price * cast(l_discount as decimal(4,2)) as decimal(22,4)) as varchar) as discount_amount,
    case when l_linestatus = 'F' then 'paid' else 'open' end as payment_status,
    case when o_custkey % 2 = 0 then 'card' else 'cash' end as payment_method,
    case when l_linestatus = 'F' then 'Batch_CSV' else 'Streaming_Docker' end as data_source
  from lines
)"""

COMPLETE = """
complete as (
  select * from raw
  where booking_id is not null and checkin_date is not null and checkout_date is not null
    and hotel_name is not null and city is not null and total_price is not null
)"""

_ORDER = ["booking_date"] + [c for c in RAW_COLUMNS if c not in ("booking_id", "booking_date")] + ["data_source"]


def _latest_first(columns: list[str]) -> str:
    return ", ".join(f"{c} desc nulls last" for c in columns)


NUMBERED = f"""
numbered as (
  select *, row_number() over (partition by booking_id order by {_latest_first(_ORDER)}) as rn,
    count(*) over (partition by booking_id) as rows_of_booking
  from complete
),
one_each as (select * from numbered where rn = 1)"""

_TYPED_COLUMNS = """
    try_cast(booking_date as date) as booking_date,
    try_cast(checkin_date as date) as checkin_date,
    try_cast(checkout_date as date) as checkout_date,
    try_cast(total_price as double) as total_price"""

_GUESTS = """
    coalesce(cast(trunc(try_cast(adults as double)) as integer), 0)
      + coalesce(cast(trunc(try_cast(children as double)) as integer), 0)
      + coalesce(cast(trunc(try_cast(infants as double)) as integer), 0) as num_guests"""

_ROOM = """
    case when lower(room_type) in ('single', 'sngl', '1') then 'SINGLE'
      when lower(room_type) in ('double', 'dbl', '2') then 'DOUBLE'
      when lower(room_type) in ('suite', 'ste') then 'SUITE'
      when lower(room_type) = 'twin' then 'TWIN' else upper(room_type) end as room_type"""

_STATUS = """
    case when lower(booking_status) in ('confirmed', 'confirm', 'cnf') then 'CONFIRMED'
      when lower(booking_status) in ('cancelled', 'canceled', 'cxl') then 'CANCELLED'
      when lower(booking_status) in ('pending', 'pnd') then 'PENDING'
      else upper(booking_status) end as booking_status"""

_TEXT = """
    trim(upper(hotel_name)) as hotel_name, trim(upper(city)) as city, trim(upper(country)) as country,
    trim(regexp_replace(full_name, '\\s+', ' ', 'g')) as full_name"""

_CHANGED = {
    "booking_date", "checkin_date", "checkout_date", "total_price", "hotel_name", "city", "country",
    "full_name", "room_type", "booking_status",
}
_KEPT = ", ".join(c for c in RAW_COLUMNS if c not in _CHANGED)

REASONS = """
judged as (
  select *, case
      when try_cast(booking_date as date) is null or try_cast(checkin_date as date) is null
        or try_cast(checkout_date as date) is null then 'bad_date'
      when date_diff('day', try_cast(checkin_date as date), try_cast(checkout_date as date)) <= 0
        then 'date_logic'
      when not coalesce(try_cast(total_price as double) > 0 and try_cast(total_price as double) < 50000
        and date_diff('day', try_cast(checkin_date as date), try_cast(checkout_date as date)) <= 365, false)
        then 'outlier' end as reject_reason
  from one_each
)"""

SILVER = f"""
silver as (
  select {_KEPT}, {_TYPED_COLUMNS}, {_GUESTS}, {_ROOM}, {_STATUS}, {_TEXT}, data_source,
    cast(date_diff('day', try_cast(checkin_date as date), try_cast(checkout_date as date)) as integer)
      as stay_duration_days,
    '1.0' as silver_version
  from judged where reject_reason is null
)"""

FACT = """
fact as (
  select booking_id, booking_date,
    cast(year(booking_date) as integer) as booking_year,
    cast(month(booking_date) as integer) as booking_month,
    checkin_date, checkout_date,
    cast(trunc(try_cast(nights as double)) as integer) as stay_nights,
    booking_status, booking_channel, booking_source,
    try_cast(is_cancelled as boolean) as is_cancelled, cancellation_date, cancellation_reason,
    customer_id, full_name as customer_name, country_customer as customer_country,
    city_customer as customer_city, loyalty_level_customer as loyalty_level, language_preference,
    hotel_id, hotel_name, country as hotel_country, city as hotel_city, hotel_type, star_rating,
    room_type, rooms_booked, adults, children, infants, num_guests, special_requests, promotion_code,
    total_price, try_cast(room_price as double) as room_price, try_cast(tax_amount as double) as tax_amount,
    try_cast(service_fee as double) as service_fee, try_cast(paid_amount as double) as paid_amount,
    try_cast(discount_amount as double) as discount_amount, payment_status, payment_method, data_source
  from silver
)"""

KPI = """
monthly as (
  select booking_year, booking_month, hotel_city, hotel_country,
    count(booking_id) as total_bookings,
    cast(count(*) filter (where not is_cancelled) as bigint) as confirmed_bookings,
    cast(count(*) filter (where is_cancelled) as bigint) as cancelled_bookings,
    sum(total_price) as gross_revenue, sum(paid_amount) as collected_revenue,
    sum(discount_amount) as total_discounts, avg(total_price) as avg_booking_value,
    cast(sum(stay_nights) as bigint) as total_nights, avg(stay_nights) as avg_stay_nights,
    count(distinct customer_id) as unique_customers, count(distinct hotel_id) as active_hotels
  from fact group by all
),
kpi as (
  select booking_year, booking_month, hotel_city, hotel_country, total_bookings,
    confirmed_bookings, cancelled_bookings, round(gross_revenue, 2) as gross_revenue,
    round(collected_revenue, 4) as collected_revenue, round(total_discounts, 4) as total_discounts,
    round(avg_booking_value, 6) as avg_booking_value, total_nights,
    round(avg_stay_nights, 6) as avg_stay_nights, unique_customers, active_hotels,
    round(cast(cancelled_bookings as double) / total_bookings * 100, 2) as cancellation_rate,
    cast(rank() over (partition by booking_year, booking_month order by round(gross_revenue, 2) desc) as integer)
      as revenue_rank
  from monthly
)"""


def _with(*parts: str) -> str:
    return "with " + ",".join(p.strip() for p in parts) + "\n"


_TO_SILVER = [RAW, COMPLETE, NUMBERED, REASONS, SILVER]
_TO_FACT = [*_TO_SILVER, FACT]

_HOTEL = """hotel_id hotel_name country city hotel_type star_rating total_rooms hotel_facilities
nearby_attractions latitude longitude website""".split()
_CUSTOMER = """customer_id first_name last_name full_name email phone birth_date gender
country_customer city_customer address postal_code language_preference loyalty_level_customer
registration_date marketing_consent""".split()


def _dimension(key: str, columns: list[str]) -> str:
    order = _latest_first(["booking_date", *[c for c in columns if c != key]])
    return (
        f"ordered as (select *, row_number() over (partition by {key} order by {order}) as rn from silver)"
    )


# ---- dates in many formats -------------------------------------------------

_FORMATS = [
    ("%-m/%-d/%Y", "^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "%m/%d/%Y"),
    ("%Y-%m-%d", "^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}$", "%Y-%m-%d"),
    ("%-d/%-m/%Y", "^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "%d/%m/%Y"),
    ("%d-%m-%Y", "^[0-9]{1,2}-[0-9]{1,2}-[0-9]{4}$", "%d-%m-%Y"),
    ("%Y%m%d", "^[0-9]{8}$", "%Y%m%d"),
    ("%b %-d, %Y", "^[A-Za-z]{3} [0-9]{1,2}, [0-9]{4}$", "%b %d, %Y"),
    ("%B %-d, %Y", "^[A-Za-z]+ [0-9]{1,2}, [0-9]{4}$", "%B %d, %Y"),
    ("%d.%m.%Y", r"^[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4}$", "%d.%m.%Y"),
]


def _rendered(selector: str) -> str:
    whens = " ".join(f"when {i} then strftime(day, '{f}')" for i, (f, _, _) in enumerate(_FORMATS))
    return (
        f"case {selector} {whens} when 8 then ' !!' || strftime(day, '%-m/%-d/%Y') || ' ' "
        "when 9 then '0000-00-00' end"
    )


def _cleaned(column: str) -> str:
    return (
        f"nullif(trim(regexp_replace(trim({column}), '^[!@#$%^&*~`]+', '')), '')"
    )


def _parsed(column: str) -> str:
    tries = []
    for _, shape, pattern in _FORMATS:
        got = f"try_strptime({column}, '{pattern}')"
        tries.append(
            f"case when regexp_matches({column}, '{shape}') and year({got}) between 2000 and 2035 "
            f"then cast({got} as date) end"
        )
    return "coalesce(" + ", ".join(tries) + ")"


DIRTY = f"""
dated as (
  select o_orderkey, cast(o_orderdate as date) + 7305 as day from orders
),
dirty as (
  select 'B' || o_orderkey as booking_id,
    {_rendered('o_orderkey % 11')} as booking_date,
    {_rendered('(o_orderkey % 7 + 3) % 10 + case when o_orderkey % 13 < 6 then 3 else 0 end')} as checkin_date,
    {_rendered('case when o_orderkey % 17 < 3 then 10 else o_orderkey % 9 end')} as checkout_date
  from dated
),
cleaned as (
  select *, {_cleaned('booking_date')} as b, {_cleaned('checkin_date')} as i, {_cleaned('checkout_date')} as o,
    case when regexp_matches(booking_date, '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}$')
      then cast(try_strptime(booking_date, '%m/%d/%Y') as date) end as d0
  from dirty
),
parsed as (
  select booking_id, checkin_date, checkout_date, d0, {_parsed('b')} as d1, {_parsed('i')} as d2, {_parsed('o')} as d3
  from cleaned
),
found as (
  select booking_id, coalesce(d0, d1, d2, d3) as booking_date, checkin_date, checkout_date,
    case when d0 is not null then 'original' when d1 is not null then 'booking_date_cleaned'
      when d2 is not null then 'derived_from_checkin' when d3 is not null then 'derived_from_checkout'
      else 'unrecoverable' end as _date_recover_src
  from parsed
)"""

_SPLIT = """
kept as (
  select booking_id, cast(booking_date as date) as booking_date, checkin_date, hotel_id, total_price,
    row_number() over (order by cast(booking_date as date), booking_id nulls last, checkin_date nulls last,
      hotel_id nulls last, total_price nulls last) as position,
    count(*) over () as n
  from raw where try_cast(booking_date as date) is not null
),
parts as (
  select booking_id, booking_date, checkin_date, hotel_id, total_price,
    case when position <= cast(floor(cast(n as double) * cast(0.7 as double)) as bigint)
      then 'batch' else 'stream' end as split
  from kept
)"""

# ---- payloads ----------------------------------------------------------------

WEATHER = """
weather as (
  select cast(cast(ts as date) as varchar) as time, max(value) as temperature_2m_max,
    min(value) as temperature_2m_min, cast(count(*) as double) as rain_sum,
    cast(max(event_id % 97) as double) as windspeed_10m_max,
    (['Amsterdam','London','Paris','Berlin','Barcelona','Rome','Vienna','Prague'])[user_id % 8 + 1] as city,
    cast(50.0 as double) as latitude, cast(8.0 as double) as longitude, 'open-meteo-api' as _source
  from events group by cast(ts as date), user_id % 8
)"""

RATES = """
rates as (
  select * from (
    select (['USD','GBP','TRY','CHF','JPY','AUD','CAD','SEK','NOK','DKK','PLN','HUF'])[o_custkey % 12 + 1]
        as currency_code,
      max(cast(o_custkey % 1000 as double) / 8.0 + 1) as rate_vs_eur, 'EUR' as base_currency,
      cast(o_orderdate as date) as rate_date, 'exchangerate-api' as _source
    from orders group by cast(o_orderdate as date), o_custkey % 12)
  where currency_code not in ('PLN', 'HUF')
)"""

# ---- quality -------------------------------------------------------------------


def _check(kind: str, column: str, bad: str, mostly: float, on_nulls: bool, source: str = "silver") -> str:
    seen = "count(*)" if on_nulls else f"count({column})"
    return f"""
  select '{kind}' as expectation, '{column}' as column_name, {seen} as evaluated,
    count(*) filter (where {bad}) as unexpected,
    case when {seen} = 0 then null
      else round(cast(count(*) filter (where {bad}) as double) / {seen} * 100, 4) end as unexpected_pct,
    cast({mostly} as double) as mostly,
    case when {seen} = 0 then true
      else cast({seen} - count(*) filter (where {bad}) as double) / {seen} >= {mostly} end as success
  from {source}"""


_CRITICAL = ["booking_id", "checkin_date", "checkout_date", "hotel_name", "city", "total_price", "data_source"]
_NN, _BT, _IS = (
    "expect_column_values_to_not_be_null", "expect_column_values_to_be_between",
    "expect_column_values_to_be_in_set",
)
DQ_NOT_NULL = [_check(_NN, c, f"{c} is null", 1.0, True) for c in _CRITICAL]
DQ_MOSTLY = [_check(_NN, c, f"{c} is null", 0.95, True) for c in ("room_type", "booking_status")]
DQ_BETWEEN = [
    _check(_BT, "total_price", "total_price < 0 or total_price > 50000", 1.0, False),
    _check(_BT, "stay_duration_days", "stay_duration_days < 1 or stay_duration_days > 365", 1.0, False),
]
DQ_IN_SET = [
    _check(_IS, "data_source", "data_source not in ('Batch_CSV', 'Streaming_Docker')", 1.0, False),
    _check(_IS, "room_type", "room_type not in ('SINGLE', 'DOUBLE', 'SUITE', 'TWIN')", 0.90, False),
]
DQ_DATES = [
    _check(
        "expect_column_values_to_match_strftime_format", c,
        f"not regexp_matches(cast({c} as varchar), '^[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}$')", 0.99, False)
    for c in ("checkin_date", "checkout_date", "booking_date")
]
DQ_EXISTS = [
    f"select 'expect_column_to_exist' as expectation, '{c}' as column_name, cast(1 as bigint) as evaluated, "
    "cast(0 as bigint) as unexpected, cast(0 as double) as unexpected_pct, cast(1 as double) as mostly, "
    "true as success"
    for c in ("booking_id", "checkin_date", "checkout_date", "total_price", "silver_load_at", "data_source",
              "stay_duration_days")
]


def _unique(source: str) -> str:
    return _check(
        "expect_column_values_to_be_unique", "booking_id", "booking_id is not null and n > 1", 1.0, False,
        f"(select booking_id, count(*) over (partition by booking_id) as n from {source})")


def _union(parts: list[str]) -> str:
    return " union all ".join(parts)


_ALL_DQ = DQ_NOT_NULL + DQ_MOSTLY + DQ_BETWEEN + DQ_IN_SET + DQ_DATES + DQ_EXISTS + [_unique("silver")]

_RAW_LIST = ", ".join(RAW_COLUMNS)


def statements() -> dict[str, str]:
    q: dict[str, str] = {}
    # gold
    q["kpi_revenue"] = _with(*_TO_FACT, KPI) + "select * from kpi"
    q["fact_booking"] = _with(*_TO_FACT) + "select * from fact"
    q["dim_hotel"] = _with(*_TO_SILVER, _dimension("hotel_id", _HOTEL)) + (
        "select hotel_id, hotel_name, country, city, hotel_type, star_rating, total_rooms, hotel_facilities, "
        "nearby_attractions, try_cast(latitude as double) as latitude, try_cast(longitude as double) as longitude, "
        "website from ordered where rn = 1")
    q["dim_city"] = _with(*_TO_SILVER) + (
        "select city as city_name, country, round(avg(try_cast(latitude as double)), 6) as latitude, "
        "round(avg(try_cast(longitude as double)), 6) as longitude, count(distinct hotel_id) as hotel_count, "
        "md5(concat_ws('_', city, country)) as city_id from silver where city is not null and city <> '' "
        "group by city, country")
    q["dim_customer"] = _with(*_TO_SILVER, _dimension("customer_id", _CUSTOMER)) + (
        "select customer_id, first_name, last_name, full_name, email, phone, birth_date, gender, "
        "country_customer as country, city_customer as city, address, postal_code, language_preference, "
        "loyalty_level_customer as loyalty_level, registration_date, marketing_consent from ordered where rn = 1")
    q["conditional_counts"] = _with(*_TO_FACT) + (
        "select booking_status, count(booking_id) as total_bookings, "
        "cast(count(*) filter (where not is_cancelled) as bigint) as confirmed_bookings, "
        "cast(count(*) filter (where is_cancelled) as bigint) as cancelled_bookings from fact group by booking_status")
    q["distinct_counts"] = _with(*_TO_FACT) + (
        "select hotel_country, count(distinct customer_id) as unique_customers, "
        "count(distinct hotel_id) as active_hotels from fact group by hotel_country")
    q["cancellation_rate"] = _with(*_TO_FACT) + (
        "select booking_channel, count(booking_id) as total_bookings, "
        "cast(count(*) filter (where is_cancelled) as bigint) as cancelled_bookings, "
        "round(cast(count(*) filter (where is_cancelled) as double) / count(booking_id) * 100, 2) "
        "as cancellation_rate from fact group by booking_channel")
    q["surrogate_key"] = _with(*_TO_SILVER) + (
        "select booking_id, city, country, md5(concat_ws('_', city, country)) as city_id from silver")
    # cleaning
    q["null_profile"] = _with(RAW) + _union([
        f"select '{c}' as column_name, count(*) - count({c}) as nulls, count(*) as total_rows from raw"
        for c in _CRITICAL[:-1]])
    q["drop_null_critical"] = _with(RAW, COMPLETE) + f"select {_RAW_LIST} from complete"
    q["dedup_latest"] = _with(RAW, COMPLETE, NUMBERED) + f"select {_RAW_LIST}, rows_of_booking from one_each"
    typed = f"typed as (select booking_id, {_TYPED_COLUMNS} from complete)"
    dated = (
        "dated as (select * from typed where booking_date is not null and checkin_date is not null "
        "and checkout_date is not null)")
    forward = (
        "forward as (select *, cast(date_diff('day', checkin_date, checkout_date) as integer) as stay_duration_days "
        "from dated where date_diff('day', checkin_date, checkout_date) > 0)")
    q["drop_bad_dates"] = _with(RAW, COMPLETE, typed, dated) + "select * from dated"
    q["date_logic"] = _with(RAW, COMPLETE, typed, dated, forward) + "select * from forward"
    q["outlier_filter"] = _with(RAW, COMPLETE, typed, dated, forward) + (
        "select * from forward where total_price > 0 and total_price < 50000 and stay_duration_days <= 365")
    q["price_flags"] = _with(RAW, COMPLETE, typed, dated, forward) + (
        "select count(*) filter (where total_price <= 0) as non_positive, "
        "count(*) filter (where total_price > 50000) as above_bound from forward")
    q["price_profile"] = _with(RAW, COMPLETE, typed, dated, forward) + (
        ", ranked as (select total_price, row_number() over (order by total_price) as rn, count(*) over () as n "
        "from forward where total_price is not null) "
        "select min(total_price) as min, "
        "min(total_price) filter (where rn >= greatest(1, ceil(n * cast(0.25 as double)))) as p25, "
        "min(total_price) filter (where rn >= greatest(1, ceil(n * cast(0.75 as double)))) as p75, "
        "max(total_price) as max from ranked")
    q["type_cast"] = _with(RAW) + (
        f"select row_number() over () as ignored, booking_id, {_TYPED_COLUMNS}, {_GUESTS}, "
        "cast(trunc(try_cast(nights as double)) as integer) as stay_nights, "
        "try_cast(is_cancelled as boolean) as is_cancelled from raw").replace("row_number() over () as ignored, ", "")
    q["text_standardize"] = _with(RAW) + (
        f"select booking_id, {_TEXT}, lower(booking_status) as status_lower, upper(room_type) as room_upper from raw")
    q["category_map"] = _with(RAW) + f"select booking_id, {_ROOM}, {_STATUS} from raw"
    q["stay_duration"] = _with(RAW) + (
        "select booking_id, try_cast(checkin_date as date) as checkin_date, "
        "try_cast(checkout_date as date) as checkout_date, cast(date_diff('day', try_cast(checkin_date as date), "
        "try_cast(checkout_date as date)) as integer) as stay_duration_days from raw")
    q["silver_bookings"] = _with(*_TO_SILVER) + "select * from silver"
    q["silver_audit"] = _with(RAW, COMPLETE, NUMBERED, REASONS) + """
      , counts as (
        select (select count(*) from raw) as r0, (select count(*) from complete) as r1,
          (select count(*) from one_each) as r2,
          (select count(*) from judged where reject_reason is distinct from 'bad_date') as r3,
          (select count(*) from judged where reject_reason is null or reject_reason = 'outlier') as r4,
          (select count(*) from judged where reject_reason is null) as r5),
      steps as (
        select 1 as step_no, 'null_critical' as step, r0 as rows_before, r1 as rows_after, r0 from counts
        union all select 2, 'duplicate', r1, r2, r0 from counts
        union all select 3, 'bad_date', r2, r3, r0 from counts
        union all select 4, 'date_logic', r3, r4, r0 from counts
        union all select 5, 'outlier', r4, r5, r0 from counts)
      select cast(step_no as integer) as step_no, step, rows_before, rows_after,
        rows_before - rows_after as rows_dropped,
        round(cast(rows_after as double) / r0 * 100, 2) as retention_pct from steps"""
    q["silver_rejects"] = _with(RAW, COMPLETE, NUMBERED, REASONS) + f"""
      select *, count(*) as row_count from (
      select {_RAW_LIST}, data_source, 'null_critical' as reject_reason from raw
        where booking_id is null or checkin_date is null or checkout_date is null or hotel_name is null
          or city is null or total_price is null
      union all select {_RAW_LIST}, data_source, 'duplicate' from numbered where rn > 1
      union all select {_RAW_LIST}, data_source, reject_reason from judged where reject_reason is not null) group by all"""
    # bronze
    q["source_distribution"] = _with(RAW) + (
        "select data_source as _source, count(*) as row_count from raw group by data_source")
    q["union_by_name"] = _with(RAW) + f"select {_RAW_LIST}, data_source as _source from raw"
    q["tag_if_missing"] = (
        "select o_orderkey, o_orderstatus as _source, 'from orders' as status_origin from orders "
        "union all select c_custkey, 'Streaming_Docker', 'added' from customer")
    q["load_stamp"] = (
        "select o_orderkey, 'Streaming_Docker' as _source, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as loaded from orders "
        "union all select c_custkey, 'Streaming_Docker', '2024-01-01 00:00:00' from customer")
    q["normalize_columns"] = (
        "select o_orderkey as booking_id, o_custkey as guest_id, o_orderstatus as star_rating, "
        "o_totalprice as price_night, o_orderpriority as channel_type from orders")
    q["schema_diff"] = _with(RAW) + (
        ", b as (select * from raw where data_source = 'Batch_CSV'), s as (select * from raw where "
        "data_source <> 'Batch_CSV') ") + _union([
            f"select '{c}' as column_name, 'string' as left_type, "
            + ("cast(null as varchar) as right_type, 'only_left' as status, " if c in ("service_fee", "promotion_code")
               else "'string' as right_type, 'common' as status, ")
            + f"(select count(*) from b) as left_rows, (select count({c}) from b) as left_filled, "
            + ("cast(null as bigint) as right_rows, cast(null as bigint) as right_filled"
               if c in ("service_fee", "promotion_code")
               else f"(select count(*) from s) as right_rows, (select count({c}) from s) as right_filled")
            for c in RAW_COLUMNS])
    # files, streams
    q["csv_roundtrip"] = _with(RAW) + f"select {_RAW_LIST}, 'Batch_CSV' as _source from raw".replace(
        " city,", " nullif(city, '') as city,")
    batch_columns = ", ".join(c for c in RAW_COLUMNS)
    q["ingest_batch"] = _with(RAW) + (
        f"select {batch_columns}, cast(null as varchar) as _corrupt_record, 'Batch_CSV' as _source, "
        "'.csv' as _source_file from raw where data_source = 'Batch_CSV'").replace(" city,", " nullif(city, '') as city,")
    q["booking_stream"] = q["typed_batch"] = q["silver_bookings"]
    q["gold_tables"] = _with(*_TO_FACT, KPI) + (
        "select *, rows_written as rows_stored, true as agree from (select 'fact_booking', count(*) from fact "
        "union all select 'dim_hotel', count(distinct coalesce(hotel_id, '')) from silver "
        "union all select 'dim_customer', count(distinct coalesce(customer_id, '')) from silver "
        "union all select 'dim_city', count(*) from (select distinct city, country from silver where city <> '') "
        "union all select 'kpi_revenue', count(*) from kpi) as t(table_name, rows_written)")
    q["write_verify"] = (
        "select count(*) as rows_written, count(*) as rows_stored, true as agree from lineitem")
    events = (
        "select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as ts, user_id, event_type, value, props from events")
    q["stream_ingest"] = events
    q["stream_decode"] = events
    q["x_stream_dedup"] = "select event_id, user_id, event_type, value, props from events"
    # recovery, split
    q["date_recovery"] = _with(DIRTY) + "select * from found"
    q["date_recovery_hist"] = _with(DIRTY) + (
        "select _date_recover_src, count(*) as row_count from found group by _date_recover_src")
    q["date_recovery_rejects"] = _with(DIRTY) + (
        "select booking_id, checkin_date, checkout_date, _date_recover_src from found where booking_date is null")
    q["chrono_split"] = _with(RAW, _SPLIT) + "select * from parts"
    q["split_ranges"] = _with(RAW, _SPLIT) + (
        "select split, count(*) as row_count, min(booking_date) as first_date, max(booking_date) as last_date "
        "from parts group by split")
    q["split_files"] = _with(DIRTY) + """
      , placed as (select booking_date, row_number() over (order by booking_date, booking_id) as position, count(*) over () as n
        from found where booking_date is not null)
      select case when position <= cast(floor(cast(n as double) * cast(0.7 as double)) as bigint) then 'batch' else 'stream' end as split,
        count(*) as row_count, cast(min(booking_date) as varchar) as first_date, cast(max(booking_date) as varchar) as last_date,
        cast(0 as bigint) as files_out_of_order
      from placed group by 1"""
    # payloads, look-ups
    q["weather_flatten"] = _with(WEATHER) + "select * from weather"
    q["fx_flatten"] = _with(RATES) + "select * from rates"
    q["city_lookup"] = _with(RAW) + """
      , known(city, latitude, longitude) as (values
        ('Amsterdam', 52.3676::double, 4.9041::double), ('London', 51.5074, -0.1278), ('Paris', 48.8566, 2.3522),
        ('Berlin', 52.52, 13.405), ('Barcelona', 41.3851, 2.1734), ('Rome', 41.9028, 12.4964),
        ('Vienna', 48.2082, 16.3738), ('Prague', 50.0755, 14.4378))
      select * from known where city in (select city from raw)"""
    # quality
    q["dq_not_null"] = _with(*_TO_SILVER) + _union(DQ_NOT_NULL)
    q["dq_not_null_mostly"] = _with(*_TO_SILVER) + _union(DQ_MOSTLY)
    q["dq_unique"] = _with(*_TO_SILVER) + _union([_unique("silver"), _unique("complete")])
    q["dq_schema"] = _with(*_TO_SILVER) + (
        ", checks as (" + _union(DQ_EXISTS) + ") "
        "select *, (select count(*) from silver) as total_rows from checks")
    q["dq_between"] = _with(*_TO_SILVER) + _union(DQ_BETWEEN)
    q["dq_in_set"] = _with(*_TO_SILVER) + _union(DQ_IN_SET)
    q["dq_date_format"] = _with(*_TO_SILVER) + _union(DQ_DATES)
    q["dq_report"] = _with(*_TO_SILVER) + ", results as (" + _union(_ALL_DQ) + """)
      select 'silver_bookings' as "table", (select count(*) from silver) as sample_size,
        (select count(*) from silver) as total_rows,
        count(*) as total_expectations, count(*) filter (where success) as successful,
        count(*) filter (where not success) as failed,
        round(cast(count(*) filter (where success) as double) / count(*) * 100, 4) as success_percent,
        count(*) filter (where not success) = 0 as overall_success,
        coalesce(string_agg(column_name || ':' || expectation, ',' order by column_name, expectation)
          filter (where not success), '') as failed_tests
      from results"""
    q["sample_rows"] = _with(*_TO_SILVER) + """

      select booking_id, total_price, city from silver
      where cast(cast('0x' || substr(md5('42|' || booking_id), 1, 15) as bigint) as double)
        / cast(1152921504606846976 as double) < cast(0.05 as double)"""
    # summaries
    q["bi_summary"] = _with(*_TO_FACT) + (
        "select hotel_country, room_type, cast(sum(stay_nights) as bigint) as stay_nights, "
        "cast(sum(num_guests) as bigint) as num_guests, round(sum(total_price), 2) as total_price, "
        "round(sum(room_price), 2) as room_price, round(sum(tax_amount), 2) as tax_amount, "
        "round(sum(service_fee), 2) as service_fee, round(sum(paid_amount), 2) as paid_amount, "
        "round(sum(discount_amount), 2) as discount_amount from fact group by hotel_country, room_type")
    q["bi_summary_kpi"] = _with(*_TO_FACT, KPI) + (
        "select hotel_city, " + ", ".join(
            f"cast(sum({c}) as bigint) as {c}" for c in ("total_bookings", "confirmed_bookings", "cancelled_bookings", "total_nights")
        ) + ", " + ", ".join(
            f"round(sum({c}), 2) as {c}" for c in ("gross_revenue", "collected_revenue", "total_discounts")
        ) + " from monthly group by hotel_city")
    q["x_hotel_performance"] = _with(*_TO_FACT) + (
        "select hotel_id, hotel_name, count(booking_id) as total_bookings, "
        "round(sum(total_price), 2) as gross_revenue, cast(sum(stay_nights) as bigint) as total_nights, "
        "round(sum(total_price) / sum(stay_nights), 6) as average_daily_rate from fact group by hotel_id, hotel_name")
    q["x_lead_time"] = _with(*_TO_FACT) + (
        "select booking_channel, count(booking_id) as total_bookings, "
        "round(avg(date_diff('day', booking_date, checkin_date)), 6) as avg_lead_days, "
        "cast(min(date_diff('day', booking_date, checkin_date)) as integer) as min_lead_days, "
        "cast(max(date_diff('day', booking_date, checkin_date)) as integer) as max_lead_days, "
        "quantile_cont(cast(date_diff('day', booking_date, checkin_date) as double), 0.5) as median_lead_days "
        "from fact group by booking_channel")
    q["x_cancel_trend"] = _with(*_TO_FACT) + (
        "select booking_year, booking_month, cancellation_reason, count(booking_id) as total_bookings, "
        "cast(count(*) filter (where is_cancelled) as bigint) as cancelled_bookings, "
        "round(cast(count(*) filter (where is_cancelled) as double) / count(booking_id) * 100, 2) "
        "as cancellation_rate from fact group by booking_year, booking_month, cancellation_reason")
    q["x_top_cities"] = _with(*_TO_FACT, KPI) + (
        "select booking_year, booking_month, hotel_city, hotel_country, gross_revenue, revenue_rank from kpi "
        "where revenue_rank <= 3")
    q["x_fx_convert"] = _with(*_TO_FACT, RATES) + """
      , newest as (select currency_code, rate_vs_eur from (
          select *, row_number() over (partition by currency_code order by rate_date desc, rate_vs_eur desc) as rn
          from rates) where rn = 1),
      priced as (select booking_id, total_price,
          (['EUR','USD','GBP','TRY','CHF','JPY','PLN'])[cast(substr(customer_id, 2) as bigint) % 7 + 1] as currency
        from fact)
      select booking_id, total_price, currency,
        round(total_price * case when currency = 'EUR' then 1.0 else rate_vs_eur end, 6) as converted_price
      from priced left join newest on currency = currency_code"""
    q["x_weather_join"] = _with(*_TO_SILVER, WEATHER) + """
      , shifted as (select booking_id, city, checkin_date,
          cast(date '2024-01-01' + cast(date_diff('day', date '1995-01-01', checkin_date) % 60 as integer) as date)
            as forecast_day from silver)
      select booking_id, shifted.city as city, checkin_date, temperature_2m_max, temperature_2m_min, rain_sum,
        windspeed_10m_max
      from shifted left join weather
        on upper(trim(shifted.city)) = upper(weather.city) and cast(forecast_day as varchar) = weather.time"""
    q["report_file"] = q["dq_report"]
    q["streaming_silver"] = q["silver_bookings"]
    # publication, drift
    q["publish_checked"] = _with(*_TO_SILVER) + """
      , seen(step, outcome, version, sources) as (values ('batch', 'published', 1, ['Batch_CSV']),
        ('bad_price', 'refused', 1, ['Batch_CSV']), ('lost', 'failed', 1, ['Batch_CSV']),
        ('all', 'published', 2, ['Batch_CSV', 'Streaming_Docker']))
      select step, outcome, cast(version as integer) as version, count(*) as rows_seen,
        round(sum(total_price), 2) as price_seen
      from seen join silver on list_contains(sources, data_source) group by step, outcome, version"""
    q["schema_drift"] = """
      select o_orderkey as k,
        case when o_orderkey % 4 < 2 then strftime(case when o_orderkey % 4 = 0 then cast(cast(o_orderdate as date) as timestamp)
          else o_orderdate end, '%Y-%m-%d %H:%M:%S') end as day,
        case when o_orderkey % 4 in (0, 2) then cast(o_custkey as integer) end as customer,
        case o_orderkey % 4 when 1 then cast(cast(o_totalprice as decimal(12,2)) as double) when 2 then cast(o_custkey as double) end as price,
        case when o_orderkey % 4 = 2 then o_orderstatus end as status
      from orders where o_orderkey % 4 < 3"""
    # look-ups in time
    q["x_fx_asof"] = _with(*_TO_FACT, RATES) + """
      , sparse as (select * from rates where date_diff('day', date '1992-01-01', rate_date) % 9 = 0),
      priced as (select booking_id, booking_date, total_price,
          (['EUR','USD','GBP','TRY','CHF','JPY','PLN'])[cast(substr(customer_id, 2) as bigint) % 7 + 1] as currency
        from fact)
      select booking_id, booking_date, total_price, currency,
        round(total_price * case when currency = 'EUR' then 1.0 else rate_vs_eur end, 6) as converted_price
      from priced asof left join sparse on currency = currency_code and booking_date >= rate_date"""
    q["x_stay_weather"] = _with(*_TO_SILVER, WEATHER) + """
      , stays as (select booking_id, city, stay_duration_days as nights,
          cast(date '2023-12-20' + cast(date_diff('day', date '1995-01-01', checkin_date) % 60 as integer) as date) as arrives
        from silver)
      select booking_id, stays.city as city, count(rain_sum) as nights_known,
        round(cast(sum(cast(rain_sum as decimal(28,6))) as double), 4) as rain_total,
        round(cast(sum(cast(temperature_2m_max as decimal(28,6))) as double) / count(temperature_2m_max), 8) as avg_temp_max
      from stays left join weather on upper(trim(stays.city)) = upper(weather.city)
        and cast(weather.time as date) >= arrives and cast(weather.time as date) < arrives + nights
      group by booking_id, stays.city"""
    history = """
      , day_rows as (select distinct hotel_id, booking_date, hotel_name, country, city, hotel_type, star_rating, total_rooms
        from silver where hotel_id is not null and booking_date is not null),
      of_day as (select * from (select *, row_number() over (partition by hotel_id, booking_date
          order by hotel_name desc nulls last, country desc nulls last, city desc nulls last, hotel_type desc nulls last,
            star_rating desc nulls last, total_rooms desc nulls last) as rn from day_rows) where rn = 1),
      marked as (select *, row(hotel_name, country, city, hotel_type, star_rating, total_rooms) as now,
          lag(row(hotel_name, country, city, hotel_type, star_rating, total_rooms)) over w as before,
          row_number() over w as k
        from of_day window w as (partition by hotel_id order by booking_date)),
      history as (select hotel_id, hotel_name, country, city, hotel_type, star_rating, total_rooms, booking_date as valid_from,
          cast(lead(booking_date) over w - 1 as date) as valid_to, lead(booking_date) over w is null as is_current
        from marked where k = 1 or now is distinct from before window w as (partition by hotel_id order by booking_date))"""
    q["dim_hotel_history"] = _with(*_TO_SILVER) + history + " select * from history"
    q["fact_as_of"] = _with(*_TO_SILVER) + history + """
      select booking_id, s.hotel_id as hotel_id, checkin_date, valid_from, h.city as city_then
      from (select booking_id, hotel_id, checkin_date from silver) s left join history h
        on s.hotel_id = h.hotel_id and checkin_date >= valid_from and checkin_date <= coalesce(valid_to, date '9999-12-31')"""
    # sketches, subtotals
    q["x_distinct_rollup"] = _with(*_TO_FACT) + _union([
        f"select '{c}' as level, cast({c} as varchar) as \"group\", count(distinct customer_id) as customers, "
        f"count(distinct hotel_id) as hotels, true as near from fact group by {c}"
        for c in ("booking_year", "hotel_country")])
    money = ["total_price", "room_price", "tax_amount", "service_fee", "paid_amount", "discount_amount"]
    q["bi_subtotals"] = _with(*_TO_FACT) + (
        "select hotel_country, room_type, cast(grouping(hotel_country, room_type) as bigint) as grouping_id, "
        "cast(sum(stay_nights) as bigint) as stay_nights, cast(sum(num_guests) as bigint) as num_guests, "
        + ", ".join(f"round(sum({m}), 2) as {m}" for m in money)
        + " from fact group by grouping sets ((hotel_country, room_type), (hotel_country), (room_type), ())")
    q["bi_summary_dims"] = _with(*_TO_SILVER, _dimension("hotel_id", _HOTEL)) + (
        ", customers as (select *, row_number() over (partition by customer_id order by "
        + _latest_first(["booking_date", *[c for c in _CUSTOMER if c != "customer_id"]]) + ") as cn from silver) "
        "select distinct 'dim_hotel' as table_name, country, cast(null as bigint) as n from ordered where rn = 1 "
        "union all select 'dim_city', country, cast(sum(hotel_count) as bigint) from (select city, country, "
        "count(distinct hotel_id) as hotel_count from silver where city <> '' group by city, country) group by country "
        "union all select distinct 'dim_customer', country_customer, cast(null as bigint) from customers where cn = 1")
    # windows over event time
    delivered = """
      delivered as (select *, case when event_id % 97 = 0 and ts < '2024-01-11' then 3 when ts < '2024-01-11' then 1
          when ts < '2024-01-21' then 2 else 3 end as delivery from events),
      bounds as (select d, (select max(ts) from delivered where delivery < d) - interval 1 hour as bound from range(1, 4) t(d)),
      dealt as (select delivered.*, coalesce(ts < bound, false) as late from delivered join bounds on d = delivery),
      timely as (select *, (select max(ts) from dealt where not late) - interval 1 hour as watermark from dealt where not late)"""
    q["x_sessions"] = _with(delivered) + """
      , steps as (select *, coalesce(ts - lag(ts) over (partition by user_id order by ts) > interval 30 minutes, true) as begins
        from timely),
      islands as (select *, sum(cast(begins as integer)) over (partition by user_id order by ts rows unbounded preceding) as island
        from steps)
      select user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') as session_start,
        strftime(max(ts) + interval 30 minutes, '%Y-%m-%d %H:%M:%S.%f') as session_end, count(*) as events,
        min(event_id) as first_event, cast(sum(cast(value as decimal(18,2))) as double) as value
      from islands group by user_id, island, watermark having max(ts) + interval 30 minutes <= watermark"""
    q["x_sliding_counts"] = _with(delivered) + """
      , opened as (select event_type, watermark, time_bucket(interval 6 hours, ts, timestamp '2024-01-01') - to_hours(6 * k) as begins
        from timely, range(4) t(k))
      select event_type, strftime(begins, '%Y-%m-%d %H:%M:%S.%f') as window_start, count(*) as events
      from opened where begins + interval 1 day <= watermark group by event_type, begins"""
    q["x_late_events"] = _with(delivered) + (
        "select event_id, user_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') as ts from dealt where late")
    return q
