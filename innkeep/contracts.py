"""Column contracts of the booking tables, and the check that a frame meets one.

Bronze is all strings: no inference pass over the files, and no type conflict
when batch and stream are put together. Typing happens once, in silver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Raw booking columns, in file order, by group.
BOOKING_COLUMNS = [
    # booking
    "booking_id", "booking_date", "checkin_date", "checkout_date", "nights",
    "booking_status", "booking_channel", "booking_source",
    "is_cancelled", "cancellation_date", "cancellation_reason",
    # customer
    "customer_id", "first_name", "last_name", "full_name", "email", "phone",
    "birth_date", "gender", "country_customer", "city_customer", "address",
    "postal_code", "language_preference", "loyalty_level_customer",
    "registration_date", "marketing_consent",
    # hotel
    "hotel_id", "hotel_name", "country", "city", "hotel_type", "star_rating",
    "total_rooms", "hotel_facilities", "nearby_attractions", "latitude",
    "longitude", "website",
    # room
    "room_type", "rooms_booked", "adults", "children", "infants",
    "special_requests", "promotion_code",
    # money
    "total_price", "room_price", "tax_amount", "service_fee", "paid_amount",
    "discount_amount", "payment_status", "payment_method",
]

RAW_BOOKING = T.StructType([T.StructField(c, T.StringType()) for c in BOOKING_COLUMNS])

# A booking without one of these is of no use.
CRITICAL_COLUMNS = [
    "booking_id", "checkin_date", "checkout_date", "hotel_name", "city", "total_price",
]
DATE_COLUMNS = ["booking_date", "checkin_date", "checkout_date"]

# Source tags.
BATCH_TAG = "Batch_CSV"
STREAM_TAG = "Streaming_Docker"
WEATHER_TAG = "open-meteo-api"
RATES_TAG = "exchangerate-api"
SILVER_VERSION = "1.0"


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "bigint": T.LongType(),
    "double": T.DoubleType(), "date": T.DateType(), "boolean": T.BooleanType(),
    "timestamp": T.TimestampType(),
}


def _table(spec: str) -> T.StructType:
    """``name type[!]`` per line; ``!`` marks NOT NULL. Spark's own DDL parser needs a
    session, which there is none of when this module is imported."""
    fields = []
    for line in spec.strip().split("\n"):
        name, kind = line.split()
        fields.append(T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


# Names, order, types and NOT NULLs of the five gold tables.
FACT_BOOKING = _table("""
booking_id string
booking_date date
booking_year int
booking_month int
checkin_date date
checkout_date date
stay_nights int
booking_status string
booking_channel string
booking_source string
is_cancelled boolean
cancellation_date string
cancellation_reason string
customer_id string
customer_name string
customer_country string
customer_city string
loyalty_level string
language_preference string
hotel_id string
hotel_name string
hotel_country string
hotel_city string
hotel_type string
star_rating string
room_type string
rooms_booked string
adults string
children string
infants string
num_guests int
special_requests string
promotion_code string
total_price double
room_price double
tax_amount double
service_fee double
paid_amount double
discount_amount double
payment_status string
payment_method string
data_source string
silver_load_at timestamp
""")

DIM_HOTEL = _table("""
hotel_id string
hotel_name string
country string
city string
hotel_type string
star_rating string
total_rooms string
hotel_facilities string
nearby_attractions string
latitude double
longitude double
website string
""")

DIM_CITY = _table("""
city_name string
country string
latitude double
longitude double
hotel_count bigint!
city_id string!
""")

DIM_CUSTOMER = _table("""
customer_id string
first_name string
last_name string
full_name string
email string
phone string
birth_date string
gender string
country string
city string
address string
postal_code string
language_preference string
loyalty_level string
registration_date string
marketing_consent string
""")

KPI_REVENUE = _table("""
booking_year int
booking_month int
hotel_city string
hotel_country string
total_bookings bigint!
confirmed_bookings bigint
cancelled_bookings bigint
gross_revenue double
collected_revenue double
total_discounts double
avg_booking_value double
total_nights bigint
avg_stay_nights double
unique_customers bigint!
active_hotels bigint!
cancellation_rate double
revenue_rank int!
""")

GOLD_TABLES = {
    "fact_booking": FACT_BOOKING,
    "dim_hotel": DIM_HOTEL,
    "dim_city": DIM_CITY,
    "dim_customer": DIM_CUSTOMER,
    "kpi_revenue": KPI_REVENUE,
}


class ContractError(ValueError):
    """A frame does not have the columns or types its table declares."""


def check_contract(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Return ``df`` unchanged if names, order, types and NOT NULLs agree.

    Looks at the analysed schema only; runs no job.
    """
    have = [(f.name, f.dataType.simpleString()) for f in df.schema]
    want = [(f.name, f.dataType.simpleString()) for f in contract]
    if have != want:
        wrong = [f"{h} instead of {w}" for h, w in zip(have, want) if h != w]
        raise ContractError(f"{len(have)} columns for {len(want)}; " + "; ".join(wrong))
    loose = [f.name for f, d in zip(contract, df.schema) if not f.nullable and d.nullable]
    if loose:
        raise ContractError(f"may be null but must not: {loose}")
    return df


def with_missing_as_null(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add the string columns of ``columns`` that ``df`` lacks, as nulls."""
    from pyspark.sql import functions as F

    lacking = [c for c in columns if c not in df.columns]
    return df.withColumns({c: F.lit(None).cast("string") for c in lacking}) if lacking else df
