"""Star schema and revenue cube out of silver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.contracts import FACT_BOOKING
from innkeep.functions.casts import to_boolean_or_null, to_double_or_null, to_int_or_null
from innkeep.functions.text import surrogate_key
from innkeep.operators.dedup import latest_attributes

_MONEY = [
    "total_price", "room_price", "tax_amount", "service_fee", "paid_amount", "discount_amount",
]


def fact_booking(silver: DataFrame) -> DataFrame:
    """One row per booking. A projection; ``stay_nights`` is the source's own ``nights``."""
    derived = {
        "booking_year": "year(booking_date)",
        "booking_month": "month(booking_date)",
        "stay_nights": to_int_or_null("nights"),
        "is_cancelled": to_boolean_or_null("is_cancelled"),
        **{m: to_double_or_null(m) for m in _MONEY},
        # Renamed in gold.
        "customer_name": "full_name",
        "customer_country": "country_customer",
        "customer_city": "city_customer",
        "loyalty_level": "loyalty_level_customer",
        "hotel_country": "country",
        "hotel_city": "city",
    }
    return silver.selectExpr(*[f"{derived.get(c, c)} as {c}" for c in FACT_BOOKING.names])


def dim_hotel(silver: DataFrame) -> DataFrame:
    """One row per hotel, with its attributes as of the latest booking date."""
    attributes = [
        "hotel_id", "hotel_name", "country", "city", "hotel_type", "star_rating",
        "total_rooms", "hotel_facilities", "nearby_attractions", "latitude", "longitude",
        "website",
    ]
    rows = silver.select(*attributes, "booking_date")
    return latest_attributes(rows, "hotel_id", attributes, "booking_date").withColumns({
        c: F.expr(to_double_or_null(c)) for c in ("latitude", "longitude")
    })


def dim_city(silver: DataFrame) -> DataFrame:
    """One row per (city, country) with mean position, hotels and an MD5 key."""
    return (
        silver.where("city is not null and city <> ''")
        .groupBy(F.col("city").alias("city_name"), "country")
        .agg(
            F.expr(f"avg({to_double_or_null('latitude')})").alias("latitude"),
            F.expr(f"avg({to_double_or_null('longitude')})").alias("longitude"),
            F.expr("count(distinct hotel_id)").alias("hotel_count"),
        )
        .withColumn("city_id", F.expr(surrogate_key("city_name", "country")))
    )


def dim_customer(silver: DataFrame) -> DataFrame:
    """One row per customer, with the attributes as of the latest booking date."""
    attributes = [
        "customer_id", "first_name", "last_name", "full_name", "email", "phone",
        "birth_date", "gender", "country_customer", "city_customer", "address",
        "postal_code", "language_preference", "loyalty_level_customer",
        "registration_date", "marketing_consent",
    ]
    rows = silver.select(*attributes, "booking_date")
    return latest_attributes(rows, "customer_id", attributes, "booking_date").withColumnsRenamed({
        "country_customer": "country",
        "city_customer": "city",
        "loyalty_level_customer": "loyalty_level",
    })


def count_where(condition: str) -> str:
    """Rows for which the condition is true; unknown counts as not true."""
    return f"count_if({condition})"


def aggregate(df: DataFrame, by: Sequence[str], measures: dict[str, str]) -> DataFrame:
    return df.groupBy(*by).agg(*[F.expr(text).alias(c) for c, text in measures.items()])


def kpi_revenue(fact: DataFrame) -> DataFrame:
    """Monthly revenue per hotel city, with cancellation rate and rank in the month.

    A booking whose cancellation flag is null is in neither of the two counts.
    The two distinct counts are exact: ids are made distinct per group on the
    map side and spread by id, so a city with a third of all bookings is not
    counted in one task. The rank works on the groups only. It ranks the revenue in
    cents: the last digits of a sum of doubles depend on the order of addition, and
    equal revenues must tie in every run.
    """
    groups = aggregate(fact, ["booking_year", "booking_month", "hotel_city", "hotel_country"], {
        "total_bookings": "count(booking_id)",
        "confirmed_bookings": count_where("not is_cancelled"),
        "cancelled_bookings": count_where("is_cancelled"),
        "gross_revenue": "sum(total_price)",
        "collected_revenue": "sum(paid_amount)",
        "total_discounts": "sum(discount_amount)",
        "avg_booking_value": "avg(total_price)",
        "total_nights": "sum(stay_nights)",
        "avg_stay_nights": "avg(stay_nights)",
        "unique_customers": "count(distinct customer_id)",
        "active_hotels": "count(distinct hotel_id)",
    })
    rank = "rank() over (partition by booking_year, booking_month order by round(gross_revenue, 2) desc)"
    return groups.selectExpr(
        "*", f"{cancellation_rate()} as cancellation_rate", f"{rank} as revenue_rank"
    )


def cancellation_rate(cancelled: str = "cancelled_bookings", total: str = "total_bookings") -> str:
    """Percentage, rounded half up to two digits; null for an empty total."""
    return f"round(try_divide({cancelled}, {total}) * 100, 2)"
