"""Look-ups and joins with the landed weather and currency tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.functions import name, values_sql
from innkeep.functions.text import upper_trim

# Coordinates of the cities with forecasts.
CITY_COORDINATES = [
    ("Amsterdam", 52.3676, 4.9041),
    ("London", 51.5074, -0.1278),
    ("Paris", 48.8566, 2.3522),
    ("Berlin", 52.5200, 13.4050),
    ("Barcelona", 41.3851, 2.1734),
    ("Rome", 41.9028, 12.4964),
    ("Vienna", 48.2082, 16.3738),
    ("Prague", 50.0755, 14.4378),
]

# Currencies kept from a rate payload.
CURRENCIES = ["USD", "GBP", "TRY", "CHF", "JPY", "AUD", "CAD", "SEK", "NOK", "DKK"]
BASE_CURRENCY = "EUR"


def coordinates(spark: SparkSession) -> DataFrame:
    return spark.sql(values_sql(CITY_COORDINATES, "city, latitude, longitude"))


def cities_to_fetch(bookings: DataFrame, city: str = "city") -> DataFrame:
    """The coordinate rows whose city occurs in ``bookings``; all if none does.

    The names are compared as they stand. The filter is pushed to the scan and
    at most one row per known city leaves it, whatever the size of the table:
    few enough to broadcast.
    """
    known = coordinates(bookings.sparkSession)
    names = [name for name, _, _ in CITY_COORDINATES]
    booked = bookings.where(F.col(city).isin(*names)).select(F.col(city).alias("city")).distinct()
    return known if booked.isEmpty() else known.join(F.broadcast(booked), "city", "left_semi")


def cities_of_table(spark: SparkSession, table: str) -> DataFrame:
    """``cities_to_fetch`` of a table; all cities if it cannot be read."""
    try:
        return cities_to_fetch(spark.read.table(table))
    except AnalysisException:
        return coordinates(spark)


def newest_rates(rates: DataFrame) -> DataFrame:
    """One row per currency: the rate of its latest date."""
    return rates.groupBy("currency_code").agg(
        F.max_by("rate_vs_eur", F.struct("rate_date", "rate_vs_eur")).alias("rate_vs_eur")
    )


def convert_prices(
    bookings: DataFrame,
    rates: DataFrame,
    currency: str,
    price: str = "total_price",
    as_column: str = "converted_price",
) -> DataFrame:
    """Price in the currency of each row; null where no rate is known.

    The rates are broadcast: filtered to ten codes and grouped by code, there
    cannot be more than ten rows.
    """
    known = newest_rates(rates.where(F.col("currency_code").isin(*CURRENCIES)))
    known = known.select(F.col("currency_code").alias("_code"), F.col("rate_vs_eur").alias("_rate"))
    joined = bookings.join(F.broadcast(known), F.col(currency) == F.col("_code"), "left")
    rate = F.when(F.col(currency) == BASE_CURRENCY, F.lit(1.0)).otherwise(F.col("_rate"))
    return joined.withColumn(as_column, F.col(price) * rate).drop("_code", "_rate")


def newest_forecast(weather: DataFrame) -> DataFrame:
    """One row per city and day: of overlapping forecasts, the last that was landed."""
    measures = ["temperature_2m_max", "temperature_2m_min", "rain_sum", "windspeed_10m_max"]
    newest = weather.groupBy(
        F.expr(upper_trim("city")).alias("_city"), F.expr("try_cast(time as date)").alias("_day")
    ).agg(F.max(F.struct("ingestion_timestamp", *measures)).alias("_w"))
    return newest.select("_city", "_day", *[f"_w.{m}" for m in measures])


def with_weather(
    bookings: DataFrame, weather: DataFrame, city: str = "city", day: str = "checkin_date"
) -> DataFrame:
    """Forecast for the check-in day, null where there is none.

    An equi-join without a hint: the optimizer broadcasts the forecasts while
    they are below its size limit. Beyond it, both sides are shuffled and a
    city-day that holds many bookings is split by adaptive execution, which is
    sound because the forecast side has one row per city-day.
    """
    forecast = newest_forecast(weather)
    matches = (F.expr(upper_trim(name(city))) == forecast["_city"]) & (F.col(day) == forecast["_day"])
    return bookings.join(forecast, matches, "left").drop("_city", "_day")
