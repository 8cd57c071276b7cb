"""Landed API payloads (JSON text) to rows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.contracts import RATES_TAG, WEATHER_TAG
from innkeep.functions import name, quoted
from innkeep.operators.columns import load_time
from innkeep.operators.enrich import BASE_CURRENCY, CURRENCIES
from innkeep.sources.tables import write_table

# The daily series of a forecast.
DAILY_SERIES = {
    "time": "string",
    "temperature_2m_max": "double",
    "temperature_2m_min": "double",
    "rain_sum": "double",
    "windspeed_10m_max": "double",
}

_FORECAST = "daily struct<" + ",".join(f"{n}:array<{t}>" for n, t in DAILY_SERIES.items()) + ">"


# Of a payload that gives rows; unknown where it cannot be read.
_EVEN = " and ".join(
    f"(_daily.{n} is null or size(_daily.{n}) = size(_daily.time))" for n in DAILY_SERIES if n != "time"
) + " and _daily.time is not null"


def skipped_payloads(payloads: DataFrame, payload: str = "payload") -> DataFrame:
    """The payloads that ``flatten_weather`` takes no rows from, as they came."""
    read = f"from_json({name(payload)}, {quoted(_FORECAST)}).daily"
    return payloads.withColumn("_daily", F.expr(read)).where(f"not coalesce({_EVEN}, false)").drop("_daily")


def flatten_weather(
    payloads: DataFrame, payload: str = "payload", as_of: datetime | None = None
) -> DataFrame:
    """One row per city and forecast day from (city, latitude, longitude, payload).

    A series that is missing leaves its column null. A payload that cannot be
    read, has no days, or whose series differ in length gives no rows; the other
    cities go on, and ``skipped_payloads`` has it.
    """
    names = list(DAILY_SERIES)
    blank = "array_repeat(cast(null as double), size(_daily.time))"
    series = ["_daily.time" if n == "time" else f"coalesce(_daily.{n}, {blank})" for n in names]
    kinds = ",".join(f"{n}:{t}" for n, t in DAILY_SERIES.items())
    zipped = f"cast(arrays_zip({', '.join(series)}) as array<struct<{kinds}>>)"
    # The test sits inside the explode: as a filter it would be moved to the
    # text and parse every payload again for each of its parts.
    rows = payloads.selectExpr(
        "city", "latitude", "longitude",
        f"from_json({name(payload)}, {quoted(_FORECAST)}).daily as _daily",
    ).selectExpr("city", "latitude", "longitude", f"explode(case when {_EVEN} then {zipped} end) as _day")
    return rows.selectExpr(*[f"_day.{n} as {n}" for n in names], "city", "latitude", "longitude").withColumns({
        "ingestion_timestamp": load_time(as_of),
        "_source": F.lit(WEATHER_TAG),
    })


def flatten_rates(
    payloads: DataFrame,
    codes: Sequence[str] = CURRENCIES,
    payload: str = "payload",
    rate_date: str | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """One row per wanted currency and payload: code, rate against the base.

    ``rate_date`` names a column of ``payloads`` with the day of the rates;
    without it they count as of today.
    """
    rates = F.from_json(F.col(payload), "rates map<string,double>").getField("rates")
    day = F.current_date() if rate_date is None else F.col(rate_date).cast("date")
    return (
        payloads.select(day.alias("rate_date"), F.explode(rates).alias("currency_code", "rate_vs_eur"))
        .where(F.col("currency_code").isin(*codes))
        .select(
            "currency_code", "rate_vs_eur",
            F.lit(BASE_CURRENCY).alias("base_currency"),
            "rate_date",
            load_time(as_of).alias("extracted_at"),
            F.lit(RATES_TAG).alias("_source"),
        )
    )


def land_if_any(rows: DataFrame, table: str, fmt: str = "parquet") -> int:
    """Replace the table, unless there are no rows: then the old one stays."""
    return 0 if rows.isEmpty() else write_table(rows, table, fmt)
