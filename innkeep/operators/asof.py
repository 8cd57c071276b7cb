"""Look-ups in time by equal keys: rates as of a day, weather over a stay, versions in force.

None of these is a range join. What is looked up is laid out on the calendar, whose
length does not grow with the bookings, and a booking looks up one day (or two).
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from innkeep.functions import name
from innkeep.functions.text import upper_trim
from innkeep.operators.enrich import BASE_CURRENCY, CURRENCIES, newest_forecast

# Calendars up to this number of rows are broadcast: 27 years of eight cities, some 8 MB.
BROADCAST_ROWS = 80_000


def _bounds(df: DataFrame, day: str) -> tuple[date | None, date | None]:
    return tuple(df.agg(F.min(day), F.max(day)).first())


def _clipped(day: Column, low: date, high: date) -> Column:
    """The day, or the nearest of the two bounds; null for a null."""
    return F.when(day.isNotNull(), F.greatest(F.least(day, F.lit(high)), F.lit(low)))


def _with(df: DataFrame, joined: DataFrame, **values: Column) -> DataFrame:
    """The columns of ``df`` as they are, some replaced or added; nothing else."""
    kept = [df[name(c)] for c in df.columns if c not in values]
    return joined.select(*kept, *[v.alias(c) for c, v in values.items()])


# ---- rates -----------------------------------------------------------------------


def rate_calendar(rates: DataFrame) -> DataFrame:
    """``_code, _day, _rate``: for each currency and day, from its first rate to the last
    day of any, the rate of that day or else the last one before.

    At most one row per currency and day. Of several rates of a day the greatest counts.
    """
    known = rates.where(F.col("currency_code").isin(*CURRENCIES)).groupBy("currency_code", "rate_date").agg(
        F.max("rate_vs_eur").alias("rate")
    )
    _, last = _bounds(known, "rate_date")
    following = F.lead("rate_date").over(Window.partitionBy("currency_code").orderBy("rate_date"))
    until = F.coalesce(F.date_sub(following, 1), F.lit(last).cast("date"))
    return known.withColumn("until", until).select(
        F.col("currency_code").alias("_code"), F.explode(F.sequence("rate_date", "until")).alias("_day"), F.col("rate").alias("_rate")
    )


def convert_as_of(
    bookings: DataFrame, rates: DataFrame, currency: str, day: str, price: str = "total_price", as_column: str = "converted_price",
) -> DataFrame:
    """Price in the currency of each row, at the last rate on or before ``day``.

    Null where there is none yet, or where the day is null. Days after the last rate
    take that one. Columns of the bookings are kept, whatever their names.
    """
    _, last = _bounds(rates, "rate_date")
    looked_up = F.least(bookings[name(day)], F.lit(last).cast("date"))
    calendar = rate_calendar(rates)
    same = (bookings[name(currency)] == calendar["_code"]) & (looked_up == calendar["_day"]) & bookings[name(day)].isNotNull()
    joined = bookings.join(calendar, same, "left")
    rate = F.when(bookings[name(currency)] == BASE_CURRENCY, F.lit(1.0)).otherwise(calendar["_rate"])
    return _with(bookings, joined, **{as_column: bookings[name(price)] * rate})


# ---- sums over intervals -----------------------------------------------------------


def running_totals(days: DataFrame, keys: list[str], day: str, measures: list[str], low: date, high: date) -> DataFrame:
    """For each key and each day from the one before ``low`` to ``high``: the sums of the
    measures, and of the days that have them, up to and with that day.

    Sums are exact decimals, so a difference of two of them has no rounding error.
    A window holds one key's calendar, however many rows look it up.
    """
    first = F.date_sub(F.lit(low), 1)
    calendar = days.select(*keys).distinct().withColumn(day, F.explode(F.sequence(first, F.lit(high))))
    window = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    totals = [F.sum(F.coalesce(F.col(name(m)).cast("decimal(28,6)"), F.lit(0))).over(window).alias(f"_sum_{m}") for m in measures]
    counts = [F.count(name(m)).over(window).alias(f"_n_{m}") for m in measures]
    return calendar.join(days, [*keys, day], "left").select(*keys, day, *totals, *counts)


def weather_over_stay(
    bookings: DataFrame, weather: DataFrame, city: str = "city", arrives: str = "checkin_date", leaves: str = "checkout_date",
) -> DataFrame:
    """``nights_known``, ``rain_total`` and ``avg_temp_max`` over the nights of a stay.

    Two look-ups of running totals, whatever the length of the stay; no night is a row
    of its own. Nights without a forecast do not count; without any, the count is 0
    and the measures are null. The optimizer cannot know how small the totals are, so
    their rows are counted, and up to ``BROADCAST_ROWS`` of them are broadcast: no stay
    is shuffled then.
    """
    rain, warm = "rain_sum", "temperature_2m_max"
    days = newest_forecast(weather).where("_city is not null and _day is not null")
    low, high, cities = days.agg(F.min("_day"), F.max("_day"), F.count_distinct("_city")).first()
    if low is None:
        return bookings.withColumns({
            "nights_known": F.lit(0).cast("bigint"), "rain_total": F.lit(None).cast("double"), "avg_temp_max": F.lit(None).cast("double"),
        })
    totals = running_totals(days.select("_city", "_day", rain, warm), ["_city"], "_day", [rain, warm], low, high)
    small = cities * ((high - low).days + 2) <= BROADCAST_ROWS
    here, out = F.expr(upper_trim(name(city))), bookings
    # Up to the night before the stay, and up to its last night.
    for side, column in (("a", arrives), ("b", leaves)):
        mine = totals.select(*[F.col(c).alias(f"_{side}{c}") for c in totals.columns])
        night = _clipped(F.date_sub(F.col(name(column)), 1), low - timedelta(days=1), high)
        out = out.join(F.broadcast(mine) if small else mine, (here == F.col(f"_{side}_city")) & (night == F.col(f"_{side}_day")), "left")
    n = lambda m: F.col(f"_b_n_{m}") - F.col(f"_a_n_{m}")
    total = lambda m: F.when(n(m) > 0, (F.col(f"_b_sum_{m}") - F.col(f"_a_sum_{m}")).cast("double"))
    return _with(
        bookings, out, nights_known=F.coalesce(n(rain), F.lit(0)).cast("bigint"), rain_total=total(rain), avg_temp_max=total(warm) / n(warm),
    )


# ---- versions in force --------------------------------------------------------------


def validity(rows: DataFrame, key: str, attributes: list[str], day: str) -> DataFrame:
    """``key``, attributes, ``valid_from``, ``valid_to``, ``is_current``: the history of each key.

    A day's attributes are the greatest variant seen on it. A version lasts until the
    day before the next one that differs; the last one has no ``valid_to``. Variants
    are counted out first, so a hot key comes to its window with one row a day.
    Null keys and days have no history.
    """
    named = [name(a) for a in attributes]
    variants = rows.where(f"{name(key)} is not null and {name(day)} is not null").select(name(key), name(day), *named).distinct()
    of_day = variants.groupBy(name(key), F.col(name(day)).alias("valid_from")).agg(F.max(F.struct(*named)).alias("_row"))
    window = Window.partitionBy(name(key)).orderBy("valid_from")
    changed = of_day.withColumn("_last", F.lag("_row").over(window)).where("_last is null or not (_row <=> _last)")
    following = F.lead("valid_from").over(window)
    return changed.select(
        name(key), *[f"_row.{a}" for a in named], "valid_from",
        F.date_sub(following, 1).alias("valid_to"), following.isNull().alias("is_current"),
    )


def in_force(facts: DataFrame, history: DataFrame, key: str, day: str, attributes: list[str], period: str = "month") -> DataFrame:
    """The facts with the attributes of their key, as of ``day``, as ``{attribute}_then``, and
    ``valid_from``. Null before the first version.

    Versions are laid out on the periods they touch, and a fact looks up its key and
    period: an equi-join in which it meets the few versions of that period.
    """
    unit = {"month": "MM", "year": "YYYY"}[period]
    _, high = _bounds(facts, name(day))
    until = F.coalesce("valid_to", F.greatest("valid_from", F.lit(high).cast("date")))
    laid = history.select(
        F.col(name(key)).alias("_key"), F.col("valid_from").alias("_from"), until.alias("_to"),
        *[F.col(name(a)).alias(f"_{a}") for a in attributes],
        F.explode(F.sequence(F.trunc("valid_from", unit), F.trunc(until, unit), F.expr(f"interval 1 {period}"))).alias("_period"),
    )
    on = facts[name(day)]
    same = (facts[name(key)] == laid["_key"]) & (F.trunc(on, unit) == laid["_period"]) & (on >= laid["_from"]) & (on <= laid["_to"])
    return _with(facts, facts.join(laid, same, "left"), valid_from=F.col("_from"), **{f"{a}_then": F.col(f"_{a}") for a in attributes})
