"""Booking dates out of dirty text, with the place each date came from."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.functions import name
from innkeep.functions.dates import MONTH_FIRST, DateFormat, clean_date_text, parse_any_date

# Provenance labels.
ORIGINAL = "original"
CLEANED = "booking_date_cleaned"
FROM_CHECKIN = "derived_from_checkin"
FROM_CHECKOUT = "derived_from_checkout"
UNRECOVERABLE = "unrecoverable"

SOURCE = "_date_recover_src"


def recover_dates(
    df: DataFrame,
    booking: str = "booking_date",
    checkin: str = "checkin_date",
    checkout: str = "checkout_date",
    primary: DateFormat = MONTH_FIRST,
) -> DataFrame:
    """Replace the booking text by a date and add where it came from.

    First the text as it stands in the primary format, any year; then cleaned,
    in all formats; then the check-in; then the check-out. A later place is
    parsed only for rows that need it.
    """
    out = df.withColumn("_original", F.expr(primary.parse(name(booking))))
    places = ["_original"]
    for place, column in (("_cleaned", booking), ("_checkin", checkin), ("_checkout", checkout)):
        missing = f"coalesce({', '.join(places)}) is null"
        text = f"case when {missing} then {clean_date_text(name(column))} end"
        # The cleaned text is its own column so that all formats share it.
        out = out.withColumn("_text", F.expr(text))
        out = out.withColumn(place, F.expr(parse_any_date("_text")))
        places.append(place)
    labels = (ORIGINAL, CLEANED, FROM_CHECKIN, FROM_CHECKOUT)
    whens = " ".join(f"when {p} is not null then '{label}'" for p, label in zip(places, labels))
    found = f"named_struct('_date', coalesce({', '.join(places)}), '{SOURCE}', case {whens} else '{UNRECOVERABLE}' end)"
    # Through ``inline`` the parsing is done once: a later filter on the outcome
    # is not rewritten into a filter on the texts, which would repeat each step
    # inside the next.
    kept = [f"_date as {name(c)}" if c == booking else name(c) for c in df.columns]
    return out.selectExpr("*", f"inline(array({found}))").selectExpr(*kept, SOURCE)


def recovered(df: DataFrame) -> DataFrame:
    return df.where(f"{SOURCE} <> '{UNRECOVERABLE}'")


def unrecoverable(df: DataFrame) -> DataFrame:
    return df.where(f"{SOURCE} = '{UNRECOVERABLE}'")


def recovery_histogram(df: DataFrame) -> DataFrame:
    return df.groupBy(SOURCE).agg(F.expr("count(*)").alias("row_count"))
