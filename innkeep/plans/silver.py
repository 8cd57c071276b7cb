"""Bronze to silver: union, reject rules in order, typing, standard text."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.contracts import BATCH_TAG, BOOKING_COLUMNS, DATE_COLUMNS, SILVER_VERSION, STREAM_TAG
from innkeep.contracts import with_missing_as_null
from innkeep.functions import name
from innkeep.functions.casts import int_or_zero, to_date_or_null, to_double_or_null
from innkeep.functions.text import (
    BOOKING_STATUSES, ROOM_TYPES, map_category, squeeze_spaces, upper_trim,
)
from innkeep.operators.cleaning import accepted, audit, rejected, stay_days, tag_rejects
from innkeep.operators.columns import load_time
from innkeep.session import scratch_path
from innkeep.sources.tables import write_files


@dataclass(frozen=True)
class Silver:
    """Three views of one tagged frame."""

    tagged: DataFrame
    bookings: DataFrame
    rejects: DataFrame
    audit: DataFrame


def as_text(df: DataFrame) -> DataFrame:
    """Booking columns as text: a reader that has inferred types must not decide how
    the two sources unite, or what a cast of theirs fails on."""
    kinds = dict(df.dtypes)
    return _replaced(df, {
        c: f"cast({name(c)} as string)" for c in BOOKING_COLUMNS if kinds.get(c, "string") != "string"
    })


def combine(batch: DataFrame, stream: DataFrame) -> DataFrame:
    """Both bronze sources as text with ``data_source``; all booking columns present."""
    both = as_text(batch).withColumn("data_source", F.lit(BATCH_TAG)).unionByName(
        as_text(stream).withColumn("data_source", F.lit(STREAM_TAG)), allowMissingColumns=True
    )
    return with_missing_as_null(both, BOOKING_COLUMNS)


def united(unified: DataFrame) -> DataFrame:
    """``combine`` of a written unified bronze table, whose ``_source`` tells the two apart."""
    rows = as_text(unified).withColumn(
        "data_source", F.when(F.col("_source") == STREAM_TAG, STREAM_TAG).otherwise(BATCH_TAG)
    )
    return with_missing_as_null(rows, BOOKING_COLUMNS)


def written_rows(combined: DataFrame) -> DataFrame:
    """The united rows from a written copy. The rejects take two branches over them, and
    the one of incomplete rows is then a scan that prunes by null counts."""
    path = scratch_path(combined.sparkSession, "unified")
    write_files(combined, path)
    return combined.sparkSession.read.schema(combined.schema).parquet(path)


def _replaced(df: DataFrame, values: dict[str, str]) -> DataFrame:
    """One projection: the columns of ``df`` with some replaced and the new ones added."""
    columns = [
        f"{values[c]} as {name(c)}" if c in values else name(c)
        for c in [*df.columns, *[v for v in values if v not in df.columns]]
    ]
    return df.selectExpr(*columns)


def typed(df: DataFrame) -> DataFrame:
    """Dates, price and number of guests out of text."""
    adults, children, infants = (int_or_zero(c) for c in ("adults", "children", "infants"))
    return _replaced(df, {
        **{c: to_date_or_null(c) for c in DATE_COLUMNS},
        "total_price": to_double_or_null("total_price"),
        "num_guests": f"try_add(try_add({adults}, {children}), {infants})",
    })


def standardized(df: DataFrame) -> DataFrame:
    """Names in upper case, single blanks in the guest's name, known categories."""
    values = {c: upper_trim(c) for c in ("hotel_name", "city", "country")}
    values["full_name"] = squeeze_spaces("full_name")
    values["room_type"] = map_category("room_type", ROOM_TYPES)
    if "booking_status" in df.columns:
        values["booking_status"] = map_category("booking_status", BOOKING_STATUSES)
    return _replaced(df, values)


def finish(rows: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Accepted raw rows to silver rows. A projection."""
    return standardized(typed(rows)).withColumns({
        "stay_duration_days": F.expr(stay_days("checkin_date", "checkout_date")),
        "silver_load_at": load_time(as_of),
        "silver_version": F.lit(SILVER_VERSION),
    })


def to_silver(batch: DataFrame, stream: DataFrame, as_of: datetime | None = None) -> Silver:
    """Lazy. Write ``tagged`` once and use ``of_tagged`` on the table to build all views."""
    return of_tagged(combine(batch, stream), None, as_of)


def to_silver_from(
    combined: DataFrame, as_of: datetime | None = None, within: Sequence[str] = (), rows: DataFrame | None = None
) -> Silver:
    """The same of united rows; ``within`` and ``rows`` as in ``tag_rejects``."""
    return of_tagged(combined.drop(*within), tag_rejects(combined, within, rows), as_of, rows)


def of_tagged(
    combined: DataFrame, tagged: DataFrame | None = None, as_of: datetime | None = None, rows: DataFrame | None = None
) -> Silver:
    tagged = tag_rejects(combined, rows=rows) if tagged is None else tagged
    return Silver(
        tagged=tagged,
        bookings=finish(accepted(tagged), as_of),
        rejects=rejected(combined, tagged, rows),
        audit=audit(tagged),
    )
