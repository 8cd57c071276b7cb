"""The cleaning rules: profiles, reject reasons, audit.

Every rule is a boolean expression on the raw row. The first rule a row
breaks is its reject reason, so one pass over the data gives the clean rows,
the rejected rows and the audit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.contracts import CRITICAL_COLUMNS, DATE_COLUMNS
from innkeep.functions import name, quoted, stacked, values_sql
from innkeep.functions.casts import to_date_or_null, to_double_or_null
from innkeep.operators.dedup import keep_latest, packed_rows, surplus_rows, unpacked_rows
from innkeep.operators.split import order_statistics

# Bounds of a believable booking. The prices are exclusive.
PRICE_ABOVE, PRICE_BELOW, LONGEST_STAY = 0.0, 50000.0, 365

NULL_CRITICAL, DUPLICATE, BAD_DATE, DATE_LOGIC, OUTLIER = (
    "null_critical", "duplicate", "bad_date", "date_logic", "outlier",
)

# Steps in the order they apply, with the note of the audit.
STEPS = [
    (NULL_CRITICAL, "a critical column is null"),
    (DUPLICATE, "another row has the same booking_id"),
    (BAD_DATE, "a date cannot be read"),
    (DATE_LOGIC, "check-out is not after check-in"),
    (OUTLIER, "price or length of stay is out of bounds"),
]

REASON, COPIES = "reject_reason", "rows_of_booking"
# Of packed rows: no critical value is null.
COMPLETE = "_complete"


def any_null(columns: Sequence[str]) -> str:
    return "(" + " or ".join(f"{name(c)} is null" for c in columns) + ")"


def stay_days(checkin: str, checkout: str) -> str:
    return f"datediff({checkout}, {checkin})"


def believable(price: str, stay: str) -> str:
    """False also where the price is null."""
    return (
        f"coalesce({price} > {PRICE_ABOVE}D and {price} < {PRICE_BELOW}D "
        f"and {stay} <= {LONGEST_STAY}, false)"
    )


def null_profile(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    """Nulls per column, one row each, from a single aggregate."""
    counts = df.selectExpr("count(*) as _rows", *[f"count({name(c)}) as {name('_' + c)}" for c in columns])
    rows = [f"{quoted(c)}, _rows - {name('_' + c)}, _rows" for c in columns]
    return counts.selectExpr(stacked(rows, "column_name, nulls, total_rows"))


def drop_nulls(df: DataFrame, columns: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    return df.dropna(subset=list(columns))


def keep_forward_stays(df: DataFrame) -> DataFrame:
    """Typed rows whose check-out is after check-in, with ``stay_duration_days``."""
    stay = stay_days("checkin_date", "checkout_date")
    return df.where(f"{stay} > 0").selectExpr("*", f"{stay} as stay_duration_days")


def keep_believable(df: DataFrame) -> DataFrame:
    return df.where(believable("total_price", "stay_duration_days"))


def price_flags(df: DataFrame, price: str = "total_price") -> DataFrame:
    """How many prices are not positive, and how many are above the bound.

    A price equal to the bound is in neither number although the filter drops it.
    """
    return df.selectExpr(
        f"count_if({name(price)} <= {PRICE_ABOVE}D) as non_positive",
        f"count_if({name(price)} > {PRICE_BELOW}D) as above_bound",
    )


def price_profile(df: DataFrame, price: str = "total_price", exact: bool = False) -> DataFrame:
    """Minimum, quartiles 1 and 3, maximum.

    By default quartiles come from mergeable sketches in one pass. ``exact``
    runs the distributed selection instead; it never brings the prices together
    in one task as an exact percentile aggregate would.
    """
    if not exact:
        return df.selectExpr(
            f"min({price}) as min",
            f"percentile_approx({price}, 0.25D) as p25",
            f"percentile_approx({price}, 0.75D) as p75",
            f"max({price}) as max",
        )
    low, q1, q3, high = order_statistics(df, price, [0.0, 0.25, 0.75, 1.0])
    return df.sparkSession.sql(values_sql([(low, q1, q3, high)], "min, p25, p75, max"))


def packed_bookings(df: DataFrame) -> DataFrame:
    """Raw rows as ``packed_rows`` for the duplicate step, with the flag ``COMPLETE``; their text
    holds all columns but the id. Rows that are not complete may be left out."""
    flagged = df.selectExpr("*", f"not {any_null(CRITICAL_COLUMNS)} as {COMPLETE}")
    return packed_rows(flagged, ["booking_id"], ["booking_date"], [COMPLETE])


def unpacked_bookings(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return unpacked_rows(rows.drop(COMPLETE), columns, ["booking_id"], ["booking_date"])


def tag_rejects(df: DataFrame, within: Sequence[str] = (), rows: DataFrame | None = None) -> DataFrame:
    """Raw rows after the duplicate step, with reject reason and copies.

    ``reject_reason`` is null for rows that pass. ``rows_of_booking`` is the
    number of raw rows a surviving booking stands for. Rows without a critical
    value skip the duplicate step, so null ids do not pile up in one group.
    Values stay as text: a rejected row can be read as it arrived. ``within`` are columns
    that the id determines, for the duplicate step; they are not kept. ``rows`` are the
    complete ``packed_bookings`` of ``df`` from a copy at hand.
    """
    incomplete = any_null(CRITICAL_COLUMNS)
    nulls = df.drop(*within).where(incomplete).selectExpr(
        "*", f"1L as {COPIES}", f"{quoted(NULL_CRITICAL)} as {REASON}"
    )
    survivors = keep_latest(
        df.where(f"not {incomplete}"), ["booking_id"], ["booking_date"], count_as=COPIES, within=within, rows=rows
    )
    return nulls.unionByName(judged(survivors))


def judged(survivors: DataFrame) -> DataFrame:
    """Complete rows, one a booking, with the reason that rejects them."""
    booked, arrives, leaves = (to_date_or_null(c) for c in DATE_COLUMNS)
    stay = stay_days(arrives, leaves)
    price = to_double_or_null("total_price")
    reason = f"""case
        when {booked} is null or {arrives} is null or {leaves} is null then {quoted(BAD_DATE)}
        when {stay} <= 0 then {quoted(DATE_LOGIC)}
        when not {believable(price, stay)} then {quoted(OUTLIER)} end"""
    return survivors.selectExpr("*", f"{reason} as {REASON}")


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where(f"{REASON} is null").drop(REASON, COPIES)


def rejected(df: DataFrame, tagged: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """Every raw row that is not in silver: distinct rows with reason and number.

    Only rows of bookings with several rows are compared with the survivors. ``rows`` as in
    ``tag_rejects``.
    """
    contested, candidates = tagged.where(f"{COPIES} > 1"), df.where(f"not {any_null(CRITICAL_COLUMNS)}")
    if rows is None:
        candidates = candidates.join(contested.select("booking_id"), "booking_id", "left_semi")
    duplicates = surplus_rows(candidates, contested, "row_count", ["booking_id"], ["booking_date"], rows).selectExpr(
        "*", f"{quoted(DUPLICATE)} as {REASON}"
    )
    others = tagged.where(f"{REASON} is not null").drop(COPIES).selectExpr("*", "1L as row_count")
    return duplicates.unionByName(others)


def audit(tagged: DataFrame) -> DataFrame:
    """Rows before, after and dropped per step, and the share still there.

    The counts are columns of the data, not side counters, so a task that runs
    twice does not count twice. One aggregate; five rows come out.
    """
    totals = tagged.selectExpr(
        f"coalesce(sum({COPIES}), 0) as raw",
        f"coalesce(sum({COPIES} - 1), 0) as {DUPLICATE}",
        *[f"count_if({REASON} = {quoted(r)}) as {r}" for r, _ in STEPS if r != DUPLICATE],
    )
    rows, left = [], "raw"
    for number, (step, note) in enumerate(STEPS, start=1):
        after = f"{left} - {step}"
        share = f"round(try_divide({after}, raw) * 100, 2)"
        rows.append(f"{number}, '{step}', {left}, {after}, {step}, {share}, {quoted(note)}")
        left = after
    names = "step_no, step, rows_before, rows_after, rows_dropped, retention_pct, note"
    return totals.selectExpr(stacked(rows, names))
