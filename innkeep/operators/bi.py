"""Default summary of a gold table: group by its attributes, add up its measures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Numbers that have no meaning when added up, by gold table.
NOT_ADDITIVE = {
    "fact_booking": ["booking_year", "booking_month"],
    "dim_hotel": ["latitude", "longitude"],
    "dim_city": ["latitude", "longitude"],
    "dim_customer": [],
    "kpi_revenue": [
        "booking_year", "booking_month", "avg_booking_value", "avg_stay_nights",
        "unique_customers", "active_hotels", "cancellation_rate", "revenue_rank",
    ],
}

_NUMBERS = (T.IntegerType, T.LongType, T.DoubleType)


def default_measures(contract: T.StructType) -> list[str]:
    """Numeric columns are summed by default, all others are attributes."""
    return [f.name for f in contract if isinstance(f.dataType, _NUMBERS)]


def summarize(
    df: DataFrame,
    table: str,
    dims: Sequence[str],
    measures: Sequence[str] | None = None,
    additive_only: bool = True,
) -> DataFrame:
    """``sum`` of each measure per ``dims``.

    Without ``measures`` all numeric columns that are not in ``dims`` are
    summed; of a table without any, the groups alone come out. ``additive_only`` leaves out those whose sum means nothing, and
    refuses them when they are asked for by name; with False they are summed.
    """
    refused = NOT_ADDITIVE[table] if additive_only else []
    if measures is None:
        measures = [
            c for c in default_measures(df.schema) if c not in dims and c not in refused
        ]
    bad = [m for m in measures if m in refused]
    if bad:
        raise ValueError(f"sums of {bad} have no meaning")
    if not measures:
        return df.select(*dims).distinct()
    return df.groupBy(*dims).agg(*[F.sum(m).alias(m) for m in measures])


def subtotals(df: DataFrame, table: str, sets: Sequence[Sequence[str]], measures: Sequence[str] | None = None) -> DataFrame:
    """The default sums of several groupings in one pass over the table.

    ``sets`` lists the groupings, ``()`` the total. ``grouping_id`` tells them apart:
    bit i, from the left, is 1 where the i-th dimension is summed over, so a null of
    the data is not taken for a subtotal.
    """
    dims = list(dict.fromkeys(c for s in sets for c in s))
    refused = NOT_ADDITIVE[table]
    if measures is None:
        measures = [c for c in default_measures(df.schema) if c not in dims and c not in refused]
    bad = [m for m in measures if m in refused]
    if bad:
        raise ValueError(f"sums of {bad} have no meaning")
    return df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in dims]).agg(
        F.grouping_id().alias("grouping_id"), *[F.sum(m).alias(m) for m in measures]
    )
