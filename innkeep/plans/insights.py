"""Reports on the gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame

from innkeep.plans.gold import aggregate, cancellation_rate, count_where


def hotel_performance(fact: DataFrame) -> DataFrame:
    """Revenue, nights and average daily rate per hotel."""
    return aggregate(fact, ["hotel_id", "hotel_name"], {
        "total_bookings": "count(booking_id)",
        "gross_revenue": "sum(total_price)",
        "total_nights": "sum(stay_nights)",
        "average_daily_rate": "try_divide(sum(total_price), sum(stay_nights))",
    })


def lead_time(fact: DataFrame) -> DataFrame:
    """Days between booking and check-in per channel, with their exact median.

    The median's aggregate keeps a count for each number of days, of which there are
    few, and not the rows.
    """
    days = "datediff(checkin_date, booking_date)"
    return aggregate(fact, ["booking_channel"], {
        "total_bookings": "count(booking_id)",
        "avg_lead_days": f"avg({days})",
        "min_lead_days": f"min({days})",
        "max_lead_days": f"max({days})",
        "median_lead_days": f"percentile({days}, 0.5D)",
    })


def cancellation_trend(fact: DataFrame) -> DataFrame:
    """Bookings and cancelled bookings per month and stated reason."""
    counts = aggregate(fact, ["booking_year", "booking_month", "cancellation_reason"], {
        "total_bookings": "count(booking_id)",
        "cancelled_bookings": count_where("is_cancelled"),
    })
    return counts.selectExpr("*", f"{cancellation_rate()} as cancellation_rate")


def top_cities(kpi: DataFrame, k: int = 3) -> DataFrame:
    """The cities of rank ``k`` or better in each month; ties stay in."""
    return kpi.where(f"revenue_rank <= {int(k)}")
