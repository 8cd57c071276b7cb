"""Whole runs: split of the raw file, and bronze to quality report."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.operators.cleaning import REASON
from innkeep.operators.columns import schema_report
from innkeep.operators.quality import run_suite, silver_suite, suite_report
from innkeep.operators.recovery import recover_dates, recovered, unrecoverable
from innkeep.operators.split import BATCH, STREAM, check_no_overlap, chrono_split, split_ranges
from innkeep.plans import gold
from innkeep.plans.bronze import unify
from innkeep.plans.silver import of_tagged, united
from innkeep.session import scratch_path
from innkeep.sources.files import write_csv, write_report
from innkeep.sources.tables import write_files, write_gold, write_table


def split_raw(spark: SparkSession, raw: DataFrame, out: str, share: float = 0.70) -> DataFrame:
    """Recover dates and write ``batch``, ``stream`` and ``rejected`` CSV folders below ``out``.

    Returns rows and date range of the two parts. The recovered rows are
    written once; counting and splitting read that copy.
    """
    path = scratch_path(spark, "recovered")
    write_files(recover_dates(raw), path)
    dated = spark.read.parquet(path)
    parts = chrono_split(recovered(dated), share)
    ranges = split_ranges(parts)
    check_no_overlap(ranges)
    order = [F.asc_nulls_last("booking_date"), F.asc_nulls_last("booking_id")]
    for part in (BATCH, STREAM):
        # Files in the order of their days and ids, rows in it within each file.
        rows = parts.where(parts["split"] == part).drop("split")
        write_csv(rows.repartitionByRange(*order).sortWithinPartitions(*order), f"{out}/{part}")
    write_csv(unrecoverable(dated), f"{out}/rejected")
    return ranges


@dataclass
class Build:
    """What a run wrote, and its small reports (still lazy)."""

    rows: dict[str, int] = field(default_factory=dict)
    schemas: DataFrame | None = None
    audit: DataFrame | None = None
    quality: DataFrame | None = None


def build_all(
    spark: SparkSession,
    batch_table: str,
    stream_table: str,
    report_path: str | None = None,
    fmt: str = "parquet",
) -> Build:
    """Unified bronze, silver with rejects, gold, quality report.

    The duplicate step, the only wide shuffle of whole rows, runs once: its
    outcome is a table partitioned by reject reason. Silver reads the partition
    without a reason; the audit reads two narrow columns. Whether a failed
    expectation stops what comes next is for the caller to decide.
    """
    batch, stream = spark.read.table(batch_table), spark.read.table(stream_table)
    done = Build(schemas=schema_report(batch, stream))
    # The two sources as they are; counted from file footers.
    done.rows[batch_table], done.rows[stream_table] = batch.count(), stream.count()
    done.rows["bronze_unified_bookings"] = write_table(
        unify(batch, stream), "bronze_unified_bookings", fmt
    )
    # Both branches of the rejects, and the search for surplus rows, read the one table.
    combined = united(spark.read.table("bronze_unified_bookings"))
    write_table(of_tagged(combined).tagged, "silver_tagged", fmt, partition_by=[REASON])
    views = of_tagged(combined, spark.read.table("silver_tagged"))
    done.rows["silver_bookings"] = write_table(views.bookings, "silver_bookings", fmt)
    done.rows["silver_rejects"] = write_table(views.rejects, "silver_rejects", fmt)
    done.audit = views.audit

    silver = spark.read.table("silver_bookings")
    done.rows["fact_booking"] = write_gold(gold.fact_booking(silver), "fact_booking", fmt)
    for name, make in (
        ("dim_hotel", gold.dim_hotel), ("dim_city", gold.dim_city), ("dim_customer", gold.dim_customer),
    ):
        done.rows[name] = write_gold(make(silver), name, fmt)
    fact = spark.read.table("gold.fact_booking")
    done.rows["kpi_revenue"] = write_gold(gold.kpi_revenue(fact), "kpi_revenue", fmt)

    done.quality = run_suite(silver, silver_suite(silver.columns), with_total=True)
    if report_path:
        write_report(suite_report(done.quality, "silver_bookings"), report_path)
    return done
