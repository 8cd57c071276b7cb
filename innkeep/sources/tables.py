"""Managed tables, and the check that a write stored what it was given."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from innkeep.contracts import GOLD_TABLES, check_contract
from innkeep.session import scratch_path

GOLD, SCRATCH = "gold", "innkeep_scratch"
# Of files that hold rows of fifty text columns; a fifth to a third smaller than Spark's default.
COMPRESSION = "zstd"
# Of copies in place of a shuffle: packed rows take a tenth less than on Parquet's level, 3.
LEVEL = "9"
# Packed rows of a bucket that a task sorts in memory, and how many are worth a bucket or a file.
MOST_OF_A_BUCKET, ROWS_OF_A_BUCKET, ROWS_OF_A_FILE = 2_000_000, 250_000, 4_000


class RowCountError(RuntimeError):
    """The stored table does not have the rows that were written."""


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """Count the rows on their way into the sink.

    Sits directly below the sink, in the result stage, where Spark takes the
    metric of each task once even if the task had to run again. Further
    upstream a repeated map task would be counted twice.
    """
    seen = Observation(f"rows-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("n")), seen


def write_table(
    df: DataFrame,
    name: str,
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
) -> int:
    """Replace the table with its schema; returns the rows written, without a second scan.

    Rows of a partitioned table are first rebalanced on its partition columns:
    few files per partition, and one that holds much of the data is split.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    counted, seen = _counted(df)
    writer = counted.write.format(fmt).mode(mode).option("overwriteSchema", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.saveAsTable(name)
    return seen.get["n"]


def write_files(df: DataFrame, path: str, partition_by: Sequence[str] = (), dealt: bool = False) -> int:
    """The same to a folder of Parquet files that does not exist yet. Rows that are ``dealt``, few
    values of the partition columns to a task, are not rebalanced."""
    if partition_by and not dealt:
        df = df.hint("rebalance", *partition_by)
    counted, seen = _counted(df)
    writer = counted.write.option("compression", COMPRESSION)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return seen.get["n"]


def scratch_table(spark: SparkSession, name: str) -> str:
    """The name of a new table in a schema below the scratch folder."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {SCRATCH} LOCATION '{scratch_path(spark, 'tables')}'")
    return f"{SCRATCH}.{name}_{uuid.uuid4().hex}"


def write_spread(df: DataFrame, by: Sequence[str], buckets: int | None = None, rows: int | None = None) -> str:
    """Write the rows in buckets by ``by``, in place of a shuffle; returns what ``read_spread`` takes.

    What groups or joins the copy by these columns shuffles nothing. As compressed columns, wide
    rows of text take half of what they take in a shuffle. There are at most as many buckets as a
    shuffle has partitions, fewer if there are few ``rows``; a task writes one file a bucket, so
    with known ``rows`` there are no more tasks than files of some size need. Unlike before a
    shuffle, the rows of a key are not reduced by each task; so, where a bucket has more rows
    than a task should sort, the copy is read without its buckets, and what groups it shuffles as ever.
    """
    spark, path, table = df.sparkSession, scratch_path(df.sparkSession, "spread"), scratch_table(df.sparkSession, "spread")
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if rows is not None:
        n = min(n, 8 + rows // ROWS_OF_A_BUCKET)
        df = df.coalesce(8 + rows // (n * ROWS_OF_A_FILE))
    writer = df.write.option("compression", COMPRESSION).option("parquet.compression.codec.zstd.level", LEVEL)
    writer.option("path", path).bucketBy(n, *by).saveAsTable(table)
    bucket = F.pmod(F.hash(*by), F.lit(n))
    sizes = spark.read.table(table).dropna(subset=list(by)).groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    return table if largest <= MOST_OF_A_BUCKET else path


def read_spread(spark: SparkSession, written: str) -> DataFrame:
    """The rows of a folder, or of a table in the scratch schema."""
    return spark.read.table(written) if written.startswith(f"{SCRATCH}.") else spark.read.parquet(written)


def spread_rows(df: DataFrame, by: Sequence[str], buckets: int | None = None, rows: int | None = None) -> DataFrame:
    """The rows from a copy that ``write_spread`` makes now."""
    return read_spread(df.sparkSession, write_spread(df, by, buckets, rows))


def write_gold(df: DataFrame, name: str, fmt: str = "parquet", mode: str = "overwrite") -> int:
    """Write a gold table that meets its contract; returns its rows.

    The fact table is partitioned by booking year and month, which the monthly
    reports prune by.
    """
    df.sparkSession.sql(f"CREATE SCHEMA IF NOT EXISTS {GOLD}")
    by = ["booking_year", "booking_month"] if name == "fact_booking" else []
    return write_table(check_contract(df, GOLD_TABLES[name]), f"{GOLD}.{name}", fmt, by, mode)


def read_gold(spark: SparkSession, name: str) -> DataFrame:
    """A gold table with the columns in the order of its contract."""
    return spark.read.table(f"{GOLD}.{name}").select(*GOLD_TABLES[name].names)


def row_counts(written: int, stored: DataFrame) -> DataFrame:
    """Rows written, rows stored, whether they agree. The count reads file footers only."""
    return stored.agg(F.count(F.lit(1)).alias("rows_stored")).select(
        F.lit(written).cast("bigint").alias("rows_written"),
        "rows_stored",
        (F.col("rows_stored") == written).alias("agree"),
    )


def assert_row_count(spark: SparkSession, written: int, table: str) -> None:
    stored = spark.read.table(table).count()
    if stored != written:
        raise RowCountError(f"{table}: {written} rows written, {stored} stored")
