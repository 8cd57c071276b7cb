"""Batch ingest and the union of the two sources."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.contracts import BATCH_TAG, STREAM_TAG
from innkeep.operators.columns import tag_source
from innkeep.sources.files import read_bookings_csv
from innkeep.sources.tables import assert_row_count, write_table


def ingest_batch(
    spark: SparkSession,
    path: str,
    table: str,
    schema: T.StructType | None = None,
    multi_line: bool = True,
    fmt: str = "parquet",
) -> int:
    """CSV to bronze table; raises if the table does not hold the rows that were read.

    Broken records are rows too, with their text in ``_corrupt_record``.
    """
    written = write_table(read_bookings_csv(spark, path, schema, multi_line), table, fmt)
    assert_row_count(spark, written, table)
    return written


def unify(batch: DataFrame, stream: DataFrame, as_of: datetime | None = None) -> DataFrame:
    """Both sources by column name, tagged; a column one of them lacks is null there.

    Columns of different types become text.
    """
    kinds = dict(stream.dtypes)
    differ = [c for c, kind in batch.dtypes if kinds.get(c, kind) != kind]
    batch, stream = (df.withColumns({c: F.col(c).cast("string") for c in differ}) for df in (batch, stream))
    return tag_source(batch, BATCH_TAG, as_of).unionByName(
        tag_source(stream, STREAM_TAG, as_of), allowMissingColumns=True
    )


def source_distribution(unified: DataFrame) -> DataFrame:
    return unified.groupBy("_source").agg(F.count(F.lit(1)).alias("row_count"))
