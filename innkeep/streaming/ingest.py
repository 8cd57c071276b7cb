"""Booking events: JSON in, bronze table out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from innkeep.sources.tables import COMPRESSION

CORRUPT = "_corrupt_record"


def _with_corrupt(schema: T.StructType) -> T.StructType:
    """A copy with the column that takes events which are not JSON."""
    if CORRUPT in schema.names:
        return schema
    return T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])


def read_event_files(
    spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None
) -> DataFrame:
    """Stream of JSON files, one event per line; bad lines keep their text."""
    reader = spark.readStream.schema(_with_corrupt(schema)).option("encoding", "UTF-8")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def read_kafka(spark: SparkSession, servers: str, topic: str, schema: T.StructType) -> DataFrame:
    """Stream of a Kafka topic whose values are JSON events."""
    records = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .load()
    )
    return decode_events(records, schema)


def decode_events(records: DataFrame, schema: T.StructType, value: str = "value") -> DataFrame:
    """JSON text or bytes to columns, for a stream or a batch alike."""
    event = F.from_json(
        F.col(value).cast("string"),
        _with_corrupt(schema),
        {"columnNameOfCorruptRecord": CORRUPT},
    )
    return records.select(event.alias("_event")).select("_event.*")


def append_files(
    df: DataFrame, path: str, checkpoint: str, name: str | None = None
) -> StreamingQuery:
    """Append to a folder of Parquet files until the input at hand is used up."""
    writer = (
        df.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
    )
    return (writer.queryName(name) if name else writer).start(path)


def append_table(
    df: DataFrame, table: str, checkpoint: str, fmt: str = "parquet", continuous: str | None = None
) -> StreamingQuery:
    """Append to a table: once through the input, or every ``continuous`` interval."""
    writer = (
        df.writeStream.format(fmt).outputMode("append")
        .option("compression", COMPRESSION).option("checkpointLocation", checkpoint)
    )
    writer = writer.trigger(processingTime=continuous) if continuous else writer.trigger(availableNow=True)
    return writer.toTable(table)


def late_events(query: StreamingQuery) -> int:
    """Events a stateful step of the run has dropped because they came too late.

    A step after another one sees what that one has let through, so none counts
    twice. Spark keeps the last ``spark.sql.streaming.numRecentProgressUpdates``
    batches.
    """
    return sum(
        step["numRowsDroppedByWatermark"] for batch in query.recentProgress for step in batch["stateOperators"]
    )


def drop_repeats(
    df: DataFrame,
    keys: Sequence[str],
    event_time: str,
    delay: str = "1 day",
    spread_by: str | None = None,
    spread: int = 32,
) -> DataFrame:
    """First event per key; repeats that come within ``delay`` of it are dropped.

    So is an event that comes more than ``delay`` after the latest one, even if its
    key is new: the state that could tell is gone. ``late_events`` counts them.

    Stateful de-duplication shuffles whole events by key. Where one key may
    send a large part of them, ``spread_by`` names a column that differs among
    its repeats and stays the same on a replay (offset, event number): repeats
    are then dropped in ``spread`` separate groups first, so that at most that
    many events per key, and not all, meet in one task.
    """
    timed = df.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(
        event_time, delay
    )
    if spread_by is None:
        return timed.dropDuplicatesWithinWatermark(list(keys))
    return (
        timed.withColumn("_group", F.pmod(F.xxhash64(spread_by), F.lit(spread)))
        .dropDuplicatesWithinWatermark([*keys, "_group"])
        .drop("_group")
        .dropDuplicatesWithinWatermark(list(keys))
    )
