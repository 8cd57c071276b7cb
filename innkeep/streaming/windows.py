"""Event-time windows that lose no event: what comes too late goes to a table of its own.

``split_late`` deals each batch to folders of events in time and events that are
late, by the watermark before the batch. A window query reads the events in time.
Its own watermark is never ahead of the one they were dealt by, so it drops none:
every event is in a window or in the late table, once.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from innkeep.functions import name as quoted_name
from innkeep.sources.snapshots import Snapshots

IN_TIME, LATE, NO_TIME = "in_time", "late", "no_time"


class SplitLate:
    """Events below ``root``: ``in_time``, ``late`` and ``no_time`` (a null event time),
    a folder per batch. ``delay`` is in seconds; an event is late if its time lies more
    than that before the latest time of earlier batches."""

    def __init__(self, spark: SparkSession, root: str, event_time: str, delay: int, schema: T.StructType):
        self.root, self.event_time, self.delay, self.schema = root.rstrip("/"), event_time, delay, schema
        self.store = Snapshots(spark, root)
        self.spark = spark

    def _mark(self, batch: int) -> dict | None:
        """What the log says of a batch."""
        path, files = self.store._path("_marks", f"{batch}.json"), self.store._files()
        if not files.exists(path):
            return None
        stream = files.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _move(self, source: str, target: str) -> None:
        files = self.store._files()
        to = self.store._path(target)
        files.mkdirs(to.getParent())
        if not files.exists(to):
            files.rename(self.store._path(source), to)

    def absorb(self, rows: DataFrame, batch: int) -> None:
        """Deal one micro-batch. It is written aside in one pass and then moved, so a batch
        that comes again finds its folders there, or makes the same ones."""
        if self._mark(batch) is not None:
            return
        before = self._mark(batch - 1) if batch else {"latest": None}
        if before is None:
            raise RuntimeError(f"{self.root}: batch {batch - 1} was not dealt here")
        latest = before["latest"]
        time = F.col(quoted_name(self.event_time)).cast("timestamp")
        micros = F.unix_micros(time)
        bound = latest - self.delay * 1_000_000 if latest is not None else None
        side = F.when(micros.isNull(), NO_TIME).when(micros < F.lit(bound), LATE).otherwise(IN_TIME) if bound is not None else (
            F.when(micros.isNull(), NO_TIME).otherwise(IN_TIME)
        )
        seen = Observation(f"latest-{uuid.uuid4().hex}")
        folder = f"_staged/{uuid.uuid4().hex}"
        dealt = rows.withColumn(self.event_time, time).withColumn("_side", side)
        dealt.observe(seen, F.max(F.unix_micros(quoted_name(self.event_time))).alias("latest")).write.partitionBy("_side").parquet(
            f"{self.root}/{folder}"
        )
        for side_name in (IN_TIME, LATE, NO_TIME):
            made = f"{folder}/_side={side_name}"
            if self.store._files().exists(self.store._path(made)):
                self._move(made, f"{side_name}/batch={batch}")
        now = seen.get["latest"]
        known = [x for x in (latest, now) if x is not None]
        path = self.store._path("_marks", f"{batch}.json")
        out = self.store._files().create(path, True)
        try:
            out.write(bytearray(json.dumps({"latest": max(known) if known else None}).encode()))
        finally:
            out.close()

    def run(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        return (
            stream.writeStream.foreachBatch(lambda rows, number: self.absorb(rows, number))
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
        )

    def _kinds(self) -> T.StructType:
        return T.StructType([
            T.StructField(f.name, T.TimestampType() if f.name == self.event_time else f.dataType) for f in self.schema
        ])

    def stream(self) -> DataFrame:
        """The events in time, as a stream with the watermark they were dealt by."""
        self.store._files().mkdirs(self.store._path(IN_TIME))
        rows = self.spark.readStream.schema(self._kinds()).option("recursiveFileLookup", True).parquet(f"{self.root}/{IN_TIME}")
        return rows.withWatermark(self.event_time, f"{self.delay} seconds")

    def table(self, side: str = LATE) -> DataFrame:
        """The events of one side so far."""
        self.store._files().mkdirs(self.store._path(side))
        return self.spark.read.schema(self._kinds()).option("recursiveFileLookup", True).parquet(f"{self.root}/{side}")


def sessions(events: DataFrame, keys: list[str], event_time: str, gap: str, measures: dict[str, str]) -> DataFrame:
    """Runs of events of a key with less than ``gap`` between neighbours.

    On a stream a session comes out once the watermark has passed its end. Events
    are merged into sessions within a task before they are shuffled, so a hot key
    sends its sessions and not its events.
    """
    found = events.groupBy(F.session_window(event_time, gap).alias("_s"), *keys).agg(
        *[F.expr(text).alias(c) for c, text in measures.items()]
    )
    return found.select(*keys, F.col("_s.start").alias("session_start"), F.col("_s.end").alias("session_end"), *measures)


def sliding(
    events: DataFrame, keys: list[str], event_time: str, length: str, slide: str, measures: dict[str, str]
) -> DataFrame:
    """Windows of ``length`` that begin every ``slide``, per key; partial sums before the shuffle."""
    found = events.groupBy(F.window(event_time, length, slide).alias("_w"), *keys).agg(
        *[F.expr(text).alias(c) for c, text in measures.items()]
    )
    return found.select(*keys, F.col("_w.start").alias("window_start"), F.col("_w.end").alias("window_end"), *measures)
