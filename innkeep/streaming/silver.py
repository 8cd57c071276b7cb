"""Silver kept up to date batch by batch.

What the duplicate step keeps of a booking, its greatest row and the number of its
rows, can be merged: of two parts of the rows, the greater row and the sum. So a
batch is reduced by itself, and the work on it grows with the batch alone. Its
outcome is a part of a ``Snapshots`` table; the number of the batch is published
with it, so a batch that comes again changes nothing. Reading merges the bookings
that the batches since the last ``compact`` have touched; all others pass as they are,
unless the batches hold many rows: then one merge of all moves less than looking up.
Many rows are grouped in a packed copy that is spread by booking, in place of a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from innkeep.contracts import BOOKING_COLUMNS, CRITICAL_COLUMNS, STREAM_TAG, with_missing_as_null
from innkeep.functions import quoted
from innkeep.operators.cleaning import (
    COMPLETE, COPIES, NULL_CRITICAL, REASON, accepted, any_null, audit, judged, packed_bookings, unpacked_bookings,
)
from innkeep.operators.dedup import keep_latest, packed_rows
from innkeep.plans.silver import as_text, finish
from innkeep.sources.snapshots import ConflictError, Part, Snapshots, Version
from innkeep.sources.tables import spread_rows

COLUMNS = [*BOOKING_COLUMNS, "data_source"]
BUCKETS = 64
# New rows up to this number are looked up among the old ones by broadcast, and shuffled.
FEW = 100_000
# A compaction deals a bucket to its tasks in slots of about so many rows.
SLOT = 50_000
_COMPLETE = f"not {any_null(CRITICAL_COLUMNS)}"


def _bucket(buckets: int) -> str:
    return f"cast(pmod(xxhash64(booking_id), {buckets}) as int)"


class SilverStream:
    """``buckets`` groups of bookings: ``compact`` rewrites those that batches have touched."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.table, self.buckets = Snapshots(spark, root), buckets

    # -- writing --

    def absorb(
        self, rows: DataFrame, batch: int, source: str = STREAM_TAG, stream: str = "bookings", count: bool = True
    ) -> bool:
        """Add raw rows as batch number ``batch`` of a stream; False if they are there already.

        Batches of one stream come in the order of their numbers. Rows are counted to tell
        whether they are few; without ``count`` they are taken for many.
        """
        if self.table.done((stream, batch)):
            return False
        raw = with_missing_as_null(as_text(rows), BOOKING_COLUMNS).withColumn("data_source", F.lit(source)).select(*COLUMNS)
        nulls, complete, packed = raw.where(f"not ({_COMPLETE})"), raw.where(_COMPLETE), None
        size = raw.count() if count else None
        if size is None or size > FEW:
            copy = spread_rows(packed_bookings(raw), ["booking_id"], rows=size)
            nulls, packed = unpacked_bookings(copy.where(f"not {COMPLETE}"), COLUMNS), copy.where(COMPLETE)
        kept = keep_latest(complete, ["booking_id"], ["booking_date"], COPIES, rows=packed)
        part = self.table.stage(kept.unionByName(nulls.selectExpr("*", f"1L as {COPIES}")))
        self._add(part, f"batch/{stream}/{batch}", (stream, batch))
        return True

    def _add(self, part: Part, name: str, transaction: tuple[str, int], tries: int = 5) -> None:
        """Publish with one more part. It needs nothing of the others, so after a conflict
        with another stream it is tried again."""
        for left in reversed(range(tries)):
            now = self.table.version()
            try:
                schema = now.struct() if now else self.table.staged(part).schema
                self.table.publish({**(now.parts if now else {}), name: part}, schema, (), now, transaction)
                return
            except ConflictError:
                if not left:
                    raise

    def run(self, stream: DataFrame, checkpoint: str, name: str = "bookings", **trigger) -> StreamingQuery:
        """Absorb every micro-batch of a stream of raw bookings, by default what is at hand."""
        return (
            stream.writeStream.foreachBatch(lambda rows, number: self.absorb(rows, number, stream=name) and None)
            .option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
        )

    def compact(self) -> Version | None:
        """Merge the batches into the buckets that hold their bookings; other buckets stay
        the files they are."""
        now = self.table.version()
        batches = [k for k in now.parts if k.startswith("batch/")] if now else []
        if not batches:
            return now
        new = self.table.read(now.number, batches)
        touched = {r[0] for r in new.where(_COMPLETE).selectExpr(f"{_bucket(self.buckets)} as b").distinct().collect()}
        old = [f"bucket/{b}" for b in touched if f"bucket/{b}" in now.parts]
        rows = self.table.read(now.number, old).unionByName(new.where(_COMPLETE))
        size = sum(now.parts[k].rows for k in [*batches, *old])
        many = size > FEW
        if many:  # what is merged slot by slot comes out with few buckets to a task, and is written as it is
            slots = self.buckets * (1 + size // (self.buckets * SLOT))
            merged = self._merged(rows.selectExpr("*", f"{_bucket(slots)} as _slot"), size, ["_slot"])
        else:
            merged = self._merged(rows)
        merged = merged.selectExpr("*", f"{_bucket(self.buckets)} as _bucket")
        parts = {k: p for k, p in now.parts.items() if k not in batches and k not in old}
        written = self.table.stage(merged, ["_bucket"], dealt=many)
        sizes = {
            r["_bucket"]: r["n"]
            for r in self.table.staged(written).groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).collect()
        }
        schema = now.struct().json()
        parts |= {f"bucket/{b}": Part(f"{written.folder}/_bucket={b}", n, schema) for b, n in sizes.items()}
        parts[f"nulls/{now.number}"] = self.table.stage(new.where(f"not ({_COMPLETE})"))
        return self.table.publish(parts, now.struct(), (), now)

    @staticmethod
    def _merged(rows: DataFrame, many: int = 0, within: Sequence[str] = ()) -> DataFrame:
        """Of rows that are survivors of parts, one a booking. ``many`` are written for it now."""
        packed = None
        if many:
            packed = packed_rows(rows, ["booking_id"], ["booking_date"], [COPIES, *within])
            packed = spread_rows(packed, within or ["booking_id"], rows=many)
        kept = keep_latest(rows, ["booking_id"], ["booking_date"], "_copies", COPIES, within, packed)
        return kept.withColumnRenamed("_copies", COPIES)

    # -- reading --

    def tagged(self) -> DataFrame:
        """As ``tag_rejects`` of all rows so far."""
        now = self.table.version()
        names = list(now.parts)
        batches = [k for k in names if k.startswith("batch/")]
        new = self.table.read(now.number, batches)
        old = self.table.read(now.number, [k for k in names if k.startswith("bucket/")])
        changed = new.where(_COMPLETE)
        if sum(now.parts[k].rows for k in batches) <= FEW:
            ids = F.broadcast(changed.select(F.col("booking_id").alias("_id")).distinct())
            same = F.col("booking_id") == F.col("_id")
            touched = old.join(ids, same, "left_semi").unionByName(changed)
            kept = old.join(ids, same, "left_anti").unionByName(self._merged(touched))
        else:  # the look-ups would shuffle the old rows twice, unpacked
            kept = self._merged(old.unionByName(changed), now.rows)
        nulls = new.where(f"not ({_COMPLETE})").unionByName(
            self.table.read(now.number, [k for k in names if k.startswith("nulls/")])
        )
        return judged(kept).unionByName(nulls.selectExpr("*", f"{quoted(NULL_CRITICAL)} as {REASON}"))

    def bookings(self, as_of: datetime | None = None) -> DataFrame:
        """Silver of all rows so far."""
        return finish(accepted(self.tagged()), as_of)

    def audit(self) -> DataFrame:
        return audit(self.tagged())
