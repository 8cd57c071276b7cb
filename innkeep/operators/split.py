"""Exact positions in a sorted order without sorting rows into one place.

The row at a given position is found by counting: rows are counted per
distinct key (combined on the map side, so a hot key is one count), the counts
are range-partitioned and written, and only the folder of the range that holds
the position is read. The split itself is then a comparison with that key.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from innkeep.session import scratch_path

BATCH, STREAM = "batch", "stream"

# Rows a task writes out for one group of identical rows.
_CHUNK = 100_000


# Distinct keys that one task sorts; a range with more is ranged again.
_PART_KEYS = 1_000_000


class _Counted:
    """Row counts per distinct key, range-partitioned by the key (nulls last).

    The counts are written once, a folder per range, with the size of each range
    kept aside; a position is then looked up in its folder alone.
    """

    def __init__(self, counts: DataFrame, columns: Sequence[str]):
        self.columns = list(columns)
        ranged = counts.repartitionByRange(*self._order()).withColumn("_part", F.spark_partition_id())
        spark = counts.sparkSession
        path = scratch_path(spark, "counts")
        ranged.write.partitionBy("_part").parquet(path)
        self.frame = spark.read.schema(ranged.schema).parquet(path)
        # One row per range.
        sizes = self.frame.groupBy("_part").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("keys"))
        self.parts = sorted((r["_part"], r["n"], r["keys"]) for r in sizes.collect())
        self.total = sum(n for _, n, _ in self.parts)

    @classmethod
    def of(cls, df: DataFrame, columns: Sequence[str]) -> "_Counted":
        return cls(df.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")), columns)

    def _order(self) -> list[Column]:
        return [F.col(f"`{c}`").asc_nulls_last() for c in self.columns]

    def _part_of(self, position: int) -> tuple[int, int, int]:
        before = 0
        for part, n, keys in self.parts:
            if before + n > position:
                break
            before += n
        return part, before, keys

    def at(self, positions: Sequence[int]) -> list[Row]:
        """For 0-based positions the keys there, with ``_n`` rows and ``_before`` rows
        before. One read of the folders they lie in."""
        found = {p: self._part_of(p) for p in positions}
        large = {part for part, _, keys in found.values() if keys > _PART_KEYS and len(self.parts) > 1}
        near = {p: x for p, x in found.items() if x[0] not in large}
        out: dict[int, Row] = {}
        if near:
            begins = {part: before for part, before, _ in near.values()}
            start = F.element_at(F.create_map(*[F.lit(x).cast("bigint") for kv in begins.items() for x in kv]), F.col("_part").cast("bigint"))
            window = Window.partitionBy("_part").orderBy(*self._order())
            running = F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, 0))
            rows = self.frame.where(F.col("_part").isin(*begins)).withColumn("_before", running - F.col("_n") + start)
            holds = [(F.col("_before") <= p) & (F.col("_before") + F.col("_n") > p) for p in near]
            for row in rows.where(reduce(Column.__or__, holds)).collect():
                out |= {p: row for p in near if row["_before"] <= p < row["_before"] + row["_n"]}
        for part in sorted(large):
            inside = _Counted(self.frame.where(F.col("_part") == part).drop("_part"), self.columns)
            mine = {p: before for p, (q, before, _) in found.items() if q == part}
            for p, row in zip(mine, inside.at([p - before for p, before in mine.items()])):
                out[p] = Row(**{**row.asDict(), "_before": row["_before"] + mine[p]})
        return [out[p] for p in positions]


def order_statistics(df: DataFrame, column: str, shares: Sequence[float]) -> list:
    """Smallest value with at least ``share`` of the non-null values up to it. Runs jobs."""
    counted = _Counted.of(df.where(F.col(column).isNotNull()), [column])
    if counted.total == 0:
        return [None] * len(shares)
    ranks = [max(1, math.ceil(counted.total * s)) for s in shares]
    return [row[column] for row in counted.at([rank - 1 for rank in ranks])]


def _same(column: str, value, kind: str) -> Column:
    return F.col(f"`{column}`").eqNullSafe(F.lit(value).cast(kind))


def _before(column: str, value, kind: str) -> Column:
    """Sorts before ``value`` with nulls last."""
    it = F.col(f"`{column}`")
    if value is None:
        return it.isNotNull()
    return F.coalesce(it < F.lit(value).cast(kind), F.lit(False))


def chrono_split(
    df: DataFrame,
    share: float = 0.70,
    date: str = "booking_date",
    key: str = "booking_id",
    label: str = "split",
) -> DataFrame:
    """Label the first ``int(n * share)`` rows by (date, key) as batch, the rest as stream.

    Exact also within a day, within a key, and among identical rows: there the
    remaining columns decide, in their order. Runs a few narrow counting jobs;
    the returned frame is a filter on ``df``, which is read but not shuffled.
    Give it a written table if ``df`` is costly to compute.
    """
    kinds = dict(df.dtypes)
    if kinds[date] != "date":
        raise TypeError(f"{date} is {kinds[date]}; the split goes by days")
    # Bounded by the calendar: one row per day.
    days = df.groupBy(date).agg(F.count(F.lit(1)).alias("_n"))
    by_day = Window.orderBy(F.col(date).asc_nulls_last())
    running = F.sum("_n").over(by_day.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("_n").over(Window.partitionBy())
    cut = F.floor(total.cast("double") * F.lit(float(share)))
    edge = (
        days.select(date, "_n", running.alias("_upto"), cut.alias("_cut"))
        .where((F.col("_upto") > F.col("_cut")) & (F.col("_upto") - F.col("_n") <= F.col("_cut")))
        .first()
    )
    if edge is None:  # no rows at all, or all of them in the first part
        return df.withColumn(label, F.lit(BATCH))

    in_first = _before(date, edge[date], kinds[date])
    tied = _same(date, edge[date], kinds[date])
    position = edge["_cut"] - (edge["_upto"] - edge["_n"])
    others = [c for c in df.columns if c not in (date, key)]
    group = None
    for columns in ([key], others):
        if position == 0 or not columns:
            break
        group = _Counted.of(df.where(tied).select(*columns), columns).at([position])[0]
        for c in columns:
            in_first = in_first | (tied & _before(c, group[c], kinds[c]))
            tied = tied & _same(c, group[c], kinds[c])
        position -= group["_before"]

    labelled = df.withColumn(label, F.when(in_first, BATCH).otherwise(STREAM))
    if position == 0:
        return labelled
    # The cut falls among identical rows. Which of them go first cannot be
    # seen, only how many: write that many of each, in chunks over many tasks.
    copies = group["_n"]
    chunks = F.sequence(F.lit(0).cast("bigint"), F.lit((copies - 1) // _CHUNK).cast("bigint"))
    first_of = F.col("_chunk") * _CHUNK
    last_of = F.least(first_of + _CHUNK, F.lit(copies).cast("bigint")) - 1
    identical = (
        df.where(tied).limit(1)
        .withColumn("_chunk", F.explode(chunks))
        .repartition("_chunk")
        .withColumn("_i", F.explode(F.sequence(first_of, last_of)))
        .withColumn(label, F.when(F.col("_i") < position, BATCH).otherwise(STREAM))
        .select(*labelled.columns)
    )
    return labelled.where(~tied).unionByName(identical)


def split_ranges(labelled: DataFrame, date: str = "booking_date", label: str = "split") -> DataFrame:
    """Rows, first and last date of each part."""
    return labelled.groupBy(label).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.min(date).alias("first_date"),
        F.max(date).alias("last_date"),
    )


def check_no_overlap(ranges: DataFrame, label: str = "split") -> None:
    """Raise if a batch date lies after a stream date. Collects the two range rows."""
    by_part = {r[label]: r for r in ranges.collect()}
    batch, stream = by_part.get(BATCH), by_part.get(STREAM)
    if batch and stream and batch["last_date"] > stream["first_date"]:
        raise ValueError(
            f"batch ends {batch['last_date']}, stream starts {stream['first_date']}"
        )
