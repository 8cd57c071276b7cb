"""Windows over event time, late events beside them, counts on the stream."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from innkeep.streaming.counts import StreamCounter
from innkeep.streaming.ingest import append_files, append_table, late_events
from innkeep.streaming.windows import IN_TIME, LATE, NO_TIME, SplitLate, sessions, sliding

from conftest import rows

START = datetime(2024, 1, 1)
SCHEMA = "id int, who string, at timestamp"


def at(minutes):
    return START + timedelta(minutes=minutes)


def land(spark, folder, number, events):
    frame = spark.createDataFrame([(k, w, at(m) if m is not None else None) for k, w, m in events], SCHEMA)
    frame.coalesce(1).write.mode("append").parquet(f"file://{folder}/{number}")


# The second batch brings one event in time, though out of order, and two that are late.
FIRST = [(1, "a", 0), (2, "a", 5), (3, "b", 7), (4, "a", 60)]
SECOND = [(5, "a", 55), (6, "a", 20), (7, "b", 49), (8, "b", 200), (9, "a", None)]


@pytest.fixture
def dealt(spark, tmp_path):
    split = SplitLate(spark, f"file://{tmp_path}/events", "at", 600, spark.createDataFrame([], SCHEMA).schema)
    for n, events in enumerate((FIRST, SECOND)):
        land(spark, tmp_path / "landing", n, events)
        source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/landing/*")
        split.run(source, f"file://{tmp_path}/checkpoint").awaitTermination()
    return split


def ids(df):
    return sorted(r["id"] for r in df.collect())


def test_late_events_have_a_table(spark, dealt):
    assert ids(dealt.table(IN_TIME)) == [1, 2, 3, 4, 5, 8]
    assert ids(dealt.table(LATE)) == [6, 7]
    assert ids(dealt.table(NO_TIME)) == [9]


def test_a_batch_that_comes_again(spark, dealt):
    again = spark.createDataFrame([(k, w, at(m) if m is not None else None) for k, w, m in SECOND], SCHEMA)
    dealt.absorb(again, 1)
    assert ids(dealt.table(IN_TIME)) == [1, 2, 3, 4, 5, 8] and ids(dealt.table(LATE)) == [6, 7]


def test_a_batch_lost_between_move_and_mark(spark, dealt):
    dealt.store._files().delete(dealt.store._path("_marks", "1.json"), False)
    dealt.absorb(spark.createDataFrame([(k, w, at(m) if m is not None else None) for k, w, m in SECOND], SCHEMA), 1)
    assert ids(dealt.table(IN_TIME)) == [1, 2, 3, 4, 5, 8] and ids(dealt.table(LATE)) == [6, 7]


def drained(spark, stream, tmp_path, name):
    query = append_files(stream, f"file://{tmp_path}/{name}", f"file://{tmp_path}/{name}-checkpoint")
    query.awaitTermination()
    return query, spark.read.schema(stream.schema).parquet(f"file://{tmp_path}/{name}")


def test_sessions_drop_nothing(spark, dealt, tmp_path):
    measures = {"n": "count(*)", "last": "max(id)"}
    query, out = drained(spark, sessions(dealt.stream(), ["who"], "at", "10 minutes", measures), tmp_path, "sessions")
    assert late_events(query) == 0
    # Those that have ended by the watermark, ten minutes before the latest event.
    assert rows(out) == [("a", at(0), at(15), 2, 2), ("a", at(55), at(70), 2, 5), ("b", at(7), at(17), 1, 3)]
    whole = sessions(dealt.table(IN_TIME), ["who"], "at", "10 minutes", measures)
    assert rows(out) == rows(whole.where(F.col("session_end") <= F.lit(at(190))))
    states = [s["customMetrics"] for p in query.recentProgress for s in p["stateOperators"]]
    assert any(k.startswith("rocksdb") for m in states for k in m)


def test_sliding_windows(spark, dealt, tmp_path):
    _, out = drained(spark, sliding(dealt.stream(), ["who"], "at", "60 minutes", "30 minutes", {"n": "count(*)"}), tmp_path, "sliding")
    whole = sliding(dealt.table(IN_TIME), ["who"], "at", "60 minutes", "30 minutes", {"n": "count(*)"})
    want = rows(whole.where(F.col("window_end") <= F.lit(at(190))))
    assert rows(out) == want and ("a", at(30), at(90), 2) in want


def test_rows_are_counted_on_the_stream(spark, tmp_path):
    for n, events in enumerate((FIRST, SECOND)):
        land(spark, tmp_path / "landing", n, events)
    source = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"file://{tmp_path}/landing/*")
    with StreamCounter(spark) as counter:
        query = append_table(counter.counted(source), "counted_events", f"file://{tmp_path}/checkpoint")
        assert counter.rows_of(query) == 9 == spark.table("counted_events").count()
    assert sorted(counter.batches.values()) == [4, 5]
