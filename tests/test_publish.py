"""Snapshots, and silver kept up to date by batches."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from innkeep.contracts import BATCH_TAG, BOOKING_COLUMNS, STREAM_TAG
from innkeep.operators import quality
from innkeep.operators.cleaning import tag_rejects
from innkeep.plans.silver import combine, of_tagged
from innkeep.sources.snapshots import ConflictError, QualityError, Snapshots, publish_table
from innkeep.streaming.silver import SilverStream

from conftest import rows

SUITE = [quality.not_null("id"), quality.between("price", 0, 10)]


@pytest.fixture
def table(spark, tmp_path):
    return Snapshots(spark, f"file://{tmp_path}/table")


def prices(spark, *values):
    return spark.createDataFrame([(k, v) for k, v in enumerate(values)], "id int, price double")


def test_versions(spark, table):
    assert table.version() is None
    with pytest.raises(FileNotFoundError):
        table.read()
    table.write(prices(spark, 1.0), SUITE)
    old = table.read()
    table.write(prices(spark, 2.0, 3.0), SUITE)
    assert rows(table.read()) == [(0, 2.0), (1, 3.0)] and table.version().rows == 2
    assert rows(table.read(1)) == rows(old) == [(0, 1.0)]
    table.write(spark.createDataFrame([("x",)], "other string"))  # another schema
    assert rows(table.read()) == [("x",)]


def test_failed_check_publishes_nothing(spark, table):
    table.write(prices(spark, 1.0), SUITE)
    with pytest.raises(QualityError) as failed:
        table.write(prices(spark, 1.0, 11.0), SUITE)
    assert failed.value.failed == [(quality.BETWEEN, "price")]
    assert rows(table.read()) == [(0, 1.0)] and table.version().number == 1


def test_failed_write_publishes_nothing(spark, table):
    table.write(prices(spark, 1.0), SUITE)
    with pytest.raises(PySparkException):
        table.write(prices(spark, 2.0, 0.0).withColumn("price", F.expr("if(price = 0, raise_error('lost'), price)")))
    assert rows(table.read()) == [(0, 1.0)] and table.version().number == 1


def test_lost_writer_of_the_log(spark, table):
    """A log file that was begun and not completed is no version, and in nobody's way."""
    table.write(prices(spark, 1.0))
    table._files().create(table._path("_log", f"{2:020d}.json"), False).close()
    assert table.version().number == 1 and rows(table.read()) == [(0, 1.0)]
    assert table.write(prices(spark, 5.0)).number == 3
    assert rows(table.read()) == [(0, 5.0)]


def test_two_writers(spark, table):
    first = table.write(prices(spark, 1.0))
    part = table.stage(prices(spark, 2.0))
    table.write(prices(spark, 3.0))
    with pytest.raises(ConflictError):
        table.publish({"all": part}, table.staged(part).schema, (), first)
    with pytest.raises(ConflictError):
        table._commit(first)
    assert rows(table.read()) == [(0, 3.0)]


def test_vacuum_keeps_what_is_read(spark, table):
    for v in (1.0, 2.0, 3.0):
        table.write(prices(spark, v))
    table.stage(prices(spark, 9.0))  # of a writer that was lost
    assert table.vacuum(keep=2, older_than=3600) == 0
    assert table.vacuum(keep=2, older_than=-5) == 2
    assert rows(table.read(2)) == [(0, 2.0)] and rows(table.read()) == [(0, 3.0)]


def test_view(spark, tmp_path):
    for v in (1.0, 2.0):
        publish_table(spark, prices(spark, v), f"file://{tmp_path}/seen", SUITE, "published_prices")
        assert rows(spark.table("published_prices")) == [(0, v)]


# ---- silver by batches ---------------------------------------------------------


def booking(number, **other):
    row = dict.fromkeys(BOOKING_COLUMNS)
    row |= dict(
        booking_id=f"b{number}", booking_date="2024-01-02", checkin_date="2024-02-01", checkout_date="2024-02-03",
        hotel_name="h", city="Rome", total_price="10",
    )
    return tuple((row | other).values())


HALF = [booking(k) for k in range(6)] + [booking(1, booking_date="2024-01-09", city="Paris"), booking(7, city=None)]
BATCHES = [
    [booking(2, booking_date="2024-03-01", total_price="99999"), booking(20), booking(20)],  # its survivor is an outlier now
    [booking(0, booking_date="2023-01-01"), booking(20, total_price="12"), booking(30, hotel_name=None), booking(None, booking_id=None)],
    [booking(3, checkout_date="2024-01-01", booking_date="x"), booking(40)],
]


def frame(spark, data):
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in BOOKING_COLUMNS))


def same(got, want):
    columns = sorted(c for c in want.columns if c != "silver_load_at")
    assert rows(got.select(*columns)) == rows(want.select(*columns))


@pytest.mark.parametrize("compact_after", [(), (0, 2)])
def test_batches_equal_a_whole_run(spark, tmp_path, compact_after):
    silver = SilverStream(spark, f"file://{tmp_path}/silver", buckets=4)
    assert silver.absorb(frame(spark, HALF), 0, BATCH_TAG, "files")
    for n, data in enumerate(BATCHES):
        assert silver.absorb(frame(spark, data).drop("promotion_code"), n)
        if n in compact_after:
            silver.compact()
        for again in range(n + 1):  # replayed
            assert not silver.absorb(frame(spark, BATCHES[again]), again)
        seen = [r for b in BATCHES[:n + 1] for r in b]
        whole = of_tagged(combine(frame(spark, HALF), frame(spark, seen).drop("promotion_code")))
        same(silver.tagged(), whole.tagged)
        same(silver.bookings(), whole.bookings)
        assert rows(silver.audit()) == rows(whole.audit)


def test_compaction_leaves_other_buckets(spark, tmp_path):
    silver = SilverStream(spark, f"file://{tmp_path}/silver", buckets=16)
    silver.absorb(frame(spark, HALF), 0)
    before = silver.compact().parts
    silver.absorb(frame(spark, [booking(1, booking_date="2025-01-01")]), 1)
    after = silver.compact().parts
    moved = {k for k in before if k.startswith("bucket/") and after[k] != before[k]}
    assert len(moved) == 1 and not [k for k in after if k.startswith("batch/")]
    assert silver.compact().parts == after  # nothing new


def test_batch_lost_before_it_is_published(spark, tmp_path, monkeypatch):
    silver = SilverStream(spark, f"file://{tmp_path}/silver", buckets=4)
    silver.absorb(frame(spark, HALF), 0, BATCH_TAG, "files")
    with monkeypatch.context() as lost:
        lost.setattr(Snapshots, "_commit", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            silver.absorb(frame(spark, BATCHES[0]), 0)
    assert silver.table.version().rows == 7
    assert silver.absorb(frame(spark, BATCHES[0]), 0)
    same(silver.tagged(), tag_rejects(combine(frame(spark, HALF), frame(spark, BATCHES[0]))))


def test_stream_of_files(spark, tmp_path):
    silver = SilverStream(spark, f"file://{tmp_path}/silver", buckets=4)
    landing = tmp_path / "landing"
    schema = frame(spark, []).schema
    for n, data in enumerate(BATCHES):
        frame(spark, data).coalesce(1).write.mode("append").json(f"file://{landing}/{n}")
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"file://{landing}/*")
        silver.run(stream, f"file://{tmp_path}/checkpoint").awaitTermination()
    whole = tag_rejects(combine(frame(spark, []), frame(spark, [r for b in BATCHES for r in b])))
    same(silver.tagged(), whole)
    assert {r["data_source"] for r in silver.tagged().collect()} == {STREAM_TAG}
