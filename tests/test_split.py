import pytest
from pyspark.sql import functions as F

from conftest import rows
from innkeep.operators.recovery import SOURCE, recover_dates, recovered, unrecoverable
from innkeep.operators import split
from innkeep.operators.split import check_no_overlap, chrono_split, order_statistics, split_ranges
from innkeep.plans.build import split_raw


def brute(df, share):
    """The same split by sorting everything in one place."""
    data = [tuple(r) for r in df.collect()]
    data.sort(key=lambda r: tuple((v is None, v if v is not None else "") for v in r))
    cut = int(len(data) * share)
    return sorted([(*r, "batch" if i < cut else "stream") for i, r in enumerate(data)], key=repr)


def bookings(spark, expression_day, expression_id, n=500):
    return spark.range(n).selectExpr(
        f"cast({expression_day} as date) as booking_date", f"{expression_id} as booking_id",
        "cast(id % 7 as string) as v",
    ).repartition(3)


@pytest.mark.parametrize("share", [0.7, 0.5, 0.01, 0.0, 1.0])
@pytest.mark.parametrize("day, key", [
    ("date_add(date'2024-01-01', cast(id % 40 as int))", "concat('B', id)"),
    # One day holds everything.
    ("date'2024-01-01'", "concat('B', id)"),
    # One day and one id hold most rows; only the other columns tell them apart.
    ("date'2024-01-01'", "if(id % 3 = 0, concat('A', id), 'hot')"),
    ("date'2024-01-01'", "if(id % 5 = 0, null, concat('B', id % 9))"),
])
def test_split_equals_a_global_sort(spark, day, key, share):
    df = bookings(spark, day, key)
    assert rows(chrono_split(df, share)) == brute(df, share)


def test_cut_among_identical_rows(spark):
    df = spark.range(1000).selectExpr("date'2024-01-01' as booking_date", "'same' as booking_id", "'x' as v")
    got = chrono_split(df, 0.7)
    assert rows(got.groupBy("split").count()) == [("batch", 700), ("stream", 300)]


def test_no_rows(spark):
    df = bookings(spark, "date'2024-01-01'", "'x'", n=0)
    assert chrono_split(df).count() == 0


def test_overlap_is_an_error(spark):
    df = bookings(spark, "date_add(date'2024-01-01', cast(id % 40 as int))", "concat('B', id)")
    parts = chrono_split(df)
    check_no_overlap(split_ranges(parts))
    swapped = parts.withColumn("split", F.when(F.col("split") == "batch", "stream").otherwise("batch"))
    with pytest.raises(ValueError):
        check_no_overlap(split_ranges(swapped))


def test_order_statistics(spark):
    df = spark.range(1, 102).selectExpr("if(id < 50, 7L, id) as v").union(spark.sql("select cast(null as bigint)"))
    values = sorted([7] * 49 + list(range(50, 102)))
    assert order_statistics(df, "v", [0.0, 0.25, 0.5, 0.75, 1.0]) == [7, 7, values[50], values[75], 101]
    assert order_statistics(df.where("v < 0"), "v", [0.5]) == [None]


def test_recovery_order(frame):
    df = frame("id booking_date checkin_date checkout_date", [
        ("1", "5/10/2025", "2025-06-01", None),
        ("2", "!!5/10/2025", "2025-06-01", None),
        ("3", "0000-00-00", "15.06.2025", None),
        ("4", None, "x", "20250620"),
        ("5", "  ", None, "1999-01-01"),
        # The primary format takes any year; the others do not.
        ("6", "5/10/1999", None, None),
    ])
    got = recover_dates(df)
    assert got.columns == [*df.columns, SOURCE]
    assert [(r["id"], str(r["booking_date"]), r[SOURCE]) for r in got.orderBy("id").collect()] == [
        ("1", "2025-05-10", "original"), ("2", "2025-05-10", "booking_date_cleaned"),
        ("3", "2025-06-15", "derived_from_checkin"), ("4", "2025-06-20", "derived_from_checkout"),
        ("5", "None", "unrecoverable"), ("6", "1999-05-10", "original")]
    assert recovered(got).count() == 5 and unrecoverable(got).count() == 1


def test_positions_in_ranges_that_are_ranged_again(spark, monkeypatch):
    monkeypatch.setattr(split, "_PART_KEYS", 20)
    df = spark.range(400).selectExpr("cast(id * 7 % 400 as string) as v", "id % 3 as w").union(spark.sql("select null, null"))
    counted = split._Counted.of(df, ["v"])
    ordered = sorted((r["v"] for r in df.collect()), key=lambda v: (v is None, v or ""))
    places = [0, 1, 57, 200, 399, 400]
    assert [(r["v"], r["_before"]) for r in counted.at(places)] == [(ordered[p], p) for p in places]


def test_the_split_goes_by_days(spark):
    with pytest.raises(TypeError):
        chrono_split(spark.sql("select timestamp'2024-01-01' as booking_date, 'x' as booking_id"))


def test_split_files_are_in_order(spark, frame, tmp_path):
    data = [(f"B{i:03d}", f"{1 + i % 12}/{1 + i * 5 % 28}/2025", None, None) for i in range(200)]
    split_raw(spark, frame("booking_id booking_date checkin_date checkout_date", data), str(tmp_path))
    for part in ("batch", "stream"):
        lines = [line for f in sorted((tmp_path / part).glob("part-*.csv")) for line in f.read_text().splitlines()[1:]]
        keys = [(x.split(",")[1], x.split(",")[0]) for x in lines]
        assert keys == sorted(keys)
