from datetime import datetime

from pyspark.sql import functions as F

from conftest import rows
from innkeep.contracts import BOOKING_COLUMNS, GOLD_TABLES, check_contract
from innkeep.operators import cleaning
from innkeep.operators.dedup import keep_latest, latest_attributes
from innkeep.plans import gold
from innkeep.plans.silver import combine, to_silver

AT = datetime(2025, 1, 1)

GOOD = {
    "booking_id": "B1", "booking_date": "2025-01-01", "checkin_date": "2025-02-01", "checkout_date": "2025-02-03",
    "hotel_name": " ritz ", "city": " paris", "country": "fr ", "total_price": "100.5", "full_name": " a  b ",
    "room_type": "dbl", "booking_status": "cnf", "adults": "2.0", "children": "x", "infants": None,
    "hotel_id": "H1", "customer_id": "C1", "nights": "2.0", "is_cancelled": "False",
    "paid_amount": "90", "discount_amount": "10.5", "latitude": "48.5", "longitude": "2.5",
}


def raw(spark, *changes):
    data = [tuple({**GOOD, **c}.get(n) for n in BOOKING_COLUMNS) for c in changes]
    return spark.createDataFrame(data, ", ".join(f"{c} string" for c in BOOKING_COLUMNS))


def reasons(spark, *changes):
    changes = [{"booking_id": f"B{i}", **c} for i, c in enumerate(changes)]
    tagged = cleaning.tag_rejects(combine(raw(spark, *changes), raw(spark)))
    return {r["booking_id"]: r[cleaning.REASON] for r in tagged.collect()}


def test_bounds(spark):
    got = reasons(
        spark,
        {"total_price": "0"}, {"total_price": "-1"}, {"total_price": "50000"}, {"total_price": "49999.99"},
        {"total_price": "99999"}, {"total_price": "abc"}, {"total_price": None},
        {"checkout_date": "2025-02-01"}, {"checkout_date": "2025-02-02"},
        {"checkout_date": "2026-02-01"}, {"checkout_date": "2026-02-02"},
        {"booking_date": "0000-00-00"}, {"booking_date": None}, {"city": None}, {"city": ""},
    )
    o, d = cleaning.OUTLIER, cleaning.DATE_LOGIC
    assert list(got[f"B{i}"] for i in range(15)) == [
        o, o, o, None, o, o, cleaning.NULL_CRITICAL, d, None, None, o,
        cleaning.BAD_DATE, cleaning.BAD_DATE, cleaning.NULL_CRITICAL, None]


def test_duplicate_step_comes_before_typing(spark):
    # The survivor has an unreadable date (text sorts last) and takes the good row with it.
    batch = raw(spark, {"booking_date": "x"}, {"booking_date": "2025-01-01"})
    view = to_silver(batch, raw(spark), AT)
    assert view.bookings.count() == 0
    dropped = {r["step"]: r["rows_dropped"] for r in view.audit.collect()}
    assert dropped == {"null_critical": 0, "duplicate": 1, "bad_date": 1, "date_logic": 0, "outlier": 0}


def test_rows_are_conserved(spark):
    batch = raw(spark, {}, {}, {}, {"city": None}, {"city": None}, {"booking_id": None}, {"booking_id": None},
                {"booking_id": "B2", "total_price": "0"}, {"booking_id": "B3"})
    stream = raw(spark, {"booking_id": "B4", "checkout_date": "2025-01-01"}, {"hotel_id": "H2"}).drop("promotion_code")
    view = to_silver(batch, stream, AT)
    counts = {(r["reject_reason"], r["n"]) for r in view.rejects.groupBy("reject_reason").agg(
        F.sum("row_count").alias("n")).collect()}
    assert counts == {("null_critical", 4), ("duplicate", 3), ("date_logic", 1), ("outlier", 1)}
    assert view.bookings.count() + sum(n for _, n in counts) == 11
    last = view.audit.orderBy("step_no").collect()
    assert [r["rows_before"] for r in last] == [11, 7, 4, 4, 3]
    assert last[-1]["rows_after"] == 2 and last[-1]["retention_pct"] == 18.18


def test_audit_of_nothing(spark):
    view = to_silver(raw(spark), raw(spark), AT)
    assert {(r["rows_before"], r["retention_pct"]) for r in view.audit.collect()} == {(0, None)}


def test_silver_values(spark):
    row = to_silver(raw(spark, {}), raw(spark), AT).bookings.first()
    assert (row["hotel_name"], row["city"], row["country"], row["full_name"]) == ("RITZ", "PARIS", "FR", "a b")
    assert (row["room_type"], row["booking_status"], row["num_guests"]) == ("DOUBLE", "CONFIRMED", 2)
    assert (row["stay_duration_days"], row["data_source"], row["silver_version"]) == (2, "Batch_CSV", "1.0")


def test_silver_is_repeatable(spark):
    batch = raw(spark, {}, {"hotel_id": "H2"}, {"hotel_id": "H3"}, {"booking_id": "B2"})
    empty = raw(spark)
    first = rows(to_silver(batch, empty, AT).bookings)
    again = rows(to_silver(batch.orderBy(F.desc("hotel_id")).repartition(3), empty, AT).bookings)
    assert first == again


def test_hot_key_is_combined_before_the_shuffle(spark):
    """A third of all rows share one id; each task sends one row of it."""
    n = 3000
    hot = spark.range(n).selectExpr("if(id % 3 = 0, 'hot', concat('B', id)) as k", "cast(id as string) as v")
    got = keep_latest(hot.repartition(4), ["k"], ["v"], "n").where("k = 'hot'").first()
    assert got["n"] == n // 3 and got["v"] == "999"
    plan = keep_latest(hot, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_null_keys_are_one_group(frame):
    df = frame("k v", [(None, "1"), (None, "2"), ("a", "1")])
    assert rows(keep_latest(df, ["k"])) == sorted([(None, "2"), ("a", "1")], key=repr)


def test_dimension_takes_the_latest_attributes(frame):
    df = frame("h name seen", [("1", "old", "2024"), ("1", "new", "2025"), ("1", "new", "2023"), ("2", "x", None)])
    assert rows(latest_attributes(df, "h", ["h", "name"], "seen")) == [("1", "new"), ("2", "x")]


def test_price_flags_leave_the_bound_out(spark):
    df = spark.createDataFrame([(0.0,), (-1.0,), (50000.0,), (50000.5,), (10.0,)], "total_price double")
    assert tuple(cleaning.price_flags(df).first()) == (2, 1)


def test_price_profile_exact_and_approximate_agree(spark):
    df = spark.range(1, 1001).selectExpr("cast(id as double) as total_price")
    assert tuple(cleaning.price_profile(df).first()) == (1.0, 250.0, 750.0, 1000.0)
    assert tuple(cleaning.price_profile(df, exact=True).first()) == (1.0, 250.0, 750.0, 1000.0)


def test_gold_meets_its_contracts(spark):
    silver = to_silver(
        raw(spark, {}, {"booking_id": "B2", "is_cancelled": "True", "total_price": "300"},
            {"booking_id": "B3", "is_cancelled": None}, {"booking_id": "B4", "city": "", "country": None}),
        raw(spark), AT).bookings
    fact = gold.fact_booking(silver)
    frames = {"fact_booking": fact, "dim_hotel": gold.dim_hotel(silver), "dim_city": gold.dim_city(silver),
              "dim_customer": gold.dim_customer(silver), "kpi_revenue": gold.kpi_revenue(fact)}
    for name, df in frames.items():
        check_contract(df, GOLD_TABLES[name])
    assert frames["dim_city"].count() == 1
    paris = frames["kpi_revenue"].where("hotel_city = 'PARIS'").first()
    # A null flag is in neither count.
    assert (paris["total_bookings"], paris["confirmed_bookings"], paris["cancelled_bookings"]) == (3, 1, 1)
    assert paris["cancellation_rate"] == 33.33 and paris["revenue_rank"] == 1
    assert fact.where("booking_id = 'B1'").first()["stay_nights"] == 2


def test_rank_ties_leave_gaps(spark):
    silver = to_silver(
        raw(spark, {}, {"booking_id": "B2", "city": "rome"}, {"booking_id": "B3", "city": "oslo", "total_price": "5"}),
        raw(spark), AT).bookings
    ranks = gold.kpi_revenue(gold.fact_booking(silver)).select("hotel_city", "revenue_rank")
    assert rows(ranks) == [("OSLO", 3), ("PARIS", 1), ("ROME", 1)]
