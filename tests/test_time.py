"""Look-ups in time, histories, sketches, drift, subtotals next to plain versions."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.operators import asof, bi, drift, sketches
from innkeep.operators.dedup import keep_latest, keep_latest_of_few
from innkeep.operators.enrich import convert_prices
from innkeep.sources.snapshots import Snapshots

from conftest import rows

DAY = date(2024, 1, 1)


def day(n):
    return None if n is None else DAY + timedelta(days=n)


# ---- rates -----------------------------------------------------------------------

RATES = [("USD", 2, 2.0), ("USD", 5, 3.0), ("USD", 5, 2.5), ("GBP", 4, 0.5), ("XXX", 0, 9.0)]


def rates(spark):
    return spark.createDataFrame([(c, day(d), r) for c, d, r in RATES], "currency_code string, rate_date date, rate_vs_eur double")


def test_rates_as_of_the_day(spark):
    asked = [(k, c, d) for k, (c, d) in enumerate(
        [("USD", 1), ("USD", 2), ("USD", 4), ("USD", 5), ("USD", 400), ("GBP", 3), ("GBP", 9), ("EUR", -9), ("XXX", 3), (None, 3), ("USD", None)]
    )]
    bookings = spark.createDataFrame(
        [(k, c, day(d), 10.0, "own") for k, c, d in asked], "id int, currency string, on date, total_price double, rate_vs_eur string"
    )
    got = {r["id"]: r["converted_price"] for r in asof.convert_as_of(bookings, rates(spark), "currency", "on").collect()}

    def brute(c, d):
        if c == "EUR" and c is not None:
            return 10.0
        known = [(x, r) for code, x, r in RATES if code == c != "XXX" and d is not None and x <= d]
        return 10.0 * max(known)[1] if known else None

    assert got == {k: brute(c, d) for k, c, d in asked}
    assert asof.convert_as_of(bookings, rates(spark), "currency", "on").columns == [*bookings.columns, "converted_price"]
    # Columns of the bookings that are named as those of the rates stay, in both conversions.
    assert {r["rate_vs_eur"] for r in convert_prices(bookings, rates(spark), "currency").collect()} == {"own"}
    none = asof.convert_as_of(bookings, rates(spark).limit(0), "currency", "on").collect()
    assert [r["converted_price"] for r in none if r["currency"] != "EUR"] == [None] * 10


# ---- weather over stays -------------------------------------------------------------


def test_weather_over_stays(spark):
    rng = random.Random(1)
    known = {(c, d): (rng.randint(0, 9) / 4, rng.choice([None, 12.5, -3.0])) for c in ("ROME", "PARIS") for d in range(30) if rng.random() < 0.7}
    weather = spark.createDataFrame(
        [(f" {c.title()}", str(day(d)), w, 0.0, r, 0.0, "2024-01-01") for (c, d), (r, w) in known.items()] + [("Rome", "no day", 1.0, 1.0, 1.0, 1.0, "x")],
        "city string, time string, temperature_2m_max double, temperature_2m_min double, rain_sum double, windspeed_10m_max double, ingestion_timestamp string",
    )
    stays = [(k, rng.choice(["Rome", "paris ", "Oslo", None]), a, a + rng.randint(0, 40)) for k, a in enumerate(rng.choices(range(-20, 45), k=200))]
    stays += [(900, "Rome", None, 3), (901, "Rome", 3, None)]
    bookings = spark.createDataFrame([(k, c, day(a), day(b)) for k, c, a, b in stays], "id int, city string, checkin_date date, checkout_date date")
    got = {r["id"]: (r["nights_known"], r["rain_total"], r["avg_temp_max"]) for r in asof.weather_over_stay(bookings, weather).collect()}
    for k, c, a, b in stays:
        nights = [known.get((c.strip().upper(), d)) for d in range(a, b)] if None not in (c, a, b) else []
        nights = [n for n in nights if n]
        warm = [w for _, w in nights if w is not None]
        want = (len(nights), sum(r for r, _ in nights) if nights else None, sum(warm) / len(warm) if warm else None)
        assert got[k][:2] == want[:2] and got[k][2] == pytest.approx(want[2]), k
    assert set(r["nights_known"] for r in asof.weather_over_stay(bookings, weather.limit(0)).collect()) == {0}


# ---- histories ------------------------------------------------------------------------


def test_history_and_versions_in_force(spark):
    rng = random.Random(2)
    seen = [(rng.choice(["a", "b", "hot", "hot", "hot", None]), rng.choice([None, *range(100)]), rng.choice(["x", "y", None]), rng.choice(["1", "2"])) for _ in range(400)]
    frame = spark.createDataFrame([(k, day(d), p, q) for k, d, p, q in seen], "k string, on date, p string, q string")
    brute = []
    for key in ("a", "b", "hot"):
        of_day = {}
        for k, d, p, q in seen:
            if k == key and d is not None:
                rank = lambda r: [(x is not None, x or "") for x in r]
                of_day[d] = max(of_day.get(d, (p, q)), (p, q), key=rank)
        versions = []
        for d in sorted(of_day):
            if not versions or versions[-1][1] != of_day[d]:
                versions.append((d, of_day[d]))
        ends = [d - 1 for d, _ in versions[1:]] + [None]
        brute += [(key, *v, day(d), day(e), e is None) for (d, v), e in zip(versions, ends)]
    history = asof.validity(frame, "k", ["p", "q"], "on")
    assert rows(history) == sorted(brute, key=repr)

    facts = spark.createDataFrame([(n, k, day(d), "mine") for n, (k, d) in enumerate([(k, d) for k in ("a", "hot", "zz", None) for d in (-5, 0, 3, 50, 99, 400, None)])],
                                  "id int, k string, at date, valid_from_ string")
    got = {r["id"]: (r["p_then"], r["valid_from"]) for r in asof.in_force(facts, history, "k", "at", ["p"]).collect()}
    assert len(got) == 28
    for r in facts.collect():
        on = [(p, f) for k, p, _, f, t, _ in brute if k == r["k"] and r["at"] is not None and f <= r["at"] and (t is None or r["at"] <= t)]
        assert got[r["id"]] == (on[0] if on else (None, None))


# ---- sketches ---------------------------------------------------------------------------


def test_sketches_unite(spark):
    frame = spark.range(60_000).selectExpr("cast(id % 6 as string) as city", "cast(id % 3 as int) as area", "id % 20000 as guest")
    fine = sketches.sketched(frame, ["city", "area"], ["guest"])
    coarse = sketches.estimates(sketches.united(fine, ["area"], ["guest"]), ["guest"]).collect()
    exact = {r["area"]: r["n"] for r in frame.groupBy("area").agg(F.countDistinct("guest").alias("n")).collect()}
    for r in coarse:
        assert abs(r["guest_distinct"] / exact[r["area"]] - 1) < sketches.relative_error()
    whole = sketches.estimates(sketches.sketched(frame, ["area"], ["guest"]), ["guest"])
    assert rows(whole) == sorted(map(tuple, coarse), key=repr)  # united or made at once: the same


# ---- drift --------------------------------------------------------------------------------


@pytest.mark.parametrize("a,b,want", [
    ("int", "bigint", "bigint"), ("tinyint", "smallint", "smallint"), ("int", "double", "double"), ("bigint", "double", None),
    ("decimal(10,2)", "int", "decimal(12,2)"), ("decimal(10,2)", "decimal(8,5)", "decimal(13,5)"), ("decimal(38,0)", "decimal(38,9)", None),
    ("float", "int", "double"), ("float", "smallint", "float"), ("date", "timestamp", "timestamp"), ("int", "string", None),
    ("boolean", "int", None), ("array<int>", "array<bigint>", "array<bigint>"), ("struct<x:int>", "struct<x:bigint,y:string>", "struct<x:bigint,y:string>"),
    ("struct<x:int>", "struct<x:string>", None),
])
def test_widest(a, b, want):
    kinds = [T.StructType.fromDDL(f"c {k}")["c"].dataType for k in (a, b)]
    for x, y in (kinds, kinds[::-1]):
        found = drift.widest(x, y)
        assert (found.simpleString() if found is not None else None) == want or x != kinds[0] and want and "struct" in want


def test_table_evolves(spark, tmp_path):
    table = Snapshots(spark, f"file://{tmp_path}/t")
    add = lambda q, **k: drift.append_evolving(table, spark.sql(q), **k)
    add("select 1 as id, date'2024-01-02' as d")
    _, changes = add("select 5000000000 as ID, 'n' as extra, timestamp'2024-01-03 04:05:06' as d")
    assert {c.column: c.change for c in changes} == {"id": drift.WIDENED, "d": drift.WIDENED, "extra": drift.ADDED}
    _, changes = add("select cast(7 as smallint) as id")
    assert {c.column: c.change for c in changes} == {"id": drift.NARROWER, "d": drift.MISSING, "extra": drift.MISSING}
    got = rows(table.read().selectExpr("id", "cast(d as string) as d", "extra"))
    assert got == sorted([(1, "2024-01-02 00:00:00", None), (5000000000, "2024-01-03 04:05:06", "n"), (7, None, None)], key=repr)
    before = table.version()
    with pytest.raises(drift.DriftError) as refused:
        add("select 'x' as id")
    assert [c.column for c in refused.value.refused] == ["id"] and table.version() == before
    with pytest.raises(drift.DriftError):
        add("select 1 as id, 2 as more", allow=[drift.SAME, drift.MISSING, drift.NARROWER])
    assert drift.changes_frame(spark, refused.value.changes).where("change = 'conflict'").count() == 1


# ---- subtotals, dedup ------------------------------------------------------------------------


def test_subtotals(spark):
    fact = spark.createDataFrame([("a", "x", 1.0), ("a", None, 2.0), (None, "x", 4.0)], "hotel_country string, room_type string, total_price double")
    got = rows(bi.subtotals(fact, "fact_booking", [["hotel_country", "room_type"], ["hotel_country"], []]))
    assert got == sorted([
        ("a", "x", 0, 1.0), ("a", None, 0, 2.0), (None, "x", 0, 4.0), ("a", None, 1, 3.0), (None, None, 1, 4.0), (None, None, 3, 7.0),
    ], key=repr)
    with pytest.raises(ValueError):
        bi.subtotals(fact.withColumn("booking_year", F.lit(1)), "fact_booking", [[]], ["booking_year"])


def test_few_repeats(spark):
    rng = random.Random(3)
    data = [(rng.choice([None, *"abcdefghijklmnop"]), rng.choice([None, "1", "2"]), rng.choice(["x", "y", None])) for _ in range(60)]
    data += [(f"id{k}", "1", "x") for k in range(100)] + [("hot", str(k % 7), "z") for k in range(200)]
    frame = spark.createDataFrame(data, "id string, at string, v string")
    want = keep_latest(frame, ["id"], ["at"], "n")
    assert rows(keep_latest_of_few(frame, ["id"], ["at"], "n")) == rows(want)
    assert rows(keep_latest_of_few(frame, ["id"], ["at"])) == rows(want.drop("n"))
