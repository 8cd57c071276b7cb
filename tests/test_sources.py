import json

import pytest
from pyspark.sql import functions as F

from conftest import rows
from innkeep import registry
from innkeep.contracts import ContractError, DIM_CITY, check_contract
from innkeep.operators import columns, enrich, quality
from innkeep.operators.bi import summarize
from innkeep.operators.sampling import sample_rows
from innkeep.plans.bronze import ingest_batch, unify
from innkeep.plans.build import build_all, split_raw
from innkeep.plans.silver import combine
from innkeep.sources.files import HeaderError, read_bookings_csv, read_csv, write_csv
from innkeep.sources.payloads import flatten_rates, flatten_weather, land_if_any, skipped_payloads
from innkeep.sources.tables import read_gold, row_counts, write_files, write_table
from innkeep.streaming.ingest import append_files, append_table, decode_events, drop_repeats, late_events, read_event_files
from test_cleaning import raw


def test_header_names(frame):
    df = frame("a", [("1",)]).select(*[F.col("a").alias(n) for n in (" Booking ID", "Guest (Name)", "star-rating", "a/b")])
    assert columns.normalize_columns(df).columns == ["booking_id", "guest_name", "star_rating", "a_b"]
    with pytest.raises(ValueError):
        columns.normalize_columns(df.select(F.col("a/b"), F.col("a/b").alias("a-b")))


def test_csv_keeps_quotes_and_lines(spark, frame, tmp_path):
    df = frame("id text", [("1", 'a "b", c'), ("2", " x "), ("3", None), ("4", "two\nlines")])
    write_csv(df, str(tmp_path / "c"))
    assert rows(read_csv(spark, str(tmp_path / "c")).drop("_corrupt_record")) == rows(df)


def test_csv_keeps_broken_records(spark, tmp_path):
    (tmp_path / "in.csv").write_text('city,booking_id,note\nRome,B1,"a\nb"\nParis,B2\nOslo,B3,x,y\n')
    schema = spark.createDataFrame([], "booking_id string, city string, note string").schema
    got = read_csv(spark, str(tmp_path / "in.csv"), schema)
    assert got.columns == ["booking_id", "city", "note", "_corrupt_record"]
    assert rows(got.where("_corrupt_record is null")) == [("B1", "Rome", "a\nb", None)]
    assert [r[1] for r in rows(got.where("_corrupt_record is not null").select("city", "_corrupt_record"))] == ["Oslo,B3,x,y", "Paris,B2"]
    assert ingest_batch(spark, str(tmp_path / "in.csv"), "broken", schema) == 3
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "in.csv"), schema, multi_line=False).collect()
    with pytest.raises(HeaderError):
        read_csv(spark, str(tmp_path / "in.csv"), spark.createDataFrame([], "booking_id string, town string, note string").schema)


def test_split_parts_can_be_ingested(spark, frame, tmp_path):
    data = [(f"B{i}", f"{1 + i % 12}/{1 + i % 28}/2025", None, 'one\n"two"') for i in range(20)]
    df = frame("booking_id booking_date checkin_date checkout_date", data)
    split_raw(spark, df, str(tmp_path / "out"))
    assert ingest_batch(spark, str(tmp_path / "out" / "batch"), "split_batch") == 14
    stored = spark.read.table("split_batch")
    assert stored.where("_corrupt_record is not null").count() == 0
    assert {r[0] for r in stored.select("checkout_date").distinct().collect()} == {'one\n"two"'}


def test_ingest_adds_lineage(spark, tmp_path):
    (tmp_path / "in.csv").write_text("Booking ID,total-price\n1,10\n2,abc\n")
    assert ingest_batch(spark, str(tmp_path / "in.csv"), "ingested") == 2
    row = spark.read.table("ingested").orderBy("booking_id").first()
    assert row["total_price"] == "10" and row["_source"] == "Batch_CSV" and row["_source_file"].endswith("in.csv")
    assert dict(read_bookings_csv(spark, str(tmp_path / "in.csv")).dtypes)["booking_id"] == "string"


def test_overwrite_replaces_the_schema(spark, frame):
    assert write_table(frame("a", [("1",)]), "replaced") == 1
    assert write_table(frame("b c", [("1", "2"), ("3", "4")]), "replaced") == 2
    assert spark.read.table("replaced").columns == ["b", "c"]


def test_counts_of_a_write(spark, frame, tmp_path):
    df = frame("a b", [(str(i), str(i % 3)) for i in range(20)])
    written = write_files(df, str(tmp_path / "w"), partition_by=["b"])
    assert tuple(row_counts(written, spark.read.parquet(str(tmp_path / "w"))).first()) == (20, 20, True)


def test_unify_tags_only_where_missing(frame):
    batch = frame("id x _source", [("1", "a", "mine")])
    stream = frame("id y", [("2", "b")])
    got = unify(batch, stream).drop("_ingestion_timestamp")
    assert rows(got.select("id", "x", "y", "_source")) == [("1", "a", None, "mine"), ("2", None, "b", "Streaming_Docker")]


def test_schema_report(spark, frame):
    left = frame("a b", [("1", None), ("2", "x")])
    right = spark.sql("select 1 as a, 'z' as c")
    got = {r["column_name"]: r.asDict() for r in columns.schema_report(left, right).collect()}
    assert got["a"]["status"] == "type_differs" and got["b"]["status"] == "only_left"
    assert got["c"]["status"] == "only_right" and got["b"]["left_filled"] == 1 and got["a"]["left_rows"] == 2


def test_weather_skips_bad_payloads(spark):
    good = json.dumps({"daily": {"time": ["2025-01-01", "2025-01-02"], "temperature_2m_max": [1.5, None],
                                 "temperature_2m_min": [0, 1], "rain_sum": [0, 0], "windspeed_10m_max": [5, 6]}})
    uneven = json.dumps({"daily": {"time": ["2025-01-01"], "temperature_2m_max": [], "temperature_2m_min": [],
                                   "rain_sum": [], "windspeed_10m_max": []}})
    data = [("Rome", 1.0, 2.0, good), ("Oslo", 1.0, 2.0, "no json"), ("Bern", 1.0, 2.0, uneven), ("Bonn", 1.0, 2.0, None)]
    payloads = spark.createDataFrame(data, "city string, latitude double, longitude double, payload string")
    got = flatten_weather(payloads)
    assert rows(got.select("city", "time", "temperature_2m_max")) == [
        ("Rome", "2025-01-01", 1.5), ("Rome", "2025-01-02", None)]
    assert land_if_any(flatten_weather(payloads.where("city <> 'Rome'")), "no_weather") == 0
    assert not spark.catalog.tableExists("no_weather")


def test_rates_and_conversion(spark, frame):
    payloads = frame("day payload", [("2025-01-01", '{"rates": {"USD": 1.5, "PLN": 4.0, "JPY": 160}}'),
                                     ("2025-01-02", '{"rates": {"USD": 2.0}}'), ("2025-01-03", "broken")])
    rates = flatten_rates(payloads, rate_date="day")
    assert rates.count() == 3
    df = spark.createDataFrame([("1", 10.0, "USD"), ("2", 10.0, "EUR"), ("3", 10.0, "PLN")],
                               "id string, total_price double, cur string")
    assert rows(enrich.convert_prices(df, rates, "cur").select("id", "converted_price")) == [
        ("1", 20.0), ("2", 10.0), ("3", None)]


def test_overlapping_forecasts_do_not_multiply_bookings(spark, frame):
    weather = spark.sql("""select * from values ('Rome', '2025-01-01', 1D, 0D, 0D, 0D, timestamp'2024-12-30'),
        ('Rome', '2025-01-01', 9D, 0D, 0D, 0D, timestamp'2024-12-31') as t(city, time, temperature_2m_max,
        temperature_2m_min, rain_sum, windspeed_10m_max, ingestion_timestamp)""")
    stays = spark.sql("select * from values ('a', 'ROME', date'2025-01-01'), ('b', 'OSLO', date'2025-01-01') "
                      "as t(id, city, checkin_date)")
    got = enrich.with_weather(stays, weather).select("id", "temperature_2m_max")
    assert rows(got) == [("a", 9.0), ("b", None)]


def test_city_fallback(spark, frame):
    assert enrich.cities_to_fetch(frame("city", [("Rome",), ("rome",), ("Oslo",)])).count() == 1
    assert enrich.cities_to_fetch(frame("city", [("ROME",)])).count() == 8
    assert enrich.cities_of_table(spark, "does_not_exist").count() == 8


def test_contract_violations(spark):
    with pytest.raises(ContractError):
        check_contract(spark.sql("select 1 as city_name"), DIM_CITY)


def test_suite_results(spark):
    df = spark.sql("""select * from values ('a', 5.0D, 'X', '2025-01-01'), ('a', 60000D, null, 'bad'),
        (null, null, 'Y', null), ('b', 1D, 'X', '2025-02-30') as t(id, price, kind, day)""")
    suite = [quality.not_null("id"), quality.not_null("id", 0.75), quality.unique("id"), quality.exists("nope"),
             quality.between("price", 0, 50000), quality.in_set("kind", ["X"], 0.6), quality.iso_date("day", 0.99)]
    got = [(r["evaluated"], r["unexpected"], r["success"]) for r in quality.run_suite(df, suite).collect()]
    assert got == [(4, 1, False), (4, 1, True), (1, 1, False), (3, 1, False), (3, 1, True), (3, 2, False), (3, 2, False)]
    report = quality.suite_report(quality.run_suite(df, suite, with_total=True), "t").first()
    assert report["total_rows"] == report["sample_size"] == 4
    assert (report["total_expectations"], report["successful"], report["failed"]) == (7, 2, 5)
    assert not report["overall_success"] and report["failed_tests"][0]["column"] == "day"


def test_suite_on_no_rows(spark):
    df = spark.sql("select 1D as total_price where false")
    got = quality.run_suite(df, [quality.not_null("total_price"), quality.between("total_price", 0, 1), quality.unique("total_price")])
    assert all(r["success"] for r in got.collect())


def test_sample_does_not_depend_on_partitions(spark):
    df = spark.range(5000).selectExpr("concat('B', id) as booking_id")
    one = rows(sample_rows(df, ["booking_id"], 0.2))
    assert one == rows(sample_rows(df.repartition(7), ["booking_id"], 0.2)) and 850 < len(one) < 1150
    assert sample_rows(df, ["booking_id"], 1.0).count() == 5000
    few = df.limit(100)
    assert rows(sample_rows(few, ["booking_id"], 0.2)) == [r for r in one if r in rows(few)]


def test_summary_refuses_meaningless_sums(spark):
    kpi = spark.sql("select 'ROME' as hotel_city, 2025 as booking_year, 3L as total_bookings, 50D as cancellation_rate")
    assert summarize(kpi, "kpi_revenue", ["hotel_city"]).columns == ["hotel_city", "total_bookings"]
    with pytest.raises(ValueError):
        summarize(kpi, "kpi_revenue", ["hotel_city"], ["cancellation_rate"])
    assert "cancellation_rate" in summarize(kpi, "kpi_revenue", ["hotel_city"], additive_only=False).columns


EVENTS = "id string, at string, v double"


def test_stream_equals_batch(spark, tmp_path):
    lines = ['{"id": "a", "at": "2025-01-01 00:00:00", "v": 1.5}', "not json", '{"id": "b"}']
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "1.json").write_text("\n".join(lines))
    schema = spark.createDataFrame([], EVENTS).schema
    stream = read_event_files(spark, str(tmp_path / "in"), schema)
    append_files(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    # A second run finds nothing new.
    append_files(stream, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    batch = decode_events(spark.createDataFrame([(x,) for x in lines], "value string"), schema)
    got = spark.read.schema(stream.schema).parquet(str(tmp_path / "out"))
    assert rows(got) == rows(batch) and got.where("_corrupt_record is not null").count() == 1


@pytest.mark.parametrize("spread_by", [None, "copy"])
def test_stream_repeats(spark, tmp_path, spread_by):
    data = spark.range(30).selectExpr("concat('k', id % 5) as id", "timestamp'2025-01-01' as at", "id as copy")
    data.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(data.schema).parquet(str(tmp_path / "in"))
    once = drop_repeats(stream, ["id"], "at", "1 hour", spread_by, 4).select("id")
    append_files(once, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [(f"k{i}",) for i in range(5)]


def test_late_events_are_counted(spark, tmp_path):
    def send(n, *events):
        spark.createDataFrame(events, "id string, at string").selectExpr("id", "cast(at as timestamp) as at").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        stream = spark.readStream.schema("id string, at timestamp").parquet(str(tmp_path / "in"))
        query = append_files(drop_repeats(stream, ["id"], "at", "1 hour"), str(tmp_path / "out"), str(tmp_path / "cp"))
        query.awaitTermination()
        return query

    send(1, ("1", "2025-01-01 10:00:00"))
    assert late_events(run()) == 0
    send(2, ("2", "2025-01-01 01:00:00"), ("3", "2025-01-01 11:00:00"), ("1", "2025-01-01 10:00:00"))
    assert late_events(run()) == 1
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "3"]


def test_stream_to_table(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    append_table(stream, "streamed", str(tmp_path / "cp")).awaitTermination()
    assert spark.read.table("streamed").count() == 5


def test_whole_build(spark, tmp_path):
    write_table(raw(spark, {}, {}, {"booking_id": "B2", "city": "rome"}, {"booking_id": "B3", "total_price": "0"}), "b_batch")
    write_table(raw(spark, {"booking_id": "B4", "is_cancelled": "True"}, {"booking_id": None}).drop("website"), "b_stream")
    done = build_all(spark, "b_batch", "b_stream", str(tmp_path / "report"))
    assert done.rows == {"b_batch": 4, "b_stream": 2, "bronze_unified_bookings": 6, "silver_bookings": 3, "silver_rejects": 3, "fact_booking": 3,
                         "dim_hotel": 1, "dim_city": 2, "dim_customer": 1, "kpi_revenue": 2}
    assert done.audit.orderBy("step_no").collect()[-1]["rows_after"] == 3
    assert done.quality.count() == 24 and done.quality.where("not success").count() == 0
    report = spark.read.json(str(tmp_path / "report")).first()
    assert report["overall_success"] and report["total_expectations"] == 24
    kpi = read_gold(spark, "kpi_revenue")
    assert kpi.agg(F.sum("total_bookings")).first()[0] == read_gold(spark, "fact_booking").count()


def test_split_of_a_raw_file(spark, frame, tmp_path):
    data = [(f"B{i}", f"{1 + i % 12}/{1 + i % 28}/2025", None, None) for i in range(50)] + [("X", "bad", None, None)]
    df = frame("booking_id booking_date checkin_date checkout_date", data)
    ranges = {r["split"]: r["row_count"] for r in split_raw(spark, df, str(tmp_path / "out")).collect()}
    assert ranges == {"batch": 35, "stream": 15}
    counts = {p: read_csv(spark, str(tmp_path / "out" / p)).count() for p in ("batch", "stream", "rejected")}
    assert counts == {"batch": 35, "stream": 15, "rejected": 1}


def test_weather_without_a_series(spark):
    full = {"time": ["2025-01-01"], "temperature_2m_max": [1.5], "temperature_2m_min": [0], "rain_sum": [2], "windspeed_10m_max": [5]}
    few = {k: v for k, v in full.items() if k != "rain_sum"}
    bad = [json.dumps({"daily": {**full, "rain_sum": [1, 2]}}), "{", json.dumps({"daily": {"rain_sum": [1]}}), None]
    data = [("a", json.dumps({"daily": full})), ("b", json.dumps({"daily": few}))] + [(f"x{i}", t) for i, t in enumerate(bad)]
    df = spark.createDataFrame(data, "city string, payload string").selectExpr("city", "1D as latitude", "2D as longitude", "payload")
    got = {r["city"]: (r["rain_sum"], r["temperature_2m_max"]) for r in flatten_weather(df).collect()}
    assert got == {"a": (2.0, 1.5), "b": (None, 1.5)}
    assert sorted(r["city"] for r in skipped_payloads(df).collect()) == ["x0", "x1", "x2", "x3"]


def test_typed_batch_unites_with_text(spark):
    batch, stream = raw(spark, {"booking_id": "B1", "adults": "2"}), raw(spark, {"booking_id": "B2", "adults": "two"})
    typed = batch.withColumn("adults", F.col("adults").cast("int"))
    got = {r["booking_id"]: r["adults"] for r in combine(typed, stream).collect()}
    assert got["B2"] == "two" and isinstance(got["B1"], str)
    assert dict(unify(typed, stream).dtypes)["adults"] == "string"


def test_changed_input_gives_new_layers(spark, tmp_path):
    for t in ("orders", "supplier", "nation", "region", "customer"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    lines = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    before = registry.all_queries()["fact_booking"](spark, str(tmp_path)).count()
    lines.where("l_orderkey % 2 = 0").write.mode("overwrite").parquet(f"{tmp_path}/lineitem.parquet")
    after = registry.all_queries()["fact_booking"](spark, str(tmp_path)).count()
    assert 0 < after < before


def test_audit_reads_no_more_than_silver(spark):
    def plan(name):
        df = registry.all_queries()[name](spark, "/root/testdata/sf0.001")
        df.collect()
        return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]

    # One of the written rows, and one of those that lack a critical value.
    assert plan("silver_audit").count("FileScan") <= 2
    # Silver alone takes one branch over the rows: nothing is written for it, and each half reads its source once.
    assert "unified-" not in plan("silver_bookings") and plan("silver_bookings").count("FileScan") <= 12
