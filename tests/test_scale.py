"""Faults that small tables do not show: narrow types, wide shuffles, input read or written twice."""

from datetime import date, datetime

from conftest import rows
from innkeep.contracts import BOOKING_COLUMNS
from innkeep.streaming import silver as streaming
from innkeep.streaming.silver import SilverStream
from test_cleaning import GOOD
from innkeep import fixtures as fx
from innkeep import registry
from innkeep.operators import asof
from innkeep.operators.cleaning import COPIES, accepted, drop_nulls, packed_bookings, tag_rejects, unpacked_bookings
from innkeep.operators.dedup import keep_latest, packed_rows, surplus_rows, unpacked_rows
from innkeep.operators.drift import narrowest
from innkeep.operators.rowtext import packed, tokens, unpacked
from innkeep.plans.silver import combine, to_silver, to_silver_from
from innkeep.sources import tables as stored
from pyspark.sql import functions as F
from pyspark.sql import types as T

AT = datetime(2024, 1, 1)


def test_drift_takes_keys_of_large_tables(spark, tmp_path):
    big = 1 << 31
    orders = spark.createDataFrame(
        [(big, 40051, datetime(2024, 1, 1), 1.5, "F", "1-URGENT"), (2, 40052, datetime(2024, 1, 2), 2.5, "O", "1-URGENT")],
        "o_orderkey bigint, o_custkey bigint, o_orderdate timestamp, o_totalprice double, o_orderstatus string, o_orderpriority string",
    )
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    got = registry.all_queries()["schema_drift"](spark, str(tmp_path))
    assert [t for _, t in got.dtypes] == ["bigint", "string", "int", "double", "string"]
    assert rows(got) == [(2, None, 40052, 40052.0, "O"), (big, "2024-01-01 00:00:00", 40051, None, None)]


def test_narrowest(spark, frame):
    got = lambda *v: narrowest(frame("k", [(x,) for x in v], ["bigint"]), "k", T.ShortType())
    assert [got(None), got(1, -32768), got(32768, 0), got(-32769), got(1 << 31, None)] == ["smallint", "smallint", "int", "int", "bigint"]


ODD = [None, "", "a", "a\x00", "a\x01", "\x00", "\x01", "\x02", "\x00\x01", "\x01\x00", "\x01\x02", "\x01\x01\x02", "é", "a,b\n"]


def test_packed_rows_come_back_and_sort_as_rows(spark, frame):
    data = [(str(i), a, b) for i, (a, b) in enumerate((a, b) for a in ODD for b in ODD)]
    df = frame("k a b", data)
    back = unpacked("_t", ["a", "b"])
    got = df.selectExpr("k", f"{packed(['a', 'b'])} as _p").selectExpr("k", f"{tokens('_p')} as _t")
    assert rows(got.selectExpr("k", *[f"{v} as {c}" for c, v in back.items()])) == rows(df)
    by_text = [r["k"] for r in df.orderBy(F.expr(packed(["a", "b"]))).collect()]
    assert by_text == [r["k"] for r in df.orderBy(F.expr("struct(a, b)")).collect()]


def test_whole_rows_are_packed_before_they_are_sorted(spark, frame):
    df = frame("id at " + " ".join(f"c{i}" for i in range(20)), [("1", "x", *[str(i) for i in range(20)])] * 2)
    plan = keep_latest(df.withColumn("c3", F.upper("c3")), ["id"], ["at"], "n")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("_packed") >= 0 and "struct(" not in plan
    sort = plan[plan.rindex("Sort ["):]
    assert "_packed" in sort.split("\n")[1]
    surplus = surplus_rows(df, df.limit(1), "n")
    assert [r["n"] for r in surplus.collect()] == [1] and surplus.columns == [*df.columns, "n"]


def test_weather_totals_are_broadcast_while_they_are_few(spark, frame, monkeypatch):
    weather = frame("city time temperature_2m_max temperature_2m_min rain_sum windspeed_10m_max ingestion_timestamp",
                    [("Rome", "2024-01-01", 8.0, 1.0, 2.5, 3.0, AT), ("Rome", "2024-01-03", 10.0, 1.0, 1.0, 3.0, AT)],
                    ["string", "string", "double", "double", "double", "double", "timestamp"])
    stays = frame("id city checkin_date checkout_date", [("1", "ROME", date(2024, 1, 1), date(2024, 1, 4)), ("2", "OSLO", None, None)],
                  ["string", "string", "date", "date"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = asof.weather_over_stay(stays, weather)
        want = [("1", 2, 3.5, 9.0), ("2", 0, None, None)]
        assert rows(got.select("id", "nights_known", "rain_total", "avg_temp_max")) == want
        assert got._jdf.queryExecution().executedPlan().toString().count("BroadcastHashJoin") >= 2
        monkeypatch.setattr(asof, "BROADCAST_ROWS", 1)
        many = asof.weather_over_stay(stays, weather)
        assert rows(many.select("id", "nights_known", "rain_total", "avg_temp_max")) == want
        assert "BroadcastHashJoin" not in many._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_new_rows_are_merged_with_all_old_ones(spark, tmp_path, monkeypatch):
    def sent(*changes):
        data = [tuple({**GOOD, **c}.get(n) for n in BOOKING_COLUMNS) for c in changes]
        return spark.createDataFrame(data, ", ".join(f"{c} string" for c in BOOKING_COLUMNS))

    silver = SilverStream(spark, str(tmp_path / "s"), buckets=4)
    silver.absorb(sent({}, {"booking_id": "B2"}, {"city": None}), 0)
    silver.compact()
    silver.absorb(sent({"booking_date": "2025-01-02"}, {"booking_id": "B3"}, {"booking_id": None}), 1)
    few = rows(silver.tagged())
    monkeypatch.setattr(streaming, "FEW", 0)
    many = silver.tagged()
    assert rows(many) == few and len(few) == 5
    assert "left_anti" not in many._jdf.queryExecution().optimizedPlan().toString().lower().replace("leftanti", "left_anti")


def _tables(spark, folder):
    """Two orders whose line items come twice, in both halves and in one, and without a half."""
    def put(name, columns, data):
        spark.createDataFrame(data, columns).write.parquet(f"{folder}/{name}.parquet")

    day = datetime(1995, 3, 4)
    put("region", "r_regionkey long, r_name string", [(0, "EUROPE")])
    put("nation", "n_nationkey int, n_name string, n_regionkey int", [(1, "FRANCE", 0)])
    put("supplier", "s_suppkey long, s_name string, s_nationkey int", [(5, "Hotel", 1)])
    put("customer", "c_custkey long, c_name string, c_nationkey int, c_mktsegment string", [(3, "Guest#3", 1, "BUILDING"), (4, None, None, None)])
    put("orders", "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp, o_orderpriority string",
        [(1, 3, "F", day, "1-URGENT"), (2, 4, None, day, None)])
    line = lambda k, n, part, half: (k, part, 5, n, 3.0, 100.5, 0.05, 0.02, "R", half, day)
    put("lineitem", "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
        "l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp",
        [line(1, 1, 10, "F"), line(1, 1, 12, "O"), line(1, 1, 12, "O"), line(1, 3, 14, "O"), line(2, 1, 15, "F"), line(2, 3, 13, None),
         line(2, None, 16, "F"), line(2, None, 17, "O"), line(None, 1, 18, "F"), line(1, 2, 9, "O")])
    return str(folder)


def test_silver_stays_where_the_join_has_put_its_rows(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    want = to_silver(*fx.batch_and_stream(spark, sf), AT).bookings
    united = fx.united(spark, sf)
    assert rows(united.drop(fx.ORDER)) == rows(combine(*fx.batch_and_stream(spark, sf)))
    silver = to_silver_from(united, AT, [fx.ORDER])
    assert rows(silver.bookings) == rows(want) and silver.bookings.columns == want.columns and want.count() == 4
    assert fx.ORDER not in [*silver.tagged.columns, *silver.rejects.columns]
    # Line items and orders are shuffled, the joined rows are not.
    plan = registry._to_silver(spark, sf).bookings._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "hashpartitioning(booking_id" not in plan
    assert plan.count("FileScan") == 6


def test_latest_within_a_column_that_the_key_determines(spark, frame):
    data = [("a", "1", "x"), ("a", "2", None), ("b", "1", ""), ("b", "1", "y"), (None, "3", "z")]
    df = frame("k at v", data)
    spread = df.withColumn("part", F.expr("ascii(k)")).repartition(3, "part")
    got = keep_latest(spread, ["k"], ["at"], "n", within=["part"])
    assert rows(got) == rows(keep_latest(df, ["k"], ["at"], "n")) and got.columns == ["k", "at", "v", "n"]
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange") == 1


def test_text_of_dimensions_is_made_before_the_joins(spark, tmp_path):
    plan = fx.bookings(spark, _tables(spark, tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    made = [line.strip(" :+-") for line in plan.split("\n") if "lower(r_name" in line]
    assert len(made) == 1 and made[0].startswith("Project [r_regionkey")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_a_spread_copy_is_grouped_where_it_lies(spark, frame, monkeypatch):
    data = [("a", "1", "x"), ("a", "2", None), ("b", "1", ""), ("b", "1", "y\x00"), (None, "3", "z"), (None, "4", "z")]
    df = frame("k at v", data)
    want = rows(keep_latest(df, ["k"], ["at"], "n"))
    packed_copy = stored.spread_rows(packed_rows(df, ["k"], ["at"]), ["k"])
    got = keep_latest(df, ["k"], ["at"], "n", rows=packed_copy)
    assert rows(got) == want and got.columns == ["k", "at", "v", "n"]
    assert "Exchange" not in _plan(got) and "LocalTableScan" not in _plan(got)
    assert rows(unpacked_rows(packed_copy, df.columns, ["k"], ["at"])) == rows(df)
    # One bucket is too much for a task: its rows are reduced by each task before the shuffle, as ever.
    monkeypatch.setattr(stored, "MOST_OF_A_BUCKET", 1)
    hot = keep_latest(df, ["k"], ["at"], "n", rows=stored.spread_rows(packed_rows(df, ["k"], ["at"]), ["k"]))
    assert rows(hot) == want and _plan(hot).count("Exchange hashpartitioning(k") == 1


def test_surplus_of_spread_rows_moves_digests_only(spark, frame):
    data = [("a", "1", "x")] * 3 + [("a", "0", "y")] * 2 + [("a", None, None), ("b", "1", ""), ("c", "1", None), ("c", "1", "")]
    df = frame("k at v", data)
    kept = keep_latest(df, ["k"], ["at"], "n")
    contested = kept.where("n > 1")
    copy = stored.spread_rows(packed_rows(df, ["k"], ["at"]), ["k"])
    got = surplus_rows(df, contested, "m", ["k"], ["at"], copy)
    assert rows(got) == [("a", "0", "y", 2), ("a", "1", "x", 2), ("a", None, None, 1), ("c", "1", None, 1)]
    assert rows(got) == rows(surplus_rows(df, kept, "m")) and got.columns == [*df.columns, "m"]
    plan = _plan(surplus_rows(df, spark.table(_saved(spark, contested)), "m", ["k"], ["at"], copy).hint("merge"))
    assert "Exchange hashpartitioning(_packed" not in plan and plan.count("Exchange hashpartitioning") <= 1


def _saved(spark, df):
    name = stored.scratch_table(spark, "kept")
    df.write.saveAsTable(name)
    return name


def test_rejects_read_a_spread_copy_of_the_bookings(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    want = to_silver_from(combine(*fx.batch_and_stream(spark, sf)), AT)
    layers = registry._layers(spark, sf)
    assert rows(layers.rejects.select(*want.rejects.columns)) == rows(want.rejects)
    assert rows(layers.tagged.select(*want.tagged.columns)) == rows(want.tagged)
    plan = _plan(layers.rejects)  # whole rows are neither shuffled nor joined unpacked
    assert "Exchange hashpartitioning(_row" not in plan and "LeftSemi" not in plan


def test_packed_bookings_come_back(spark, frame):
    columns = [*BOOKING_COLUMNS, "data_source"]
    data = [tuple({**GOOD, "data_source": "x", **c}.get(n) for n in columns) for c in ({}, {"city": None}, {"booking_id": None})]
    df = frame(" ".join(columns), data)
    copy = packed_bookings(df)
    assert rows(unpacked_bookings(copy, columns)) == rows(df)
    got = tag_rejects(df, rows=copy.where("_complete"))
    assert rows(got) == rows(tag_rejects(df)) and accepted(got).count() == 1


def test_dedup_latest_reads_a_spread_copy(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    complete = drop_nulls(combine(*fx.batch_and_stream(spark, sf)))
    want = keep_latest(complete, ["booking_id"], ["booking_date"], COPIES).drop("data_source")
    got = registry.all_queries()["dedup_latest"](spark, sf)
    assert rows(got) == rows(want) and got.columns == want.columns and "Exchange" not in _plan(got)


def test_booking_stream_reads_a_spread_copy(spark, tmp_path):
    sf = _tables(spark, tmp_path)
    want = to_silver_from(combine(*fx.batch_and_stream(spark, sf)), AT).bookings.drop("silver_load_at")
    got = registry.all_queries()["booking_stream"](spark, sf)
    assert rows(got) == rows(want) and got.columns == want.columns and "Exchange" not in _plan(got)


def test_many_rows_of_silver_are_grouped_in_spread_copies(spark, tmp_path, monkeypatch):
    def sent(*changes):
        data = [tuple({**GOOD, **c}.get(n) for n in BOOKING_COLUMNS) for c in changes]
        return spark.createDataFrame(data, ", ".join(f"{c} string" for c in BOOKING_COLUMNS))

    batches = [
        sent({}, {}, {"booking_id": "B2"}, {"city": None}, {"booking_id": None}),
        sent({"booking_date": "2025-01-02"}, {"booking_id": "B3"}, {"booking_id": "B3", "city": ""}, {"city": None}),
        sent({"booking_id": "B2", "booking_date": None}, {"booking_id": "B4"}, {"booking_id": None}),
    ]
    few, many = (SilverStream(spark, str(tmp_path / n), buckets=4) for n in ("few", "many"))
    for number, batch in enumerate(batches):
        few.absorb(batch, number)
        with monkeypatch.context() as patched:
            patched.setattr(streaming, "FEW", 0)
            patched.setattr(streaming, "SLOT", 1)
            many.absorb(batch, number, count=number > 0)
            if number < 2:
                many.compact()
            got = many.tagged()
        if number < 2:
            few.compact()
        assert rows(got) == rows(few.tagged()) and got.columns == few.tagged().columns
        parts = [{k: p.rows for k, p in s.table.version().parts.items()} for s in (few, many)]
        assert parts[0] == parts[1]
        assert rows(many.audit()) == rows(few.audit())
    assert "Exchange" not in _plan(got)


def test_dealt_rows_are_not_shuffled_to_be_written(spark, tmp_path, frame, monkeypatch):
    seen = []
    monkeypatch.setattr(stored, "_counted", lambda df, f=stored._counted: seen.append(_plan(df)) or f(df))
    df = frame("k v", [("a", "1"), ("b", "2")])
    for dealt in (False, True):
        assert stored.write_files(df, f"{tmp_path}/{dealt}", ["k"], dealt) == 2
        assert rows(spark.read.parquet(f"{tmp_path}/{dealt}").select("k", "v")) == rows(df)
    assert ["Exchange" in plan for plan in seen] == [True, False]
