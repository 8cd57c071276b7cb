"""Expectations on a table, evaluated as aggregates over all of its rows.

A suite is a list of expectations. All row-level ones share a single
aggregate, so the table is scanned once however long the suite is; each
uniqueness check adds one narrow group-by of its column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.contracts import BATCH_TAG, CRITICAL_COLUMNS, STREAM_TAG
from innkeep.functions import in_list, name, quoted, stacked

# Names of the expectations in the report.
NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
EXISTS = "expect_column_to_exist"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
DATE_FORMAT = "expect_column_values_to_match_strftime_format"


@dataclass(frozen=True)
class Expectation:
    """``fails`` is SQL, true for a bad value; nulls do not count unless ``on_nulls``."""

    kind: str
    column: str
    fails: str = ""
    mostly: float = 1.0
    on_nulls: bool = False


def not_null(column: str, mostly: float = 1.0) -> Expectation:
    return Expectation(NOT_NULL, column, f"{name(column)} is null", mostly, on_nulls=True)


def unique(column: str) -> Expectation:
    return Expectation(UNIQUE, column)


def exists(column: str) -> Expectation:
    return Expectation(EXISTS, column)


def between(column: str, low: float, high: float, mostly: float = 1.0) -> Expectation:
    return Expectation(BETWEEN, column, f"{name(column)} not between {low} and {high}", mostly)


def in_set(column: str, values: Sequence[str], mostly: float = 1.0) -> Expectation:
    return Expectation(IN_SET, column, f"not {in_list(name(column), values)}", mostly)


def iso_date(column: str, mostly: float = 1.0) -> Expectation:
    """The text form of the column is a real ``yyyy-MM-dd`` date."""
    text = f"cast({name(column)} as string)"
    good = rf"{text} rlike r'^\d{{4}}-\d{{2}}-\d{{2}}$' and try_cast({text} as date) is not null"
    return Expectation(DATE_FORMAT, column, f"not ({good})", mostly)


def silver_suite(columns: Sequence[str]) -> list[Expectation]:
    """Expectations on silver; optional columns are checked where present.

    Fixed values: columns, bounds, sets and shares.
    """
    suite = [not_null(c) for c in [*CRITICAL_COLUMNS, "data_source"]]
    suite.append(unique("booking_id"))
    suite += [
        exists(c)
        for c in (
            "booking_id", "checkin_date", "checkout_date", "total_price",
            "silver_load_at", "data_source", "stay_duration_days",
        )
    ]
    suite.append(between("total_price", 0, 50000))
    suite.append(between("stay_duration_days", 1, 365))
    suite.append(in_set("data_source", [BATCH_TAG, STREAM_TAG]))
    if "room_type" in columns:
        suite.append(in_set("room_type", ["SINGLE", "DOUBLE", "SUITE", "TWIN"], mostly=0.90))
    suite += [
        iso_date(c, mostly=0.99)
        for c in ("checkin_date", "checkout_date", "booking_date")
        if c in columns
    ]
    suite += [
        not_null(c, mostly=0.95)
        for c in ("customer_name", "room_type", "booking_status")
        if c in columns
    ]
    return suite


_RESULT = "expectation, column_name, evaluated, unexpected, unexpected_pct, mostly, success"


def _result(e: Expectation, evaluated: str, unexpected: str) -> str:
    """One report row. Nothing to evaluate is a success."""
    return (
        f"{quoted(e.kind)}, {quoted(e.column)}, {evaluated}, {unexpected}, "
        f"round(try_divide({unexpected}, {evaluated}) * 100, 4), {float(e.mostly)}D, "
        f"coalesce(try_divide({evaluated} - {unexpected}, {evaluated}) >= {float(e.mostly)}D, true)"
    )


def run_suite(
    df: DataFrame, suite: Sequence[Expectation], with_total: bool = False
) -> DataFrame:
    """One row per expectation, on request with the rows of the table. Lazy."""
    extra = ["_rows as total_rows"] if with_total else []
    frames, rows, measures = [], [], {"_rows": "count(*)"}
    for i, e in enumerate(e for e in suite if e.kind != UNIQUE):
        if e.kind == EXISTS:
            rows.append(_result(e, "1L", "0L" if e.column in df.columns else "1L"))
            continue
        seen = "_rows" if e.on_nulls else f"_seen{i}"
        measures.setdefault(seen, f"count({name(e.column)})")
        bad = e.fails if e.on_nulls else f"{name(e.column)} is not null and ({e.fails})"
        measures[f"_bad{i}"] = f"count_if({bad})"
        rows.append(_result(e, seen, f"_bad{i}"))
    if rows:
        totals = df.selectExpr(*[f"{text} as {c}" for c, text in measures.items()])
        frames.append(totals.selectExpr(stacked(rows, _RESULT), *extra))
    for e in suite:
        if e.kind != UNIQUE:
            continue
        # Nulls are one group here; they count as rows but not as evaluated.
        groups = df.groupBy(name(e.column)).agg(F.expr("count(*)").alias("_n"))
        known = f"{name(e.column)} is not null"
        totals = groups.selectExpr(
            "coalesce(sum(_n), 0) as _rows",
            f"coalesce(sum(_n) filter (where {known}), 0) as _seen",
            f"coalesce(sum(_n) filter (where {known} and _n > 1), 0) as _bad",
        )
        frames.append(totals.selectExpr(stacked([_result(e, "_seen", "_bad")], _RESULT), *extra))
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def suite_report(results: DataFrame, table: str, as_of: datetime | None = None) -> DataFrame:
    """The report as one row: totals, overall flag, failed expectations.

    Of results ``with_total``. The list is bounded by the length of the suite.
    ``sample_size`` equals ``total_rows``, the rows of the table: nothing is sampled.
    """
    run_date = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    failed = "named_struct('column', column_name, 'expectation', expectation)"
    totals = results.selectExpr(
        "max(total_rows) as total_rows",
        "count(*) as total_expectations",
        "count_if(success) as successful",
        "count_if(not success) as failed",
        f"sort_array(collect_list({failed}) filter (where not success)) as failed_tests",
    )
    return totals.select(run_date.alias("run_date"), "*").selectExpr(
        "run_date", f"{quoted(table)} as table", "total_rows as sample_size", "total_rows",
        "total_expectations", "successful", "failed",
        "round(try_divide(successful, total_expectations) * 100, 4) as success_percent",
        "failed = 0 as overall_success", "failed_tests",
    )
