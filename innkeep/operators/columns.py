"""Names, tags and schema comparison."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from innkeep.functions import name, quoted, stacked, values_sql


# What happens to each special character of a header.
_SPECIAL = str.maketrans({" ": "_", "-": "_", "/": "_", "(": None, ")": None})


def normalize_name(header: str) -> str:
    """Outer white space off, lower case, special characters replaced or removed."""
    return header.strip().lower().translate(_SPECIAL)


def normalize_columns(df: DataFrame) -> DataFrame:
    """Normalise all names in one projection; two columns with one name are an error."""
    names = [normalize_name(c) for c in df.columns]
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"several columns would be called {twice}")
    return df.toDF(*names)


def load_time(as_of: datetime | None = None) -> Column:
    """The load timestamp: now, or a given time where runs must repeat exactly."""
    return F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")


def add_missing(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Add those of ``columns`` that ``df`` does not have; present ones are kept."""
    new = {c: value for c, value in columns.items() if c not in df.columns}
    return df.withColumns(new) if new else df


def tag_source(df: DataFrame, tag: str, as_of: datetime | None = None) -> DataFrame:
    """``_source`` and ``_ingestion_timestamp``, where absent."""
    return add_missing(df, {"_source": F.lit(tag), "_ingestion_timestamp": load_time(as_of)})


def schema_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row per column name of either side: where it is, and with which type.

    Compares schemas; the data is not read.
    """
    lefts = {f.name: f.dataType.simpleString() for f in left.schema}
    rights = {f.name: f.dataType.simpleString() for f in right.schema}

    def status(column: str) -> str:
        if column not in rights:
            return "only_left"
        if column not in lefts:
            return "only_right"
        return "common" if lefts[column] == rights[column] else "type_differs"

    rows = [
        (c, lefts.get(c), rights.get(c), status(c)) for c in sorted(set(lefts) | set(rights))
    ]
    return left.sparkSession.sql(values_sql(rows, "column_name, left_type, right_type, status"))


def schema_report(left: DataFrame, right: DataFrame) -> DataFrame:
    """``schema_diff`` with the number of rows and of non-null values per side.

    One aggregate per side reads everything; one row per column name comes out
    of each.
    """

    def filled(df: DataFrame, side: str) -> DataFrame:
        counts = df.selectExpr(
            "count(*) as all_rows",
            *[f"count({name(c)}) as n{i}" for i, c in enumerate(df.columns)],
        )
        rows = [f"{quoted(c)}, all_rows, n{i}" for i, c in enumerate(df.columns)]
        return counts.selectExpr(stacked(rows, f"column_name, {side}_rows, {side}_filled"))

    facts = ["left_type", "right_type", "status", "left_rows", "left_filled", "right_rows", "right_filled"]
    parts = schema_diff(left, right)
    for part in (filled(left, "left"), filled(right, "right")):
        parts = parts.unionByName(part, allowMissingColumns=True)
    return parts.groupBy("column_name").agg(*[F.max(f).alias(f) for f in facts])
