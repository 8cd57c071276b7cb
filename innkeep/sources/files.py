"""CSV and JSON files."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from innkeep.contracts import BATCH_TAG
from innkeep.operators.columns import load_time, normalize_columns


CORRUPT = "_corrupt_record"


class HeaderError(ValueError):
    """The header of a file does not have the columns that are expected."""


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """CSV with a header and ``"`` as quote and escape; every column is text.

    Columns are found by their names in the header, in any order; a header that
    lacks one of ``schema``, or has others, is an error. A record with too few or
    too many fields keeps its text in ``_corrupt_record``, which is null for all
    others. (Spark answers no query on files about that column alone.)

    A quoted field may span lines, so a file is read by one task; a large input is
    better delivered as many files. ``multi_line=False`` splits files among tasks.
    It is for input without line breaks in fields, and a record with the wrong
    number of fields is then an error.
    """
    reader = (
        spark.read.option("header", True).option("sep", ",")
        .option("quote", '"').option("escape", '"').option("multiLine", multi_line)
    )
    names = reader.option("inferSchema", False).csv(path).columns
    kinds = {f.name: f.dataType for f in schema} if schema is not None else {}
    if schema is not None and sorted(names) != sorted(kinds):
        raise HeaderError(f"{path}: missing {sorted(set(kinds) - set(names))}, unknown {sorted(set(names) - set(kinds))}")
    fields = [T.StructField(n, kinds.get(n, T.StringType())) for n in names]
    checked = reader.option("enforceSchema", False)  # each file's header must be this one
    if multi_line:
        whole = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
        # Without pruning a record counts as broken whichever columns are asked for.
        rows = checked.schema(whole).option("columnPruning", False).option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    else:
        rows = checked.schema(T.StructType(fields)).option("columnPruning", False).option("mode", "FAILFAST").csv(path)
        rows = rows.withColumn(CORRUPT, F.lit(None).cast("string"))
    return rows.select(*[F.col(f"`{n}`") for n in (kinds or names)], CORRUPT)


def with_lineage(df: DataFrame, tag: str = BATCH_TAG, as_of: datetime | None = None) -> DataFrame:
    """``_source``, ``_ingestion_timestamp`` and ``_source_file`` of rows read from files."""
    return df.withColumns({
        "_source": F.lit(tag),
        "_ingestion_timestamp": load_time(as_of),
        "_source_file": F.col("_metadata.file_path"),
    })


def read_bookings_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    multi_line: bool = True,
    as_of: datetime | None = None,
) -> DataFrame:
    """Bookings of the batch source with normalised names and lineage."""
    raw = with_lineage(read_csv(spark, path, schema, multi_line), as_of=as_of)
    return normalize_columns(raw)


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", compression: str = "none") -> None:
    """A folder of CSV files with headers, quoted so that ``read_csv`` gives the rows back.

    Empty text comes back as null: CSV does not tell the two apart. ``compression="gzip"``
    costs the reader nothing in parallelism, since it reads a file in one task anyway.
    """
    (
        df.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("compression", compression).csv(path)
    )


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A one-row report as a JSON document."""
    df.coalesce(1).write.mode(mode).json(path)
