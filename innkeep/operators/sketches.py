"""Distinct counts that can be added up: sketches per group, united for any coarser one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.functions import name

LG_K = 12  # 4,096 registers: at most 4 KB a sketch


def relative_error(lg_k: int = LG_K, sigmas: float = 3.0) -> float:
    """The error that an estimate stays within with ``sigmas`` standard deviations."""
    return sigmas * 1.04 / 2 ** (lg_k / 2)


def sketched(df: DataFrame, by: Sequence[str], columns: Sequence[str], lg_k: int = LG_K) -> DataFrame:
    """Per group a sketch of the distinct values of each column, as ``{column}_sketch``.

    Sketches are merged on the map side, so a group with a third of all rows sends
    one sketch a task. Nulls are not counted.
    """
    return df.groupBy(*[name(c) for c in by]).agg(
        *[F.hll_sketch_agg(name(c), lg_k).alias(f"{c}_sketch") for c in columns]
    )


def united(sketches: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The sketches of coarser groups; the data itself is not read again."""
    return sketches.groupBy(*[name(c) for c in by]).agg(
        *[F.hll_union_agg(name(f"{c}_sketch")).alias(f"{c}_sketch") for c in columns]
    )


def estimates(sketches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The sketches as numbers, ``{column}_distinct``."""
    values = {f"{c}_distinct": F.hll_sketch_estimate(name(f"{c}_sketch")) for c in columns}
    return sketches.withColumns(values).drop(*[f"{c}_sketch" for c in columns])
