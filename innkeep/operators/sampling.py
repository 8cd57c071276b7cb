"""Bernoulli sample by key, the same on every run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The first hex digits of an MD5, as a share of all their values; 60 bits fit in a long.
_HEX_DIGITS, _SPAN = 15, 16.0**15


def in_sample(keys: Sequence[str], fraction: float, seed: int = 42) -> Column:
    """True for about ``fraction`` of the rows, decided by key and seed alone.

    A seeded ``DataFrame.sample`` depends on how rows are partitioned, so it
    may choose other rows after a lost executor. Hashing the key does not.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    draw = F.conv(F.substring(F.md5(text), 1, _HEX_DIGITS), 16, 10).cast("double") / F.lit(_SPAN)
    return draw < F.lit(float(fraction))


def sample_rows(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = 42) -> DataFrame:
    """About ``fraction`` of the rows, whatever their number. A filter."""
    return df.where(in_sample(keys, fraction, seed))
