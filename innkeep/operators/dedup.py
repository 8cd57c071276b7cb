"""One row per key.

Both forms combine on the map side: however many rows a key has, a task sends
at most one row per key into the shuffle, so a hot key cannot fill one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from innkeep.functions import name
from innkeep.operators.rowtext import NO_ROW, all_text, packed, tokens, unpacked


def packed_rows(df: DataFrame, keys: Sequence[str], latest: Sequence[str] = (), beside: Sequence[str] = ()) -> DataFrame:
    """Rows of text as their keys, the columns ``beside`` and one text ``_packed`` of all others,
    which sorts as ``keep_latest`` compares. Takes the place of the rows in ``keep_latest`` and
    ``surplus_rows``: from a written copy that is spread by the keys, neither shuffles them."""
    order = _order(df.columns, keys, latest, beside)
    if not all_text(df, order):
        raise TypeError("only columns of text can be packed")
    return df.selectExpr(*[name(c) for c in [*keys, *beside]], f"{packed(order)} as _packed")


def unpacked_rows(rows: DataFrame, columns: Sequence[str], keys: Sequence[str], latest: Sequence[str] = ()) -> DataFrame:
    """The ``columns`` of ``packed_rows`` again; all others but the packed text stay too."""
    others = [c for c in rows.columns if c not in columns and c != "_packed"]
    split = rows.withColumn("_tokens", F.expr(tokens("_packed")))
    values = unpacked("_tokens", _order(columns, keys, latest, ()))
    return split.selectExpr(*[f"{values[c]} as {name(c)}" if c in values else name(c) for c in [*columns, *others]])


def _order(columns: Sequence[str], keys: Sequence[str], latest: Sequence[str], beside: Sequence[str]) -> list[str]:
    return [*latest, *[c for c in columns if c not in {*latest, *keys, *beside}]]


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    latest: Sequence[str] = (),
    count_as: str | None = None,
    weight: str | None = None,
    within: Sequence[str] = (),
    rows: DataFrame | None = None,
) -> DataFrame:
    """The greatest row per key: by ``latest``, then by all other columns in order.

    Nulls are smallest. The order covers the whole row, so the survivor does
    not depend on how the rows were partitioned. Null keys form one group.
    With ``count_as`` the number of rows of the key is added; where the rows are
    themselves survivors, ``weight`` is the column with the rows each stands for.
    Rows of text go packed through the sort and the shuffle. ``within`` are columns that
    the keys determine, and that are not kept: rows that are already spread by these, as
    after a join, are not shuffled again. ``rows`` are the ``packed_rows`` of ``df``, which
    are then read in its place.
    """
    df_columns = [c for c in df.columns if c != weight and c not in within]
    order = _order(df_columns, keys, latest, ())
    weigh = [name(weight)] if weight else []
    by = [name(k) for k in [*within, *keys]]
    if rows is not None or all_text(df, order):
        # Named twice in the aggregate, the packed row is not moved into it by the optimizer
        # and is made before the sort. No packed row is the text it is compared with.
        rows = df.selectExpr(*by, *weigh, f"{packed(order)} as _packed") if rows is None else rows
        greatest = tokens(f"max(if(_packed = {NO_ROW}, null, _packed))")
        values = unpacked("_row", order)
    else:
        rows, greatest = df, f"max(struct({', '.join(name(c) for c in order)}))"
        values = {c: f"_row.{name(c)}" for c in order}
    measures = [F.expr(greatest).alias("_row")]
    if count_as:
        measures.append(F.expr(f"sum({name(weight)})" if weight else "count(*)").alias(count_as))
    columns = [name(c) if c in keys else f"{values[c]} as {name(c)}" for c in df_columns]
    grouped = rows.groupBy(*by).agg(*measures)
    return grouped.selectExpr(*columns, *([name(count_as)] if count_as else []))


def keep_latest_of_few(
    df: DataFrame, keys: Sequence[str], latest: Sequence[str] = (), count_as: str | None = None
) -> DataFrame:
    """``keep_latest`` of written rows of which nearly all have a key of their own.

    A narrow count finds the keys with several rows. All other rows pass as they
    are; only those of contested keys are compared. While the contested keys are few
    enough to be broadcast, no other row is shuffled or sorted; beyond that both joins
    shuffle whole rows, and ``keep_latest`` moves less. Reads ``df`` three times. Null
    keys are compared too.
    """
    by = [name(k) for k in keys]
    contested = df.groupBy(*by).agg(F.expr("count(*)").alias("_n")).where("_n > 1").select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(by)]
    )
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(by)]
    alone = df.join(contested, same, "left_anti")
    if count_as:
        alone = alone.withColumn(count_as, F.lit(1).cast("bigint"))
    return alone.unionByName(keep_latest(df.join(contested, same, "left_semi"), keys, latest, count_as))


def latest_attributes(
    df: DataFrame, key: str, attributes: Sequence[str], recency: str
) -> DataFrame:
    """Attributes of each key as of its latest ``recency``, for dimension tables.

    Many facts share few attribute variants. So the variants are counted out
    first with a hash aggregate (nothing is sorted, the shuffle carries the
    variants only), and the order is applied to those.
    """
    columns = [key, *[a for a in attributes if a != key]]
    variants = df.groupBy(*columns).agg(F.max(recency).alias("_seen"))
    return keep_latest(variants, [key], latest=["_seen"]).select(*attributes)


def surplus_rows(
    df: DataFrame,
    kept: DataFrame,
    count_as: str,
    keys: Sequence[str] = (),
    latest: Sequence[str] = (),
    rows: DataFrame | None = None,
) -> DataFrame:
    """What ``df`` holds beyond ``kept``, each distinct row once with its number.

    A multiset difference by counting: identical rows are added up before the
    shuffle, different rows of one hot key spread over all tasks. Where ``rows``, the
    ``packed_rows`` of ``df`` by ``keys``, are at hand, of ``kept`` only the keys and a digest
    of each row are moved. ``kept`` has one row per key then, and only rows of its
    keys are compared; none is null.
    """
    columns = df.columns
    if rows is not None:
        digest = lambda row: f"unhex(sha2({row}, 256))"
        chosen = packed_rows(kept.select(*columns), keys, latest)
        chosen = chosen.selectExpr(*[name(k) for k in keys], f"{digest('_packed')} as _kept")
        counted = rows.join(chosen, list(keys)).groupBy(*keys, "_packed", "_kept").agg(F.count(F.lit(1)).alias("_n"))
        surplus = counted.withColumn(count_as, F.expr(f"_n - if({digest('_packed')} = _kept, 1, 0)"))
        surplus = surplus.where(f"{name(count_as)} > 0").drop("_kept", "_n")
        return unpacked_rows(surplus, columns, keys, latest)
    if all_text(df, columns):  # packed, a row is one key
        keys, values = [f"{packed(columns)} as _row"], unpacked("_tokens", columns)
    else:
        keys, values = [name(c) for c in columns], None
    signed = df.selectExpr(*keys, "1 as _n").unionByName(kept.selectExpr(*keys, "-1 as _n"))
    counted = signed.groupBy(*[c for c in signed.columns if c != "_n"]).agg(F.sum("_n").alias(count_as))
    surplus = counted.where(f"{name(count_as)} > 0")
    if values is None:
        return surplus
    split = surplus.selectExpr(f"{tokens('_row')} as _tokens", name(count_as))
    return split.selectExpr(*[f"{values[c]} as {name(c)}" for c in columns], name(count_as))
