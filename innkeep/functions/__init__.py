"""Expressions as Spark SQL text, for ``F.expr`` and ``selectExpr``.

Text composes without a call into the JVM per operator: a projection over
fifty columns is handed over in one piece. All of them are built-ins, so they
stay inside code generation.
"""

from __future__ import annotations


def name(column: str) -> str:
    """A column name, quoted."""
    return "`" + column.replace("`", "``") + "`"


def quoted(value: str | None) -> str:
    """A string literal without escape processing."""
    if value is None:
        return "cast(null as string)"
    if "'" in value:
        return '"' + value + '"' if '"' not in value and "\\" not in value else _escaped(value)
    return "r'" + value + "'"


def _escaped(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def stacked(rows: list[str], names: str) -> str:
    """Rows of values out of one row of aggregates."""
    return f"stack({len(rows)}, {', '.join(rows)}) as ({names})"


def values_sql(rows: list[tuple], names: str) -> str:
    """A query over a few literal rows; the optimizer knows its exact size."""

    def literal(v) -> str:
        if v is None or isinstance(v, str):
            return quoted(v)
        return f"{v!r}D" if isinstance(v, float) else str(v)

    body = ", ".join("(" + ", ".join(literal(v) for v in row) + ")" for row in rows)
    return f"select * from values {body} as t({names})"


def in_list(text: str, values) -> str:
    return f"{text} in ({', '.join(quoted(v) for v in values)})"
