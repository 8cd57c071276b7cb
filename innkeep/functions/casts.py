"""Text to typed values; text that does not fit becomes null, never an error."""

from __future__ import annotations

# A plain decimal number; its whole part may be left out. Exponents do not count.
_DECIMAL = r"r'^\s*[+-]?(?:[0-9]+(?:[.][0-9]*)?|[.][0-9]+)\s*$'"


def to_date_or_null(text: str) -> str:
    return f"try_cast({text} as date)"


def to_double_or_null(text: str) -> str:
    return f"try_cast({text} as double)"


def to_int_or_null(text: str) -> str:
    """``'2'`` and ``'2.9'`` give 2, ``'.5'`` gives 0: cut off, not rounded. Text with a
    point, which no cast takes for whole, is not cast: each failure costs an exception."""
    whole = f"substring_index({text}, '.', 1)"
    return (
        f"case when not contains({text}, '.') then try_cast({text} as int) when rlike({text}, {_DECIMAL}) "
        f"then if(right({whole}, 1) between '0' and '9', try_cast({whole} as int), 0) end"
    )


def to_boolean_or_null(text: str) -> str:
    return f"try_cast({text} as boolean)"


def int_or_zero(text: str) -> str:
    return f"coalesce({to_int_or_null(text)}, 0)"
