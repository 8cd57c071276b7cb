"""Dates out of dirty text in several formats.

A formatter that fails raises inside the JVM, which costs microseconds per
row and format. So each format is first checked by shape; numeric shapes are
then rewritten to ISO text and cast, which needs no formatter at all.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from innkeep.functions import quoted


_ANY_YEAR = r"\d{4}"


@dataclass(frozen=True)
class DateFormat:
    """``YYYY`` in ``shape`` stands for the year.

    ``iso`` rewrites the groups of ``shape`` to ``y-m-d``; without it
    ``pattern`` parses the text.
    """

    shape: str
    iso: str | None = None
    pattern: str | None = None

    def parse(self, text: str, years: str = _ANY_YEAR) -> str:
        shape = quoted(self.shape.replace("YYYY", years))
        if self.iso:
            day = f"try_cast(regexp_replace({text}, {shape}, {quoted(self.iso)}) as date)"
        else:
            day = f"cast(try_to_timestamp({text}, {quoted(self.pattern)}) as date)"
        return f"case when {text} rlike {shape} then {day} end"


MONTH_FIRST = DateFormat(r"^(\d{1,2})/(\d{1,2})/(YYYY)$", iso="$3-$1-$2")

# The formats, in the order they are tried.
DATE_FORMATS = [
    MONTH_FIRST,
    DateFormat(r"^(YYYY)-(\d{1,2})-(\d{1,2})$", iso="$1-$2-$3"),
    DateFormat(r"^(\d{1,2})/(\d{1,2})/(YYYY)$", iso="$3-$2-$1"),
    DateFormat(r"^(\d{1,2})-(\d{1,2})-(YYYY)$", iso="$3-$2-$1"),
    DateFormat(r"^(YYYY)(\d{2})(\d{2})$", iso="$1-$2-$3"),
    DateFormat(r"^[A-Za-z]{3} \d{1,2}, (YYYY)$", pattern="MMM d, yyyy"),
    DateFormat(r"^[A-Za-z]{3,9} \d{1,2}, (YYYY)$", pattern="MMMM d, yyyy"),
    DateFormat(r"^(\d{1,2})\.(\d{1,2})\.(YYYY)$", iso="$3-$2-$1"),
]

# A recovered date outside these years is not believed.
FIRST_YEAR, LAST_YEAR = 2000, 2035

# Outer white space and the junk characters in front, in one pass.
_JUNK = r"(?U)^\s*[!@#$%^&*~`]*\s*|\s+$"


def clean_date_text(text: str) -> str:
    """Text without outer white space and leading junk; null if nothing is left."""
    return f"nullif(regexp_replace({text}, {quoted(_JUNK)}, ''), '')"


def parse_any_date(
    text: str,
    formats: Sequence[DateFormat] = tuple(DATE_FORMATS),
    first_year: int = FIRST_YEAR,
    last_year: int = LAST_YEAR,
) -> str:
    """First format that gives a date within the years; later ones are not tried.

    The years are part of the shape, so a text is parsed at most once per format.
    """
    years = "|".join(f"{y:04d}" for y in range(first_year, last_year + 1))
    return f"coalesce({', '.join(f.parse(text, years) for f in formats)})"
