"""Text standardisation and category mapping."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from innkeep.functions import in_list, quoted

# Spellings of each category.
ROOM_TYPES = {
    "SINGLE": ["single", "sngl", "1"],
    "DOUBLE": ["double", "dbl", "2"],
    "SUITE": ["suite", "ste"],
    "TWIN": ["twin"],
}
BOOKING_STATUSES = {
    "CONFIRMED": ["confirmed", "confirm", "cnf"],
    "CANCELLED": ["cancelled", "canceled", "cxl"],
    "PENDING": ["pending", "pnd"],
}


def upper_trim(text: str) -> str:
    """Upper case without outer blanks (blanks only; tabs stay)."""
    return f"trim(upper({text}))"


def squeeze_spaces(text: str) -> str:
    """Every run of white space becomes one blank; none at either end."""
    return rf"trim(regexp_replace({text}, r'\s+', ' '))"


def map_category(text: str, categories: Mapping[str, Sequence[str]]) -> str:
    """Name of the category that lists the spelling; other text in upper case.

    The spelling is compared in lower case and untrimmed.
    """
    whens = [
        f"when {in_list(f'lower({text})', spellings)} then {quoted(category)}"
        for category, spellings in categories.items()
    ]
    return f"case {' '.join(whens)} else upper({text}) end" if whens else f"upper({text})"


def surrogate_key(*parts: str, separator: str = "_") -> str:
    """MD5 of the joined parts; null parts are left out."""
    return f"md5(concat_ws({quoted(separator)}, {', '.join(parts)}))"
