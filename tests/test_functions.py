from datetime import date

import pytest
from pyspark.sql import functions as F

from innkeep.functions import quoted
from innkeep.functions.casts import to_boolean_or_null, to_date_or_null, to_double_or_null, to_int_or_null
from innkeep.functions.dates import clean_date_text, parse_any_date
from innkeep.functions.text import (
    BOOKING_STATUSES, ROOM_TYPES, map_category, squeeze_spaces, surrogate_key, upper_trim,
)


@pytest.fixture
def each(spark):
    """Evaluate an expression of ``x`` on several texts in one query."""

    def run(expression, values):
        df = spark.createDataFrame(list(enumerate(values)), "i int, x string")
        return [r[0] for r in df.orderBy("i").select(F.expr(expression)).collect()]

    return run


def test_quoted_literals(spark):
    for text in ("plain", r"\d{2}$", "it's", "both ' and \" and \\", ""):
        assert spark.range(1).select(F.expr(quoted(text))).first()[0] == text


def test_dates(each):
    assert each(to_date_or_null("x"), ["2025-01-15", "0000-00-00", "abc", None, "2025-02-30"]) == [
        date(2025, 1, 15), None, None, None, None]


def test_numbers(each):
    assert each(to_double_or_null("x"), ["1.5", "abc", None, "-1"]) == [1.5, None, None, -1.0]
    texts = ["2", "2.0", "2.9", " 3 ", "x", None, "1e2", "99999999999", "-4.0"]
    assert each(to_int_or_null("x"), texts) == [2, 2, 2, 3, None, None, None, None, -4]


def test_booleans(each):
    assert each(to_boolean_or_null("x"), ["True", "0", "yes", "1.0", None]) == [True, False, True, None, None]


def test_text(each):
    assert each(upper_trim("x"), [" london ", "\tx", None]) == ["LONDON", "\tX", None]
    assert each(squeeze_spaces("x"), ["  a \t b  "]) == ["a b"]


def test_room_categories_do_not_trim(each):
    texts = ["sngl", "DBL", " dbl", "2", "ste", "Twin", "king", None]
    assert each(map_category("x", ROOM_TYPES), texts) == [
        "SINGLE", "DOUBLE", " DBL", "DOUBLE", "SUITE", "TWIN", "KING", None]


def test_status_categories(each):
    texts = ["cnf", "canceled", "CXL", "pnd", "no show"]
    assert each(map_category("x", BOOKING_STATUSES), texts) == [
        "CONFIRMED", "CANCELLED", "CANCELLED", "PENDING", "NO SHOW"]


def test_surrogate_key_leaves_nulls_out(spark):
    one = spark.sql("select 'ROME' as a, cast(null as string) as b, 'IT' as c")
    got = one.select(F.expr(surrogate_key("a", "b")), F.expr(surrogate_key("a", "c")), F.md5(F.lit("ROME")),
                     F.md5(F.lit("ROME_IT"))).first()
    assert got[0] == got[2] and got[1] == got[3]


def test_clean_date_text(each):
    texts = ["!!5/10/2025", "  5/10/2025 ", "", "   ", "!!", "! !5", None, "\t#x\n"]
    assert each(clean_date_text("x"), texts) == [
        "5/10/2025", "5/10/2025", None, None, None, "!5", None, "x"]


def test_all_formats(each):
    want = date(2025, 10, 15)
    texts = ["10/15/2025", "2025-10-15", "15/10/2025", "15-10-2025", "20251015", "Oct 15, 2025",
             "October 15, 2025", "15.10.2025", "october 15, 2025"]
    assert each(parse_any_date("x"), texts) == [want] * len(texts)


def test_month_first_wins_and_years_are_checked(each):
    texts = ["5/10/2025", "1999-01-01", "2036-01-01", "02/30/2025", "2025051", "2025-1-5", "nonsense", "2025"]
    assert each(parse_any_date("x"), texts) == [
        date(2025, 5, 10), None, None, None, None, date(2025, 1, 5), None, None]


def test_whole_part_of_odd_numbers(each):
    texts = [".5", "+.5", "-.9 ", " 2.", "\t-2.9", "2147483647.9", "2147483648.0", ".", "+.", "1.2.3", "1. 5", "1e1.0", "", None]
    assert each(to_int_or_null("x"), texts) == [0, 0, 0, 2, -2, 2147483647, None, None, None, None, None, None, None, None]
    # Text with a point is not given to a cast that has to fail.
    assert "try_cast(x as int)" in to_int_or_null("x").split("not contains(x, '.') then ")[1]
