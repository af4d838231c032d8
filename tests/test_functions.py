import pytest
from pyspark.sql import functions as F

from cratewise.functions.lists import by_lower, filled, join_sorted, joined, json_text, sort_by
from cratewise.functions.moments import pad_release_date, safe_date, safe_int, safe_timestamp
from cratewise.functions.text import (
    first_listed,
    has_word,
    is_filled,
    join_parts,
    normalize_label,
    status_code,
    tidy_code,
)


def one(rows, value, expression, kind="string"):
    df = rows([(value,)], f"x {kind}")
    column = F.expr(expression) if isinstance(expression, str) else expression
    return df.select(column.alias("y")).first()[0]


@pytest.mark.parametrize(
    ("label", "published", "stripped"),
    [
        ("<b>Bass</b> Guitar", "bass guitar", "bass guitar"),
        ("organ [pipe] (solo)", "organ  pipe   solo", "organ"),
        ("a   b", "a   b", "a b"),
        ('{"attribute":"harp"}', "attribute   harp", "attribute harp"),
        ("Flûte", "fl te", "fl te"),
        (None, "", ""),
        ("<i></i>", "", ""),
    ],
)
def test_normalize_label(rows, label, published, stripped):
    assert one(rows, label, normalize_label(F.col("x"))) == published
    assert one(rows, label, normalize_label(F.col("x"), strip_wrappers=True)) == stripped


@pytest.mark.parametrize(
    ("message", "code"),
    [
        ("caused by: HTTP Error 404: Not Found", "404"),
        ("timeout after 1200 ms", ""),
        ("code 999 then 503", "503"),
        ("", ""),
        (None, ""),
    ],
)
def test_status_code(rows, message, code):
    assert one(rows, message, status_code(F.col("x"))) == code


@pytest.mark.parametrize(
    ("date", "precision", "padded"),
    [
        ("2001", "year", "2001-01-01"),
        ("2001-05", "month", "2001-05-01"),
        ("2001-05-06", "day", "2001-05-06"),
        ("2001-05-06", None, "2001-05-06"),
        ("", "year", "1900-01-01"),
        (None, None, "1900-01-01"),
    ],
)
def test_pad_release_date(rows, date, precision, padded):
    df = rows([(date, precision)], "d string, p string")
    assert df.select(pad_release_date(F.col("d"), F.col("p"))).first()[0] == padded


@pytest.mark.parametrize(
    ("text", "date"),
    [
        ("2001", None),
        ("2001-05", None),
        ("2001-05-06", "2001-05-06"),
        (" 2001-5-6 ", "2001-05-06"),
        ("2001-05-06T10:00:00Z", "2001-05-06"),
        ("2001-05-06 x", None),
        ("2001-02-30", None),
        ("", None),
        (None, None),
    ],
)
def test_safe_date(rows, text, date):
    value = one(rows, text, safe_date("x"))
    assert (value.isoformat() if value else None) == date


def test_safe_timestamp_needs_a_date_and_reads_utc(rows):
    assert one(rows, "10:00:00", safe_timestamp("x")) is None
    assert one(rows, "bad", safe_timestamp("x")) is None
    text = f"cast({safe_timestamp('x')} as string)"
    assert one(rows, "2001-08-02T01:00:00Z", text) == "2001-08-02 01:00:00"
    assert one(rows, "2001-08-02T01:00:00+00:00", text) == "2001-08-02 01:00:00"


@pytest.mark.parametrize(
    ("text", "number"),
    [("12", 12), ("1.5", 2), ("1e3", 1000), (" 7 ", 7), ("x", None), ("", None), (None, None),
     ("99999999999", None)],
)
def test_safe_int(rows, text, number):
    assert one(rows, text, safe_int("x")) == number


def test_text_columns(rows):
    assert one(rows, "  us1 ", tidy_code(F.col("x"))) == "US1"
    assert one(rows, "   ", is_filled(F.col("x"))) is False
    assert one(rows, None, is_filled(F.col("x"))) is False
    assert one(rows, None, join_parts(F.lit("a"), F.col("x"), F.lit("b"))) == "ab"
    assert one(rows, "A, B", first_listed(F.col("x"))) == "A"
    assert one(rows, "celtic harp", has_word(F.col("x"), "harp")) is True
    assert one(rows, "harpsichord", has_word(F.col("x"), "harp")) is False


def test_lists(rows):
    names = ["b", None, "B", "a"]
    kind = "array<string>"
    assert one(rows, names, sort_by("x", "lower(x)", "x"), kind) == ["a", "B", "b", None]
    assert one(rows, ["b", "B", "a"], by_lower("x"), kind) == ["a", "B", "b"]
    assert one(rows, ["a", " ", None], filled("x"), kind) == ["a"]
    assert one(rows, ["b", "a", "b", None], join_sorted("x", "|"), kind) == "a|b"
    assert one(rows, [None], join_sorted("x", "|"), kind) is None
    assert one(rows, ["b", None, "a"], joined("x", ", "), kind) == "b, a"
    assert one(rows, [None], joined("x", ", "), kind) is None
    assert one(rows, None, joined("x", ", "), kind) is None
    assert one(rows, ['a"b', None], json_text("x"), kind) == '["a\\"b",null]'
    assert one(rows, [], json_text("x"), kind) is None
    assert one(rows, None, json_text("x"), kind) is None
