import datetime
import hashlib
import random
import re

import pytest
from helpers import column
from hypothesis import given, settings, strategies as st

from sievemark.functions import (
    as_text,
    clean,
    collapse,
    date_pattern,
    full_match,
    is_blank,
    is_finite,
    md5_number,
    null_if_blank,
    quoted,
    row_digest,
    strip,
    to_bigint,
    to_date,
    to_double,
)

SPACES = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0   　"
TEXTS = [
    "",
    " ",
    "a",
    " a ",
    " a b\xa0",
    "a\x1c",
    "\x1fa",
    "a\nb\n",
    "é",
    "  é  ü ",
    "a" + " " * 5000 + "b",
    SPACES,
    f"x{SPACES}y",
    "it's",
    'say "x"',
    "it's \"x\"",
    "back\\slash",
    "tab\t\r\n",
    "\x00\x07\x7f\x85\xa0\xad",
    "​﻿",
    "emoji 😀 ok",
    "\U000e0001",
]


def test_strip_blank_and_quoted_follow_python(spark):
    assert column(spark, TEXTS, strip("v")) == [text.strip() for text in TEXTS]
    assert column(spark, TEXTS, is_blank("v")) == [not text.strip() for text in TEXTS]
    assert column(spark, TEXTS, quoted("v")) == [repr(text) for text in TEXTS]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(st.sampled_from(SPACES + "ab'\"\\é"), max_size=8), min_size=40, max_size=40))
def test_text_functions_on_random_values(spark, values):
    assert column(spark, values, strip("v")) == [value.strip() for value in values]
    assert column(spark, values, is_blank("v")) == [not value.strip() for value in values]
    assert column(spark, values, quoted("v")) == [repr(value) for value in values]
    collapsed = [re.sub("[\t\n\f\r ]+", " ", value) for value in values]
    assert column(spark, values, collapse("v")) == collapsed


def test_nulls(spark):
    assert column(spark, [None], is_blank("v")) == [True]
    assert column(spark, [None], as_text("v")) == [""]
    assert column(spark, [None, " ", "x"], null_if_blank("v")) == [None, None, "x"]


def test_cleaning_steps_in_order(spark):
    steps = ["trim_whitespace", "collapse_internal_whitespace", "uppercase"]
    assert column(spark, ["  new \t york\n"], clean("v", steps)) == ["NEW YORK"]
    with pytest.raises(ValueError, match="unsupported cleaning"):
        clean("v", ["reverse"])


def test_full_match_is_not_a_search(spark):
    values = ["IL", "ILL", " IL", "IL\n", "il"]
    assert column(spark, values, full_match("v", "^[A-Z]{2}$")) == [True] + [False] * 4
    assert column(spark, ["ab"], full_match("v", "a|ab")) == [True]
    assert column(spark, ["xx"], full_match("v", r"(?P<c>x)\1")) == [True]


def test_integers(spark):
    values = ["7", " 7 ", "-3", "+4", "007", "1d", "1.0", "", None, "x"]
    assert column(spark, values, to_bigint("v")) == [7, 7, -3, 4, 7, None, None, None, None, None]
    edge = ["9223372036854775807", "9223372036854775808", "1" * 50]
    assert column(spark, edge, to_bigint("v")) == [2**63 - 1, None, None]


def test_numbers(spark):
    values = ["1.5", " -2 ", ".5", "5.", "1e3", "1f", "1d", "NaN", "inf", "0x1", "", "1 2"]
    expected = [1.5, -2.0, 0.5, 5.0, 1000.0] + [None] * 7
    assert column(spark, values, to_double("v")) == expected
    assert column(spark, ["1e999"], to_double("v")) == [float("inf")]
    values = [1.0, float("nan"), float("inf"), float("-inf"), None]
    assert column(spark, values, is_finite("v"), "double") == [True] + [False] * 4


def test_dates(spark):
    day = datetime.date(2019, 1, 10)
    iso = ["%Y-%m-%dT%H:%M:%S.%f"]
    good = ["2019-01-10T10:30:00.000", "2019-01-10T23:59:59.123456789", "2019-1-10T1:2:3.5"]
    bad = [
        "2019-01-10T10:30:00",
        "2019-01-10T10:30:00.000Z",
        " 2019-01-10T10:30:00.000",
        "2019-02-30T00:00:00.000",
        "2019-13-01T00:00:00.000",
        "2019-01-10T24:00:00.000",
        "2019-01-10T10:60:00.000",
        "0000-01-10T10:00:00.000",
        "19-01-10T10:30:00.000",
        "2019-01-10",
        "",
        None,
    ]
    assert column(spark, good + bad, to_date("v", iso)) == [day] * 3 + [None] * len(bad)
    both = to_date("v", ["%Y-%m-%d", "%d/%m/%Y"])
    assert column(spark, ["2019-01-10", "10/01/2019", "10.01.2019"], both) == [day, day, None]
    assert column(spark, ["20190110"], to_date("v", ["%Y%m%d"])) == [day]
    assert column(spark, ["10 January 2019"], to_date("v", [" %d %B %Y "])) == [day]
    with pytest.raises(ValueError, match="unsupported date directive"):
        date_pattern("%Q")


FORMATS = [
    "%Y-%m-%d", "%d/%m/%Y", "%m/%d/%y", "%Y%m%d", "%d%b%Y", "%d %B %Y", "%B %d, %Y", "%b %d %Y %I:%M %p", "%Y-%j",
    "%y%j", "%A, %d. %B %Y", "%a %d %b %Y %H:%M:%S %z", "%Y-%m-%dT%H:%M:%S.%f%z", "%Y-%m-%d %H:%M:%S %Z", "%c", "%x",
    "%Y week %U day %w", "%Y-W%W-%u", "%a %U %Y", "%G-W%V-%u", "%d.%m.", "%B %Y", "%Y", "%H:%M", "%Y-%m-%d %%", "%m-%d-%Y %X",
    "%Y-%m-%d %j", "%w %Y", "%U %Y", "%A",
]


@pytest.mark.parametrize("directives", FORMATS)
def test_dates_equal_strptime(spark, directives):
    rng = random.Random(directives)
    values = []
    for _ in range(250):
        moment = datetime.datetime(
            rng.choice([1000, 1899, 1968, 1969, 2000, 2023, 2024, 9998, rng.randint(1000, 9998)]), 1, 1, tzinfo=datetime.timezone.utc
        ) + datetime.timedelta(seconds=rng.randint(0, 366 * 86_400))
        value = moment.strftime(directives)
        change = rng.random()
        if change < 0.5 and value:
            at = rng.randrange(len(value))
            value = value[:at] + rng.choice(["", "0", "9", " ", "x", value[at].swapcase()]) + value[at + (change < 0.35) :]
        elif change < 0.6:
            value = re.sub(r"\b0", "", value)
        elif change < 0.65:
            value = re.sub(r"\b0", " ", value)
        values.append(value)
    expected = []
    for value in values:
        try:
            # strptime reads six digits of a second, we read nine.
            known = re.sub(r"(\.[0-9]{6})[0-9]{1,3}(?![0-9])", r"\1", value)
            expected.append(datetime.datetime.strptime(known, directives).date())
        except (ValueError, OverflowError):
            expected.append(None)
    found = column(spark, values, to_date("v", [directives]))
    assert [x for x in zip(values, found, expected) if x[1] != x[2]] == []
    assert any(expected)


def test_date_formats_that_say_too_little_or_too_much():
    for directives in ("%Q", "%Y %", "%Y-%Y", "%Y %y", "%G-%m", "%V", "%G %V", "%U %W"):
        with pytest.raises(ValueError):
            to_date("v", [directives])


def test_row_digest_separates_fields_and_nulls(spark):
    schema = "a string, b string, d double"
    rows = [
        ("x", "y", 0.0),
        ("x", "y", -0.0),
        ("xy", "", 0.0),
        ("", "xy", 0.0),
        (None, "xy", 0.0),
        ("1:x", "y", 0.0),
        ("x", None, None),
    ]
    frame = spark.createDataFrame(rows, schema)
    digests = [row.x for row in frame.selectExpr(f"{row_digest(frame.schema, 'abd')} AS x").collect()]
    assert digests[0] == digests[1]
    assert len(set(digests)) == len(rows) - 1
    assert len(digests[0]) == 32


def test_md5_number(spark):
    expected = int(hashlib.md5(b"abc").hexdigest()[:15], 16)
    assert [int(x) for x in column(spark, ["abc"], md5_number("v"))] == [expected]
