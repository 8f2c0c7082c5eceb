"""Strict casts from raw text: a value either converts exactly or gives null.

Spark's own casts are lenient (``'1d'`` becomes 1.0) and raise in ANSI mode, so
each one sits behind a pattern and uses ``try_cast``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from .sql import text
from .text import strip

_DIGITS = text(r"\A[0-9]+\z")
_INTEGER = text(r"\A[+-]?[0-9]+\z")
_NUMBER = text(r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\z")

# What each date directive reads. A day may be padded with a space.
_FIELDS = {
    "Y": "(?!0000)[0-9]{4}",
    "y": "[0-9]{2}",
    "G": "(?!0000)[0-9]{4}",
    "m": "1[0-2]|0[1-9]|[1-9]",
    "d": "3[01]|[12][0-9]|0[1-9]|[1-9]| [1-9]",
    "j": "36[0-6]|3[0-5][0-9]|[12][0-9][0-9]|0[1-9][0-9]|00[1-9]|[1-9][0-9]|0[1-9]|[1-9]",
    "H": "2[0-3]|[01][0-9]|[0-9]",
    "I": "1[0-2]|0[1-9]|[1-9]| [1-9]",
    "M": "[0-5][0-9]|[0-9]",
    "S": "[0-5][0-9]|[0-9]",
    "f": "[0-9]{1,9}",
    "U": "5[0-3]|[0-4][0-9]|[0-9]",
    "W": "5[0-3]|[0-4][0-9]|[0-9]",
    "V": "5[0-3]|0[1-9]|[1-4][0-9]|[0-9]",
    "w": "[0-6]",
    "u": "[1-7]",
    "a": "mon|tue|wed|thu|fri|sat|sun",
    "A": "monday|tuesday|wednesday|thursday|friday|saturday|sunday",
    "b": "jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec",
    "B": "january|february|march|april|may|june|july|august|september|october|november|december",
    "p": "am|pm",
    "z": r"[+-](?:2[0-3]|[01][0-9])(?::[0-5][0-9](?::[0-5][0-9](?:\.[0-9]{1,6})?)?|[0-5][0-9](?:[0-5][0-9](?:\.[0-9]{1,6})?)?)|(?-i:Z)",
    "Z": "utc|gmt",
}
# Directives that stand for others.
_WHOLE = {"c": "%a %b %d %H:%M:%S %Y", "x": "%m/%d/%y", "X": "%H:%M:%S"}
_MONTHS = text("janfebmaraprmayjunjulaugsepoctnovdec")
_WEEKDAYS = text("montuewedthufrisatsun")
_FULL_WIDTH = {
    "Y": "(?!0000)[0-9]{4}",
    "m": "(?:0[1-9]|1[0-2])",
    "d": "(?:0[1-9]|[12][0-9]|3[01])",
    "H": "(?:[01][0-9]|2[0-3])",
    "M": "[0-5][0-9]",
    "S": "[0-5][0-9]",
    "f": "[0-9]{1,9}",
}
_MARK = "\x1f"  # between extracted fields; none of them can hold it


def is_digits(value: str) -> str:
    return f"({value} RLIKE {_DIGITS})"


def parse_bigint(stripped: str) -> str:
    """An integer from text without outer whitespace."""
    return f"(CASE WHEN {stripped} RLIKE {_INTEGER} THEN try_cast({stripped} AS bigint) END)"


def parse_double(stripped: str) -> str:
    """A number from text without outer whitespace."""
    return f"(CASE WHEN {stripped} RLIKE {_NUMBER} THEN try_cast({stripped} AS double) END)"


def to_bigint(value: str) -> str:
    return _unless_spaced(value, _INTEGER, "bigint", parse_bigint(strip(value)))


def to_double(value: str) -> str:
    return _unless_spaced(value, _NUMBER, "double", parse_double(strip(value)))


def _unless_spaced(value: str, pattern: str, kind: str, parsed: str) -> str:
    """One match for a number among plain spaces; only the rest is stripped and matched again."""
    among = pattern.replace(r"\\A", r"\\A *").replace(r"\\z", r" *\\z")
    return f"(CASE WHEN {value} RLIKE {among} THEN try_cast(trim({value}) AS {kind}) ELSE {parsed} END)"


def is_finite(value: str) -> str:
    """False for null, NaN and the infinities."""
    return f"coalesce(abs({value}) < double('infinity'), false)"


def _pieces(directives: str) -> list[str]:
    """Text and directives by turns, with directives of several fields written out."""
    for name, whole in _WHOLE.items():
        directives = re.sub(rf"(?<!%)((?:%%)*)%{name}", lambda m: m[1] + whole, directives)
    pieces = re.split("(%.?)", directives, flags=re.DOTALL)
    fields = [item[1:] for item in pieces[1::2]]
    for field in fields:
        if field != "%" and field not in _FIELDS:
            raise ValueError(f"unsupported date directive %{field} in {directives!r}")
    given = {field for field in fields if field != "%"}
    if len(given) != len([field for field in fields if field != "%"]):
        raise ValueError(f"a date directive stands twice in {directives!r}")
    if len(given & {"Y", "y", "G"}) > 1 or len(given & {"U", "W"}) > 1:
        raise ValueError(f"two directives for one thing in {directives!r}")
    if ("G" in given) != ("V" in given) or ("G" in given and (not given & {"a", "A", "w", "u"} or "j" in given)):
        raise ValueError(f"%G and %V need each other and a day of the week in {directives!r}")
    return pieces


def date_pattern(directives: str, capture: str = "") -> str:
    """Regular expression for a ``%Y-%m-%d`` style format; fields in ``capture`` become groups.

    Fields may have all digits or fewer, names any case, and white space of the format
    stands for any white space, as in ``strptime``. Alternatives come in its order, so fields that
    touch are told apart in the same way.
    """
    pattern = ""
    for index, piece in enumerate(_pieces(directives)):
        if piece == "%%":
            pattern += "%"
        elif index % 2:
            pattern += f"({'' if piece[1] in capture else '?:'}{_FIELDS[piece[1]]})"
        else:
            pattern += r"(?U:\s)+".join(map(re.escape, re.split(r"\s+", piece)))
    return rf"(?i)\A{pattern}\z"


def _full_width(directives: str) -> str | None:
    """Pattern of fully padded values, for formats that begin with an ISO date."""
    if not directives.startswith("%Y-%m-%d"):
        return None
    pieces = re.split(r"(%.)", directives)
    fields = pieces[1::2]
    if len(fields) != len(set(fields)) or any(item[1] not in _FULL_WIDTH for item in fields):
        return None
    if re.search(r"\s", directives):
        return None
    return "".join(
        _FULL_WIDTH[piece[1]] if index % 2 else re.escape(piece)
        for index, piece in enumerate(pieces)
    )


def _extracted(value: str, directives: str, wanted: str, between: str) -> tuple[str, list[str]]:
    """The wanted fields of a value as one string, empty where the value does not match.

    One replacement does it: the second alternative takes what the format does not, and has no groups.
    """
    order = [piece[1] for piece in _pieces(directives)[1::2] if piece[1] in wanted]
    pattern = text(rf"{date_pattern(directives, wanted)}|\A(?s:.*)\z")
    groups = {name: f"${index}" for index, name in enumerate(order, 1)}
    shown = text(between.join(groups[name] for name in wanted if name in groups))
    return f"regexp_replace({value}, {pattern}, {shown})", [name for name in wanted if name in groups]


def _numeric_date(value: str, directives: str) -> str:
    """Year, month and day as numbers: an ISO date, whose cast is many times faster than a formatter."""
    joined, _ = _extracted(value, directives, "Ymd", "-")
    return f"try_cast(replace({joined}, '- ', '-') AS date)"


def _any_date(value: str, directives: str) -> str:
    """A date from whatever fields the format has; those that it lacks are those of 1900-01-01."""
    joined, names = _extracted(value, directives, "YyGmbBdjUWVaAwu", _MARK)
    if not names:
        # Fields of the day alone.
        return f"CASE WHEN {value} RLIKE {text(date_pattern(directives))} THEN DATE'1900-01-01' END"
    raw = {name: f"split_part({joined}, {text(_MARK)}, {index})" for index, name in enumerate(names, 1)}
    number = {name: f"try_cast({item} AS int)" for name, item in raw.items()}
    year = number.get("Y", "1900")
    if "y" in number:
        year = f"({number['y']} + CASE WHEN {number['y']} < 69 THEN 2000 ELSE 1900 END)"
    month = number.get("m", "1")
    for name in set(names) & {"b", "B"}:
        month = f"((nullif(locate(lower(left({raw[name]}, 3)), {_MONTHS}), 0) + 2) div 3)"
    # From Monday, 0.
    weekday = None
    for name in set(names) & {"a", "A"}:
        weekday = f"cast((nullif(locate(lower(left({raw[name]}, 3)), {_WEEKDAYS}), 0) - 1) div 3 AS int)"
    if "w" in number:
        weekday = f"pmod({number['w']} + 6, 7)"
    if "u" in number:
        weekday = f"({number['u']} - 1)"
    first = f"make_date({year}, 1, 1)"
    # What the value must have, also where the date does not need it.
    made = None
    if "j" in number:
        made = f"date_add({first}, {number['j']} - 1)"
    elif weekday and ("U" in number or "W" in number):
        week = number.get("U", number.get("W"))
        shift = 1 if "U" in number else 0
        start = f"pmod(weekday({first}) + {shift}, 7)"
        day = f"pmod({weekday} + {shift}, 7)"
        made = (
            f"date_add({first}, CASE WHEN {week} = 0 THEN {day} - {start} "
            f"ELSE pmod(7 - {start}, 7) + 7 * ({week} - 1) + {day} END)"
        )
    elif "G" in number:
        fourth = f"make_date({number['G']}, 1, 4)"
        monday = f"date_add({fourth}, 7 * ({number['V']} - 1) - weekday({fourth}))"
        # A week is of the year of its Thursday.
        made = f"CASE WHEN year(date_add({monday}, 3)) = {number['G']} THEN date_add({monday}, {weekday}) END"
    if made is None:
        day = f"try_cast(trim({raw['d']}) AS int)" if "d" in raw else "1"
        made = f"try_cast(concat(lpad({year}, 4, '0'), '-', {month}, '-', {day}) AS date)"
        if set(names).isdisjoint("YybBmd"):
            made = f"CASE WHEN {value} RLIKE {text(date_pattern(directives))} THEN {made} END"
    none = "DATE'0000-12-31'"
    return f"CASE WHEN {made} > {none} AND {made} < DATE'10000-01-01' THEN {made} END" if made else made


def _try_date(value: str, directives: str) -> str:
    fields = {piece[1:] for piece in _pieces(directives)[1::2]}
    simple = {"Y", "m", "d"} <= fields and fields.isdisjoint("jUWVaAbBwu")
    parsed = _numeric_date(value, directives) if simple else _any_date(value, directives)
    padded = _full_width(directives)
    if padded is None:
        return f"({parsed})"
    # Fully padded values need no replacement.
    iso = f"try_cast(left({value}, 10) AS date)"
    return f"(CASE WHEN {value} RLIKE {text(rf'\A{padded}\z')} THEN {iso} ELSE {parsed} END)"


def to_date(value: str, formats: Sequence[str]) -> str:
    """First format that reads the value wins; null when none does.

    All directives of ``strptime`` are read, names in English. No formatter is involved, so nothing
    is thrown for values that are no dates. The date is the one written, whatever its time zone.
    """
    return f"coalesce({', '.join(_try_date(value, item.strip()) for item in formats)})"
