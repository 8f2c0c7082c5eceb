"""String expressions that use the Unicode notion of whitespace.

``trim`` removes spaces only, and a plain ``\\s`` is ASCII only, so the character
class below adds the Unicode flag and the four information separators. Every
function starts with a cheap byte comparison that settles ordinary values; the
regular expression runs for the rest.
"""

from __future__ import annotations

from collections.abc import Sequence

from .sql import text

_SPACE = r"[\s\x1c-\x1f]"
_INK = text(r"(?U)[^\s\x1c-\x1f]")
_LEADING = text(rf"(?U)\A{_SPACE}+")
_TRAILING = text(rf"(?U)(?<!{_SPACE}){_SPACE}+\z")
_PLAIN = text(r"\A[ -&(-\[\]-~]*\z")
_UNPRINTABLE = text(r"[\p{C}\p{Z}&&[^ ]]")


def as_text(value: str) -> str:
    """The value as a string, with null as the empty string."""
    return f"coalesce(cast({value} AS string), '')"


def _is_ink(char: str) -> str:
    return f"({char} >= '!' AND {char} < '\x7f')"


def is_blank(value: str) -> str:
    """Null, empty or whitespace only."""
    return f"(NOT coalesce({_is_ink(value)} OR {value} RLIKE {_INK}, false))"


def null_if_blank(value: str) -> str:
    return f"(CASE WHEN NOT {is_blank(value)} THEN {value} END)"


def strip(value: str) -> str:
    """Remove whitespace at both ends."""
    tidy = f"{_is_ink(value)} AND {_is_ink(f'right({value}, 1)')}"
    stripped = f"regexp_replace(regexp_replace({value}, {_LEADING}, ''), {_TRAILING}, '')"
    return f"(CASE WHEN {tidy} THEN {value} ELSE {stripped} END)"


def collapse(value: str) -> str:
    """Turn each run of ASCII whitespace into one space."""
    uneven = " OR ".join(f"contains({value}, '{run}')" for run in ("  ", "\n", "\t", "\r", "\f"))
    replaced = f"regexp_replace({value}, {text(r'[\t\n\f\r ]+')}, ' ')"
    return f"(CASE WHEN {uneven} THEN {replaced} ELSE {value} END)"


def upper(value: str) -> str:
    return f"upper({value})"


CLEANERS = {
    "trim_whitespace": strip,
    "collapse_internal_whitespace": collapse,
    "uppercase": upper,
}


def clean(value: str, operations: Sequence[str]) -> str:
    """Apply the named cleaning steps in order."""
    unknown = [operation for operation in operations if operation not in CLEANERS]
    if unknown:
        raise ValueError(f"unsupported cleaning operations: {unknown}")
    for operation in operations:
        value = CLEANERS[operation](value)
    return value


def full_match(value: str, pattern: str) -> str:
    """Whole-value match; ``RLIKE`` alone searches, and ``$`` allows a final newline."""
    java = pattern.replace("(?P<", "(?<")
    return f"({value} RLIKE {text(rf'\A(?:{java})\z')})"


def quoted(value: str) -> str:
    """The value as a quoted literal with escapes, as issue values show it."""
    single = f"(NOT contains({value}, '\\'') OR contains({value}, '\"'))"
    quote = f"(CASE WHEN {single} THEN '\\'' ELSE '\"' END)"

    def code(prefix: str, width: int) -> str:
        return f"concat({text(prefix)}, lpad(lower(hex(ascii(c))), {width}, '0'))"

    escapes = " ".join(
        f"WHEN c = {text(char)} THEN {text(escape)}"
        for char, escape in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t"))
    )
    escaped = (
        f"CASE {escapes} WHEN c = '\\'' AND {single} THEN {text(chr(92) + chr(39))} "
        f"WHEN NOT c RLIKE {_UNPRINTABLE} THEN c WHEN ascii(c) < 256 THEN {code(r'\x', 2)} "
        f"WHEN ascii(c) < 65536 THEN {code(r'\u', 4)} ELSE {code(r'\U', 8)} END"
    )
    body = f"array_join(transform(split({value}, ''), c -> {escaped}), '')"
    return (
        f"(CASE WHEN {value} RLIKE {_PLAIN} THEN concat('\\'', {value}, '\\'') "
        f"ELSE concat({quote}, {body}, {quote}) END)"
    )
