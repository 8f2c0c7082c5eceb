"""Names of text encodings: what Python calls them, what Spark does, and how lines end in them."""

from __future__ import annotations

import codecs
from dataclasses import dataclass

# The encodings in which Spark's readers find records, by Python's own name.
_SPARK_NAMES = {
    "utf-8": "UTF-8",
    "utf-8-sig": "UTF-8",
    "ascii": "US-ASCII",
    "iso8859-1": "ISO-8859-1",
}
# Encodings in which what a byte means depends on bytes long before it, and those of names.
_STATEFUL = ("utf-7", "hz", "iso2022", "idna", "punycode", "unicode", "raw-unicode", "undefined", "mbcs", "oem")


@dataclass(frozen=True)
class Encoding:
    """``spark`` is None where lines are decoded by Python. ``unit`` is the size of a code unit.

    Where the bytes of a file tell the byte order, ``python`` and ``line_feed`` are those of the little endian.
    """

    given: str
    python: str
    spark: str | None
    unit: int = 1
    line_feed: bytes = b"\n"
    by_mark: bool = False

    def ordered(self, first: bytes) -> Encoding:
        """The same with the byte order that the first bytes of a file tell."""
        if not self.by_mark:
            return self
        order = "be" if first.startswith("﻿".encode(f"utf-{8 * self.unit}-be")) else "le"
        return _wide(self.given, self.unit, order)


def _wide(given: str, unit: int, order: str) -> Encoding:
    python = f"utf-{8 * unit}-{order}"
    return Encoding(given, python, None, unit, "\n".encode(python))


def find_encoding(name: object) -> Encoding:
    """The encoding of that name or alias; an error for one that cannot be read."""
    try:
        info = codecs.lookup(name) if isinstance(name, str) else None
    except LookupError:
        info = None
    if info is None or not info._is_text_encoding or info.name.replace("_", "-").startswith(_STATEFUL):
        raise ValueError(f"unsupported encoding: {name!r}")
    if info.name in _SPARK_NAMES:
        return Encoding(name, info.name, _SPARK_NAMES[info.name])
    for unit in (2, 4):
        wide = f"utf-{8 * unit}"
        if info.name == wide:
            return Encoding(name, f"{wide}-le", None, unit, "\n".encode(f"{wide}-le"), by_mark=True)
        if info.name in (f"{wide}-le", f"{wide}-be"):
            return _wide(name, unit, info.name[-2:])
    feed = "\n".encode(info.name)
    # The byte of a line feed must not be the second one of a character.
    pairs = (bytes([lead]) + feed for lead in range(256))
    if len(feed) != 1 or feed[0] > 127 or not all(p.decode(info.name, "replace").endswith("\n") for p in pairs):
        raise ValueError(f"unsupported encoding: {name!r}")
    return Encoding(name, info.name, None, 1, feed)
