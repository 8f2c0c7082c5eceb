"""Digests of rows and of row sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import types as T

from .sql import name


def _canonical(field: T.StructField) -> str:
    """Text of one value, prefixed with its length so that fields cannot run together."""
    column, kind = name(field.name), field.dataType
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        value = f"cast({column} + 0.0D AS string)"  # -0.0 and 0.0 are equal
    elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
        value = f"to_json({column})"
    elif isinstance(kind, T.BinaryType):
        value = f"hex({column})"
    else:
        value = f"cast({column} AS string)"
    return f"coalesce(concat(cast(octet_length({value}) AS string), ':', {value}), '-')"


def canonical_text(schema: T.StructType, columns: Sequence[str]) -> str:
    """The listed columns as one string that no other values give."""
    return f"concat({', '.join(_canonical(schema[c]) for c in columns)})"


def row_digest(schema: T.StructType, columns: Sequence[str]) -> str:
    """32-byte digest of the listed columns; equal rows (nulls equal) share it."""
    return f"unhex(sha2({canonical_text(schema, columns)}, 256))"


def md5_number(value: str) -> str:
    """The first 60 bits of the md5 of a string, as a number that sums exactly."""
    return f"cast(conv(substring(md5({value}), 1, 15), 16, 10) AS decimal(38,0))"
