"""Names and literals as SQL text.

Expressions in this package are SQL fragments: a function takes fragments and
returns one, and ``F.expr`` or ``selectExpr`` turns the result into a column. A
contract with dozens of rules is then a single short round trip to the JVM.
"""

from __future__ import annotations


def name(column: str) -> str:
    """A column reference."""
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    """A string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
