"""SQL failure predicates of the built-in rule kinds.

Each returns text that is true for an offending row. A null value never makes
a range or set predicate true; missing values have a predicate of their own.
"""

from __future__ import annotations

from collections.abc import Sequence


def literal(text: str) -> str:
    """``text`` as a SQL string."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def quoted(column: str) -> str:
    return f"`{column.replace('`', '``')}`"


def missing(column: str) -> str:
    return f"{quoted(column)} IS NULL"


def not_positive(column: str) -> str:
    return f"{quoted(column)} IS NOT NULL AND {quoted(column)} <= 0"


def outside(column: str, values: Sequence[str]) -> str:
    listed = ", ".join(literal(v.upper()) for v in values)
    return f"{quoted(column)} IS NOT NULL AND upper({quoted(column)}) NOT IN ({listed})"
