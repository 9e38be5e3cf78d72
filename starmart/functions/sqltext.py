"""Literals and names for SQL expressions.

Long expressions are built as SQL text: one call into the JVM instead of one per
operator, which keeps planning short.
"""

from __future__ import annotations

import datetime as dt


def name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def day(value: dt.date | str) -> str:
    """A date literal; text is read as an ISO date, so it never compares as text."""
    return f"DATE'{dt.date.fromisoformat(value) if isinstance(value, str) else value}'"
