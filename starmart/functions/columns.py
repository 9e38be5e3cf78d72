"""Expressions shared by the operators. All are built-in functions; no UDFs."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column, functions as F

from starmart.functions.sqltext import day as day_literal, name as quoted, text

OPEN_END = dt.date(9999, 12, 31)


def overlaps(valid_from: str, valid_to: str, lo: dt.date | str, hi: dt.date | str) -> Column:
    """Validity range meets [lo, hi]; both ends inclusive."""
    return F.expr(f"{quoted(valid_from)} <= {day_literal(hi)} AND {quoted(valid_to)} >= {day_literal(lo)}")


def covers_sql(valid_from: str, valid_to: str, day: str, closed: str = "both") -> str:
    if closed not in ("both", "left"):
        raise ValueError(f"closed must be 'both' or 'left', not {closed!r}")
    return f"{day} >= {quoted(valid_from)} AND {day} {'<=' if closed == 'both' else '<'} {quoted(valid_to)}"


def covers(valid_from: str, valid_to: str, day: dt.date | str, closed: str = "both") -> Column:
    """Validity range holds ``day``, a date or a column name.

    ``closed="both"`` treats ``valid_to`` as the last valid day, which is how the
    versions are built; ``"left"`` is the half-open reading, under which a fact
    dated on the last day of a version matches nothing.
    """
    return F.expr(
        covers_sql(valid_from, valid_to, quoted(day) if isinstance(day, str) else day_literal(day), closed)
    )


def in_year(day: str, year: int) -> Column:
    """Year test as a date range, so that a scan can prune on it."""
    return F.expr(
        f"{quoted(day)} BETWEEN {day_literal(dt.date(year, 1, 1))} AND {day_literal(dt.date(year, 12, 31))}"
    )


def recode_sql(column: str, mapping: dict[str, str], default: str = "null") -> str:
    if default not in ("null", "keep"):
        raise ValueError(f"default must be 'null' or 'keep', not {default!r}")
    pairs = ", ".join(f"{text(old)}, {text(new)}" for old, new in mapping.items())
    found = f"map({pairs})[{quoted(column)}]"
    return f"coalesce({found}, {quoted(column)})" if default == "keep" else found


def recode(column: str, mapping: dict[str, str], default: str = "null") -> Column:
    """Replace a value through a literal map.

    Values that the map lacks become NULL (``default="null"``) or stay (``"keep"``).
    """
    return F.expr(recode_sql(column, mapping, default))


def scaled_price_sql(price: str, factor: Decimal | str) -> str:
    return f"CAST(round({quoted(price)} * {Decimal(str(factor)):f}BD, 2) AS DECIMAL(18,2))"


def scaled_price(price: str, factor: Decimal | str) -> Column:
    """``price * factor`` rounded half up to cents, kept in decimals throughout."""
    return F.expr(scaled_price_sql(price, factor))


def percent_sql(part: str, whole: str) -> str:
    return f"CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0.0D) * 100"


def percent_of(part: str, whole: str) -> Column:
    """``part / whole * 100`` as double; NULL where ``whole`` is zero."""
    return F.expr(percent_sql(quoted(part), quoted(whole)))


def percent_change(before: str, after: str) -> Column:
    """Relative change in percent; NULL where ``before`` is zero."""
    return F.expr(percent_sql(f"({quoted(after)} - {quoted(before)})", quoted(before)))


# Multipliers of a small congruential mixer, modulus 2**31 - 1.
_MODULUS = 2147483647
_STEP_A = 48271
_STEP_B = 69621


def draw(index: str, seed: int, stream: int, bound: str | int) -> str:
    """SQL for a repeatable pseudo-random integer in ``[0, bound)`` for a row index.

    Depends on the row only, so a retried task gives the same value, and it is
    plain 64-bit arithmetic that any SQL engine can repeat. ``index`` and ``bound``
    are SQL expressions of type long, not negative.
    """
    start = f"(({index}) % {_MODULUS} * {_STEP_A} + {seed * 7919 + stream * 104729 + 1}) % {_MODULUS}"
    return f"(({start} * {_STEP_B} + {stream}) % {_MODULUS} % ({bound}))"
