"""Slowly changing dimensions, type 2: building versions and reading changes.

Versions carry ``Valid_From`` and ``Valid_To`` (dates, both inclusive) and
``Is_Current``. Builders make every version of a row in one pass over the base
table (an array of eras, exploded), so no base row is scanned twice and nothing
is shuffled.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.functions.columns import OPEN_END, recode, recode_sql, scaled_price_sql
from starmart.functions.sqltext import day, name

VALID_FROM, VALID_TO, IS_CURRENT = "Valid_From", "Valid_To", "Is_Current"
_DAY = dt.timedelta(days=1)


@dataclass(frozen=True)
class Era:
    """A past validity period, both days inclusive, with the factor its prices take."""

    start: dt.date
    end: dt.date
    factor: Decimal = Decimal("1")


def scd2_current(base: DataFrame) -> DataFrame:
    """Snapshot rows as current, open-ended versions, valid from the day they name.

    Any ``Valid_To`` of the snapshot is replaced: every input row is taken as current.
    """
    start = F.to_date(VALID_FROM)
    return base.withColumns({VALID_FROM: start, VALID_TO: F.lit(OPEN_END), IS_CURRENT: F.lit(True)})


def scd2_history(
    base: DataFrame, changed: Column, attribute: str, mapping: dict[str, str], era: Era, default: str = "null"
) -> DataFrame:
    """Closed earlier versions of the changed rows, with one attribute recoded."""
    return base.filter(changed).withColumns(
        {
            attribute: recode(attribute, mapping, default),
            VALID_FROM: F.lit(era.start),
            VALID_TO: F.lit(era.end),
            IS_CURRENT: F.lit(False),
        }
    )


def scd2_reopen(current: DataFrame, changed: Column, start: dt.date) -> DataFrame:
    """Let the current versions of changed rows begin at ``start``; leave the others."""
    return current.withColumn(VALID_FROM, F.when(changed, F.lit(start)).otherwise(F.col(VALID_FROM)))


def scd2_union(
    base: DataFrame, changed: Column, attribute: str, mapping: dict[str, str], era: Era, default: str = "null"
) -> DataFrame:
    """History and current versions as a union by name: two scans of the base."""
    current = scd2_reopen(scd2_current(base), changed, era.end + _DAY)
    return scd2_history(base, changed, attribute, mapping, era, default).unionByName(current)


def _version(start: str, end: dt.date, current: bool, values: dict[str, str]) -> str:
    fields = {VALID_FROM: start, VALID_TO: day(end), IS_CURRENT: str(current).lower(), **values}
    return "named_struct(" + ", ".join(f"'{i}', {v}" for i, v in fields.items()) + ")"


def _explode_versions(
    base: DataFrame, changed: Column, of_changed: list[str], of_others: list[str], replaced: list[str]
) -> DataFrame:
    """One row per version; replaced columns and those of the validity stay at their old positions, new ones follow."""
    replaced = [*replaced, VALID_FROM, VALID_TO, IS_CURRENT]
    kept = [f"__v.{name(c)} AS {name(c)}" if c in replaced else name(c) for c in base.columns]
    kept += [f"__v.{c}" for c in (VALID_FROM, VALID_TO, IS_CURRENT) if c not in base.columns]
    versions = f"IF(__changed, array({', '.join(of_changed)}), array({', '.join(of_others)}))"
    return (
        base.withColumn("__changed", F.coalesce(changed, F.lit(False)))
        .selectExpr("*", f"explode({versions}) AS __v")
        .selectExpr(*kept)
    )


def scd2_recoded(
    base: DataFrame, changed: Column, attribute: str, mapping: dict[str, str], era: Era, default: str = "null"
) -> DataFrame:
    """The rows of ``scd2_union`` from a single scan of the base."""
    same = {attribute: name(attribute)}
    past = _version(day(era.start), era.end, False, {attribute: recode_sql(attribute, mapping, default)})
    reopened = _version(day(era.end + _DAY), OPEN_END, True, same)
    untouched = _version(f"to_date({VALID_FROM})", OPEN_END, True, same)
    return _explode_versions(base, changed, [past, reopened], [untouched], [attribute])


def scd2_tiered(
    base: DataFrame,
    changed: Column,
    prices: list[str],
    eras: list[Era],
    current_from: dt.date,
    unchanged_from: dt.date | None = None,
) -> DataFrame:
    """Price history: changed rows get one version per era plus the current one.

    Unchanged rows have the current version only. It starts at ``current_from``
    like all others, so earlier facts find no version, unless ``unchanged_from``
    opens it earlier.
    """
    past = [_version(day(e.start), e.end, False, {p: scaled_price_sql(p, e.factor) for p in prices}) for e in eras]
    now = {p: f"CAST({name(p)} AS DECIMAL(18,2))" for p in prices}
    current = _version(day(current_from), OPEN_END, True, now)
    single = _version(day(unchanged_from or current_from), OPEN_END, True, now)
    return _explode_versions(base, changed, [*past, current], [single], prices)


def current_versions(versions: DataFrame) -> DataFrame:
    """The view of rows that are valid now."""
    return versions.filter(F.col(IS_CURRENT))


def version_counts(versions: DataFrame, key: str, at_least: int = 2) -> DataFrame:
    """Keys with several versions, and how many."""
    return versions.groupBy(key).agg(F.count(F.lit(1)).alias("n_versions")).filter(F.col("n_versions") >= at_least)


def changed_versions(versions: DataFrame, key: str) -> DataFrame:
    """All versions of the keys that have more than one."""
    return versions.join(version_counts(versions, key).select(key), key, "left_semi")


def version_chain(versions: DataFrame, key: str, *attributes: str) -> DataFrame:
    """One row per key and start day, in the order they follow each other.

    Grouping by day first bounds each key's window by the days of the calendar,
    however many rows one key holds. Where several versions start on one day, the
    attributes are those of the version that ends last.
    """
    by_day = versions.groupBy(key, VALID_FROM).agg(
        F.max(VALID_TO).alias(VALID_TO),
        F.count(F.lit(1)).alias("n_rows"),
        *[F.max_by(a, F.struct(VALID_TO, a)).alias(a) for a in attributes],
    )
    return by_day


def changes(versions: DataFrame, key: str, attribute: str, carry: tuple[str, ...] = ()) -> DataFrame:
    """Before and after of each pair of consecutive versions of a key whose attribute differs; NULL is a value here."""
    chain = version_chain(versions, key, attribute, *carry)
    order = Window.partitionBy(key).orderBy(VALID_FROM)
    paired = chain.withColumns(
        {
            "before": F.lag(attribute).over(order),
            "before_from": F.lag(VALID_FROM).over(order),
            "before_to": F.lag(VALID_TO).over(order),
        }
    )
    changed = F.col("before_from").isNotNull() & ~F.col("before").eqNullSafe(F.col(attribute))
    return paired.filter(changed).select(
        key,
        *carry,
        "before",
        F.col(attribute).alias("after"),
        "before_from",
        "before_to",
        F.col(VALID_FROM).alias("after_from"),
        F.col(VALID_TO).alias("after_to"),
    )
