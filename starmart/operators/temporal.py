"""Point-in-time joins of facts to versioned dimensions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from starmart.functions.columns import covers, covers_sql, overlaps
from starmart.functions.sqltext import name, text
from starmart.operators.scd2 import VALID_FROM, VALID_TO


def temporal_join(
    fact: DataFrame,
    versions: DataFrame,
    key: str,
    on_date: str,
    attributes: list[str],
    how: str = "inner",
    closed: str = "both",
    salt: int = 1,
) -> DataFrame:
    """Add to each fact row the attributes of the version valid on its date.

    An equi-join on the key with the range as a residual condition: it hashes or
    sorts by key and never becomes a nested loop. ``how="left"`` keeps fact rows
    that no version covers. ``attributes`` may name the validity columns too.

    Adaptive execution splits a hot key here by itself. Where it is off, ``salt``
    spreads each key over that many partitions by date and repeats the versions as
    often; the salt is a function of the row, so retried tasks agree. A salted join sorts
    and merges, so that the repeated versions are spread too. Under
    ``how="left"`` rows with a NULL key, which match nothing, are spread by date.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    clash = set(attributes) & set(fact.columns)
    if clash:
        raise ValueError(f"columns already present: {sorted(clash)}")
    side = versions.selectExpr(
        f"{name(key)} AS __k", f"{VALID_FROM} AS __from", f"{VALID_TO} AS __to", *[name(a) for a in attributes]
    )
    condition = f"{name(key)} = __k AND " + covers_sql("__from", "__to", name(on_date), closed)
    if salt > 1:
        fact = fact.withColumn("__salt", F.expr(f"pmod(hash({name(on_date)}), {salt})"))
        # The copies are not in the estimated size: without the hint all of them may be broadcast to every task.
        side = side.selectExpr("*", f"explode(sequence(0, {salt - 1})) AS __copy").hint("merge")
        condition += " AND __salt = __copy"
    if how == "left":
        fact = fact.withColumn("__null", F.expr(f"IF({name(key)} IS NULL, 1 + pmod(hash({name(on_date)}), 1024), 0)"))
        side = side.selectExpr("*", "0 AS __none")
        condition += " AND __null = __none"
    scratch = ("__k", "__from", "__to", "__salt", "__copy", "__null", "__none")
    return fact.join(side, F.expr(condition), how).drop(*scratch)


def as_of_join(
    fact: DataFrame,
    versions: DataFrame,
    key: str,
    on_date: str,
    attributes: list[str],
    how: str = "inner",
    closed: str = "both",
    days: int = 32,
    copies: int = 1,
) -> DataFrame:
    """The rows of ``temporal_join`` for keys with long histories: sorted once, never paired.

    Versions and facts are put in one order per key and day, and the last version begun is carried forward to
    the facts behind it, so a key's cost is its rows and not facts times versions. A key is cut into
    ranges of ``days`` days; each starts with the version that was open when it began, which is handed on along a
    chain of one row per key and range. So a hot key is spread over its ranges; ``copies`` spreads each of
    them further, by the whole fact row, and repeats the versions as often.

    Of versions that overlap, the one that began last counts (of equal starts, the one that ends last), where
    ``temporal_join`` gives all. Facts without key or date match nothing.
    """
    if how not in ("inner", "left") or closed not in ("both", "left"):
        raise ValueError(f"how must be 'inner' or 'left' and closed 'both' or 'left', not {how!r}, {closed!r}")
    if days < 1 or copies < 1:
        raise ValueError("days and copies must be at least 1")
    clash = set(attributes) & set(fact.columns)
    if clash:
        raise ValueError(f"columns already present: {sorted(clash)}")
    values = "".join(f", {text(a)}, {name(a)}" for a in attributes)
    state = f"named_struct('__to', {VALID_TO}{values}) AS __state"
    begun = versions.filter(f"{name(key)} IS NOT NULL AND {VALID_FROM} IS NOT NULL").selectExpr(
        f"{name(key)} AS __k", f"{VALID_FROM} AS __day", f"floor(unix_date({VALID_FROM}) / {days}) AS __range", state
    )
    row = f"struct({', '.join(name(c) for c in fact.columns)})"
    matched = f"{name(key)} IS NOT NULL AND {name(on_date)} IS NOT NULL"
    dated = fact.filter(matched).selectExpr(
        f"{name(key)} AS __k",
        f"{name(on_date)} AS __day",
        f"floor(unix_date({name(on_date)}) / {days}) AS __range",
        f"{row} AS __fact",
        f"CAST(pmod(xxhash64({row}), {copies}) AS INT) AS __copy",
    )
    # What is open when a range begins: the last version begun in the nearest earlier range that has one.
    lasts = begun.groupBy("__k", "__range").agg(F.max_by("__state", F.struct("__day", "__state.__to")).alias("__state"))
    asked = dated.select("__k", "__range").distinct()
    chain = lasts.unionByName(asked, allowMissingColumns=True).groupBy("__k", "__range")
    chain = chain.agg(F.first("__state", ignorenulls=True).alias("__state"))
    earlier = Window.partitionBy("__k").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    opening = chain.withColumn("__state", F.last("__state", ignorenulls=True).over(earlier)).filter("__state IS NOT NULL")
    opening = opening.withColumn("__day", F.lit(None).cast("date"))  # sorts before every day of the range
    side = opening.unionByName(begun).selectExpr("*", f"explode(sequence(0, {copies - 1})) AS __copy")
    rows = dated.unionByName(side, allowMissingColumns=True)
    order = ["__day", F.col("__fact").isNotNull(), "__state.__to"]
    so_far = Window.partitionBy("__k", "__range", "__copy").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    carried = rows.withColumn("__open", F.last("__state", ignorenulls=True).over(so_far)).filter("__fact IS NOT NULL")
    valid = f"__day {'<=' if closed == 'both' else '<'} __open.__to"
    if how == "inner":
        carried = carried.filter(valid)
    found = carried.selectExpr("__fact.*", *[f"IF({valid}, __open.{name(a)}, NULL) AS {name(a)}" for a in attributes])
    if how == "inner":
        return found
    return found.unionByName(fact.filter(f"NOT ({matched})"), allowMissingColumns=True)


def as_of(versions: DataFrame, day: dt.date, closed: str = "both") -> DataFrame:
    """The versions valid on one day."""
    return versions.filter(covers(VALID_FROM, VALID_TO, day, closed))


def valid_during(versions: DataFrame, lo: dt.date | str, hi: dt.date | str) -> DataFrame:
    """The versions valid at any time in [lo, hi]."""
    return versions.filter(overlaps(VALID_FROM, VALID_TO, lo, hi))
