"""A stored dimension brought up to date by the next snapshot, changing only what differs.

Snapshots have the attributes of the dimension without the columns of the validity. Rows are compared by a digest of
all tracked attributes in which NULL is a value of its own.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.functions.columns import OPEN_END
from starmart.functions.sqltext import day as day_literal, name
from starmart.operators.scd2 import IS_CURRENT, VALID_FROM, VALID_TO
from starmart.sources.tables import write_table

_VALIDITY = (VALID_FROM, VALID_TO, IS_CURRENT)
OPENED, CLOSED, DROPPED = "opened", "closed", "dropped"
ACTION = "__action"


def row_digest(columns: list[str]) -> Column:
    """SHA-256 of the columns with their names; NULL differs from every text."""
    return F.sha2(F.to_json(F.struct(*[F.col(name(c)) for c in columns]), {"ignoreNullFields": "false"}), 256)


def opened_on(snapshot: DataFrame, day: dt.date) -> DataFrame:
    """The rows as current versions that begin on ``day``."""
    return snapshot.withColumns({VALID_FROM: F.lit(day), VALID_TO: F.lit(OPEN_END), IS_CURRENT: F.lit(True)})


def refuse_unclear_keys(snapshot: DataFrame, key: str) -> None:
    """A snapshot has one row per key; a repeated or NULL key is an error."""
    unclear = snapshot.groupBy(key).count().filter(f"count > 1 OR {name(key)} IS NULL").head()
    if unclear is not None:
        raise ValueError(f"the snapshot has {unclear['count']} rows with {key} {unclear[key]}")


def refresh_changes(
    versions: DataFrame, snapshot: DataFrame, key: str, day: dt.date, tracked: list[str] | None = None, missing: str = "close"
) -> DataFrame:
    """The versions that a snapshot of ``day`` closes, opens or drops, named in the column ACTION.

    Stored current versions meet the snapshot in one full outer join by key; rows whose tracked attributes (all, unless
    named) are equal go no further. A changed version is closed on the day before, or dropped where it began on
    ``day`` or later, so a day's second snapshot replaces the first. Keys that the snapshot lacks
    are closed, or kept with ``missing="keep"``.
    """
    if missing not in ("close", "keep"):
        raise ValueError(f"missing must be 'close' or 'keep', not {missing!r}")
    attributes = [c for c in versions.columns if c not in _VALIDITY]
    if set(attributes) != set(snapshot.columns):
        raise ValueError(f"the snapshot has {sorted(snapshot.columns)}, the dimension {sorted(attributes)}")
    compared = tracked or [c for c in attributes if c != key]
    current = versions.filter(IS_CURRENT).select(
        F.col(name(key)).alias("__k"), row_digest(compared).alias("__old"), F.struct(*[name(c) for c in versions.columns]).alias("__was")
    )
    fields = ", ".join(f"'{c}', {name(c)}" for c in attributes)
    opened = f"'{VALID_FROM}', {day_literal(day)}, '{VALID_TO}', {day_literal(OPEN_END)}, '{IS_CURRENT}', true"
    arriving = snapshot.select(
        F.col(name(key)).alias("__k"), row_digest(compared).alias("__new"), F.expr(f"named_struct({fields}, {opened})").alias("__is")
    )
    met = current.join(arriving, "__k", "full_outer").filter("NOT (__old <=> __new)")
    if missing == "keep":
        met = met.filter("__new IS NOT NULL")
    past = f"__was.{VALID_FROM} < {day_literal(day)}"
    action = f"CASE WHEN __was IS NULL THEN NULL WHEN {past} THEN '{CLOSED}' ELSE '{DROPPED}' END"
    exploded = met.selectExpr("__was", "__is", f"{action} AS __end").selectExpr(
        "*", f"explode(filter(array(__end, IF(__is IS NULL, NULL, '{OPENED}')), a -> a IS NOT NULL)) AS {ACTION}"
    )

    def value(column: str) -> str:
        old = f"__was.{name(column)}"
        if column == VALID_TO:
            old = f"IF({ACTION} = '{CLOSED}', date_sub({day_literal(day)}, 1), {old})"
        if column == IS_CURRENT:
            old = f"IF({ACTION} = '{CLOSED}', false, {old})"
        return f"IF({ACTION} = '{OPENED}', __is.{name(column)}, {old}) AS {name(column)}"

    return exploded.selectExpr(*[value(c) for c in versions.columns], ACTION)


def with_changes(versions: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """The versions after the changes: history and untouched current ones stay as they are."""
    ended = changes.filter(f"{ACTION} <> '{OPENED}'").select(key)
    history, current = versions.filter(f"NOT {IS_CURRENT}"), versions.filter(IS_CURRENT)
    lasting = current.join(ended, key, "left_anti").select(*versions.columns)
    return history.unionByName(lasting).unionByName(changes.filter(f"{ACTION} <> '{DROPPED}'").drop(ACTION))


def merged(versions: DataFrame, snapshot: DataFrame, key: str, day: dt.date, **options) -> DataFrame:
    """The versions after a snapshot of ``day``, as a plan; see `refresh_changes`."""
    return with_changes(versions, refresh_changes(versions, snapshot, key, day, **options), key)


def refresh_dimension(
    spark: SparkSession, table: str, snapshot: DataFrame, key: str, day: dt.date, schema: str = "dbo", path: str | None = None, **options
) -> dict[str, int]:
    """Bring a stored dimension up to date; returns how many versions were opened, closed and dropped.

    The first snapshot creates the table. One without a change writes nothing; otherwise the new versions are staged and
    published at once, so readers see the old or the new ones.
    """
    refuse_unclear_keys(snapshot, key)
    counts = {OPENED: 0, CLOSED: 0, DROPPED: 0}
    full = f"{schema}.{table}"
    if not spark.catalog.tableExists(full):
        return counts | {OPENED: write_table(opened_on(snapshot, day), table, schema, path=path)}
    versions = spark.table(full)
    changes = refresh_changes(versions, snapshot, key, day, **options).persist()
    try:
        counts |= {r[ACTION]: r["count"] for r in changes.groupBy(ACTION).count().collect()}  # three rows at most
        if any(counts.values()):
            write_table(with_changes(versions, changes, key), table, schema, path=path)
    finally:
        changes.unpersist()
    return counts
