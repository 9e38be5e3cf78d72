"""Many-to-many bridges: weighted allocation and dual-role lookups."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window, functions as F

from starmart.operators.star import reduce_fact, star_join

WEIGHT = "Allocation_Weight"
UNALLOCATED = "Unallocated"


def bridge_join(
    fact: DataFrame, bridge: DataFrame, key: str, columns: list[str], how: str = "inner"
) -> DataFrame:
    """Fan each row out to its bridge rows."""
    return fact.join(bridge.select(key, *columns), key, how)


def apportioned(parts: DataFrame, name: str, measures: list[str], by: list[str] | None = None) -> DataFrame:
    """Exact decimal parts as whole cents that add up to their rounded total, by largest remainder.

    Every part is cut to cents, and the cents that the total is short of go to the largest remainders, one each;
    equal ones by member name. ``parts`` has one row per member and ``by`` combination, so a window holds no
    more rows than there are members.
    """
    group = Window.partitionBy(*(by or [F.lit(0)]))
    for m in measures:
        cents = F.col(m) * 100
        parts = parts.withColumns({"__whole": F.floor(cents), "__rest": cents - F.floor(cents), "__total": F.round(F.sum(m).over(group), 2) * 100})
        short = F.col("__total") - F.sum("__whole").over(group)
        place = F.row_number().over(group.orderBy(F.desc("__rest"), name))
        whole = F.col("__whole") + F.when(place <= short, 1).otherwise(0)
        parts = parts.withColumn(m, F.when(F.col(m).isNotNull(), (whole * F.lit(Decimal("0.01"))).cast("decimal(38,2)")))
    return parts.drop("__whole", "__rest", "__total")


def weighted_sum(
    reduced: DataFrame,
    bridge: DataFrame,
    members: DataFrame,
    key: str,
    member_key: str,
    name: str,
    measures: list[str],
    by: list[str] | None = None,
    weight: str = WEIGHT,
    unallocated: bool = False,
    adding_up: bool = False,
) -> DataFrame:
    """Allocate already reduced measures to bridge members and add them up by member name.

    ``reduced`` should hold one row per key and ``by`` combination: multiplying
    after adding is exact, since a key's weight is the same for all its rows, and
    only the reduced rows fan out. Names are looked up last, on one row per member:
    a join of the whole bridge on so few member keys would pile up on them.

    A NULL weight allocates nothing. With ``unallocated``, what a key's weights leave of
    its measures, and what goes to members without a name, is kept under that name
    instead of dropping out, so the totals still add up. Each member is rounded by itself, or with
    ``adding_up`` so that the members of each ``by`` combination sum to their rounded total (see `apportioned`).
    """
    by = by or []
    joined = bridge_join(reduced, bridge, key, [member_key, weight])
    share = F.coalesce(F.col(weight), F.lit(0))
    per_member = joined.groupBy(*by, member_key).agg(*[F.sum(F.col(m) * share).alias(m) for m in measures])
    named = star_join(per_member, members, member_key, member_key, [name], "left" if unallocated else "inner")
    if unallocated:
        allocated = named.withColumn(name, F.coalesce(F.col(name), F.lit(UNALLOCATED))).select(*by, name, *measures)
        weights = bridge.groupBy(key).agg(F.sum(share).alias("__w"))
        left = 1 - F.coalesce(F.col("__w"), F.lit(0))
        rest = reduced.join(weights, key, "left").filter(left != 0)
        rest = rest.groupBy(*by).agg(*[F.sum(F.col(m) * left).alias(m) for m in measures])
        # Without groups the sum of no rows is a row of NULLs.
        rest = rest.filter(F.coalesce(*measures).isNotNull()).withColumn(name, F.lit(UNALLOCATED))
        named = allocated.unionByName(rest)
    if adding_up:
        return apportioned(named.groupBy(*by, name).agg(*[F.sum(m).alias(m) for m in measures]), name, measures, by)
    return named.groupBy(*by, name).agg(*[F.round(F.sum(m), 2).alias(m) for m in measures])


def weighted_agg(
    fact: DataFrame,
    bridge: DataFrame,
    members: DataFrame,
    key: str,
    member_key: str,
    name: str,
    measures: dict[str, str],
    by: list[str] | None = None,
    weight: str = WEIGHT,
    unallocated: bool = False,
    adding_up: bool = False,
) -> DataFrame:
    """Weighted totals of additive measures (output -> measure) per bridge member."""
    reduced = reduce_fact(fact, [key, *(by or [])], measures)
    return weighted_sum(reduced, bridge, members, key, member_key, name, list(measures), by, weight, unallocated, adding_up)


def fan_out_totals(fact: DataFrame, bridge: DataFrame, key: str, measure: str, weight: str = WEIGHT) -> DataFrame:
    """True, weighted and unweighted totals of a measure over a bridge, in one row.

    The bridge is reduced to one row per key (members, weight sum) before the join,
    so nothing fans out.
    """
    reduced = reduce_fact(fact, [key], {"__m": measure})
    shape = bridge.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.sum(weight).alias("__w"))
    m, n, w = F.col("__m"), F.coalesce(F.col("__n"), F.lit(0)), F.coalesce(F.col("__w"), F.lit(0))
    return reduced.join(shape, key, "left").agg(
        F.sum(m).alias("true_total"),
        F.round(F.sum(m * w), 2).alias("weighted_total"),
        F.sum(m * n).alias("unweighted_total"),
    )


def multi_member(bridge: DataFrame, key: str) -> DataFrame:
    """Bridge rows of the keys that have more than one."""
    several = bridge.groupBy(key).agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").select(key)
    return bridge.join(several, key, "left_semi")


def dual_role_join(
    bridge: DataFrame, dimension: DataFrame, dimension_key: str, attribute: str, roles: dict[str, str]
) -> DataFrame:
    """Look one dimension up once per role (bridge key column -> output name)."""
    for role_key, out in roles.items():
        bridge = star_join(bridge, dimension, role_key, dimension_key, {attribute: out})
    return bridge


def only_of_kind(bridge: DataFrame, key: str, kind: str, value: str, excluding: str) -> DataFrame:
    """Bridge rows of one kind, for keys without any row of another kind."""
    others = bridge.filter(F.col(kind) == excluding).select(key)
    return bridge.filter(F.col(kind) == value).join(others, key, "left_anti")
