"""Joins and reductions around a star schema.

The pattern throughout: add the fact up on its own keys first, then join the
dimension, then add up on the attributes. The first step combines on the map side,
so a key that holds a large share of the fact reaches the shuffle as one row per
task. No join carries a
broadcast hint: Spark compares sizes with its threshold, again at run time, and
sorts and merges what is too large.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from starmart.functions.sqltext import name


def reduce_fact(
    fact: DataFrame, keys: list[str], measures: dict[str, str] | None = None, count_as: str | None = None
) -> DataFrame:
    """Exact sums (output name -> measure) and a row count per key combination."""
    aggs = [F.sum(m).alias(out) for out, m in (measures or {}).items()]
    if count_as:
        aggs.append(F.count(F.lit(1)).alias(count_as))
    return fact.groupBy(*keys).agg(*aggs)


def star_join(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    attributes: dict[str, str] | list[str],
    how: str = "inner",
) -> DataFrame:
    """Join a dimension in the role that ``fact_key`` names.

    ``attributes`` are the dimension columns to add; a dict renames them
    (dimension column -> output), which lets one dimension play several roles.
    """
    names = attributes if isinstance(attributes, dict) else {a: a for a in attributes}
    clash = set(names.values()) & set(fact.columns)
    if clash:
        raise ValueError(f"columns already present: {sorted(clash)}")
    side = dimension.selectExpr(
        f"{name(dimension_key)} AS __k", *[f"{name(c)} AS {name(out)}" for c, out in names.items()]
    )
    return fact.join(side, F.expr(f"{name(fact_key)} = __k"), how).drop("__k")


def sum_by_attribute(
    fact: DataFrame,
    dimension: DataFrame,
    fact_key: str,
    dimension_key: str,
    attributes: dict[str, str] | list[str],
    measures: dict[str, str],
    extra_keys: list[str] | None = None,
) -> DataFrame:
    """Sums of measures per dimension attribute: reduce, join, reduce again."""
    extra = extra_keys or []
    reduced = reduce_fact(fact, [fact_key, *extra], measures)
    joined = star_join(reduced, dimension, fact_key, dimension_key, attributes)
    names = list(attributes.values()) if isinstance(attributes, dict) else attributes
    return joined.groupBy(*names, *extra).agg(*[F.sum(out).alias(out) for out in measures])


def top_n(df: DataFrame, n: int, by: str, tie_break: list[str]) -> DataFrame:
    """The ``n`` rows with the largest ``by``; ties go by ``tie_break`` ascending."""
    return df.orderBy(F.desc(by), *tie_break).limit(n)


def signed_split(quantity: str) -> dict[str, Column]:
    """Inflow and outflow parts of a signed quantity, both non-negative."""
    q = F.col(quantity)
    return {"quantity_in": F.when(q > 0, q).otherwise(0), "quantity_out": F.when(q < 0, -q).otherwise(0)}
