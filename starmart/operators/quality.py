"""Data-quality checks. Each returns the violations, or a summary with counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from starmart.functions.sqltext import name, text
from starmart.operators.bridge import WEIGHT, fan_out_totals
from starmart.operators.scd2 import IS_CURRENT, VALID_FROM, VALID_TO, version_chain


def weight_sum_violations(bridge: DataFrame, key: str, weight: str = WEIGHT) -> DataFrame:
    """Keys whose weights do not add up to 1 (double weights: to nine digits)."""
    total = F.sum(weight)
    if bridge.schema[weight].dataType.typeName() in ("double", "float"):
        total = F.round(total, 9)
    return bridge.groupBy(key).agg(total.alias("weight_sum")).filter(F.col("weight_sum") != 1)


def membership_violations(bridge: DataFrame, key: str, member: str, lo: int = 1, hi: int = 3) -> DataFrame:
    """Keys with fewer than ``lo`` or more than ``hi`` members, or a repeated one."""
    counted = bridge.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_distinct(member).alias("n_members")
    )
    return counted.filter(~F.col("n_rows").between(lo, hi) | (F.col("n_rows") != F.col("n_members")))


def allocation_reconciliation(fact: DataFrame, bridge: DataFrame, key: str, measure: str) -> DataFrame:
    """Weighted against true total, with the difference."""
    totals = fan_out_totals(fact, bridge, key, measure)
    return totals.select(
        "true_total", "weighted_total", (F.col("true_total") - F.col("weighted_total")).alias("difference")
    )


def era_violations(versions: DataFrame, key: str) -> DataFrame:
    """Overlaps and gaps between consecutive versions, and days with several starts."""
    chain = version_chain(versions, key)
    order = Window.partitionBy(key).orderBy(VALID_FROM)
    # The furthest end so far, so that a long version is checked against all that follow.
    reached = F.max(VALID_TO).over(order.rowsBetween(Window.unboundedPreceding, -1))
    seen = chain.withColumn("previous_to", reached)
    problem = (
        F.when(F.col("n_rows") > 1, "duplicate start")
        .when(F.col(VALID_TO) < F.col(VALID_FROM), "ends before start")
        .when(F.col(VALID_FROM) <= F.col("previous_to"), "overlap")
        .when(F.col(VALID_FROM) > F.date_add("previous_to", 1), "gap")
    )
    return seen.withColumn("problem", problem).filter("problem IS NOT NULL").select(
        key, VALID_FROM, VALID_TO, "previous_to", "problem"
    )


def temporal_coverage(
    fact: DataFrame, versions: DataFrame, key: str, on_date: str, closed: str = "both"
) -> DataFrame:
    """Fact rows by the number of versions that match them; all should match one.

    A key's versions travel as one array, which its eras bound, so each fact row stays
    one row and only the counts are added up. Rows with a NULL key match none.
    """
    spans = versions.groupBy(F.col(key).alias("__k")).agg(
        F.collect_list(F.struct(F.col(VALID_FROM).alias("lo"), F.col(VALID_TO).alias("hi"))).alias("__spans")
    )
    # One pass over the fact: rows without a key are spread by date, so they never meet in one task.
    spread = F.expr(f"IF({name(key)} IS NULL, 1 + pmod(hash({name(on_date)}), 1024), 0)")
    spans = spans.withColumn("__none", F.lit(0))
    joined = fact.withColumn("__null", spread).join(spans, (F.col(key) == F.col("__k")) & (F.col("__null") == F.col("__none")), "left")
    until = "<=" if closed == "both" else "<"
    hits = f"size(filter(__spans, s -> {name(on_date)} >= s.lo AND {name(on_date)} {until} s.hi))"
    counted = joined.select(F.expr(f"CAST(IF(__spans IS NULL, 0, {hits}) AS BIGINT)").alias("n_versions"))
    return counted.groupBy("n_versions").agg(F.count(F.lit(1)).alias("n_fact_rows"))


def current_violations(versions: DataFrame, key: str, open_end: Column) -> DataFrame:
    """Keys without exactly one current version, or whose current version is closed."""
    current = F.col(IS_CURRENT)
    counted = versions.groupBy(key).agg(
        F.count_if(current).alias("n_current"), F.count_if(current & (F.col(VALID_TO) == open_end)).alias("n_open")
    )
    return counted.filter((F.col("n_current") != 1) | (F.col("n_open") != 1))


def self_substitutes(bridge: DataFrame) -> DataFrame:
    """Bridge rows that name the primary supplier as its own substitute."""
    return bridge.filter(F.col("Primary_Supplier_Key") == F.col("Substitute_Supplier_Key"))


def orphan_keys(fact: DataFrame, fact_key: str, dimension: DataFrame, dimension_key: str) -> DataFrame:
    """Fact key values that the dimension lacks, with their row counts.

    Distinct keys are counted before the join. NULL keys refer to nothing and are
    not orphans.
    """
    used = fact.filter(F.col(fact_key).isNotNull()).groupBy(F.col(fact_key).alias("key")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )
    return used.join(dimension.select(F.col(dimension_key).alias("key")), "key", "left_anti")


def foreign_key_report(checks: list[tuple[str, str, str, DataFrame, DataFrame, str]]) -> DataFrame:
    """Orphan counts per foreign key: (fact name, key, dimension name, fact, dimension, dimension key).

    A fact, which should be the same frame in all its checks, is read once: the values of its
    keys are stacked as (check, text) and counted before the one anti-join.
    """
    frames = {id(fact): fact for _, _, _, fact, _, _ in checks}
    used = []
    for frame_id, fact in frames.items():
        own = [(i, k) for i, (_, k, _, f, _, _) in enumerate(checks) if id(f) == frame_id]
        stack = ", ".join(f"{i}, CAST({name(k)} AS STRING)" for i, k in own)
        used.append(fact.selectExpr(f"stack({len(own)}, {stack}) AS (check, key)").filter("key IS NOT NULL"))
    counted = reduce(DataFrame.unionByName, used).groupBy("check", "key").agg(F.count(F.lit(1)).alias("n_rows"))
    known = [
        dimension.select(F.lit(i).alias("check"), F.col(dk).cast("string").alias("key"))
        for i, (_, _, _, _, dimension, dk) in enumerate(checks)
    ]
    orphans = counted.join(reduce(DataFrame.unionByName, known), ["check", "key"], "left_anti")
    totals = orphans.groupBy("check").agg(
        F.count(F.lit(1)).alias("n_orphan_keys"), F.sum("n_rows").alias("n_orphan_rows")
    )
    rows = ", ".join(
        f"struct({i} AS check, {text(f)} AS fact, {text(k)} AS fact_key, {text(d)} AS dimension)"
        for i, (f, k, d, *_) in enumerate(checks)
    )
    listed = checks[0][3].sparkSession.range(1).selectExpr(f"inline(array({rows}))")
    zero = F.lit(0).cast("long")
    return listed.join(totals, "check", "left").select(
        "fact",
        "fact_key",
        "dimension",
        F.coalesce("n_orphan_keys", zero).alias("n_orphan_keys"),
        F.coalesce("n_orphan_rows", zero).alias("n_orphan_rows"),
    )
