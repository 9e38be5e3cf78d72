from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from starmart.operators.bridge import (
    apportioned, dual_role_join, fan_out_totals, multi_member, only_of_kind, weighted_agg,
)


@pytest.fixture(scope="module")
def facts(spark):
    rows = [(1, 2015, Dec("100.00"), 3), (1, 2015, Dec("0.05"), 1), (2, 2015, Dec("10.01"), 2), (2, 2016, Dec("1.00"), 1), (9, 2016, Dec("7.00"), 5)]
    return spark.createDataFrame(rows, "c int, y int, m decimal(18,2), q int")


@pytest.fixture(scope="module")
def bridge(spark):
    rows = [(1, 1, Dec("1.00")), (2, 1, Dec("0.33")), (2, 2, Dec("0.33")), (2, 3, Dec("0.34"))]
    return spark.createDataFrame(rows, "c int, s int, Allocation_Weight decimal(5,2)")


@pytest.fixture(scope="module")
def members(spark):
    return spark.createDataFrame([(1, "one"), (2, "two"), (3, "three")], "s int, name string")


def test_weighted_totals(facts, bridge, members):
    out = weighted_agg(facts, bridge, members, "c", "s", "name", {"m": "m", "q": "q"})
    got = {r.name: (r.m, r.q) for r in out.collect()}
    assert got == {
        "one": (Dec("103.68"), Dec("3.99") + Dec("1.00")),
        "two": (Dec("3.63"), Dec("0.99")),
        "three": (Dec("3.74"), Dec("1.02")),
    }


def test_weighted_totals_by_year(facts, bridge, members):
    out = weighted_agg(facts, bridge, members, "c", "s", "name", {"m": "m"}, ["y"])
    got = {(r.y, r.name): r.m for r in out.collect()}
    assert got[(2016, "three")] == Dec("0.34") and got[(2015, "one")] == Dec("103.35") and len(got) == 6


def test_unallocated_keeps_the_total(facts, bridge, members):
    out = weighted_agg(facts, bridge, members, "c", "s", "name", {"m": "m"}, unallocated=True)
    got = {r.name: r.m for r in out.collect()}
    assert got["Unallocated"] == Dec("7.00")
    assert sum(got.values()) == Dec("118.06") - Dec("0.01")  # three shares, each rounded to cents


def test_member_names_that_repeat_are_added_up(spark, facts, bridge):
    names = spark.createDataFrame([(1, "x"), (2, "x"), (3, "y")], "s int, name string")
    got = {r.name: r.m for r in weighted_agg(facts, bridge, names, "c", "s", "name", {"m": "m"}).collect()}
    assert got == {"x": Dec("107.32"), "y": Dec("3.74")}


def test_fan_out_totals(facts, bridge):
    row = fan_out_totals(facts, bridge, "c", "m").first()
    assert row.true_total == Dec("118.06")
    assert row.weighted_total == Dec("111.06")
    assert row.unweighted_total == Dec("100.05") + 3 * Dec("11.01")


def test_multi_member(bridge):
    assert {r.c for r in multi_member(bridge, "c").collect()} == {2}
    assert multi_member(bridge, "c").count() == 3


def test_dual_role_join(spark):
    pairs = spark.createDataFrame([(1, 2), (2, 1), (1, 9)], "p int, s int")
    suppliers = spark.createDataFrame([(1, "A"), (2, "B")], "id int, name string")
    out = dual_role_join(pairs, suppliers, "id", "name", {"p": "pn", "s": "sn"})
    assert sorted((r.pn, r.sn) for r in out.collect()) == [("A", "B"), ("B", "A")]


def test_only_of_kind(spark):
    rows = [(1, "Emergency"), (2, "Emergency"), (2, "Secondary"), (3, "Primary"), (3, "Emergency"), (4, "Secondary")]
    df = spark.createDataFrame(rows, "k int, t string")
    out = only_of_kind(df, "k", "t", "Emergency", "Secondary")
    assert sorted(r.k for r in out.collect()) == [1, 3]


def test_double_weights_work_too(facts, bridge, members):
    as_double = bridge.withColumn("Allocation_Weight", F.col("Allocation_Weight").cast("double"))
    out = weighted_agg(facts, as_double, members, "c", "s", "name", {"m": "m"})
    assert {r.name: r.m for r in out.collect()}["one"] == pytest.approx(103.68)


def test_unallocated_keeps_the_total_of_short_and_null_weights(spark):
    facts = spark.createDataFrame([(k, Dec("100.00")) for k in (1, 2, 3)], "c int, m decimal(18,2)")
    bridge = spark.createDataFrame(
        [(1, 1, Dec("0.60")), (2, 1, None), (2, 2, None)], "c int, s int, Allocation_Weight decimal(5,2)"
    )
    names = spark.createDataFrame([(1, "a"), (2, "b")], "s int, name string")
    out = weighted_agg(facts, bridge, names, "c", "s", "name", {"m": "m"}, unallocated=True)
    assert {r.name: r.m for r in out.collect()} == {"a": Dec("60.00"), "b": Dec("0.00"), "Unallocated": Dec("240.00")}


def test_apportioned_parts_add_up(spark):
    rows = [("a", "x", Dec("10.3333")), ("a", "y", Dec("10.3333")), ("a", "z", Dec("10.3334")), ("b", "x", Dec("-1.0050")), ("b", "y", Dec("2.0050")), ("c", "x", None), ("c", "y", Dec("0.0050"))]
    parts = spark.createDataFrame(rows, "g string, m string, v decimal(38,4)")
    got = {(r.g, r.m): r.v for r in apportioned(parts, "m", ["v"], ["g"]).collect()}
    assert got == {("a", "x"): Dec("10.33"), ("a", "y"): Dec("10.33"), ("a", "z"): Dec("10.34"), ("b", "x"): Dec("-1.00"), ("b", "y"): Dec("2.00"), ("c", "x"): None, ("c", "y"): Dec("0.01")}


def test_apportioned_in_one_group(spark):
    parts = spark.createDataFrame([(f"m{i}", Dec(1) / Dec(3)) for i in range(3)], "m string, v decimal(38,10)")
    assert sorted(r.v for r in apportioned(parts, "m", ["v"]).collect()) == [Dec("0.33"), Dec("0.33"), Dec("0.34")]
