"""Properties of the generated tables, over several key counts."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators.generators import RELATIONSHIPS, SEGMENTS, segment_bridge, segment_dimension, substitution_bridge


def keys(spark, name, first, n):
    return spark.range(first, first + n).select(F.col("id").cast("int").alias(name))


def test_segment_dimension(spark):
    assert [tuple(r) for r in segment_dimension(spark).orderBy("Segment_Key").collect()] == list(enumerate(SEGMENTS, 1))


@pytest.mark.parametrize(("first", "n"), [(1, 1), (1, 403), (0, 5000)])
def test_segment_bridge(spark, first, n):
    bridge = segment_bridge(keys(spark, "Customer_Key", first, n), first_key=first)
    per = bridge.groupBy("Customer_Key").agg(
        F.sum("Allocation_Weight").alias("w"), F.count("*").alias("n"), F.count_distinct("Segment_Key").alias("d"),
        F.min("Allocation_Weight").alias("lo"), F.min("Segment_Key").alias("s0"), F.max("Segment_Key").alias("s1"),
    ).collect()
    assert len(per) == n
    for r in per:
        assert r.w == 1 and r.n == r.d and 1 <= r.n <= 3 and r.lo >= Decimal("0.10") and 1 <= r.s0 <= r.s1 <= 7
    if n > 100:
        assert {r.n for r in per} == {1, 2, 3}


def test_segment_bridge_repeats_and_follows_the_seed(spark):
    customers = keys(spark, "Customer_Key", 1, 300)
    a, b = (sorted(map(tuple, segment_bridge(customers).collect())) for _ in range(2))
    c = sorted(map(tuple, segment_bridge(customers, seed=7).collect()))
    assert a == b != c
    # key 0 stays outside where keys start at 1
    assert segment_bridge(keys(spark, "Customer_Key", 0, 3)).filter("Customer_Key = 0").isEmpty()


@pytest.mark.parametrize(("n_items", "n_suppliers", "expected"), [(672, 28, 200), (200, 3, 200), (60, 28, 200), (7, 2, 200)])
def test_substitutes_dealt_out_over_items(spark, n_items, n_suppliers, expected):
    out = substitution_bridge(keys(spark, "Stock_Item_Key", 1, n_items), keys(spark, "Supplier_Key", 1, n_suppliers))
    rows = out.collect()
    assert len(rows) == expected
    # row i belongs to item i mod n + 1, so the counts differ by one at most
    counts = {}
    for r in rows:
        counts[r.Stock_Item_Key] = counts.get(r.Stock_Item_Key, 0) + 1
    assert sorted(counts) == list(range(1, min(n_items, expected) + 1))
    assert max(counts.values()) - min(counts.values()) <= 1
    for r in rows:
        assert r.Primary_Supplier_Key != r.Substitute_Supplier_Key
        assert 1 <= r.Primary_Supplier_Key <= n_suppliers and 1 <= r.Substitute_Supplier_Key <= n_suppliers
        assert 1 <= r.Lead_Time_Days <= 45 and 0 <= r.Unit_Cost_Premium_Pct <= 25
        assert r.Relationship_Type in RELATIONSHIPS
    if n_items >= 200:
        assert all(r.Relationship_Type == RELATIONSHIPS[(r.Stock_Item_Key - 1) % 3] for r in rows)
        assert 0.75 < sum(r.Is_Active for r in rows) / len(rows) < 0.95


def test_substitutes_per_item(spark):
    out = substitution_bridge(
        keys(spark, "Stock_Item_Key", 0, 50), keys(spark, "Supplier_Key", 0, 10), None, "1 + Stock_Item_Key % 3", first_key=0
    )
    counts = {r.Stock_Item_Key: r["count"] for r in out.groupBy("Stock_Item_Key").count().collect()}
    assert counts == {k: 1 + k % 3 for k in range(50)}


def test_single_supplier_has_no_substitute(spark):
    out = substitution_bridge(keys(spark, "Stock_Item_Key", 1, 4), keys(spark, "Supplier_Key", 1, 1), 4)
    assert out.count() == 0


def test_rows_argument(spark):
    with pytest.raises(ValueError):
        substitution_bridge(keys(spark, "Stock_Item_Key", 1, 4), keys(spark, "Supplier_Key", 1, 1), 4, "1")
