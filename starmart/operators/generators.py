"""Generated enrichment tables: segments, their bridge, supplier substitutes.

Rows come from the dimensions they enrich, as column expressions over the key, so
they scale with the key set. The key ranges stay scalar subqueries in the plan;
nothing is brought to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart.functions.columns import draw
from starmart.functions.sqltext import name, text

# The segments, numbered from 1 in this order.
SEGMENTS = ("High Value", "Growth", "Loyal", "Seasonal", "At Risk", "New Business", "Tail")
# The relationship types, cycled in this order.
RELATIONSHIPS = ("Primary", "Secondary", "Emergency")


def segment_dimension(spark: SparkSession) -> DataFrame:
    """The segments and their keys. A range has a known size, so joins see how small it is."""
    names = ", ".join(text(s) for s in SEGMENTS)
    return spark.range(1, len(SEGMENTS) + 1, 1, 1).selectExpr(
        "CAST(id AS INT) AS Segment_Key", f"element_at(array({names}), CAST(id AS INT)) AS Segment"
    )


def segment_bridge(customers: DataFrame, seed: int = 42, key: str = "Customer_Key", first_key: int = 1) -> DataFrame:
    """One to three distinct segments per customer, weights in hundredths that add up to 1.

    Two segments take 0.30-0.70 and the rest; three take 0.20-0.50, then from 0.20
    up to what leaves at least 0.10, and the rest.
    """
    k, n_segments = f"CAST({name(key)} AS BIGINT)", len(SEGMENTS)
    plan = customers.filter(F.col(key) >= first_key).selectExpr(
        name(key),
        f"{draw(k, seed, 1, 3)} + 1 AS n",
        f"{draw(k, seed, 2, n_segments)} AS first",
        f"{draw(k, seed, 3, n_segments - 1)} + 1 AS step",
        f"{draw(k, seed, 4, 41)} + 30 AS half",
        f"{draw(k, seed, 5, 31)} + 20 AS third",
    )

    def entry(j: int, hundredths: str) -> str:
        # The number of segments is prime, so equal steps around it never meet.
        member = f"CAST((first + step * {j}) % {n_segments} + 1 AS INT)"
        weight = f"CAST(CAST({hundredths} AS DECIMAL(3,0)) * 0.01BD AS DECIMAL(5,2))"
        return f"named_struct('Segment_Key', {member}, 'Allocation_Weight', {weight})"

    one = f"array({entry(0, '100')})"
    two = f"array({entry(0, 'half')}, {entry(1, '100 - half')})"
    three = f"array({entry(0, 'third')}, {entry(1, 'second')}, {entry(2, '100 - third - second')})"
    return (
        plan.selectExpr("*", f"{draw(k, seed, 6, '71 - third')} + 20 AS second")
        .selectExpr(name(key), f"explode(CASE n WHEN 1 THEN {one} WHEN 2 THEN {two} ELSE {three} END) AS m")
        .selectExpr(name(key), "m.Segment_Key", "m.Allocation_Weight")
    )


def substitution_bridge(
    items: DataFrame,
    suppliers: DataFrame,
    total_rows: int | None = 200,
    rows_per_item: str | None = None,
    seed: int = 42,
    item_key: str = "Stock_Item_Key",
    supplier_key: str = "Supplier_Key",
    first_key: int = 1,
) -> DataFrame:
    """Substitute suppliers per stock item.

    Row ``i`` belongs to item ``i`` modulo the items, its primary supplier is ``i``
    modulo the suppliers and its type cycles with ``i``. Either ``total_rows`` rows
    are dealt out over the items in turn, or each item gets ``rows_per_item`` (a SQL
    expression over the item's columns). A substitute is another supplier; where there is
    only one, there are no rows.
    """
    if (total_rows is None) == (rows_per_item is None):
        raise ValueError("give either total_rows or rows_per_item")
    item = name(item_key)
    n_items = items.selectExpr(f"CAST(max({item}) - {first_key} + 1 AS BIGINT)").scalar()
    n_suppliers = suppliers.selectExpr(f"CAST(max({name(supplier_key)}) - {first_key} + 1 AS BIGINT)").scalar()
    position = f"CAST({item} - {first_key} AS BIGINT)"
    copies = rows_per_item or f"(greatest({total_rows} - 1 - {position}, -n_items) + n_items) div n_items"
    rows = (
        items.filter(F.col(item_key) >= first_key)
        .select(item_key, n_items.alias("n_items"), n_suppliers.alias("s"))
        .selectExpr("*", f"CAST({copies} AS INT) AS copies")
        .filter("copies > 0 AND s > 1")
        .selectExpr(item, "s", "n_items", "explode(sequence(0, copies - 1)) AS copy")
        .selectExpr(item, "s", f"copy * n_items + {position} AS i")
    )
    # One to s - 1 suppliers further on: never the primary itself.
    offset = f"{draw('i', seed, 1, 's - 1')} + 1"
    drawn = rows.selectExpr(item, "i", "i % s AS primary", f"(i + {offset}) % s AS substitute")
    kinds = ", ".join(text(r) for r in RELATIONSHIPS)
    premium = f"CAST({draw('i', seed, 3, 2501)} AS DECIMAL(4,0)) * 0.01BD"
    return drawn.selectExpr(
        item,
        f"primary + {first_key} AS Primary_Supplier_Key",
        f"substitute + {first_key} AS Substitute_Supplier_Key",
        f"element_at(array({kinds}), CAST(i % {len(RELATIONSHIPS)} + 1 AS INT)) AS Relationship_Type",
        f"CAST({draw('i', seed, 2, 45)} + 1 AS INT) AS Lead_Time_Days",
        f"CAST({premium} AS DECIMAL(5,2)) AS Unit_Cost_Premium_Pct",
        f"{draw('i', seed, 4, 100)} < 85 AS Is_Active",
    )
