"""Enrichment of a loaded warehouse: two versioned dimensions, two bridges, two views."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from starmart.operators import generators, scd2
from starmart.sources.tables import Layout, load_base_tables, summary_frame, write_table, write_view

# The recoding of buying groups and the eras of prices and groups.
GROUP_RECODE = {"Tailspin Toys": "Wingtip Toys", "Wingtip Toys": "Tailspin Toys", "N/A": "Tailspin Toys"}
GROUP_ERA = scd2.Era(dt.date(2013, 1, 1), dt.date(2018, 12, 31))
PRICE_ERAS = (
    scd2.Era(dt.date(2013, 1, 1), dt.date(2018, 12, 31), Decimal("0.85")),
    scd2.Era(dt.date(2019, 1, 1), dt.date(2019, 12, 31), Decimal("0.92")),
)
PRICE_CURRENT_FROM = dt.date(2020, 1, 1)
#: The tables that the enrichment writes.
ENRICHED = (
    "Dimension_Customer_SCD2",
    "Dimension_StockItem_SCD2",
    "Bridge_SupplierSubstitution",
    "Dimension_CustomerSegment",
    "Bridge_CustomerSegment",
)
PRICED = ("Unit_Price", "Recommended_Retail_Price")


@dataclass(frozen=True)
class Enrichment:
    """How far history reaches and how much is generated. Defaults fit the full warehouse."""

    changed_customers: Column | int = 150
    group_recode: dict | None = None
    unknown_group: str = "null"
    group_era: scd2.Era = GROUP_ERA
    changed_items: Column | int = 100
    price_eras: tuple[scd2.Era, ...] = PRICE_ERAS
    price_current_from: dt.date = PRICE_CURRENT_FROM
    priced: tuple[str, ...] = PRICED
    unchanged_items_from: dt.date | None = None
    substitution_rows: int | None = 200
    substitutes_per_item: str | None = None
    first_key: int = 1
    seed: int = 42


def _up_to(key: str, bound: Column | int) -> Column:
    return bound if isinstance(bound, Column) else F.col(key) <= bound


def customer_versions(customers: DataFrame, e: Enrichment = Enrichment()) -> DataFrame:
    """Customers with the buying group they had before the change."""
    changed = _up_to("Customer_Key", e.changed_customers)
    recoding = GROUP_RECODE if e.group_recode is None else e.group_recode
    return scd2.scd2_recoded(customers, changed, "Buying_Group", recoding, e.group_era, e.unknown_group)


def stock_item_versions(items: DataFrame, e: Enrichment = Enrichment()) -> DataFrame:
    """Stock items with their earlier prices; a price column of ``e.priced`` that is missing is an error."""
    missing = [p for p in e.priced if p not in items.columns]
    if missing:
        raise ValueError(f"price columns not found: {missing}")
    return scd2.scd2_tiered(
        items,
        _up_to("Stock_Item_Key", e.changed_items),
        list(e.priced),
        list(e.price_eras),
        e.price_current_from,
        e.unchanged_items_from,
    )


def customer_segments(customers: DataFrame, e: Enrichment = Enrichment()) -> DataFrame:
    return generators.segment_bridge(customers, e.seed, first_key=e.first_key)


def supplier_substitutes(items: DataFrame, suppliers: DataFrame, e: Enrichment = Enrichment()) -> DataFrame:
    return generators.substitution_bridge(
        items, suppliers, e.substitution_rows, e.substitutes_per_item, e.seed, first_key=e.first_key
    )


def enrich(
    spark: SparkSession,
    schema: str = "dbo",
    fmt: str = "parquet",
    overwrite: bool = True,
    e: Enrichment = Enrichment(),
    layout: Layout | None = None,
) -> list[tuple[str, int]]:
    """Write the enrichment tables and views beside the base tables; returns row counts."""
    customers, items, suppliers = (
        spark.table(f"{schema}.{n}") for n in ("Dimension_Customer", "Dimension_Stock_Item", "Dimension_Supplier")
    )
    frames = {
        "Dimension_Customer_SCD2": customer_versions(customers, e),
        "Dimension_StockItem_SCD2": stock_item_versions(items, e),
        "Bridge_SupplierSubstitution": supplier_substitutes(items, suppliers, e),
        "Dimension_CustomerSegment": generators.segment_dimension(spark),
        "Bridge_CustomerSegment": customer_segments(customers, e),
    }
    counts = [
        (name, write_table(df, name, schema, fmt, overwrite, **(layout or {}).get(name, {})))
        for name, df in frames.items()
    ]
    for view, table in (
        ("vw_Customer_Current", "Dimension_Customer_SCD2"),
        ("vw_StockItem_Current", "Dimension_StockItem_SCD2"),
    ):
        write_view(spark, view, f"SELECT * FROM {schema}.{table} WHERE Is_Current = true", schema)
    return counts


def build_warehouse(
    spark: SparkSession,
    csv_root: str,
    schema: str = "dbo",
    fmt: str = "parquet",
    overwrite: bool = True,
    e: Enrichment = Enrichment(),
    layout: Layout | None = None,
    on_error: str = "fail",
    multi_line: bool = False,
) -> DataFrame:
    """Load, enrich and add views; returns the load summary."""
    counts = load_base_tables(
        spark, csv_root, schema, fmt, overwrite, on_error, layout=layout, multi_line=multi_line
    )
    counts += enrich(spark, schema, fmt, overwrite, e, layout)
    return summary_frame(spark, counts)
