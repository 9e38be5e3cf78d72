"""Operators over the sample mart that no question covers by itself."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from starmart.functions.columns import OPEN_END, recode
from starmart.operators import quality, scd2, scd2_refresh
from starmart.operators.bridge import weighted_agg
from starmart.operators.scd2 import Era
from starmart.operators.temporal import as_of
from starmart.plans import sales, segments
from starmart.plans.mart import FrameMart
from starmart.session import database, scratch_path
from starmart.sources import typed_csv
from starmart.sources.tables import MONTH, broken_views, formatted, row_counts, with_month, write_table, write_view
from starmart.sources.testdata import GROUP_ERA, GROUP_RECODE, OPENED, SampleMart

_PARTIAL_RECODE = {"BUILDING": "MACHINERY", "MACHINERY": "BUILDING", "AUTOMOBILE": "BUILDING"}
_REOPENED = dt.date(1999, 1, 1)


def _customers(mart: SampleMart) -> DataFrame:
    return mart.table("Dimension_Customer")


def _versions(mart: SampleMart) -> DataFrame:
    return mart.table("Dimension_Customer_SCD2")


def _history(mart: SampleMart, default: str) -> DataFrame:
    return scd2.scd2_history(
        _customers(mart), mart.changed_customers(), "Buying_Group", _PARTIAL_RECODE, GROUP_ERA, default
    )


def _reopened(mart: SampleMart) -> DataFrame:
    return scd2.scd2_reopen(scd2.scd2_current(_customers(mart)), mart.changed_customers(), _REOPENED)


def _by_union(mart: SampleMart) -> DataFrame:
    return scd2.scd2_union(_customers(mart), mart.changed_customers(), "Buying_Group", GROUP_RECODE, GROUP_ERA)


def _misdated(mart: SampleMart, end: dt.date) -> DataFrame:
    """Versions whose history does not end the day before the current version starts."""
    era = Era(OPENED, end)
    past = scd2.scd2_history(_customers(mart), mart.changed_customers(), "Buying_Group", GROUP_RECODE, era)
    return quality.era_violations(past.unionByName(_reopened(mart)), "Customer_Key")


def _late_start_items(mart: SampleMart) -> DataFrame:
    """Unchanged items only from the start of the current prices on."""
    return mart.item_versions(unchanged_from=None)


def _segment_sizes(mart: SampleMart) -> DataFrame:
    sizes = mart.table("Bridge_CustomerSegment", "Segment_Key").groupBy("Segment_Key").agg(
        F.count(F.lit(1)).alias("n")
    )
    named = mart.table("Dimension_CustomerSegment").join(sizes, "Segment_Key", "left")
    return named.select("Segment_Key", "Segment", F.coalesce("n", F.lit(0).cast("long")).alias("n_customers"))


def _coverage(mart: SampleMart, versions: DataFrame, key: str, closed: str = "both") -> DataFrame:
    sale = mart.table("Fact_Sale", key, "Invoice_Date_Key")
    return quality.temporal_coverage(sale, versions, key, "Invoice_Date_Key", closed)


def _closed_group(mart: SampleMart) -> DataFrame:
    """Current violations after one buying group's current versions were closed."""
    closes = F.when(
        F.col("Is_Current") & (F.col("Buying_Group") == "FURNITURE"), F.lit(dt.date(2001, 12, 31))
    ).otherwise(F.col("Valid_To"))
    closed = _versions(mart).withColumn("Valid_To", closes)
    return quality.current_violations(closed, "Customer_Key", F.lit(OPEN_END))


def _unallocated(mart: SampleMart) -> DataFrame:
    """Segment revenue over a bridge without customer 0, with short and with NULL weights; it adds up to all revenue."""
    bridge = mart.table("Bridge_CustomerSegment").filter("Customer_Key >= 1 AND NOT (Customer_Key % 7 = 1 AND Segment_Key > 4)")
    return weighted_agg(
        mart.table("Fact_Sale", "Customer_Key", "Total_Including_Tax"),
        bridge.withColumn("Allocation_Weight", F.expr("IF(Customer_Key % 5 = 2, NULL, Allocation_Weight)")),
        mart.table("Dimension_CustomerSegment"),
        "Customer_Key",
        "Segment_Key",
        "Segment",
        {"weighted_revenue": "Total_Including_Tax"},
        unallocated=True,
    )


def _apportioned_totals(mart: SampleMart) -> DataFrame:
    """Sums of the segments' rounded shares against the revenue they share, in all and by year: no cent is missing."""
    allocated, total = F.sum("weighted_revenue").alias("allocated"), F.col("revenue").alias("total_revenue")
    whole = segments.segment_revenue(mart, unallocated=True, adding_up=True).agg(allocated).withColumn("Calendar_Year", F.lit(0))
    yearly = segments.segment_revenue_by_year(mart, adding_up=True).groupBy("Calendar_Year").agg(allocated)
    revenue = sales.total_revenue(mart).withColumn("Calendar_Year", F.lit(0))
    revenue = revenue.unionByName(sales.revenue_by_year(mart).select(total, "Calendar_Year"))
    sides = whole.unionByName(yearly).unionByName(revenue, allowMissingColumns=True).groupBy("Calendar_Year")
    sums = sides.agg(F.sum("allocated").alias("allocated"), F.sum("total_revenue").alias("total_revenue"))
    return sums.withColumn("missing", F.col("total_revenue") - F.col("allocated"))


def _key_ranges(mart: SampleMart) -> DataFrame:
    """Smallest and largest key per dimension."""
    keys = {
        "Dimension_Customer": "Customer_Key",
        "Dimension_Stock_Item": "Stock_Item_Key",
        "Dimension_Supplier": "Supplier_Key",
    }
    ranges = [
        mart.table(table, key)
        .agg(F.min(key).alias("first_key"), F.max(key).alias("last_key"))
        .select(F.lit(table).alias("table_name"), "first_key", "last_key")
        for table, key in keys.items()
    ]
    return reduce(DataFrame.unionByName, ranges)


_SUBSTITUTE = ["Stock_Item_Key", "Primary_Supplier_Key", "Substitute_Supplier_Key", "Relationship_Type"]


def _emergency_from_primary(mart: SampleMart) -> DataFrame:
    """Self-substitutes after emergency rows were pointed at their primary supplier."""
    wrong = F.when(F.col("Relationship_Type") == "Emergency", F.col("Primary_Supplier_Key")).otherwise(
        F.col("Substitute_Supplier_Key")
    )
    bridge = mart.table("Bridge_SupplierSubstitution", *_SUBSTITUTE)
    return quality.self_substitutes(bridge.withColumn("Substitute_Supplier_Key", wrong))


def _foreign_keys(mart: SampleMart, customers: str = "true") -> DataFrame:
    """Orphans of each key that the sample mart holds; ``customers`` picks the customers that are known."""
    pairs = [
        ("Fact_Sale", "City_Key", "Dimension_City", "City_Key"),
        ("Fact_Sale", "Bill_To_Customer_Key", "Dimension_Customer", "Customer_Key"),
        ("Fact_Sale", "Salesperson_Key", "Dimension_Employee", "Employee_Key"),
        ("Fact_Sale", "Supplier_Key", "Dimension_Supplier", "Supplier_Key"),
        ("Fact_Sale", "Invoice_Date_Key", "Dimension_Date", "Date"),
        ("Fact_Sale", "Delivery_Date_Key", "Dimension_Date", "Date"),
        ("Fact_Order", "Order_Date_Key", "Dimension_Date", "Date"),
        ("Fact_Order", "Picked_Date_Key", "Dimension_Date", "Date"),
        ("Fact_Order", "Salesperson_Key", "Dimension_Employee", "Employee_Key"),
        ("Fact_Order", "Picker_Key", "Dimension_Employee", "Employee_Key"),
        ("Fact_Purchase", "Date_Key", "Dimension_Date", "Date"),
        ("Fact_Purchase", "Stock_Item_Key", "Dimension_Stock_Item", "Stock_Item_Key"),
        ("Fact_Movement", "Date_Key", "Dimension_Date", "Date"),
        ("Fact_Movement", "Stock_Item_Key", "Dimension_Stock_Item", "Stock_Item_Key"),
        ("Fact_Movement", "Supplier_Key", "Dimension_Supplier", "Supplier_Key"),
        ("Fact_Movement", "Transaction_Type_Key", "Dimension_Transaction_Type", "Transaction_Type_Key"),
        ("Fact_Transaction", "Date_Key", "Dimension_Date", "Date"),
        ("Fact_Transaction", "Bill_To_Customer_Key", "Dimension_Customer", "Customer_Key"),
        ("Fact_Transaction", "Payment_Method_Key", "Dimension_Payment_Method", "Payment_Method_Key"),
        ("Fact_Sale", "Customer_Key", "Dimension_Customer", "Customer_Key"),
        ("Fact_Sale", "Stock_Item_Key", "Dimension_Stock_Item", "Stock_Item_Key"),
        ("Fact_Order", "Customer_Key", "Dimension_Customer", "Customer_Key"),
        ("Fact_Purchase", "Supplier_Key", "Dimension_Supplier", "Supplier_Key"),
        ("Fact_Transaction", "Customer_Key", "Dimension_Customer", "Customer_Key"),
        ("Fact_Stock_Holding", "Stock_Item_Key", "Dimension_Stock_Item", "Stock_Item_Key"),
    ]
    facts = {f: mart.table(f, *[k for name, k, *_ in pairs if name == f]) for f in dict.fromkeys(p[0] for p in pairs)}
    known = {(d, dk): mart.table(d, dk) for _, _, d, dk in pairs}
    known["Dimension_Customer", "Customer_Key"] = known["Dimension_Customer", "Customer_Key"].filter(customers)
    return quality.foreign_key_report([(f, fk, d, facts[f], known[d, dk], dk) for f, fk, d, dk in pairs])


def _row_counts(mart: SampleMart) -> DataFrame:
    """All tables of the mart: the fourteen base tables and the five of the enrichment."""
    base = "Date City Customer Employee Stock_Item Supplier Payment_Method Transaction_Type"
    facts = "Order Purchase Movement Stock_Holding Transaction"
    names = [f"Dimension_{n}" for n in base.split()] + [f"Fact_{n}" for n in facts.split()]
    names += ["Dimension_Customer_SCD2", "Dimension_StockItem_SCD2", "Dimension_CustomerSegment"]
    names += ["Bridge_CustomerSegment", "Bridge_SupplierSubstitution"]
    frames = {n: mart.table(n) for n in names}
    return row_counts({**frames, "Fact_Sale": mart.table("Fact_Sale", "Sale_Key")})


def _csv_round_trip(mart: SampleMart) -> DataFrame:
    """Stock items out to CSV and back through typed casts."""
    path = scratch_path(mart.spark, "stock-items")
    items = mart.table("Dimension_Stock_Item", "Stock_Item_Key", "Stock_Item", "Brand", "Size", "Unit_Price")
    typed_csv.export_csv(items.toDF(*[c.replace("_", " ") for c in items.columns]), path)
    return typed_csv.read_typed_csv(
        mart.spark, path, {"Stock Item Key": "long", "Unit Price": "decimal(18,2)"}
    )


def _table_round_trip(mart: SampleMart) -> DataFrame:
    """Orders through a catalog table: written, kept on the second write, read by name."""
    orders = mart.table("Fact_Order", "Order_Key", "Customer_Key", "Order_Date_Key", "Total_Including_Tax")
    spaced = orders.toDF(*[c.replace("_", " ") for c in orders.columns])
    with database(mart.spark, "fact-order") as (schema, path):
        write_table(spaced, "Orders", schema, path=f"{path}/Orders")
        write_table(spaced.unionByName(spaced), "Orders", schema, path=f"{path}/Orders", overwrite=False)
        return mart.spark.table(f"{schema}.Orders")


def _schema_replacement(mart: SampleMart) -> DataFrame:
    """A table replaced by a frame that reads it, with a column gone, one of another type and one more."""
    with database(mart.spark, "replaced") as (schema, path):
        write_table(mart.table("Fact_Order", "Order_Key", "Customer_Key", "Order_Date_Key"), "Orders", schema, path=f"{path}/Orders")
        stored = mart.spark.table(f"{schema}.Orders")
        doubled = stored.unionByName(stored.filter("Customer_Key % 2 = 0"))
        changed = doubled.selectExpr("CAST(Order_Key AS STRING) AS Order_Key", "Customer_Key", "year(Order_Date_Key) AS Order_Year")
        write_table(changed, "Orders", schema, path=f"{path}/Orders")
        return mart.spark.table(f"{schema}.Orders")


def _through_view(mart: SampleMart, table: str, view: str) -> DataFrame:
    """Current versions by `SELECT` from a view, after the table below it was replaced."""
    with database(mart.spark, "views") as (schema, path):
        versions = mart.table(table)
        write_table(versions.filter("NOT Is_Current"), table, schema, path=f"{path}/{table}")
        write_view(mart.spark, view, f"SELECT * FROM {schema}.{table} WHERE Is_Current = true", schema)
        write_table(versions, table, schema, path=f"{path}/{table}")
        broken = broken_views(mart.spark, schema)
        if broken:
            raise ValueError(f"views do not resolve: {broken}")
        return mart.spark.sql(f"SELECT * FROM {schema}.{view}")


def _export_tables(mart: SampleMart) -> DataFrame:
    """Catalog tables exported together, one of them with a binary column: rows, total and the headers that were written."""
    frames = {
        "Customers_With_Photo": mart.table("Dimension_Customer", "Customer_Key", "Customer").selectExpr("*", "CAST(Customer AS BINARY) AS Photo", "Customer_Key % 3 AS `Third Part`"),
        "Order_Totals": mart.table("Fact_Order", "Order_Key", "Total_Including_Tax"),
        "Supplier_Names": mart.table("Dimension_Supplier"),
    }
    with database(mart.spark, "exports") as (schema, path):
        for name, df in frames.items():
            write_table(df, name, schema, path=f"{path}/{name}")
        summary = typed_csv.export_tables(mart.spark, schema, f"{path}/csv", list(frames))
        written = [(n, ",".join(next(iter(typed_csv.headers(mart.spark, f"{path}/csv/{n}.csv").values())))) for n in frames]
    found = mart.spark.createDataFrame(written, "table_name string, header string")
    return summary.join(found, "table_name", "left")


def _other_headers(mart: SampleMart) -> DataFrame:
    """A folder of CSV files whose columns come in other orders, or not at all."""
    path = scratch_path(mart.spark, "headers")
    items = mart.table("Dimension_Stock_Item", "Stock_Item_Key", "Stock_Item", "Brand", "Unit_Price")
    orders = [["Stock_Item_Key", "Stock_Item", "Brand", "Unit_Price"], ["Unit_Price", "Brand", "Stock_Item_Key", "Stock_Item"], ["Stock_Item", "Unit_Price", "Stock_Item_Key"]]
    for i, columns in enumerate(orders):
        typed_csv.export_csv(items.filter(f"Stock_Item_Key % 3 = {i}").select(*columns), f"{path}/part{i}")
    return typed_csv.read_typed_csv(mart.spark, path, {"Stock_Item_Key": "long", "Unit_Price": "decimal(18,2)"})


_ATTRIBUTES = ("Customer_Key", "Customer", "Buying_Group")


def _snapshots(mart: SampleMart) -> list[tuple[dt.date, DataFrame]]:
    """Three days' snapshots: groups before the change; today's; today's without some customers and with others renamed."""
    customers = mart.table("Dimension_Customer", *_ATTRIBUTES)
    recoded = F.when(mart.changed_customers(), recode("Buying_Group", GROUP_RECODE)).otherwise(F.col("Buying_Group"))
    renamed = "IF(Customer_Key % 7 = 2, NULL, Customer)"
    later = customers.filter("Customer_Key % 5 <> 3").selectExpr("Customer_Key", f"{renamed} AS Customer", "Buying_Group")
    return [(OPENED, customers.withColumn("Buying_Group", recoded)), (_REOPENED, customers), (dt.date(2000, 6, 1), later)]


def _refreshed(mart: SampleMart) -> DataFrame:
    """Customer versions from two snapshots, one after the other: those of a rebuild."""
    (first, before), (second, after) = _snapshots(mart)[:2]
    return scd2_refresh.merged(scd2_refresh.opened_on(before, first), after, "Customer_Key", second)


def _refreshed_table(mart: SampleMart, counts: bool) -> DataFrame:
    """A stored dimension after all snapshots, the second one twice; or what each refresh opened and closed."""
    snapshots = _snapshots(mart)
    steps = []
    with database(mart.spark, "refreshed") as (schema, path):
        for day, snapshot in [*snapshots[:2], snapshots[1], snapshots[2]]:
            found = scd2_refresh.refresh_dimension(mart.spark, "Customers", snapshot, "Customer_Key", day, schema, f"{path}/Customers")
            steps.append((len(steps) + 1, found[scd2_refresh.OPENED], found[scd2_refresh.CLOSED], found[scd2_refresh.DROPPED]))
        if counts:
            return mart.spark.createDataFrame(steps, "step int, opened long, closed long, dropped long")
        return mart.spark.table(f"{schema}.Customers")


def _year_by_partition(mart: SampleMart, year: int = 1998) -> DataFrame:
    """A year's revenue over a fact stored by month, the year taken from the calendar."""
    path = scratch_path(mart.spark, "by-month")
    sale = mart.table("Fact_Sale", "Invoice_Date_Key", "Total_Including_Tax")
    with_month(sale, "Invoice_Date_Key").write.partitionBy("Invoice_Date_Key" + MONTH).parquet(path)
    stored = FrameMart(Fact_Sale=mart.spark.read.parquet(path), Dimension_Date=mart.table("Dimension_Date"))
    return sales.revenue_of_calendar_year(stored, year)


def _export_summary(mart: SampleMart) -> DataFrame:
    """Row counts as taken while the tables were exported."""
    from starmart.sources.tables import summary_frame

    names = ("Dimension_Customer", "Fact_Order")
    counts = [(n, typed_csv.export_csv(mart.table(n), scratch_path(mart.spark, n))) for n in names]
    return summary_frame(mart.spark, counts)


CHECKS: dict[str, Callable[[SampleMart], DataFrame]] = {
    "q08_segment_revenue_unallocated": _unallocated,
    "v03_apportioned_totals": _apportioned_totals,
    "a11_key_ranges": _key_ranges,
    "e01_current_versions": lambda m: scd2.scd2_current(_customers(m)),
    "e02_history_unknown_null": lambda m: _history(m, "null"),
    "e02_history_unknown_kept": lambda m: _history(m, "keep"),
    "e03_reopened_versions": _reopened,
    "e04_customer_versions": _versions,
    "u01_customer_versions_by_union": _by_union,
    "e05_stock_item_versions": lambda m: m.table("Dimension_StockItem_SCD2"),
    "e05_stock_item_versions_late_start": _late_start_items,
    "e06_supplier_substitutes": lambda m: m.table("Bridge_SupplierSubstitution"),
    "e08_segment_sizes": _segment_sizes,
    "e09_segment_bridge": lambda m: m.table("Bridge_CustomerSegment"),
    "p12_current_customers": lambda m: m.table("vw_Customer_Current"),
    "p13_current_stock_items": lambda m: m.table("vw_StockItem_Current"),
    "s12_view_of_current_customers": lambda m: _through_view(m, "Dimension_Customer_SCD2", "vw_Customer_Current"),
    "s12_view_of_current_items": lambda m: _through_view(m, "Dimension_StockItem_SCD2", "vw_StockItem_Current"),
    "e04_customer_versions_by_refresh": _refreshed,
    "e03_refreshed_customers": lambda m: _refreshed_table(m, counts=False),
    "e03_refresh_counts": lambda m: _refreshed_table(m, counts=True),
    "s09_schema_replacement": _schema_replacement,
    "s06_export_tables": _export_tables,
    "s01_files_with_other_headers": _other_headers,
    "f13_formatted_counts": lambda m: formatted(_row_counts(m)),
    "p09_year_by_partition": _year_by_partition,
    "p10_versions_on_a_day": lambda m: as_of(_versions(m), dt.date(1998, 12, 31)),
    "a15_version_counts": lambda m: scd2.version_counts(_versions(m), "Customer_Key"),
    "v01_weight_sum_violations": lambda m: quality.weight_sum_violations(
        m.table("Bridge_CustomerSegment"), "Customer_Key"
    ),
    "v01_weights_without_a_segment": lambda m: quality.weight_sum_violations(
        m.table("Bridge_CustomerSegment").filter("Segment_Key <> 7"), "Customer_Key"
    ),
    "v02_membership_violations": lambda m: quality.membership_violations(
        m.table("Bridge_CustomerSegment"), "Customer_Key", "Segment_Key"
    ),
    "v02_members_of_one_segment": lambda m: quality.membership_violations(
        m.table("Bridge_CustomerSegment"), "Customer_Key", "Segment_Key", lo=2
    ),
    "v03_allocation_reconciliation": lambda m: quality.allocation_reconciliation(
        m.table("Fact_Sale", "Customer_Key", "Total_Including_Tax"),
        m.table("Bridge_CustomerSegment"),
        "Customer_Key",
        "Total_Including_Tax",
    ),
    "v04_customer_era_violations": lambda m: quality.era_violations(_versions(m), "Customer_Key"),
    "v04_eras_ending_early": lambda m: _misdated(m, dt.date(1998, 6, 30)),
    "v04_eras_ending_late": lambda m: _misdated(m, dt.date(1999, 3, 31)),
    "v05_customer_coverage": lambda m: _coverage(m, _versions(m), "Customer_Key"),
    "v05_customer_coverage_half_open": lambda m: _coverage(m, _versions(m), "Customer_Key", "left"),
    "v05_item_coverage": lambda m: _coverage(m, m.table("Dimension_StockItem_SCD2"), "Stock_Item_Key"),
    "v05_item_coverage_late_start": lambda m: _coverage(m, _late_start_items(m), "Stock_Item_Key"),
    "v06_current_violations": lambda m: quality.current_violations(_versions(m), "Customer_Key", F.lit(OPEN_END)),
    "v06_closed_group": _closed_group,
    "v07_self_substitutes": lambda m: quality.self_substitutes(
        m.table("Bridge_SupplierSubstitution", *_SUBSTITUTE)
    ),
    "v07_emergency_from_primary": _emergency_from_primary,
    "v08_foreign_keys": _foreign_keys,
    "v08_foreign_keys_of_unknown_customers": lambda m: _foreign_keys(m, "Customer_Key % 11 <> 3"),
    "v09_row_counts": _row_counts,
    "s01_csv_round_trip": _csv_round_trip,
    "s07_table_round_trip": _table_round_trip,
    "s14_export_summary": _export_summary,
}
