"""Suppliers, substitutes, stock levels, movements, purchases and balances."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.operators.bridge import dual_role_join, only_of_kind
from starmart.operators.star import reduce_fact, signed_split, star_join
from starmart.plans.mart import Mart

_ROLES = {"Primary_Supplier_Key": "primary_supplier", "Substitute_Supplier_Key": "substitute_supplier"}
_TERMS = ["Relationship_Type", "Lead_Time_Days", "Unit_Cost_Premium_Pct"]


def _with_item(mart: Mart, df: DataFrame, *attributes: str) -> DataFrame:
    items = mart.table("Dimension_Stock_Item", "Stock_Item_Key", *attributes)
    return star_join(df, items, "Stock_Item_Key", "Stock_Item_Key", list(attributes))


def below_reorder_level(mart: Mart) -> DataFrame:
    """Items short of their reorder level, in no particular order."""
    holding = mart.table("Fact_Stock_Holding", "Stock_Item_Key", "Quantity_On_Hand", "Reorder_Level")
    short = holding.filter(F.col("Quantity_On_Hand") < F.col("Reorder_Level"))
    return _with_item(mart, short, "Stock_Item").select("Stock_Item", "Quantity_On_Hand", "Reorder_Level")


def below_reorder_level_by_shortfall(mart: Mart) -> DataFrame:
    shortfall = F.col("Reorder_Level") - F.col("Quantity_On_Hand")
    return below_reorder_level(mart).orderBy(F.desc(shortfall), "Stock_Item", "Quantity_On_Hand")


def suppliers_of_item(mart: Mart, item: int | None = 10, active_only: bool = True) -> DataFrame:
    """Primary and substitute suppliers of one item, or of all."""
    bridge = mart.table("Bridge_SupplierSubstitution")
    if item is not None:
        bridge = bridge.filter(F.col("Stock_Item_Key") == item)
    if active_only:
        bridge = bridge.filter("Is_Active")
    suppliers = mart.table("Dimension_Supplier", "Supplier_Key", "Supplier")
    named = dual_role_join(_with_item(mart, bridge, "Stock_Item"), suppliers, "Supplier_Key", "Supplier", _ROLES)
    columns = ["Stock_Item", *_ROLES.values(), *_TERMS]
    return named.select(*columns).orderBy("Relationship_Type", "substitute_supplier", "Stock_Item")


def emergency_suppliers(mart: Mart, premium_above: float = 10.0) -> DataFrame:
    """Active emergency substitutes that cost more than the given premium."""
    bridge = mart.table("Bridge_SupplierSubstitution").filter(
        (F.col("Relationship_Type") == "Emergency")
        & F.col("Is_Active")
        & (F.col("Unit_Cost_Premium_Pct") > F.lit(str(premium_above)).cast("decimal(9,4)"))
    )
    suppliers = mart.table("Dimension_Supplier", "Supplier_Key", "Supplier")
    named = dual_role_join(
        _with_item(mart, bridge, "Stock_Item"),
        suppliers,
        "Supplier_Key",
        "Supplier",
        {"Substitute_Supplier_Key": "emergency_supplier"},
    )
    return named.select("Stock_Item", "emergency_supplier", "Lead_Time_Days", "Unit_Cost_Premium_Pct").orderBy(
        F.desc("Unit_Cost_Premium_Pct"), "Stock_Item", "emergency_supplier", "Lead_Time_Days"
    )


def cost_exposure(mart: Mart, item: int | None = 10) -> DataFrame:
    """What each active alternative to the primary supplier costs and how long it takes."""
    bridge = mart.table("Bridge_SupplierSubstitution").filter("Is_Active")
    if item is not None:
        bridge = bridge.filter(F.col("Stock_Item_Key") == item)
    suppliers = mart.table("Dimension_Supplier", "Supplier_Key", "Supplier")
    named = dual_role_join(
        _with_item(mart, bridge, "Stock_Item", "Unit_Price"), suppliers, "Supplier_Key", "Supplier", _ROLES
    )
    premium = F.col("Unit_Cost_Premium_Pct").cast("decimal(9,2)")
    extra = F.round(F.col("Unit_Price").cast("decimal(12,2)") * premium / 100, 2).cast("decimal(18,2)")
    return (
        named.withColumn("extra_cost", extra)
        .withColumn("exposed_price", (F.col("Unit_Price") + F.col("extra_cost")).cast("decimal(18,2)"))
        .select("Stock_Item", *_ROLES.values(), *_TERMS, "Unit_Price", "extra_cost", "exposed_price")
        .orderBy("Unit_Cost_Premium_Pct", "Lead_Time_Days", "substitute_supplier", "Stock_Item")
    )


def emergency_only_items(mart: Mart, active_only: bool = True) -> DataFrame:
    """Emergency substitutes of items that have no secondary one."""
    bridge = mart.table("Bridge_SupplierSubstitution")
    if active_only:
        bridge = bridge.filter("Is_Active")
    exposed = only_of_kind(bridge, "Stock_Item_Key", "Relationship_Type", "Emergency", "Secondary")
    return (
        _with_item(mart, exposed, "Stock_Item")
        .select("Stock_Item_Key", "Stock_Item", "Unit_Cost_Premium_Pct", "Lead_Time_Days")
        .orderBy("Stock_Item_Key", "Unit_Cost_Premium_Pct", "Lead_Time_Days")
    )


def net_stock_movement(mart: Mart) -> DataFrame:
    """Inflow, outflow and net movement per item; positive quantities come in."""
    moves = mart.table("Fact_Movement", "Stock_Item_Key", "Quantity")
    split = moves.withColumns(signed_split("Quantity"))
    sums = {"quantity_in": "quantity_in", "quantity_out": "quantity_out", "net_quantity": "Quantity"}
    return reduce_fact(split, ["Stock_Item_Key"], sums).orderBy("Stock_Item_Key")


def movement_by_type(mart: Mart) -> DataFrame:
    moves = mart.table("Fact_Movement", "Transaction_Type_Key", "Quantity")
    reduced = reduce_fact(moves, ["Transaction_Type_Key"], {"net_quantity": "Quantity"}, "n_movements")
    types = mart.table("Dimension_Transaction_Type")
    named = star_join(reduced, types, "Transaction_Type_Key", "Transaction_Type_Key", ["Transaction_Type"])
    return named.drop("Transaction_Type_Key").orderBy("Transaction_Type")


def balances_by_year(mart: Mart, open_only: bool = False) -> DataFrame:
    """Transaction totals and outstanding balances per year and finalized flag."""
    moves = mart.table("Fact_Transaction", "Date_Key", "Is_Finalized", "Total_Including_Tax", "Outstanding_Balance")
    if open_only:
        moves = moves.filter(~F.col("Is_Finalized"))
    sums = {"total": "Total_Including_Tax", "outstanding": "Outstanding_Balance"}
    daily = reduce_fact(moves, ["Date_Key", "Is_Finalized"], sums, "n_transactions")
    calendar = mart.table("Dimension_Date", "Date", "Calendar_Year")
    dated = star_join(daily, calendar, "Date_Key", "Date", ["Calendar_Year"])
    return (
        dated.groupBy("Calendar_Year", "Is_Finalized")
        .agg(*[F.sum(c).alias(c) for c in (*sums, "n_transactions")])
        .orderBy("Calendar_Year", "Is_Finalized")
    )


def outstanding_by_payment_method(mart: Mart) -> DataFrame:
    """Open balances per payment method, of transactions not finalized."""
    moves = mart.table("Fact_Transaction", "Payment_Method_Key", "Is_Finalized", "Outstanding_Balance")
    reduced = reduce_fact(
        moves.filter(~F.col("Is_Finalized")), ["Payment_Method_Key"], {"outstanding": "Outstanding_Balance"}
    )
    methods = mart.table("Dimension_Payment_Method")
    named = star_join(reduced, methods, "Payment_Method_Key", "Payment_Method_Key", ["Payment_Method"])
    return named.drop("Payment_Method_Key").orderBy(F.desc("outstanding"), "Payment_Method")


def purchases_by_supplier(mart: Mart) -> DataFrame:
    """Ordered and received outers per supplier and finalized flag."""
    purchases = mart.table(
        "Fact_Purchase", "Supplier_Key", "Is_Order_Finalized", "Ordered_Outers", "Received_Outers"
    )
    sums = {"ordered_outers": "Ordered_Outers", "received_outers": "Received_Outers"}
    reduced = reduce_fact(purchases, ["Supplier_Key", "Is_Order_Finalized"], sums, "n_purchases")
    suppliers = mart.table("Dimension_Supplier", "Supplier_Key", "Supplier")
    named = star_join(reduced, suppliers, "Supplier_Key", "Supplier_Key", ["Supplier"])
    return (
        named.withColumn("open_outers", F.col("ordered_outers") - F.col("received_outers"))
        .drop("Supplier_Key")
        .orderBy("Supplier", "Is_Order_Finalized")
    )
