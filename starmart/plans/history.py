"""Questions that need the dimension versions of their time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window, functions as F

from starmart.functions.columns import OPEN_END, overlaps, percent_change, percent_of
from starmart.operators.scd2 import changed_versions, changes
from starmart.operators.star import reduce_fact, star_join, sum_by_attribute
from starmart.operators.temporal import as_of_join, temporal_join, valid_during
from starmart.plans.mart import Mart

_SPAN = ("Valid_From", "Valid_To")


def group_at_each_sale(mart: Mart, customer: int = 50, closed: str = "both") -> DataFrame:
    """The buying group a customer was in at each sale."""
    sale = mart.table("Fact_Sale", "Sale_Key", "Invoice_Date_Key", "Customer_Key")
    versions = mart.table("Dimension_Customer_SCD2", "Customer_Key", "Customer", "Buying_Group", *_SPAN)
    joined = temporal_join(
        sale.filter(F.col("Customer_Key") == customer),
        versions.filter(F.col("Customer_Key") == customer),
        "Customer_Key",
        "Invoice_Date_Key",
        ["Customer", "Buying_Group", *_SPAN],
        closed=closed,
    )
    return joined.drop("Customer_Key").orderBy("Invoice_Date_Key", "Sale_Key")


def item_price_during(mart: Mart, item: int = 50, year: int = 2015) -> DataFrame:
    versions = mart.table("Dimension_StockItem_SCD2", "Stock_Item_Key", "Stock_Item", "Unit_Price", *_SPAN)
    of_item = versions.filter(F.col("Stock_Item_Key") == item)
    return valid_during(of_item, dt.date(year, 1, 1), dt.date(year, 12, 31)).drop("Stock_Item_Key")


def revenue_by_historical_group(
    mart: Mart, closed: str = "both", how: str = "inner", salt: int = 1, in_order: bool = False
) -> DataFrame:
    """Revenue per buying group at the time of sale, and year; ``in_order`` takes the join for long histories."""
    sale = mart.table("Fact_Sale", "Customer_Key", "Invoice_Date_Key", "Total_Including_Tax")
    versions = mart.table("Dimension_Customer_SCD2", "Customer_Key", "Buying_Group", *_SPAN)
    # Few sales share a customer and a day: they are joined as they are, and added up per group and day.
    if in_order:
        joined = as_of_join(sale, versions, "Customer_Key", "Invoice_Date_Key", ["Buying_Group"], how, closed)
    else:
        joined = temporal_join(sale, versions, "Customer_Key", "Invoice_Date_Key", ["Buying_Group"], how, closed, salt)
    grouped = reduce_fact(joined, ["Buying_Group", "Invoice_Date_Key"], {"revenue": "Total_Including_Tax"})
    calendar = mart.table("Dimension_Date", "Date", "Calendar_Year")
    dated = star_join(grouped, calendar, "Invoice_Date_Key", "Date", ["Calendar_Year"])
    return (
        dated.groupBy("Buying_Group", "Calendar_Year")
        .agg(F.sum("revenue").alias("revenue"))
        .orderBy("Calendar_Year", "Buying_Group")
    )


def daily_orders(mart: Mart) -> DataFrame:
    """What each buying group ordered on its last day with orders, as versions: one for each such day, so long histories."""
    order = mart.table("Fact_Order", "Customer_Key", "Order_Date_Key", "Total_Including_Tax")
    customers = mart.table("Dimension_Customer", "Customer_Key", "Buying_Group")
    sums = {"Ordered": "Total_Including_Tax"}
    daily = sum_by_attribute(order, customers, "Customer_Key", "Customer_Key", ["Buying_Group"], sums, ["Order_Date_Key"])
    following = F.lead("Order_Date_Key").over(Window.partitionBy("Buying_Group").orderBy("Order_Date_Key"))
    until = F.coalesce(F.date_sub(following, 1), F.lit(OPEN_END))
    return daily.select("Buying_Group", "Ordered", F.col("Order_Date_Key").alias("Valid_From"), until.alias("Valid_To"))


def sales_after_orders(mart: Mart, copies: int = 1) -> DataFrame:
    """Sales of each buying group beside its orders of the last day before them that had any.

    Few groups hold all sales and have a version for nearly every day: facts times versions would be paired
    by a join on the key.
    """
    sale = mart.table("Fact_Sale", "Customer_Key", "Invoice_Date_Key", "Total_Including_Tax")
    customers = mart.table("Dimension_Customer", "Customer_Key", "Buying_Group")
    grouped = star_join(sale, customers, "Customer_Key", "Customer_Key", ["Buying_Group"])
    versions = daily_orders(mart)
    found = as_of_join(grouped, versions, "Buying_Group", "Invoice_Date_Key", ["Ordered", "Valid_From"], "left", copies=copies)
    return (
        found.groupBy("Buying_Group")
        .agg(
            F.count(F.lit(1)).alias("n_sales"),
            F.count("Ordered").alias("n_after_orders"),
            F.sum("Total_Including_Tax").alias("revenue"),
            F.sum("Ordered").cast("decimal(38,2)").alias("ordered_before"),
            F.sum(F.datediff("Invoice_Date_Key", "Valid_From")).alias("days_since"),
        )
        .orderBy("Buying_Group")
    )


def customers_with_changes(mart: Mart) -> DataFrame:
    """All versions of the customers that have more than one."""
    versions = mart.table(
        "Dimension_Customer_SCD2", "Customer_Key", "Customer", "Buying_Group", *_SPAN, "Is_Current"
    )
    return changed_versions(versions, "Customer_Key").orderBy("Customer_Key", "Valid_From")


def group_changes(mart: Mart) -> DataFrame:
    """Buying group before and after each change."""
    versions = mart.table("Dimension_Customer_SCD2", "Customer_Key", "Customer", "Buying_Group", *_SPAN)
    return changes(versions, "Customer_Key", "Buying_Group", ("Customer",)).orderBy("Customer_Key", "after_from")


def group_members(mart: Mart, group: str = "Tailspin Toys") -> DataFrame:
    """Current and former members of a buying group, with their time in it."""
    versions = mart.table(
        "Dimension_Customer_SCD2", "Customer_Key", "Customer", "Buying_Group", *_SPAN, "Is_Current"
    )
    return (
        versions.filter(F.col("Buying_Group") == group)
        .select(
            "Customer_Key",
            "Customer",
            *_SPAN,
            F.when(F.col("Is_Current"), "current").otherwise("former").alias("status"),
        )
        .orderBy("Customer_Key", "Valid_From")
    )


def _average_prices(mart: Mart, up_to_key: int, before: int, after: int) -> DataFrame:
    """One pass over the versions; one conditional average per year."""
    versions = mart.table("Dimension_StockItem_SCD2", "Stock_Item_Key", "Unit_Price", *_SPAN)

    def average(year: int):
        valid = overlaps(*_SPAN, dt.date(year, 1, 1), dt.date(year, 12, 31))
        return F.avg(F.when(valid, F.col("Unit_Price")))

    return versions.filter(F.col("Stock_Item_Key") <= up_to_key).agg(
        average(before).alias("before"), average(after).alias("after")
    )


def average_price_comparison(mart: Mart, up_to_key: int = 10, before: int = 2015, after: int = 2020) -> DataFrame:
    prices = _average_prices(mart, up_to_key, before, after)
    return prices.select(
        F.round("before", 2).alias(f"avg_price_{before}"), F.round("after", 2).alias(f"avg_price_{after}")
    )


def price_increase(mart: Mart, up_to_key: int = 10, before: int = 2015, after: int = 2020) -> DataFrame:
    prices = _average_prices(mart, up_to_key, before, after)
    return prices.select(F.round(percent_change("before", "after"), 2).alias("increase_pct"))


def margin_at_historical_price(mart: Mart, up_to_key: int | None = 10, closed: str = "both") -> DataFrame:
    """Profit and mean margin per year, item and the price valid at the time.

    The margin is the plain mean of the rows' own margins, not weighted by revenue.
    ``up_to_key=None`` covers all items.
    """
    sale = mart.table("Fact_Sale", "Stock_Item_Key", "Invoice_Date_Key", "Profit", "Total_Including_Tax")
    versions = mart.table("Dimension_StockItem_SCD2", "Stock_Item_Key", "Stock_Item", "Unit_Price", *_SPAN)
    if up_to_key is not None:
        sale = sale.filter(F.col("Stock_Item_Key") <= up_to_key)
        versions = versions.filter(F.col("Stock_Item_Key") <= up_to_key)
    margin = percent_of("Profit", "Total_Including_Tax")
    sale = sale.select("Stock_Item_Key", "Invoice_Date_Key", "Profit", margin.alias("margin"))
    priced = temporal_join(
        sale, versions, "Stock_Item_Key", "Invoice_Date_Key", ["Stock_Item", "Unit_Price"], closed=closed
    )
    calendar = mart.table("Dimension_Date", "Date", "Calendar_Year")
    dated = star_join(priced, calendar, "Invoice_Date_Key", "Date", ["Calendar_Year"])
    return (
        dated.groupBy("Calendar_Year", "Stock_Item", F.col("Unit_Price").alias("price_at_time"))
        .agg(
            F.round(F.sum("Profit"), 2).alias("total_profit"),
            F.round(F.avg("margin"), 1).alias("avg_margin_pct"),
        )
        .orderBy("Stock_Item", "Calendar_Year", "price_at_time")
    )
