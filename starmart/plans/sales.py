"""Revenue, units and orders over the current-state dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.operators.star import reduce_fact, star_join, sum_by_attribute, top_n
from starmart.sources.tables import MONTH
from starmart.plans.mart import Mart, whole_year

_REVENUE = {"revenue": "Total_Including_Tax"}


def _by_calendar(
    mart: Mart, fact: DataFrame, date_key: str, attributes: list[str], measures: dict[str, str]
) -> DataFrame:
    """Sums per calendar attribute; only one row per day reaches the calendar join."""
    calendar = mart.table("Dimension_Date", "Date", *attributes)
    return sum_by_attribute(fact, calendar, date_key, "Date", attributes, measures)


def total_revenue(mart: Mart) -> DataFrame:
    sale = mart.table("Fact_Sale", "Total_Including_Tax")
    return sale.agg(F.sum("Total_Including_Tax").alias("total_revenue"))


def total_revenue_of_year(mart: Mart, year: int = 2016) -> DataFrame:
    sale = mart.table(
        "Fact_Sale", "Invoice_Date_Key", "Total_Including_Tax", during=whole_year("Invoice_Date_Key", year)
    )
    return sale.agg(F.sum("Total_Including_Tax").alias("total_revenue"))


def revenue_of_calendar_year(mart: Mart, year: int = 2016) -> DataFrame:
    """A year's revenue, the year taken from the date dimension.

    Where the fact is laid out by month, its days are joined by month as well: the months of the year's days
    prune its partitions at run time.
    """
    calendar = mart.table("Dimension_Date", "Date", "Calendar_Year").filter(F.col("Calendar_Year") == year)
    sale = mart.table("Fact_Sale")
    condition = F.col("Invoice_Date_Key") == F.col("Date")
    if "Invoice_Date_Key" + MONTH in sale.columns:
        calendar = calendar.withColumn("__month", F.trunc("Date", "MM"))
        condition &= F.col("Invoice_Date_Key" + MONTH) == F.col("__month")
    return sale.join(calendar, condition).agg(F.sum("Total_Including_Tax").alias("total_revenue"))


def revenue_by_year(mart: Mart) -> DataFrame:
    sale = mart.table("Fact_Sale", "Invoice_Date_Key", "Total_Including_Tax")
    return _by_calendar(mart, sale, "Invoice_Date_Key", ["Calendar_Year"], _REVENUE).orderBy("Calendar_Year")


def monthly_revenue(mart: Mart) -> DataFrame:
    sale = mart.table("Fact_Sale", "Invoice_Date_Key", "Total_Including_Tax")
    months = ["Calendar_Year", "Calendar_Month_Number"]
    return _by_calendar(mart, sale, "Invoice_Date_Key", months, _REVENUE).orderBy(*months)


def top_items_by_units(mart: Mart, n: int = 10) -> DataFrame:
    sale = mart.table("Fact_Sale", "Stock_Item_Key", "Quantity")
    items = mart.table("Dimension_Stock_Item", "Stock_Item_Key", "Stock_Item")
    units = sum_by_attribute(
        sale, items, "Stock_Item_Key", "Stock_Item_Key", ["Stock_Item"], {"units_sold": "Quantity"}
    )
    return top_n(units, n, "units_sold", ["Stock_Item"])


def revenue_by_customer(mart: Mart, role: str = "Customer_Key", output: str = "Customer") -> DataFrame:
    """Revenue per customer name, in the ship-to (default) or bill-to role."""
    sale = mart.table("Fact_Sale", role, "Total_Including_Tax")
    customers = mart.table("Dimension_Customer", "Customer_Key", "Customer")
    return sum_by_attribute(sale, customers, role, "Customer_Key", {"Customer": output}, _REVENUE)


def top_customers_by_revenue(mart: Mart, n: int = 10) -> DataFrame:
    return top_n(revenue_by_customer(mart), n, "revenue", ["Customer"])


def top_bill_to_customers(mart: Mart, n: int = 10) -> DataFrame:
    by_payer = revenue_by_customer(mart, "Bill_To_Customer_Key", "Bill_To_Customer")
    return top_n(by_payer, n, "revenue", ["Bill_To_Customer"])


def revenue_by_salesperson(mart: Mart) -> DataFrame:
    sale = mart.table("Fact_Sale", "Salesperson_Key", "Total_Including_Tax")
    employees = mart.table("Dimension_Employee", "Employee_Key", "Employee")
    by_name = sum_by_attribute(
        sale, employees, "Salesperson_Key", "Employee_Key", {"Employee": "Salesperson"}, _REVENUE
    )
    return by_name.orderBy(F.desc("revenue"), "Salesperson")


def orders_by_picker(mart: Mart) -> DataFrame:
    """Orders taken and picked per employee: one dimension in two roles."""
    orders = mart.table("Fact_Order", "Salesperson_Key", "Picker_Key", "Total_Including_Tax")
    employees = mart.table("Dimension_Employee", "Employee_Key", "Employee")
    reduced = reduce_fact(orders, ["Salesperson_Key", "Picker_Key"], {"total": "Total_Including_Tax"}, "n_orders")
    named = star_join(reduced, employees, "Salesperson_Key", "Employee_Key", {"Employee": "Salesperson"})
    named = star_join(named, employees, "Picker_Key", "Employee_Key", {"Employee": "Picker"})
    return (
        named.groupBy("Salesperson", "Picker")
        .agg(F.sum("n_orders").alias("n_orders"), F.sum("total").alias("total"))
        .orderBy("Salesperson", "Picker")
    )


def revenue_by_city(mart: Mart) -> DataFrame:
    sale = mart.table("Fact_Sale", "City_Key", "Total_Including_Tax")
    cities = mart.table("Dimension_City", "City_Key", "City", "Region")
    by_city = sum_by_attribute(sale, cities, "City_Key", "City_Key", ["Region", "City"], _REVENUE)
    return by_city.orderBy("Region", F.desc("revenue"), "City")


def invoiced_and_delivered_by_month(mart: Mart) -> DataFrame:
    """Revenue by invoice month and delivery month: one calendar in two roles."""
    sale = mart.table("Fact_Sale", "Invoice_Date_Key", "Delivery_Date_Key", "Total_Including_Tax")
    months = ["Calendar_Year", "Calendar_Month_Number"]
    calendar = mart.table("Dimension_Date", "Date", *months)
    reduced = reduce_fact(sale, ["Invoice_Date_Key", "Delivery_Date_Key"], _REVENUE)
    named = star_join(
        reduced, calendar, "Invoice_Date_Key", "Date",
        {"Calendar_Year": "invoice_year", "Calendar_Month_Number": "invoice_month"},
    )
    named = star_join(
        named, calendar, "Delivery_Date_Key", "Date",
        {"Calendar_Year": "delivery_year", "Calendar_Month_Number": "delivery_month"},
    )
    keys = ["invoice_year", "invoice_month", "delivery_year", "delivery_month"]
    return named.groupBy(*keys).agg(F.sum("revenue").alias("revenue")).orderBy(*keys)


def orders_and_sales_by_year(mart: Mart) -> DataFrame:
    """Ordered and invoiced totals, each by its own date, side by side."""
    sale = mart.table("Fact_Sale", "Invoice_Date_Key", "Total_Including_Tax")
    orders = mart.table("Fact_Order", "Order_Date_Key", "Total_Including_Tax")
    year = ["Calendar_Year"]
    sold = _by_calendar(mart, sale, "Invoice_Date_Key", year, {"invoiced": "Total_Including_Tax"})
    ordered = _by_calendar(mart, orders, "Order_Date_Key", year, {"ordered": "Total_Including_Tax"})
    return ordered.join(sold, year, "full").orderBy(*year)
