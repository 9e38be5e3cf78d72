"""Customer segments: weighted shares, memberships, and the double count they avoid."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starmart.functions.columns import percent_of
from starmart.operators.bridge import fan_out_totals, multi_member, weighted_agg, weighted_sum
from starmart.operators.star import reduce_fact, star_join
from starmart.operators.temporal import temporal_join
from starmart.plans.mart import During, Mart, whole_year


_SEGMENT = ("Customer_Key", "Segment_Key", "Segment")


def _bridge(mart: Mart) -> tuple[DataFrame, DataFrame]:
    bridge = mart.table("Bridge_CustomerSegment", "Customer_Key", "Segment_Key", "Allocation_Weight")
    return bridge, mart.table("Dimension_CustomerSegment", "Segment_Key", "Segment")


def segment_metrics(
    mart: Mart,
    measures: dict[str, str],
    during: During | None = None,
    unallocated: bool = False,
    adding_up: bool = False,
) -> DataFrame:
    """Weighted totals of any additive measures (output -> measure) per segment."""
    dates = [during[0]] if during else []
    sale = mart.table("Fact_Sale", "Customer_Key", *dates, *dict.fromkeys(measures.values()), during=during)
    return weighted_agg(sale, *_bridge(mart), *_SEGMENT, measures, unallocated=unallocated, adding_up=adding_up)


def segment_revenue(mart: Mart, unallocated: bool = False, adding_up: bool = False) -> DataFrame:
    """Weighted revenue per segment; with ``adding_up`` and ``unallocated`` the rows sum to the total revenue to the cent."""
    measures = {"weighted_revenue": "Total_Including_Tax"}
    revenue = segment_metrics(mart, measures, unallocated=unallocated, adding_up=adding_up)
    return revenue.orderBy(F.desc("weighted_revenue"), "Segment")


def segment_revenue_of_year(mart: Mart, year: int = 2016, adding_up: bool = False) -> DataFrame:
    measures = {"weighted_revenue": "Total_Including_Tax"}
    revenue = segment_metrics(mart, measures, whole_year("Invoice_Date_Key", year), adding_up=adding_up)
    return revenue.orderBy(F.desc("weighted_revenue"), "Segment")


def segment_profit_and_units(mart: Mart) -> DataFrame:
    return segment_metrics(mart, {"weighted_profit": "Profit", "weighted_units": "Quantity"}).orderBy("Segment")


def segment_revenue_by_year(mart: Mart, adding_up: bool = False) -> DataFrame:
    sale = mart.table("Fact_Sale", "Customer_Key", "Invoice_Date_Key", "Total_Including_Tax")
    calendar = mart.table("Dimension_Date", "Date", "Calendar_Year")
    dated = star_join(sale, calendar, "Invoice_Date_Key", "Date", ["Calendar_Year"])
    measures = {"weighted_revenue": "Total_Including_Tax"}
    revenue = weighted_agg(dated, *_bridge(mart), *_SEGMENT, measures, ["Calendar_Year"], adding_up=adding_up)
    return revenue.orderBy("Calendar_Year", F.desc("weighted_revenue"), "Segment")


def multi_segment_customers(mart: Mart) -> DataFrame:
    """Customers in several segments, with their weights."""
    bridge, names = _bridge(mart)
    several = multi_member(bridge, "Customer_Key")
    customers = mart.table("Dimension_Customer", "Customer_Key", "Customer")
    named = star_join(several, customers, "Customer_Key", "Customer_Key", ["Customer"])
    named = star_join(named, names, "Segment_Key", "Segment_Key", ["Segment"])
    return named.select("Customer", "Segment", "Allocation_Weight").orderBy(
        "Customer", F.desc("Allocation_Weight"), "Segment"
    )


def segment_and_historical_group(mart: Mart, year: int = 2015, closed: str = "both") -> DataFrame:
    """A year's weighted revenue per segment and the buying group at the time of sale."""
    sale = mart.table(
        "Fact_Sale",
        "Customer_Key",
        "Invoice_Date_Key",
        "Total_Including_Tax",
        during=whole_year("Invoice_Date_Key", year),
    )
    versions = mart.table("Dimension_Customer_SCD2", "Customer_Key", "Buying_Group", "Valid_From", "Valid_To")
    grouped = temporal_join(sale, versions, "Customer_Key", "Invoice_Date_Key", ["Buying_Group"], closed=closed)
    # Still partitioned by customer after a sorted join, so this sum needs no shuffle there.
    per_group = reduce_fact(grouped, ["Customer_Key", "Buying_Group"], {"weighted_revenue": "Total_Including_Tax"})
    revenue = weighted_sum(per_group, *_bridge(mart), *_SEGMENT, ["weighted_revenue"], ["Buying_Group"])
    return revenue.orderBy("Segment", F.desc("weighted_revenue"), "Buying_Group")


def double_count(mart: Mart, year: int | None = None) -> DataFrame:
    """What leaving the weights out does to the total."""
    during = whole_year("Invoice_Date_Key", year) if year else None
    dates = ["Invoice_Date_Key"] if year else []
    sale = mart.table("Fact_Sale", "Customer_Key", *dates, "Total_Including_Tax", during=during)
    bridge = mart.table("Bridge_CustomerSegment", "Customer_Key", "Allocation_Weight")
    totals = fan_out_totals(sale, bridge, "Customer_Key", "Total_Including_Tax")
    return totals.withColumn("inflation_pct", F.round(percent_of("unweighted_total", "true_total"), 2))
