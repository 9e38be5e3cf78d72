"""Every registered query against its SQL, row for row."""

import os

import pytest

import __spark_entry__ as entry
from tests.compare import difference, duck

FOLDER = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
# The optional queries have tests of their own.
QUERIES = {name: q for name, q in entry.queries().items() if name not in entry.LLM_QUERIES}
SQL = {name: s for name, s in entry.oracle_sql().items() if name not in entry.LLM_SQL}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


def test_each_query_has_its_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, con, name):
    assert difference(QUERIES[name](spark, FOLDER), con, SQL[name]) is None


def test_flagship(spark):
    assert entry.entry(spark).columns == ["Buying_Group", "Segment", "weighted_revenue"]


# The order of each question's rows. The other questions have one row, or none is asked for (q19).
ORDERS = {
    "q01_revenue_by_year": ["Calendar_Year"],
    "q02_top_items_by_units": ["units_sold DESC", "Stock_Item"],
    "q03_below_reorder_level_by_shortfall": ["Reorder_Level - Quantity_On_Hand DESC"],
    "q04_group_at_each_sale": ["Invoice_Date_Key", "Sale_Key"],
    "q06_revenue_by_historical_group": ["Calendar_Year", "Buying_Group"],
    "q07_customers_with_changes": ["Customer_Key", "Valid_From"],
    "q08_segment_revenue": ["weighted_revenue DESC", "Segment"],
    "q09_multi_segment_customers": ["Customer", "Allocation_Weight DESC", "Segment"],
    "q10_segment_revenue_by_year": ["Calendar_Year", "weighted_revenue DESC", "Segment"],
    "q11_suppliers_of_all_items": ["Relationship_Type", "substitute_supplier", "Stock_Item"],
    "q12_emergency_suppliers": ["Unit_Cost_Premium_Pct DESC", "Stock_Item", "emergency_supplier", "Lead_Time_Days"],
    "q13_segment_and_historical_group": ["Segment", "weighted_revenue DESC", "Buying_Group"],
    "q15_margin_at_historical_price_all_items": ["Stock_Item", "Calendar_Year", "price_at_time"],
    "q17_top_customers_by_revenue": ["revenue DESC", "Customer"],
    "q18_monthly_revenue": ["Calendar_Year", "Calendar_Month_Number"],
    "r05_group_changes": ["Customer_Key", "after_from"],
    "r02_group_members": ["Customer_Key", "Valid_From"],
    "j03_sales_after_orders": ["Buying_Group"],
}


@pytest.mark.parametrize("name", sorted(ORDERS))
def test_order_of_results(spark, name):
    """Rows come by the question's own order: their positions after the sort are those of a sort by hand."""
    rows = [r.asDict() for r in QUERIES[name](spark, FOLDER).collect()]
    order = ORDERS[name]
    expected, keys = list(rows), []
    for term in reversed(order):
        column, descending = term.removesuffix(" DESC"), term.endswith(" DESC")
        first, _, second = column.partition(" - ")
        keys.append(lambda r, first=first, second=second: r[first] - r[second] if second else r[first])
        expected.sort(key=keys[-1], reverse=descending)
    # Rows that tie in all of the order may stand either way round.
    assert [[k(r) for k in keys] for r in rows] == [[k(r) for k in keys] for r in expected]
    assert len(rows) > 1
