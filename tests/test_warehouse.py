"""From CSV files to answers: load all tables, enrich, and ask every question."""

import csv
import datetime as dt
from decimal import Decimal as Dec

import pytest

from starmart.operators import quality
from starmart.plans.catalog import QUESTIONS
from starmart.plans.enrich import build_warehouse, enrich
from starmart.plans.mart import CatalogMart, FrameMart
from starmart.sources.registry import TABLES
from starmart.sources.tables import load_base_tables, write_table
from starmart.sources.typed_csv import export_tables

SCHEMA = "mart_test"
# Columns that are not typed, so that the spec does not name them.
TEXT = {
    "Dimension_Date": ["Month"],
    "Dimension_City": ["City", "State Province", "Country", "Continent", "Sales Territory", "Region", "Subregion"],
    "Dimension_Customer": ["Customer", "Bill To Customer", "Category", "Buying Group", "Primary Contact", "Postal Code"],
    "Dimension_Employee": ["Employee", "Preferred Name"],
    "Dimension_Payment_Method": ["Payment Method"],
    "Dimension_Stock_Item": ["Stock Item", "Color", "Selling Package", "Buying Package", "Brand", "Size", "Barcode"],
    "Dimension_Supplier": ["Supplier", "Category", "Primary Contact", "Supplier Reference"],
    "Dimension_Transaction_Type": ["Transaction Type"],
}
N_CUSTOMERS, N_ITEMS, N_SUPPLIERS, N_SALES = 170, 220, 5, 600
GROUPS = ["Tailspin Toys", "Wingtip Toys", "N/A"]
START = dt.date(2013, 1, 1)


def sale_day(i):
    return START + dt.timedelta(days=(i * 37) % 1461)


def value(table, column, kind, i):
    """A cell of row ``i``, such that keys resolve; written as an exporter would."""
    special = {
        ("Dimension_Date", "Date"): START + dt.timedelta(days=i),
        ("Dimension_Date", "Calendar Year"): (START + dt.timedelta(days=i)).year,
        ("Dimension_Date", "Calendar Month Number"): (START + dt.timedelta(days=i)).month,
        ("Dimension_Customer", "Buying Group"): GROUPS[i % 3],
        ("Fact_Sale", "Quantity"): 1 + i % 9,
        ("Fact_Sale", "Total Including Tax"): f"{10 + i % 90}.{i % 100:02d}",
        ("Fact_Sale", "Profit"): f"{i % 7}.50",
        ("Dimension_Stock_Item", "Unit Price"): f"{10 + i}.10",
        ("Fact_Stock_Holding", "Quantity On Hand"): i % 10,
        ("Fact_Stock_Holding", "Reorder Level"): 5,
    }
    if (table, column) in special:
        return special[table, column]
    if column == TABLES[table].key:
        return i + 1
    sizes = {"Customer Key": N_CUSTOMERS, "Bill To Customer Key": N_CUSTOMERS, "Stock Item Key": N_ITEMS,
             "Supplier Key": N_SUPPLIERS, "City Key": 3, "Salesperson Key": 4, "Picker Key": 4,
             "Transaction Type Key": 2, "Payment Method Key": 2}
    if column in sizes:
        return i % sizes[column] + 1
    return {
        "int": i, "long": i, "date": sale_day(i), "timestamp": "2013-01-01 00:00:00.0000000",
        "boolean": i % 2 == 0, "decimal(18,2)": f"{i}.25", "decimal(18,3)": "15.000",
    }.get(kind, f'{column} "{i}", x' if i % 5 == 0 else f"{column} {i}")


@pytest.fixture(scope="module")
def mart(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("csv")
    sizes = {"Dimension_Date": 1461, "Dimension_Customer": N_CUSTOMERS, "Dimension_Stock_Item": N_ITEMS,
             "Dimension_Supplier": N_SUPPLIERS, "Dimension_City": 3, "Dimension_Employee": 4,
             "Dimension_Payment_Method": 2, "Dimension_Transaction_Type": 2, "Fact_Stock_Holding": N_ITEMS}
    for name, spec in TABLES.items():
        kinds = {**{f"SRC {c}" if c in spec.source_ids else c: k for c, k in spec.types.items()}, **{c: "string" for c in TEXT.get(name, [])}}
        with open(root / spec.file_name, "w", newline="", encoding="utf-8") as f:
            out = csv.writer(f)
            out.writerow(kinds)
            for i in range(sizes.get(name, N_SALES)):
                out.writerow([value(name, c, k, i) for c, k in kinds.items()])
    spark.sql(f"DROP DATABASE IF EXISTS {SCHEMA} CASCADE")
    summary = build_warehouse(spark, str(root), SCHEMA)
    built = CatalogMart(spark, SCHEMA)
    built.summary = {r.table_name: r.n_rows for r in summary.collect()}
    return built


def test_summary(mart):
    s = mart.summary
    assert s["Fact_Sale"] == N_SALES and s["Dimension_Date"] == 1461
    assert s["Dimension_Customer_SCD2"] == N_CUSTOMERS + 150
    assert s["Dimension_StockItem_SCD2"] == N_ITEMS + 200
    assert s["Bridge_SupplierSubstitution"] == 200 and s["Dimension_CustomerSegment"] == 7
    assert s["TOTAL"] == sum(n for t, n in s.items() if t != "TOTAL")


def test_types_and_names(mart):
    sale = dict(mart.table("Fact_Sale").dtypes)
    assert sale["Sale_Key"] == "bigint" and sale["Total_Including_Tax"] == "decimal(18,2)" and sale["SRC_Invoice_ID"] == "int"
    item = dict(mart.table("Dimension_StockItem_SCD2").dtypes)
    assert item["Unit_Price"] == "decimal(18,2)" and item["Valid_From"] == "date" and item["Is_Current"] == "boolean"
    name = mart.table("Dimension_Customer").filter("Customer_Key = 1").first()
    assert name.Customer == 'Customer "0", x'


def test_views(mart):
    assert mart.table("vw_Customer_Current").count() == N_CUSTOMERS
    assert mart.table("vw_StockItem_Current").count() == N_ITEMS


@pytest.mark.parametrize("name", sorted(QUESTIONS))
def test_every_question_runs_with_its_defaults(mart, name):
    out = QUESTIONS[name](mart)
    assert out.columns and out.collect() is not None


def sales():
    for i in range(N_SALES):
        yield {
            "customer": i % N_CUSTOMERS + 1, "item": i % N_ITEMS + 1, "day": sale_day(i), "quantity": 1 + i % 9,
            "total": Dec(f"{10 + i % 90}.{i % 100:02d}"), "key": i + 1,
        }


def grouped(pairs):
    out = {}
    for k, v in pairs:
        out[k] = out.get(k, 0) + v
    return out


def test_revenue_by_year(mart):
    got = {r.Calendar_Year: r.revenue for r in QUESTIONS["q01_revenue_by_year"](mart).collect()}
    assert got == grouped((s["day"].year, s["total"]) for s in sales())


def test_group_at_the_time_of_sale(mart):
    """All sales precede the change of 2019, so changed customers show their earlier group."""
    flip = {"Tailspin Toys": "Wingtip Toys", "Wingtip Toys": "Tailspin Toys", "N/A": "Tailspin Toys"}
    now = {c: GROUPS[(c - 1) % 3] for c in range(1, N_CUSTOMERS + 1)}
    then = {c: flip[g] if c <= 150 else g for c, g in now.items()}
    expected = grouped(((then[s["customer"]], s["day"].year), s["total"]) for s in sales())
    for closed in ("both", "left"):
        out = QUESTIONS["q06_revenue_by_historical_group"](mart, closed=closed).collect()
        assert {(r.Buying_Group, r.Calendar_Year): r.revenue for r in out} == expected
    one = QUESTIONS["q04_group_at_each_sale"](mart).collect()
    assert [r.Sale_Key for r in one] == [s["key"] for s in sorted(sales(), key=lambda s: (s["day"], s["key"])) if s["customer"] == 50]
    assert {r.Buying_Group for r in one} == {then[50]}


def test_item_without_history_loses_its_early_sales(mart):
    """Items past the first hundred are only valid from 2020 on; the check says so."""
    sale = mart.table("Fact_Sale", "Stock_Item_Key", "Invoice_Date_Key")
    out = quality.temporal_coverage(sale, mart.table("Dimension_StockItem_SCD2"), "Stock_Item_Key", "Invoice_Date_Key")
    expected = grouped((1 if s["item"] <= 100 else 0, 1) for s in sales())
    assert {r.n_versions: r.n_fact_rows for r in out.collect()} == expected


def test_price_in_2015_is_the_first_tier(mart):
    rows = QUESTIONS["q05_item_price_during"](mart).collect()
    assert [(r.Unit_Price, r.Valid_From) for r in rows] == [(Dec("50.24"), dt.date(2013, 1, 1))]  # 59.10 * 0.85 = 50.235
    row = QUESTIONS["r07_price_increase"](mart).first()
    assert row.increase_pct == pytest.approx(17.6, abs=0.1)


def test_segments_add_up(mart):
    total = QUESTIONS["r01_total_revenue_of_year"](mart).first().total_revenue
    shares = [r.weighted_revenue for r in QUESTIONS["r04_segment_revenue_of_year"](mart).collect()]
    assert total == sum(s["total"] for s in sales() if s["day"].year == 2016)
    assert abs(sum(shares) - total) <= Dec("0.04")  # seven roundings to cents
    double = QUESTIONS["r12_double_count"](mart).first()
    assert double.true_total == double.weighted_total < double.unweighted_total


def test_invariants_hold(mart):
    bridge = mart.table("Bridge_CustomerSegment")
    assert quality.weight_sum_violations(bridge, "Customer_Key").isEmpty()
    assert quality.membership_violations(bridge, "Customer_Key", "Segment_Key").isEmpty()
    assert quality.self_substitutes(mart.table("Bridge_SupplierSubstitution")).isEmpty()
    for table, key in (("Dimension_Customer_SCD2", "Customer_Key"), ("Dimension_StockItem_SCD2", "Stock_Item_Key")):
        assert quality.era_violations(mart.table(table), key).isEmpty()
    checks = [
        (f, fk, d, mart.table(f, fk), mart.table(d, dk), dk)
        for f, spec in TABLES.items() for fk, (d, dk) in spec.foreign_keys.items()
    ]
    assert {r.n_orphan_keys for r in quality.foreign_key_report(checks).collect()} == {0}


def test_second_load_keeps_or_replaces(spark, mart):
    kept = dict(enrich(spark, SCHEMA, overwrite=False))
    assert kept["Dimension_Customer_SCD2"] == N_CUSTOMERS + 150
    assert write_table(mart.table("Dimension_Supplier").limit(2), "Scratch", SCHEMA) == 2
    assert write_table(mart.table("Dimension_Supplier").limit(3), "Scratch", SCHEMA) == 3


def test_export_and_reload(spark, mart, tmp_path):
    """Tables to CSV and back: the same rows and types."""
    summary = {r.table_name: r.n_rows for r in export_tables(spark, SCHEMA, str(tmp_path)).collect()}
    assert summary == {t: n for t, n in mart.summary.items() if t in TABLES} | {"TOTAL": summary["TOTAL"]}
    counts = dict(load_base_tables(spark, str(tmp_path), "reload_test"))
    again = CatalogMart(spark, "reload_test")
    for name in TABLES:
        before, after = mart.table(name), again.table(name, *mart.table(name).columns)
        assert counts[name] == mart.summary[name] and before.dtypes == after.dtypes
        assert before.exceptAll(after).isEmpty()


def test_buckets_by_customer_spare_the_shuffles(spark, mart):
    """Fact, versions and bridge in the same buckets: nothing is shuffled by customer."""
    tables = ("Fact_Sale", "Dimension_Customer_SCD2", "Bridge_CustomerSegment")
    for name in tables:
        write_table(mart.table(name), f"Bucketed_{name}", SCHEMA, bucket_by=(4, "Customer_Key"))

    class Bucketed(CatalogMart):
        def table(self, name, *columns, during=None):
            return super().table(f"Bucketed_{name}" if name in tables else name, *columns, during=during)

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ("q08_segment_revenue", "q13_segment_and_historical_group"):
            bucketed = QUESTIONS[name](Bucketed(spark, SCHEMA))
            assert "hashpartitioning(Customer_Key" not in bucketed._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(str, bucketed.collect())) == sorted(map(str, QUESTIONS[name](mart).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_ties_and_zero_totals(spark):
    day = dt.date(2015, 1, 1)
    sale = spark.createDataFrame(
        [(1, day, 5, Dec("1.00"), Dec("0.00")), (2, day, 5, Dec("2.00"), Dec("8.00")), (3, day, 9, Dec("1.00"), Dec("4.00"))],
        "Stock_Item_Key int, Invoice_Date_Key date, Quantity int, Profit decimal(18,2), Total_Including_Tax decimal(18,2)",
    )
    items = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c")], "Stock_Item_Key int, Stock_Item string")
    versions = items.selectExpr("*", "CAST(1 AS DECIMAL(18,2)) AS Unit_Price", "DATE'2013-01-01' AS Valid_From", "DATE'9999-12-31' AS Valid_To")
    calendar = spark.createDataFrame([(day, 2015)], "Date date, Calendar_Year int")
    small = FrameMart(Fact_Sale=sale, Dimension_Stock_Item=items, Dimension_StockItem_SCD2=versions, Dimension_Date=calendar)
    top = QUESTIONS["q02_top_items_by_units"](small, n=2).collect()
    assert [(r.Stock_Item, r.units_sold) for r in top] == [("c", 9), ("a", 5)]
    margins = {r.Stock_Item: r.avg_margin_pct for r in QUESTIONS["q15_margin_at_historical_price"](small).collect()}
    assert margins == {"a": 25.0, "b": None, "c": 25.0}
