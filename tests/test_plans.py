"""The shape of the physical plans, with and without room to broadcast."""

import datetime as dt
import re

import pytest

import __spark_entry__ as entry
from starmart.plans import sales
from starmart.plans.mart import CatalogMart
from starmart.sources.tables import write_table
from starmart.sources.testdata import SampleMart

FOLDER = "/root/testdata/sf0.001"
QUERIES = {name: query for name, query in entry.queries().items() if name not in entry.LLM_QUERIES}


def plan(spark, name, broadcast=True):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    if not broadcast:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("broadcast", [True, False])
@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n[0] not in "lw"))
def test_no_pairing_of_everything_with_everything(spark, name, broadcast):
    text = plan(spark, name, broadcast)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


@pytest.mark.parametrize("name", ["q07_customers_with_changes", "q09_multi_segment_customers"])
def test_membership_is_a_semi_join(spark, name):
    assert "LeftSemi" in plan(spark, name)


def test_backup_check_is_an_anti_join(spark):
    assert "LeftAnti" in plan(spark, "r06_emergency_only_items")


@pytest.mark.parametrize("name", ["q02_top_items_by_units", "q17_top_customers_by_revenue", "j11_top_bill_to_customers"])
def test_top_n_is_not_a_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(spark, name)


def columns_read(text, some_column):
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", text)
    return [{c.split("#")[0] for c in s.split(",")} for s in scans if some_column in s]


def test_only_used_columns_are_read(spark):
    assert columns_read(plan(spark, "q02_top_items_by_units"), "l_") == [{"l_partkey", "l_quantity"}]
    assert columns_read(plan(spark, "q16_total_revenue"), "l_") == [{"l_extendedprice", "l_discount", "l_tax"}]


def test_revenue_by_year_joins_no_orders(spark):
    assert "o_custkey" not in plan(spark, "q01_revenue_by_year")


@pytest.mark.parametrize("name", ["q06_revenue_by_historical_group", "q13_segment_and_historical_group"])
def test_point_in_time_joins_shuffle_the_fact_by_key_only(spark, name):
    text = plan(spark, name, broadcast=False)
    assert not re.search(r"hashpartitioning\(Customer_Key#\d+L?, Invoice_Date_Key", text)
    assert len(re.findall(r"Exchange hashpartitioning\(Customer_Key#\d+L?, \d+\)", text)) <= 2  # fact side, bridge side


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("q04_group_at_each_sale", "EqualTo(o_custkey,50)"),
        ("q05_item_price_during", "EqualTo(p_partkey,50)"),
        ("q15_margin_at_historical_price", "LessThanOrEqual(l_partkey,10)"),
        ("r01_total_revenue_of_year", "GreaterThanOrEqual(l_shipdate,1998-01-01"),
        ("q13_segment_and_historical_group", "LessThan(l_shipdate,1999-01-01"),
    ],
)
def test_filters_reach_the_scan(spark, capsys, name, pushed):
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        QUERIES[name](spark, FOLDER).explain("formatted")
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert any(pushed in line for line in capsys.readouterr().out.splitlines() if line.startswith("PushedFilters"))


def test_segment_totals_need_one_shuffle_of_the_fact(spark):
    """Sorted joins: the sum per customer already has the partitioning the bridge join wants."""
    text = plan(spark, "q08_segment_revenue", broadcast=False)
    assert len(re.findall(r"Exchange hashpartitioning\(Customer_Key", text)) == 2  # fact side, bridge side


def test_year_through_the_calendar_reads_its_months_only(spark, tmp_path):
    """A fact stored by month: the calendar's months prune its partitions at run time, a year's range does at planning."""
    spark.sql("CREATE DATABASE IF NOT EXISTS plan_test")
    mart = SampleMart(spark, FOLDER)
    for name, options in (("Fact_Sale", {"by_month": "Invoice_Date_Key"}), ("Dimension_Date", {})):
        df = mart.table(name, "Invoice_Date_Key", "Total_Including_Tax") if name == "Fact_Sale" else mart.table(name)
        write_table(df, name, "plan_test", path=str(tmp_path / name), **options)
    stored = CatalogMart(spark, "plan_test")
    found = sales.revenue_of_calendar_year(stored, 1998)
    text = found._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in text
    (total,) = found.first()
    assert total == sales.total_revenue_of_year(mart, 1998).first()[0]
    by_range = sales.total_revenue_of_year(stored, 1998)
    assert by_range.first()[0] == total
    assert "Invoice_Date_Key_Month" in by_range._jdf.queryExecution().executedPlan().toString().split("PartitionFilters")[1].split("PushedFilters")[0]
    read = {f.split("Invoice_Date_Key_Month=")[1][:4] for f in stored.table("Fact_Sale", during=("Invoice_Date_Key", dt.date(1998, 1, 1), dt.date(1998, 12, 31))).select("_metadata.file_path").distinct().toPandas()["file_path"]}
    assert read == {"1998"}
