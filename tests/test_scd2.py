import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators import scd2
from starmart.operators.scd2 import Era

D = dt.date
OPEN = D(9999, 12, 31)
ERA = Era(D(2013, 1, 1), D(2018, 12, 31))
FLIP = {"Tailspin Toys": "Wingtip Toys", "Wingtip Toys": "Tailspin Toys", "N/A": "Tailspin Toys"}


@pytest.fixture(scope="module")
def customers(spark):
    stamp, end = dt.datetime(2013, 1, 1, 7), dt.datetime(2014, 5, 5)
    rows = [
        (1, "A", "Tailspin Toys", stamp, end),
        (2, "B", "N/A", stamp, end),
        (3, "C", "Other", stamp, end),
        (4, "D", "Wingtip Toys", stamp, end),
        (None, "E", "N/A", stamp, end),
    ]
    schema = "Customer_Key int, Customer string, Buying_Group string, Valid_From timestamp, Valid_To timestamp"
    return spark.createDataFrame(rows, schema)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=str)


def test_current_replaces_validity(customers):
    out = scd2.scd2_current(customers)
    assert out.columns == [*customers.columns, "Is_Current"]
    assert {tuple(r) for r in out.select("Valid_From", "Valid_To", "Is_Current").collect()} == {(D(2013, 1, 1), OPEN, True)}


def test_history_of_unknown_value(customers):
    changed = F.col("Customer_Key") <= 3
    null = scd2.scd2_history(customers, changed, "Buying_Group", FLIP, ERA)
    kept = scd2.scd2_history(customers, changed, "Buying_Group", FLIP, ERA, "keep")
    assert rows(null, "Customer_Key", "Buying_Group") == [(1, "Wingtip Toys"), (2, "Tailspin Toys"), (3, None)]
    assert (3, "Other") in rows(kept, "Customer_Key", "Buying_Group")


@pytest.mark.parametrize("default", ["null", "keep"])
def test_one_pass_equals_union(customers, default):
    changed = F.col("Customer_Key") <= 3
    one = scd2.scd2_recoded(customers, changed, "Buying_Group", FLIP, ERA, default)
    union = scd2.scd2_union(customers, changed, "Buying_Group", FLIP, ERA, default)
    assert one.columns == union.columns
    assert rows(one) == rows(union)
    assert one.count() == customers.count() + 3


def test_reopened_only_where_changed(customers):
    out = scd2.scd2_reopen(scd2.scd2_current(customers), F.col("Customer_Key") <= 3, D(2019, 1, 1))
    assert rows(out, "Customer_Key", "Valid_From") == [
        (1, D(2019, 1, 1)), (2, D(2019, 1, 1)), (3, D(2019, 1, 1)), (4, D(2013, 1, 1)), (None, D(2013, 1, 1)),
    ]


def test_tiered_prices(spark):
    base = spark.createDataFrame(
        [(1, "x", Decimal("10.10"), Decimal("20.00")), (2, "y", Decimal("5.00"), None)],
        "k int, name string, Unit_Price decimal(18,2), Recommended_Retail_Price decimal(18,2)",
    )
    eras = [Era(D(2013, 1, 1), D(2018, 12, 31), Decimal("0.85")), Era(D(2019, 1, 1), D(2019, 12, 31), Decimal("0.92"))]
    prices = ["Unit_Price", "Recommended_Retail_Price"]
    out = scd2.scd2_tiered(base, F.col("k") <= 1, prices, eras, D(2020, 1, 1))
    assert [f.dataType.simpleString() for f in out.schema if f.name in prices] == ["decimal(18,2)"] * 2
    assert rows(out) == [
        (1, "x", Decimal("10.10"), Decimal("20.00"), D(2020, 1, 1), OPEN, True),
        (1, "x", Decimal("8.59"), Decimal("17.00"), D(2013, 1, 1), D(2018, 12, 31), False),
        (1, "x", Decimal("9.29"), Decimal("18.40"), D(2019, 1, 1), D(2019, 12, 31), False),
        (2, "y", Decimal("5.00"), None, D(2020, 1, 1), OPEN, True),
    ]
    opened = scd2.scd2_tiered(base, F.col("k") <= 1, prices, eras, D(2020, 1, 1), D(2013, 1, 1))
    assert rows(opened.filter("k = 2"), "Valid_From") == [(D(2013, 1, 1),)]


def test_base_is_scanned_once(spark, customers, tmp_path):
    customers.write.parquet(str(tmp_path / "c"))
    base = spark.read.parquet(str(tmp_path / "c"))
    plan = scd2.scd2_recoded(base, F.col("Customer_Key") <= 3, "Buying_Group", FLIP, ERA)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Exchange" not in text


def test_changes_pair_consecutive_versions(spark):
    data = [
        (1, "a", D(2013, 1, 1), D(2014, 12, 31)),
        (1, "b", D(2015, 1, 1), D(2016, 12, 31)),
        (1, "c", D(2018, 1, 1), OPEN),  # after a gap
        (2, "a", D(2013, 1, 1), OPEN),
    ]
    df = spark.createDataFrame(data, "k int, v string, Valid_From date, Valid_To date")
    out = rows(scd2.changes(df, "k", "v"), "k", "before", "after", "before_to", "after_from")
    assert out == [(1, "a", "b", D(2014, 12, 31), D(2015, 1, 1)), (1, "b", "c", D(2016, 12, 31), D(2018, 1, 1))]


def test_changes_with_several_starts_on_one_day(spark):
    data = [(1, "a", D(2013, 1, 1), D(2013, 6, 30)), (1, "b", D(2013, 1, 1), D(2014, 12, 31)), (1, "c", D(2015, 1, 1), OPEN)]
    df = spark.createDataFrame(data, "k int, v string, Valid_From date, Valid_To date")
    assert rows(scd2.changes(df, "k", "v"), "before", "after") == [("b", "c")]


def test_version_counts_and_changed_versions(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    assert rows(scd2.version_counts(df, "k")) == [(1, 2)]
    assert rows(scd2.changed_versions(df, "k")) == [(1,), (1,)]


def test_one_pass_keeps_the_order_of_columns(spark):
    base = spark.createDataFrame(
        [(1, "a", D(2013, 1, 1), OPEN, 7), (9, "b", D(2013, 1, 1), OPEN, 8)],
        "Customer_Key int, Buying_Group string, Valid_From date, Valid_To date, Lineage_Key int",
    )
    args = (base, F.col("Customer_Key") <= 3, "Buying_Group", FLIP, ERA)
    assert scd2.scd2_recoded(*args).columns == scd2.scd2_union(*args).columns
    assert rows(scd2.scd2_recoded(*args)) == rows(scd2.scd2_union(*args))


def test_changes_leave_out_what_did_not_change(spark):
    data = [(1, None, D(2013, 1, 1), D(2014, 12, 31)), (1, None, D(2015, 1, 1), D(2016, 12, 31)), (1, "a", D(2017, 1, 1), OPEN)]
    df = spark.createDataFrame(data, "k int, v string, Valid_From date, Valid_To date")
    assert rows(scd2.changes(df, "k", "v"), "before", "after", "after_from") == [(None, "a", D(2017, 1, 1))]
