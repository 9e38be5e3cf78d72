"""Each check is silent on good rows and reports a seeded defect."""

import datetime as dt
from decimal import Decimal as Dec

import pytest
from pyspark.sql import functions as F

from starmart.functions.columns import OPEN_END
from starmart.operators import quality

D = dt.date
SPAN = "k int, Valid_From date, Valid_To date, Is_Current boolean"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_weight_sums(spark):
    good = [(1, 1, Dec("0.30")), (1, 2, Dec("0.70")), (2, 1, Dec("0.33")), (2, 2, Dec("0.33")), (2, 3, Dec("0.34"))]
    df = spark.createDataFrame([*good, (3, 1, Dec("0.99"))], "c int, s int, Allocation_Weight decimal(5,2)")
    assert rows(quality.weight_sum_violations(df, "c")) == [(3, Dec("0.99"))]
    as_double = df.withColumn("Allocation_Weight", F.col("Allocation_Weight").cast("double"))
    assert [r[0] for r in rows(quality.weight_sum_violations(as_double, "c"))] == [3]


def test_memberships(spark):
    df = spark.createDataFrame([(1, 1), (2, 1), (2, 1), (3, 1), (3, 2), (3, 3), (3, 4), (4, 5), (4, 6)], "c int, s int")
    assert rows(quality.membership_violations(df, "c", "s")) == [(2, 2, 1), (3, 4, 4)]


def test_reconciliation(spark):
    facts = spark.createDataFrame([(1, Dec("10.00")), (9, Dec("5.00"))], "c int, m decimal(18,2)")
    bridge = spark.createDataFrame([(1, 1, Dec("1.00"))], "c int, s int, Allocation_Weight decimal(5,2)")
    assert rows(quality.allocation_reconciliation(facts, bridge, "c", "m")) == [(Dec("15.00"), Dec("10.00"), Dec("5.00"))]


def test_eras(spark):
    data = [
        (1, D(2013, 1, 1), D(2018, 12, 31), False), (1, D(2019, 1, 1), OPEN_END, True),
        (2, D(2013, 1, 1), D(2018, 12, 30), False), (2, D(2019, 1, 1), OPEN_END, True),
        (3, D(2013, 1, 1), D(2019, 1, 1), False), (3, D(2019, 1, 1), OPEN_END, True),
        (4, D(2013, 1, 1), D(2014, 1, 1), False), (4, D(2013, 1, 1), OPEN_END, True),
        (5, D(2013, 1, 1), D(2012, 1, 1), False),
        (6, D(2013, 1, 1), D(2020, 1, 1), False), (6, D(2014, 1, 1), D(2014, 12, 31), False), (6, D(2016, 1, 1), D(2016, 2, 1), False),
    ]
    out = quality.era_violations(spark.createDataFrame(data, SPAN), "k").select("k", "Valid_From", "problem")
    assert rows(out) == [
        (2, D(2019, 1, 1), "gap"),
        (3, D(2019, 1, 1), "overlap"),
        (4, D(2013, 1, 1), "duplicate start"),
        (5, D(2013, 1, 1), "ends before start"),
        (6, D(2014, 1, 1), "overlap"),
        (6, D(2016, 1, 1), "overlap"),
    ]


@pytest.mark.parametrize(("closed", "expected"), [("both", {0: 2, 1: 3, 2: 1}), ("left", {0: 4, 1: 1, 2: 1})])
def test_coverage(spark, closed, expected):
    versions = spark.createDataFrame(
        [
            (1, D(2013, 1, 1), D(2018, 12, 31), False), (1, D(2019, 1, 1), OPEN_END, True),
            (2, D(2013, 1, 1), OPEN_END, True), (2, D(2015, 1, 1), OPEN_END, True),
        ],
        SPAN,
    )
    facts = spark.createDataFrame(
        [(1, D(2018, 12, 31)), (1, D(2018, 12, 31)), (1, D(2019, 1, 1)), (2, D(2016, 1, 1)), (3, D(2016, 1, 1)), (1, D(2012, 1, 1))],
        "k int, d date",
    )
    out = quality.temporal_coverage(facts, versions, "k", "d", closed)
    assert {r.n_versions: r.n_fact_rows for r in out.collect()} == expected


def test_current(spark):
    data = [
        (1, D(2013, 1, 1), OPEN_END, True),
        (2, D(2013, 1, 1), OPEN_END, True), (2, D(2014, 1, 1), OPEN_END, True),
        (3, D(2013, 1, 1), D(2014, 1, 1), False),
        (4, D(2013, 1, 1), D(2014, 1, 1), True),
    ]
    out = quality.current_violations(spark.createDataFrame(data, SPAN), "k", F.lit(OPEN_END))
    assert rows(out) == [(2, 2, 2), (3, 0, 0), (4, 1, 0)]


def test_self_substitutes(spark):
    df = spark.createDataFrame([(1, 2), (3, 3)], "Primary_Supplier_Key int, Substitute_Supplier_Key int")
    assert rows(quality.self_substitutes(df)) == [(3, 3)]


def test_foreign_keys(spark):
    fact = spark.createDataFrame([(1,), (2,), (2,), (3,), (None,)], "fk int")
    dim = spark.createDataFrame([(1,)], "id int")
    assert rows(quality.orphan_keys(fact, "fk", dim, "id")) == [(2, 2), (3, 1)]
    report = quality.foreign_key_report([("F", "fk", "D", fact, dim, "id"), ("F", "fk", "G", fact, fact.toDF("id"), "id")])
    assert rows(report) == [("F", "fk", "D", 2, 3), ("F", "fk", "G", 0, 0)]
