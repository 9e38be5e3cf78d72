"""One key with a third of all rows: same results, and few rows of it past the first sum."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starmart.operators.bridge import fan_out_totals, weighted_agg
from starmart.operators.generators import segment_bridge, segment_dimension
from starmart.operators.quality import orphan_keys, temporal_coverage
from starmart.operators.star import reduce_fact, sum_by_attribute
from starmart.operators.temporal import temporal_join

N = 60_000


@pytest.fixture(scope="module")
def fact(spark):
    return spark.range(N).selectExpr(
        "IF(id % 3 = 0, 7L, id % 500) AS Customer_Key",
        "date_add(DATE'1998-01-01', CAST(id % 700 AS INT)) AS d",
        "CAST(id % 1000 AS DECIMAL(18,2)) AS m",
    ).cache()


@pytest.fixture(scope="module")
def versions(spark):
    return spark.range(500).selectExpr(
        "id AS Customer_Key",
        "explode(array(named_struct('v', 'old', 'Valid_From', DATE'1990-01-01', 'Valid_To', DATE'1998-12-31'),"
        " named_struct('v', 'new', 'Valid_From', DATE'1999-01-01', 'Valid_To', DATE'9999-12-31'))) AS s",
    ).select("Customer_Key", "s.*")


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_key_is_reduced_before_it_is_joined(fact):
    reduced = reduce_fact(fact, ["Customer_Key", "d"], {"m": "m"}, "n")
    hot = reduced.filter("Customer_Key = 7")
    assert hot.count() <= 700
    assert hot.agg(F.sum("n")).first()[0] >= N // 3


@pytest.mark.parametrize("salt", [1, 16])
def test_temporal_totals(no_broadcast, fact, versions, salt):
    reduced = reduce_fact(fact, ["Customer_Key", "d"], {"m": "m"})
    out = temporal_join(reduced, versions, "Customer_Key", "d", ["v"], salt=salt).groupBy("v").agg(F.sum("m").alias("m"))
    boundary = F.when(F.col("d") <= F.lit(dt.date(1998, 12, 31)), "old").otherwise("new")
    expected = fact.groupBy(boundary.alias("v")).agg(F.sum("m").alias("m"))
    assert {r.v: r.m for r in out.collect()} == {r.v: r.m for r in expected.collect()}


def test_weighted_totals_reconcile(spark, no_broadcast, fact):
    bridge = segment_bridge(spark.range(500).withColumnRenamed("id", "Customer_Key"), first_key=0)
    out = weighted_agg(fact, bridge, segment_dimension(spark), "Customer_Key", "Segment_Key", "Segment", {"m": "m"})
    total = fact.agg(F.sum("m")).first()[0]
    assert out.agg(F.sum("m")).first()[0] == pytest.approx(total, abs=1)
    row = fan_out_totals(fact, bridge, "Customer_Key", "m").first()
    assert row.true_total == row.weighted_total == total


def test_coverage_and_orphans(no_broadcast, fact, versions):
    out = temporal_coverage(fact, versions.filter("Customer_Key <> 7"), "Customer_Key", "d")
    got = {r.n_versions: r.n_fact_rows for r in out.collect()}
    hot = fact.filter("Customer_Key = 7").count()
    assert got == {0: hot, 1: N - hot}
    orphans = orphan_keys(fact, "Customer_Key", versions.filter("Customer_Key <> 7"), "Customer_Key").collect()
    assert [(r.key, r.n_rows) for r in orphans] == [(7, hot)]


def test_sums_by_attribute(spark, no_broadcast, fact):
    names = spark.range(500).selectExpr("id AS Customer_Key", "IF(id % 2 = 0, 'even', 'odd') AS parity")
    out = sum_by_attribute(fact, names, "Customer_Key", "Customer_Key", ["parity"], {"m": "m"})
    expected = fact.groupBy(F.expr("IF(Customer_Key % 2 = 0, 'even', 'odd')").alias("parity")).agg(F.sum("m").alias("m"))
    assert {r.parity: r.m for r in out.collect()} == {r.parity: r.m for r in expected.collect()}
