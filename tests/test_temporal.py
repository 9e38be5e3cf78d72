import datetime as dt

import pytest

from starmart.operators.temporal import as_of, as_of_join, temporal_join, valid_during

D = dt.date


@pytest.fixture(scope="module")
def versions(spark):
    rows = [
        (1, "old", D(1995, 1, 1), D(1998, 12, 31)),
        (1, "new", D(1999, 1, 1), D(9999, 12, 31)),
        (2, "late", D(2000, 1, 1), D(9999, 12, 31)),
    ]
    return spark.createDataFrame(rows, "k int, v string, Valid_From date, Valid_To date")


@pytest.fixture(scope="module")
def facts(spark):
    rows = [
        (10, 1, D(1998, 12, 31)),
        (11, 1, D(1999, 1, 1)),
        (12, 1, D(1994, 12, 31)),
        (13, 1, None),
        (14, 2, D(1999, 12, 31)),
        (15, 2, D(2000, 1, 1)),
        (16, 3, D(2000, 1, 1)),
        (17, None, D(2000, 1, 1)),
    ]
    return spark.createDataFrame(rows, "id int, k int, d date")


def found(df):
    return {r.id: r.v for r in df.collect()}


def test_inner_join_at_boundaries(facts, versions):
    assert found(temporal_join(facts, versions, "k", "d", ["v"])) == {10: "old", 11: "new", 15: "late"}
    assert found(temporal_join(facts, versions, "k", "d", ["v"], closed="left")) == {11: "new", 15: "late"}


def test_left_join_keeps_every_fact(facts, versions):
    out = temporal_join(facts, versions, "k", "d", ["v"], how="left")
    assert out.count() == facts.count()
    assert found(out) == {10: "old", 11: "new", 12: None, 13: None, 14: None, 15: "late", 16: None, 17: None}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("salt", [2, 7])
def test_salt_changes_nothing(facts, versions, how, salt):
    plain = temporal_join(facts, versions, "k", "d", ["v", "Valid_From"], how)
    salted = temporal_join(facts, versions, "k", "d", ["v", "Valid_From"], how, salt=salt)
    assert plain.columns == salted.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.collect()))


@pytest.mark.parametrize("how", ["inner", "left"])
def test_repeated_versions_are_spread_not_broadcast(spark, facts, how):
    """A range has a known size, small enough for a broadcast."""
    known = spark.range(100).selectExpr("CAST(id AS INT) AS k", "'v' AS v", "DATE'1995-01-01' AS Valid_From", "DATE'9999-12-31' AS Valid_To")
    assert "Broadcast" in temporal_join(facts, known, "k", "d", ["v"], how)._jdf.queryExecution().executedPlan().toString()
    salted = temporal_join(facts, known, "k", "d", ["v"], how, salt=7)
    text = salted._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in text and "Broadcast" not in text


def test_bad_arguments(facts, versions):
    with pytest.raises(ValueError):
        temporal_join(facts, versions, "k", "d", ["v"], how="outer")
    with pytest.raises(ValueError):
        temporal_join(facts.withColumnRenamed("id", "v"), versions, "k", "d", ["v"])


def test_snapshot_and_range(versions):
    assert {r.v for r in as_of(versions, D(1998, 12, 31)).collect()} == {"old"}
    assert {r.v for r in as_of(versions, D(1998, 12, 31), "left").collect()} == set()
    assert {r.v for r in valid_during(versions, D(1998, 1, 1), D(1999, 12, 31)).collect()} == {"old", "new"}


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("closed", ["both", "left"])
@pytest.mark.parametrize(("days", "copies"), [(32, 1), (1, 1), (5000, 3)])
def test_in_order_gives_the_rows_of_the_join(facts, versions, how, closed, days, copies):
    plain = temporal_join(facts, versions, "k", "d", ["v", "Valid_From"], how, closed)
    ordered = as_of_join(facts, versions, "k", "d", ["v", "Valid_From"], how, closed, days, copies)
    assert plain.columns == ordered.columns
    assert sorted(map(str, plain.collect())) == sorted(map(str, ordered.collect()))


@pytest.fixture(scope="module")
def long_history(spark):
    """A key with 10,000 versions of one day, gaps between some, and a third of the facts; 50 other keys."""
    day = "date_add(DATE'1990-01-01', CAST({} AS INT))"
    versions = spark.range(10000).selectExpr("0L AS k", "id AS v", f"{day.format('id')} AS Valid_From", f"{day.format('id')} AS Valid_To")
    versions = versions.filter("v % 10 <> 7").unionByName(
        spark.range(500).selectExpr("1 + id % 50 AS k", "id AS v", f"{day.format('(id div 50) * 700')} AS Valid_From", f"{day.format('(id div 50) * 700 + 650')} AS Valid_To")
    )
    facts = spark.range(30000).selectExpr("IF(id % 3 = 0, 0L, id % 60) AS k", "id", f"{day.format('id * 7919 % 11000 - 300')} AS d")
    return facts, versions


@pytest.mark.parametrize("how", ["inner", "left"])
def test_long_history(long_history, how):
    facts, versions = long_history
    rows = [sorted(map(tuple, f(facts, versions, "k", "d", ["v"], how).collect()), key=str) for f in (as_of_join, temporal_join)]
    assert rows[0] == rows[1]


def test_long_history_pairs_nothing(long_history):
    facts, versions = long_history
    text = as_of_join(facts, versions, "k", "d", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text and "CartesianProduct" not in text


def test_last_of_overlapping_versions_counts(spark, facts):
    rows = [(1, "long", D(1990, 1, 1), D(9999, 12, 31)), (1, "short", D(1998, 12, 1), D(1998, 12, 31)), (1, "twin", D(1998, 12, 1), D(1998, 12, 5)), (None, "none", D(1990, 1, 1), D(9999, 12, 31))]
    overlapping = spark.createDataFrame(rows, "k int, v string, Valid_From date, Valid_To date")
    assert found(as_of_join(facts, overlapping, "k", "d", ["v"], "left")) == {10: "short", 11: None, 12: "long", 13: None, 14: None, 15: None, 16: None, 17: None}


def test_as_of_join_bad_arguments(facts, versions):
    for wrong in ({"how": "outer"}, {"closed": "right"}, {"days": 0}, {"copies": 0}):
        with pytest.raises(ValueError):
            as_of_join(facts, versions, "k", "d", ["v"], **wrong)
    with pytest.raises(ValueError):
        as_of_join(facts, versions, "k", "d", ["id"])
