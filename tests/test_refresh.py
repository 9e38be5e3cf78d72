"""Stored dimensions refreshed by snapshots."""

import datetime as dt

import pytest

from starmart.operators.scd2 import VALID_FROM
from starmart.operators.scd2_refresh import merged, opened_on, refresh_changes, refresh_dimension

D, END = dt.date, dt.date(9999, 12, 31)
DAY1, DAY2, DAY3 = D(2015, 1, 1), D(2016, 1, 1), D(2017, 1, 1)
SCHEMA = "k int, name string, grp string"


@pytest.fixture(scope="module")
def snapshots(spark):
    first = [(1, "a", "x"), (2, "b", None), (3, "", "z"), (4, "d", "w")]
    second = [(1, "a", "y"), (2, "b", None), (3, None, "z"), (5, "e", "v")]
    third = [(1, "a", "x"), (2, None, "b"), (3, None, "z"), (5, "e", "v"), (4, "d", "w")]
    return [spark.createDataFrame(rows, SCHEMA) for rows in (first, second, third)]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def by_hand(days, snapshots):
    """Versions by comparing each key's rows from one snapshot to the next."""
    out, open_ = [], {}
    for day, snapshot in zip(days, snapshots):
        now = {r.k: tuple(r) for r in snapshot.collect()}
        for k in set(open_) | set(now):
            if k in open_ and open_[k][0] != now.get(k):
                row, since = open_.pop(k)
                if since < day:
                    out.append((*row, since, day - dt.timedelta(days=1), False))
            if k in now and k not in open_:
                open_[k] = (now[k], day)
    return sorted(out + [(*row, since, END, True) for row, since in open_.values()], key=str)


@pytest.mark.parametrize("days", [(DAY1, DAY2, DAY3), (DAY1, DAY2, DAY2), (DAY1, DAY1, DAY3)])
def test_snapshots_one_after_the_other(snapshots, days):
    versions = opened_on(snapshots[0], days[0])
    for day, snapshot in zip(days[1:], snapshots[1:]):
        versions = merged(versions, snapshot, "k", day)
    assert rows(versions) == by_hand(days, snapshots)


def test_keys_that_are_missing_may_stay(snapshots):
    versions = merged(opened_on(snapshots[0], DAY1), snapshots[1], "k", DAY2, missing="keep")
    assert (4, "d", "w", DAY1, END, True) in rows(versions)


def test_untracked_columns_open_nothing(snapshots):
    changes = refresh_changes(opened_on(snapshots[0], DAY1), snapshots[1], "k", DAY2, tracked=["name"], missing="keep")
    assert {r.k for r in changes.collect()} == {3, 5}


def test_null_text_and_column_are_told_apart(spark):
    before = spark.createDataFrame([(1, None, "b"), (2, "", None), (3, "x", "y")], SCHEMA)
    after = spark.createDataFrame([(1, "b", None), (2, None, ""), (3, "x", "y")], SCHEMA)
    assert {r.k for r in refresh_changes(opened_on(before, DAY1), after, "k", DAY2).collect()} == {1, 2}


@pytest.mark.parametrize("path", [False, True])
def test_stored_dimension(spark, tmp_path, snapshots, path):
    spark.sql("CREATE DATABASE IF NOT EXISTS refresh_test")
    table = f"dim_{path}"
    where = str(tmp_path / table) if path else None
    days = (DAY1, DAY2, DAY3)
    counts = [refresh_dimension(spark, table, s, "k", d, "refresh_test", where) for d, s in zip(days, snapshots)]
    assert counts == [
        {"opened": 4, "closed": 0, "dropped": 0},
        {"opened": 3, "closed": 3, "dropped": 0},
        {"opened": 3, "closed": 2, "dropped": 0},
    ]
    assert rows(spark.table(f"refresh_test.{table}")) == by_hand(days, snapshots)
    # An unchanged snapshot writes nothing.
    files = sorted(spark.table(f"refresh_test.{table}").inputFiles())
    assert set(refresh_dimension(spark, table, snapshots[2], "k", D(2018, 1, 1), "refresh_test", where).values()) == {0}
    assert sorted(spark.table(f"refresh_test.{table}").inputFiles()) == files


def test_unclear_snapshots_are_refused(spark, snapshots):
    for extra in ((1, "a", "q"), (None, "a", "q")):
        with pytest.raises(ValueError, match="rows with k"):
            refresh_dimension(spark, "none", snapshots[0].unionByName(spark.createDataFrame([extra] * 2, SCHEMA)), "k", DAY1, "refresh_test")
    with pytest.raises(ValueError, match="dimension"):
        merged(opened_on(snapshots[0], DAY1), snapshots[1].drop("grp"), "k", DAY2)
    with pytest.raises(ValueError):
        merged(opened_on(snapshots[0], DAY1), snapshots[1], "k", DAY2, missing="drop")


def test_empty_snapshot_and_empty_dimension(spark, snapshots):
    versions = opened_on(snapshots[0], DAY1)
    closed = merged(versions, snapshots[0].limit(0), "k", DAY2)
    assert {(r[VALID_FROM], r.Is_Current) for r in closed.collect()} == {(DAY1, False)}
    assert rows(merged(versions.limit(0), snapshots[0], "k", DAY1)) == rows(versions)
