import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.operators.star import reduce_fact
from starmart.functions import covers, draw, in_year, overlaps, percent_change, percent_of, recode, scaled_price

D = dt.date


@pytest.fixture(scope="module")
def spans(spark):
    rows = [(1, D(1992, 1, 1), D(1998, 12, 31)), (2, D(1999, 1, 1), D(9999, 12, 31)), (3, None, D(1999, 1, 1))]
    return spark.createDataFrame(rows, "id int, vf date, vt date")


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize(
    ("day", "closed", "expected"),
    [
        (D(1998, 12, 31), "both", [1]),
        (D(1998, 12, 31), "left", []),
        (D(1999, 1, 1), "both", [2]),
        (D(1999, 1, 1), "left", [2]),
        (D(1991, 12, 31), "both", []),
    ],
)
def test_covers_at_boundaries(spans, day, closed, expected):
    assert ids(spans.filter(covers("vf", "vt", day, closed))) == expected


def test_covers_rejects_unknown_convention():
    with pytest.raises(ValueError):
        covers("vf", "vt", D(2000, 1, 1), "right")


def test_overlaps_is_inclusive_and_reads_text_as_dates(spans):
    assert ids(spans.filter(overlaps("vf", "vt", "1998-12-31", "1999-01-01"))) == [1, 2]
    assert ids(spans.filter(overlaps("vf", "vt", D(1998, 12, 31), D(1998, 12, 31)))) == [1]


def test_in_year(spark):
    df = spark.createDataFrame([(1, D(1997, 12, 31)), (2, D(1998, 1, 1)), (3, D(1998, 12, 31)), (4, None)], "id int, d date")
    assert ids(df.filter(in_year("d", 1998))) == [2, 3]


def test_recode_unknown_and_quoted_values(spark):
    df = spark.createDataFrame([("a",), ("it's",), ("b",), (None,)], "v string")
    mapping = {"a": "x", "it's": "o'k"}
    assert [r[0] for r in df.select(recode("v", mapping)).collect()] == ["x", "o'k", None, None]
    assert [r[0] for r in df.select(recode("v", mapping, "keep")).collect()] == ["x", "o'k", "b", None]


def test_scaled_price_rounds_half_up_in_decimals(spark):
    df = spark.createDataFrame([(Decimal("10.10"),), (Decimal("0.01"),), (None,)], "p decimal(18,2)")
    out = df.select(scaled_price("p", "0.85").alias("p"))
    assert out.schema["p"].dataType.simpleString() == "decimal(18,2)"
    assert [r.p for r in out.collect()] == [Decimal("8.59"), Decimal("0.01"), None]


def test_percentages_of_zero_are_null(spark):
    df = spark.createDataFrame([(1.0, 4.0), (1.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(percent_of("a", "b")).collect()] == [25.0, None]
    assert [r[0] for r in df.select(percent_change("b", "a")).collect()] == [-75.0, None]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_are_exact_and_do_not_wrap(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        big = Decimal("9000000000000000.00")
        df = spark.createDataFrame([("a", big)] * 20 + [("b", Decimal("0.10")), ("b", None)], "k string, m decimal(18,2)")
        out = reduce_fact(df, ["k"], {"m": "m"})
        assert {r.k: r.m for r in out.collect()} == {"a": big * 20, "b": Decimal("0.10")}
        assert out.schema["m"].dataType.simpleString() == "decimal(28,2)"
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


def test_draw_repeats_and_stays_in_bounds(spark):
    df = spark.range(0, 2000).select("id", F.expr(draw("id", 42, 3, 7)).alias("a"), F.expr(draw("id", 42, 3, "7")).alias("b"))
    rows = df.collect()
    assert all(r.a == r.b and 0 <= r.a < 7 for r in rows)
    counts = [sum(r.a == v for r in rows) for v in range(7)]
    assert min(counts) > 200
