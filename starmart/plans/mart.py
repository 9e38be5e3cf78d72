"""A mart hands the questions their tables, with only the columns they ask for."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from starmart.sources.tables import MONTH

During = tuple[str, dt.date | None, dt.date | None]


class Mart:
    """Access to star-schema tables by name.

    ``columns`` is what the caller will use; a source may skip joins that only feed
    other columns. ``during`` is (date column, first day, last day), both days
    inclusive and either one None, for the source to prune by.
    """

    def table(self, name: str, *columns: str, during: During | None = None) -> DataFrame:
        raise NotImplementedError


def within(df: DataFrame, during: During | None) -> DataFrame:
    if during is None:
        return df
    column, lo, hi = during
    if lo is not None:
        df = df.filter(F.col(column) >= F.lit(lo))
    if hi is not None:
        df = df.filter(F.col(column) <= F.lit(hi))
    return df


def within_months(df: DataFrame, during: During | None) -> DataFrame:
    """`within`, and for a table laid out by month the months too, so that no other partition is listed or read."""
    if during is not None and during[0] + MONTH in df.columns:
        column, lo, hi = during
        df = within(df, (column + MONTH, lo and lo.replace(day=1), hi and hi.replace(day=1)))
    return within(df, during)


def whole_year(column: str, year: int) -> During:
    return column, dt.date(year, 1, 1), dt.date(year, 12, 31)


class CatalogMart(Mart):
    """Tables and views of a catalog schema, as the loader and enrichment write them."""

    def __init__(self, spark: SparkSession, schema: str = "dbo"):
        self.spark, self.schema = spark, schema

    def table(self, name: str, *columns: str, during: During | None = None) -> DataFrame:
        df = within_months(self.spark.table(f"{self.schema}.{name}"), during)
        return df.select(*columns) if columns else df


class FrameMart(Mart):
    """Tables given as DataFrames."""

    def __init__(self, **frames: DataFrame):
        self.frames = frames

    def table(self, name: str, *columns: str, during: During | None = None) -> DataFrame:
        df = within_months(self.frames[name], during)
        return df.select(*columns) if columns else df
