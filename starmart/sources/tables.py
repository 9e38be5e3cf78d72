"""Catalog tables and views, and the load summary."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from starmart.sources.registry import TABLES
from starmart.sources.typed_csv import read_typed_csv

# Table name -> further arguments of write_table.
Layout = dict[str, dict]


def underscored(df: DataFrame) -> DataFrame:
    """Column names with underscores for spaces, in one projection."""
    return df.toDF(*[c.replace(" ", "_") for c in df.columns])


#: Ending of the column that holds the first day of a date's month.
MONTH = "_Month"


def with_month(df: DataFrame, date_key: str) -> DataFrame:
    """``df`` with the month of a date column, its rows laid out by it; large months are split when adaptive execution is on."""
    return df.withColumn(date_key + MONTH, F.trunc(date_key, "MM")).hint("rebalance", date_key + MONTH)


def write_table(
    df: DataFrame,
    name: str,
    schema: str = "dbo",
    fmt: str = "parquet",
    overwrite: bool = True,
    partition_by: list[str] | None = None,
    bucket_by: tuple[int, str] | None = None,
    path: str | None = None,
    by_month: str | None = None,
    options: dict[str, str] | None = None,
) -> int:
    """Save as a catalog table and return its row count.

    ``overwrite`` replaces the table, its schema included; otherwise an existing
    table is left alone. A table that exists is replaced by writing the new one beside it and switching the
    catalog entry, so the old one is whole until then and ``df`` may read it; with a ``path``, the new
    one lies in a folder of its own next to it. The count is taken while writing. ``bucket_by`` (number,
    column) lets later joins and sums on that column run without a shuffle; leave it
    where one key holds much of the table, since a bucket is read by one task. ``by_month``
    names a date column: the table is partitioned by its month (see `with_month`), and a filter
    on the days or on a calendar joined by month reads those months only. ``options`` go
    to the format's writer, say its codec.
    """
    spark = df.sparkSession
    if by_month:
        df = with_month(underscored(df), by_month)
        partition_by = [*(partition_by or []), by_month + MONTH]
    full = f"{schema}.{name}"
    if fmt != "delta":
        _recover(spark, schema, name)
    if not overwrite and spark.catalog.tableExists(full):
        return spark.table(full).count()
    replaces = fmt != "delta" and spark.catalog.tableExists(full)
    target = f"{full}{_STAGED}" if replaces else full
    rows = Observation()
    writer = underscored(df).observe(rows, F.count(F.lit(1)).alias("n")).write.format(fmt)
    writer = writer.mode("overwrite" if overwrite else "ignore")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", True)
    if options:
        writer = writer.options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(bucket_by[1])
    if path:
        writer = writer.option("path", f"{path.rstrip('/')}-{uuid.uuid4().hex}" if replaces else path)
    writer.saveAsTable(target)
    if replaces:
        _publish(spark, schema, name)
    return rows.get["n"]


# Names beside a table while it is replaced: the new one, and the old one for a moment.
_STAGED, _RETIRED = "__staged", "__retired"


def _location(spark: SparkSession, full: str) -> tuple[str, bool]:
    """Where a table's files lie, and whether they are dropped with it."""
    parts = full.split(".")
    table = spark._jsparkSession.sessionState().catalog().getTableMetadata(
        spark._jvm.org.apache.spark.sql.catalyst.TableIdentifier(parts[1], spark._jvm.scala.Option.apply(parts[0]))
    )
    return table.location().toString(), table.tableType().name() == "MANAGED"


def _drop(spark: SparkSession, full: str) -> None:
    """Drop a table with its files, those at a path of its own too."""
    location, managed = _location(spark, full)
    spark.sql(f"DROP TABLE {full}")
    if not managed:
        path = spark._jvm.org.apache.hadoop.fs.Path(location)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def _recover(spark: SparkSession, schema: str, name: str) -> None:
    """Undo what a replacement that was broken off left: the old table comes back, a staged one goes."""
    full = f"{schema}.{name}"
    if spark.catalog.tableExists(full + _RETIRED):
        if spark.catalog.tableExists(full):
            _drop(spark, full + _RETIRED)
        else:
            spark.sql(f"ALTER TABLE {full}{_RETIRED} RENAME TO {full}")
    if spark.catalog.tableExists(full + _STAGED):
        _drop(spark, full + _STAGED)


def _publish(spark: SparkSession, schema: str, name: str) -> None:
    """Let the name stand for the staged table; the old one comes back if that fails."""
    full = f"{schema}.{name}"
    spark.sql(f"ALTER TABLE {full} RENAME TO {full}{_RETIRED}")
    try:
        spark.sql(f"ALTER TABLE {full}{_STAGED} RENAME TO {full}")
    except Exception:
        spark.sql(f"ALTER TABLE {full}{_RETIRED} RENAME TO {full}")
        raise
    spark.catalog.refreshTable(full)  # forgets where the old one lay
    _drop(spark, full + _RETIRED)


def broken_views(spark: SparkSession, schema: str = "dbo") -> dict[str, str]:
    """Views that no longer resolve, with the reason: after a table lost columns that they name."""
    broken = {}
    for row in spark.sql(f"SHOW VIEWS IN {schema}").filter("NOT isTemporary").collect():  # one row a view
        try:
            spark.table(f"{schema}.{row.viewName}").schema
        except AnalysisException as problem:
            broken[row.viewName] = problem.getCondition() or str(problem)
    return broken


def write_view(spark: SparkSession, name: str, sql: str, schema: str = "dbo") -> None:
    """Create or replace a view of a query."""
    spark.sql(f"CREATE OR REPLACE VIEW {schema}.{name} AS {sql}")


def summary_frame(spark: SparkSession, counts: list[tuple[str, int]]) -> DataFrame:
    """Table names with row counts and a total row; one entry per table, so small."""
    total = sum(n for _, n in counts)
    return spark.createDataFrame([*counts, ("TOTAL", total)], "table_name string, n_rows long")


def row_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Row counts per named frame and their total, as one lazy plan."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        for name, df in frames.items()
    ]
    counts = reduce(DataFrame.unionByName, parts)
    return counts.rollup("table_name").agg(F.sum("n_rows").alias("n_rows")).select(
        F.coalesce("table_name", F.lit("TOTAL")).alias("table_name"), "n_rows"
    )


def formatted(summary: DataFrame) -> DataFrame:
    """The summary for reading: counts with thousands separators."""
    return summary.withColumn("n_rows", F.format_number("n_rows", 0))


def load_base_tables(
    spark: SparkSession,
    csv_root: str,
    schema: str = "dbo",
    fmt: str = "parquet",
    overwrite: bool = True,
    on_error: str = "fail",
    names: list[str] | None = None,
    layout: Layout | None = None,
    multi_line: bool = False,
) -> list[tuple[str, int]]:
    """Load the registered tables from ``<csv_root>/<name>.csv``; returns row counts.

    ``layout`` gives ``write_table`` options per table, say buckets by customer.
    """
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema}")
    counts = []
    for name in names or list(TABLES):
        spec = TABLES[name]
        df = read_typed_csv(spark, f"{csv_root.rstrip('/')}/{spec.file_name}", spec, on_error, multi_line)
        counts.append((name, write_table(df, name, schema, fmt, overwrite, **(layout or {}).get(name, {}))))
    return counts
