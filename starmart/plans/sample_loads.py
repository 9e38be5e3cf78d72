"""The typed load of each registered table, fed from the sample tables.

Every row of a sample table becomes a CSV row with the registered header and a column of
quoted text. Cells are arithmetic on the row's key, with NULLs, negative and large values and
times of day; the files are then loaded by their spec like any export.
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, functions as F, types as T

from starmart.plans import segments
from starmart.plans.enrich import ENRICHED, Enrichment, build_warehouse
from starmart.plans.mart import CatalogMart
from starmart.session import database, scratch_path
from starmart.sources.registry import TABLES
from starmart.sources.tables import underscored
from starmart.sources.testdata import SampleMart
from starmart.sources.typed_csv import export_csv, read_typed_csv

# Registered table -> (sample table, key of its rows), in load order.
SOURCES = {
    "Dimension_Date": ("orders", "o_orderkey"),
    "Dimension_City": ("customer", "c_custkey"),
    "Dimension_Customer": ("customer", "c_custkey"),
    "Dimension_Employee": ("supplier", "s_suppkey"),
    "Dimension_Payment_Method": ("customer", "c_custkey"),
    "Dimension_Stock_Item": ("part", "p_partkey"),
    "Dimension_Supplier": ("supplier", "s_suppkey"),
    "Dimension_Transaction_Type": ("supplier", "s_suppkey"),
    "Fact_Sale": ("lineitem", "l_orderkey * 10 + l_linenumber"),
    "Fact_Order": ("orders", "o_orderkey"),
    "Fact_Purchase": ("lineitem", "l_partkey"),
    "Fact_Movement": ("lineitem", "l_orderkey"),
    "Fact_Stock_Holding": ("part", "p_partkey"),
    "Fact_Transaction": ("orders", "o_orderkey"),
}


def _cell(kind: str, key: str, position: int) -> str:
    """Values of a kind over its range, negative ones too, and NULL for every thirteenth row."""
    n = f"({key} + {position})"
    large = f"IF({n} % 2 = 0, 1, -1) * ({n} * 1000003 % 10000000000000)"
    day = f"date_add(DATE'2013-01-01', CAST({n} % 1461 AS INT))"
    cell = {
        "int": f"CAST({n} % 2000000 - 1000000 AS INT)",
        "long": f"{n} * 1000003 - 5000000000",
        "boolean": f"{n} % 2 = 0",
        "decimal(18,2)": f"CAST({large} AS DECIMAL(14,0)) * 0.01BD",
        "decimal(18,3)": f"CAST({large} AS DECIMAL(14,0)) * 0.001BD",
        "date": day,
        "timestamp": f"CAST({day} AS TIMESTAMP_NTZ) + make_dt_interval(0, 8, 0, {n} % 43200)",
        "string": f"concat('row \"', {key}, '\", as written')",
    }[kind]
    return f"IF({n} % 13 = 0, NULL, {cell})"


def typed_load(mart: SampleMart, name: str) -> DataFrame:
    """Write one table's rows as CSV, with a column of quoted text, and load them by the table's spec."""
    spec = TABLES[name]
    source, key = SOURCES[name]
    columns = {f"SRC {c}" if c in spec.source_ids else c: kind for c, kind in spec.types.items()} | {"Remark": "string"}
    cells = [f"{_cell(kind, key, i)} AS `{column}`" for i, (column, kind) in enumerate(columns.items())]
    path = scratch_path(mart.spark, name)
    export_csv(mart.raw(source).selectExpr(*cells), path, compression="gzip")
    loaded = underscored(read_typed_csv(mart.spark, path, spec))
    times = [f.name for f in loaded.schema if isinstance(f.dataType, T.TimestampType)]
    return loaded.withColumns({c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in times}) if times else loaded


# How the whole run stores its tables: integers packed by their differences (pages of version 2), in a denser codec.
_COMPACT = {"compression": "zstd", "parquet.writer.version": "v2"}

# Columns of real content for the run from files to answers: registered table -> column -> expression on its sample table.
_CONTENT = {
    "Dimension_Date": {"Date": "date_add(DATE'1990-01-01', CAST(o_orderkey AS INT))"},
    "Dimension_Customer": {"Customer Key": "c_custkey", "Customer": "c_name", "Buying Group": "c_mktsegment"},
    "Dimension_Employee": {"Employee Key": "s_suppkey", "Employee": "'Manager of ' || s_name", "Preferred Name": "s_name"},
    "Dimension_Stock_Item": {
        "Stock Item Key": "p_partkey",
        "Stock Item": "p_name",
        "Brand": "p_brand",
        "Size": "CAST(p_size AS STRING)",
        "Unit Price": "CAST(p_retailprice AS DECIMAL(18,2))",
        "Recommended Retail Price": "CAST(p_retailprice * 1.4 AS DECIMAL(18,2))",
    },
    "Dimension_Supplier": {"Supplier Key": "s_suppkey", "Supplier": "s_name"},
    "Fact_Sale": {
        "Customer Key": "CAST(l_orderkey % 100 AS INT)",
        "Stock Item Key": "CAST(l_partkey AS INT)",
        "Invoice Date Key": "CAST(l_shipdate AS DATE)",
        "Quantity": "CAST(l_quantity AS INT)",
        "Total Including Tax": "CAST(l_extendedprice AS DECIMAL(18,2))",
    },
}


def _write_export(mart: SampleMart, name: str, folder: str) -> None:
    """One table as an exporter would leave it: typed cells by arithmetic, those of `_CONTENT` from the sample."""
    spec = TABLES[name]
    source, key = SOURCES[name]
    columns = {f"SRC {c}" if c in spec.source_ids else c: kind for c, kind in spec.types.items()}
    cells = {column: _cell(kind, key, i) for i, (column, kind) in enumerate(columns.items())} | _CONTENT.get(name, {})
    for missing in spec.columns or ():  # listed for the export, but neither typed nor in the sample
        cells.setdefault(f"SRC {missing}" if missing in spec.source_ids else missing, f"concat('{missing} ', {key})")
    rows = mart.raw(source).selectExpr(*[f"{cell} AS `{column}`" for column, cell in cells.items()])
    export_csv(rows, f"{folder}/{spec.file_name}", compression="gzip")


def whole_run(mart: SampleMart) -> DataFrame:
    """From files to answers: fourteen CSV exports loaded, enriched and given views; the load summary, and beside each
    table of the enrichment what a question over it says."""
    with database(mart.spark, "whole-run") as (schema, path):
        with ThreadPoolExecutor(4) as pool:
            list(pool.map(lambda name: _write_export(mart, name, f"{path}/csv"), SOURCES))
        layout = {name: {"path": f"{path}/{name}", "options": _COMPACT} for name in [*SOURCES, *ENRICHED]}
        summary = build_warehouse(mart.spark, f"{path}/csv", schema, e=Enrichment(first_key=0), layout=layout)
        stored = CatalogMart(mart.spark, schema)
        answers = [
            ("Fact_Sale", stored.table("Fact_Sale", "Total_Including_Tax").agg(F.sum("Total_Including_Tax"))),
            ("Bridge_CustomerSegment", segments.segment_revenue(stored, adding_up=True).agg(F.sum("weighted_revenue"))),
            ("Dimension_Customer_SCD2", stored.table("vw_Customer_Current").agg(F.count(F.lit(1)))),
            ("Dimension_StockItem_SCD2", stored.table("vw_StockItem_Current").agg(F.count(F.lit(1)))),
        ]
        rows = [(name, float(frame.first()[0])) for name, frame in answers]
    return summary.join(mart.spark.createDataFrame(rows, "table_name string, answer double"), "table_name", "left")


LOADS: dict[str, Callable[[SampleMart], DataFrame]] = {
    f"l{i:02d}_load_{name.lower()}": partial(typed_load, name=name) for i, name in enumerate(SOURCES, 1)
} | {"w01_files_to_answers": whole_run}
