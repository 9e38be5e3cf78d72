import csv
import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmart.plans import sample_loads
from starmart.plans.catalog import QUESTIONS
from starmart.sources import typed_csv
from starmart.sources.registry import TABLES
from starmart.sources.tables import broken_views, formatted, row_counts, summary_frame, underscored, write_table, write_view
from starmart.sources.testdata import SampleMart
from starmart.sources.typed_csv import cast_columns, export_csv, export_tables, exportable, read_typed_csv

CASTS = {"Id": "int", "Is Big": "boolean", "Price": "decimal(18,2)", "Day": "date"}
HEADER = ["Id", "Name", "Is Big", "Price", "Day"]


def write_csv(path, header, rows):
    with open(path, "w", newline="", encoding="utf-8") as f:
        csv.writer(f, quoting=csv.QUOTE_MINIMAL).writerows([header, *rows])
    return str(path)


def test_quotes_commas_and_empty_text(spark, tmp_path):
    path = write_csv(
        tmp_path / "a.csv",
        HEADER,
        [[1, 'say "hi", you', True, "10.10", "2013-01-01"], [2, "", False, "", ""], ["", "plain", "", "0.5", "2013-12-31"]],
    )
    rows = read_typed_csv(spark, path, CASTS).collect()
    assert tuple(rows[0]) == (1, 'say "hi", you', True, Decimal("10.10"), dt.date(2013, 1, 1))
    assert tuple(rows[1]) == (2, None, False, None, None)
    assert tuple(rows[2]) == (None, "plain", None, Decimal("0.50"), dt.date(2013, 12, 31))


def test_line_breaks_need_multi_line(spark, tmp_path):
    path = write_csv(tmp_path / "m.csv", ["Id", "Name"], [[1, "two\nlines"], [2, "x"]])
    rows = read_typed_csv(spark, path, {"Id": "int"}, multi_line=True).collect()
    assert [tuple(r) for r in rows] == [(1, "two\nlines"), (2, "x")]


def test_bad_text(spark, tmp_path):
    path = write_csv(tmp_path / "b.csv", ["Id", "Name"], [["seven", "x"], [8, "y"]])
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        read_typed_csv(spark, path, {"Id": "int"}).collect()
    rows = read_typed_csv(spark, path, {"Id": "int"}, on_error="null").collect()
    assert [r.Id for r in rows] == [None, 8]
    with pytest.raises(ValueError):
        read_typed_csv(spark, path, {"Id": "int"}, on_error="skip")
    with pytest.raises(ValueError, match="Nope"):
        read_typed_csv(spark, path, {"Nope": "int"})


def test_casts_are_one_projection(spark):
    df = spark.createDataFrame([("1", "2.5", "x")], "a string, b string, c string")
    out = cast_columns(df, {"a": "int", "b": "double"})
    assert out.dtypes == [("a", "int"), ("b", "double"), ("c", "string")]


def test_export_round_trip(spark, tmp_path):
    rows = [
        (1, 'a "q", b', True, Decimal("1.50"), dt.date(2015, 2, 3), dt.datetime(2015, 2, 3, 4, 5, 6), b"x"),
        (2, None, None, None, None, None, None),
    ]
    schema = "Id int, Name string, Flag boolean, Price decimal(18,2), Day date, At timestamp, Photo binary"
    df = spark.createDataFrame(rows, schema)
    assert "Photo" not in exportable(df).columns
    path = str(tmp_path / "out.csv")
    assert export_csv(df, path) == 2
    back = read_typed_csv(spark, path, {"Id": "int", "Flag": "boolean", "Price": "decimal(18,2)", "Day": "date", "At": "timestamp"})
    assert [tuple(r) for r in back.orderBy("Id").collect()] == [r[:-1] for r in rows]


def test_compressed_export_round_trip(spark, tmp_path, monkeypatch):
    """Compressed files are read by one task each, so they are many where rows are many."""
    monkeypatch.setattr(typed_csv, "_COMPRESSED_ROWS", 10)
    path = str(tmp_path / "out.csv")
    assert export_csv(spark.range(0, 35, 1, 1).selectExpr("id AS Id", "'a \"q\", ' || id AS Name"), path, compression="gzip") == 35
    assert [f.name.endswith(".csv.gz") for f in (tmp_path / "out.csv").glob("part-*")] == [True] * 4
    back = read_typed_csv(spark, path, {"Id": "int"})
    assert sorted(map(tuple, back.collect())) == [(i, f'a "q", {i}') for i in range(35)]


def test_whole_run_writes_compressed_files(spark, tmp_path, monkeypatch):
    """Exports and tables: as plain text and in the session's codec they were twice as large."""
    written = {}

    def stop(session, csv_root, schema, e, layout):
        files = [f for n in sample_loads.SOURCES for f in typed_csv.headers(session, f"{csv_root}/{TABLES[n].file_name}")]
        path = str(tmp_path / "t")
        assert write_table(session.range(5), "t", schema, **layout["Fact_Sale"] | {"path": path}) == 5
        written.update(csv=files, table=[f.name for f in (tmp_path / "t").glob("part-*")])
        raise InterruptedError

    monkeypatch.setattr(sample_loads, "build_warehouse", stop)
    with pytest.raises(InterruptedError):
        sample_loads.whole_run(SampleMart(spark, "/root/testdata/sf0.001"))
    assert len(written["csv"]) >= len(sample_loads.SOURCES) and all(f.endswith(".csv.gz") for f in written["csv"])
    assert written["table"] and all(f.endswith(".zstd.parquet") for f in written["table"])


def test_registry_matches_any_system_name():
    spec = TABLES["Dimension_City"]
    casts = spec.casts(["City Key", "ABC City ID", "City", "Latest Recorded Population", "Valid From", "Valid To", "Lineage Key"])
    assert casts["ABC City ID"] == "int" and casts["Latest Recorded Population"] == "long" and "City" not in casts
    with pytest.raises(ValueError, match="Lineage Key"):
        spec.casts(["City Key", "ABC City ID", "Latest Recorded Population", "Valid From", "Valid To"])


def test_registry_covers_the_warehouse():
    assert len(TABLES) == 14
    assert sum(n.startswith("Dimension_") for n in TABLES) == 8
    typed = {n: [k.split("(")[0] for k in s.types.values()] for n, s in TABLES.items()}
    counts = {n: {k: v.count(k) for k in sorted(set(v))} for n, v in typed.items()}
    assert counts == {
        "Dimension_Date": {"date": 1, "int": 7},
        "Dimension_City": {"int": 3, "long": 1, "timestamp": 2},
        "Dimension_Customer": {"int": 3, "timestamp": 2},
        "Dimension_Employee": {"boolean": 1, "int": 3, "timestamp": 2},
        "Dimension_Payment_Method": {"int": 3, "timestamp": 2},
        "Dimension_Stock_Item": {"boolean": 1, "decimal": 4, "int": 5, "timestamp": 2},
        "Dimension_Supplier": {"int": 4, "timestamp": 2},
        "Dimension_Transaction_Type": {"int": 3, "timestamp": 2},
        "Fact_Sale": {"date": 2, "decimal": 6, "int": 10, "long": 1},
        "Fact_Order": {"date": 2, "decimal": 5, "int": 9, "long": 1},
        "Fact_Purchase": {"boolean": 1, "date": 1, "int": 7, "long": 1},
        "Fact_Movement": {"date": 1, "int": 9, "long": 1},
        "Fact_Stock_Holding": {"decimal": 1, "int": 6, "long": 1},
        "Fact_Transaction": {"boolean": 1, "date": 1, "decimal": 4, "int": 10, "long": 1},
    }
    for spec in TABLES.values():
        for target, key in spec.foreign_keys.values():
            assert TABLES[target].key.replace(" ", "_") == key


def test_tables_views_and_summary(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS io_test")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "`My Key` int, Name string")
    assert underscored(df).columns == ["My_Key", "Name"]
    path = str(tmp_path / "t")
    assert write_table(df, "t", "io_test", path=path) == 2
    assert write_table(df.limit(1), "t", "io_test", overwrite=False) == 2  # kept
    wider = df.selectExpr("*", "1.5D AS Extra")
    assert write_table(wider.limit(1), "t", "io_test", path=path) == 1  # replaced, with its schema
    assert spark.table("io_test.t").columns == ["My_Key", "Name", "Extra"]
    write_view(spark, "v", "SELECT My_Key FROM io_test.t", "io_test")
    write_view(spark, "v", "SELECT Name FROM io_test.t", "io_test")
    assert spark.table("io_test.v").columns == ["Name"]
    summary = summary_frame(spark, [("a", 1200), ("b", 34)])
    assert [tuple(r) for r in formatted(summary).collect()] == [("a", "1,200"), ("b", "34"), ("TOTAL", "1,234")]
    assert {tuple(r) for r in row_counts({"x": df, "y": df}).collect()} == {("x", 2), ("y", 2), ("TOTAL", 4)}


def test_partitioned_and_bucketed_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS io_test")
    df = spark.range(0, 100).selectExpr("id AS Customer_Key", "CAST(id % 3 AS INT) AS Year")
    write_table(df, "p", "io_test", partition_by=["Year"], path=str(tmp_path / "p"))
    assert "PartitionFilters: [isnotnull(Year" in spark.table("io_test.p").filter("Year = 1")._jdf.queryExecution().executedPlan().toString()
    write_table(df, "b", "io_test", bucket_by=(4, "Customer_Key"), path=str(tmp_path / "b"))
    plan = spark.table("io_test.b").groupBy("Customer_Key").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_export_of_catalog_tables(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS io_test")
    employee = spark.createDataFrame(
        [(1, 11, "Jo", "Jo", True, "2013-01-01", "9999-12-31", 1, "extra")],
        "Employee_Key int, SRC_Employee_ID int, Employee string, Preferred_Name string, Is_Salesperson boolean, "
        "Valid_From string, Valid_To string, Lineage_Key int, Unlisted string",
    )
    write_table(employee, "Dimension_Employee", "io_test", path=str(tmp_path / "e"))
    out = export_tables(spark, "io_test", str(tmp_path / "csv"), ["Dimension_Employee"])
    assert [tuple(r) for r in out.collect()] == [("Dimension_Employee", 1), ("TOTAL", 1)]
    header = spark.read.option("header", True).csv(str(tmp_path / "csv" / "Dimension_Employee.csv")).columns
    assert header == [c.replace("_", " ") for c in employee.columns[:-1]]


def test_lines_with_other_fields_than_the_header(spark, tmp_path):
    (tmp_path / "x.csv").write_text("k,v,m\n1,a,2.00\n2,b,3.00,EXTRA\n3,c\n")
    casts = {"k": "int", "m": "decimal(18,2)"}
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        typed_csv.read_typed_csv(spark, str(tmp_path / "x.csv"), casts).collect()
    df = typed_csv.read_typed_csv(spark, str(tmp_path / "x.csv"), casts, on_error="null")
    assert typed_csv.corrupt_rows(df.cache()) == 2 and df.filter("k = 1").first()[typed_csv.CORRUPT] is None


def test_missing_stored_column_is_an_error(spark, tmp_path):
    spark.read.parquet("/root/testdata/sf0.001/orders.parquet").withColumnRenamed("o_custkey", "o_custkeyX").write.parquet(
        str(tmp_path / "orders.parquet")
    )
    with pytest.raises(ValueError, match="o_custkey"):
        SampleMart(spark, str(tmp_path)).raw("orders")


def test_calendar_follows_the_facts(spark, tmp_path):
    """Facts before 1992 and after 2012 count like all others."""
    for name, days in (("lineitem", "l_shipdate"), ("orders", "o_orderdate")):
        df = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        shift = F.expr(f"IF(l_orderkey % 2 = 0, {days} + INTERVAL '14' YEAR, {days} - INTERVAL '14' YEAR)" if name == "lineitem" else days)
        df.withColumn(days, shift.cast("timestamp_ntz")).write.parquet(str(tmp_path / f"{name}.parquet"))
    mart = SampleMart(spark, str(tmp_path))
    by_year = QUESTIONS["q01_revenue_by_year"](mart).agg(F.sum("revenue")).first()[0]
    assert by_year == QUESTIONS["q16_total_revenue"](mart).first()[0]
    assert mart.table("Dimension_Date").filter("Calendar_Year < 1992 OR Calendar_Year > 2012").count() > 0


def test_files_with_other_headers(spark, tmp_path):
    """Columns go by their own file's header: swapped, missing and quoted ones."""
    folder = tmp_path / "many"
    folder.mkdir()
    (folder / "a.csv").write_text("A,B,Note\n1,2,x\n")
    (folder / "b.csv").write_text('B,A,"Note"\n20,10,"y, z"\n')
    (folder / "c.csv").write_text("﻿A,B\n100,200\n", encoding="utf-8")
    (folder / "_SUCCESS").write_text("")
    for on_error in ("fail", "null"):
        df = read_typed_csv(spark, str(folder), {"A": "int", "B": "int"}, on_error)
        assert sorted((r.A, r.B, r.Note) for r in df.collect()) == [(1, 2, "x"), (10, 20, "y, z"), (100, 200, None)]
    (folder / "d.csv").write_text("A,Note\n5,x\n")
    with pytest.raises(ValueError, match="B"):
        read_typed_csv(spark, str(folder), {"A": "int", "B": "int"})
    (folder / "d.csv").write_text("A,a\n5,x\n")
    with pytest.raises(ValueError, match="twice"):
        read_typed_csv(spark, str(folder), {"A": "int"})
    with pytest.raises(FileNotFoundError):
        read_typed_csv(spark, str(tmp_path / "none*.csv"), {"A": "int"})


def test_table_is_replaced_by_a_frame_that_reads_it(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS io_test")
    for path in (None, str(tmp_path / "self")):
        write_table(spark.range(10).withColumnRenamed("id", "k"), "own", "io_test", path=path)
        grown = spark.table("io_test.own")
        assert write_table(grown.unionByName(grown).selectExpr("k", "k * 2 AS twice"), "own", "io_test", path=path) == 20
        assert write_table(spark.table("io_test.own").filter("k > 4"), "own", "io_test", path=path) == 10
        assert spark.table("io_test.own").columns == ["k", "twice"] and spark.table("io_test.own").count() == 10
        names = {t.name for t in spark.catalog.listTables("io_test")}
        assert not {n for n in names if n.startswith("own__")}
        spark.sql("DROP TABLE io_test.own")


def test_failed_replacement_leaves_the_old_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS io_test")
    write_table(spark.range(3), "safe", "io_test")
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        write_table(spark.range(0, 5, 1, 1).selectExpr("1 div (id - 2) AS x"), "safe", "io_test")
    assert spark.table("io_test.safe").count() == 3
    # Broken off between the two renamings: the next write brings the old table back first.
    spark.sql("ALTER TABLE io_test.safe RENAME TO io_test.safe__retired")
    assert write_table(spark.range(9), "safe", "io_test", overwrite=False) == 3
    assert write_table(spark.range(9), "safe", "io_test") == 9
    assert {t.name for t in spark.catalog.listTables("io_test") if t.name.startswith("safe")} == {"safe"}


def test_views_after_their_table_was_replaced(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS io_views")
    write_table(spark.range(4).selectExpr("id AS k", "id % 2 = 0 AS Is_Current"), "base", "io_views")
    write_view(spark, "now", "SELECT * FROM io_views.base WHERE Is_Current", "io_views")
    write_table(spark.range(6).selectExpr("id AS k", "id % 2 = 0 AS Is_Current", "1 AS more"), "base", "io_views")
    assert broken_views(spark, "io_views") == {} and spark.table("io_views.now").count() == 3
    write_table(spark.range(6).selectExpr("id AS k"), "base", "io_views")
    assert list(broken_views(spark, "io_views")) == ["now"]


def test_calendar_reads_no_data(spark):
    mart = SampleMart(spark, "/root/testdata/sf0.001")
    text = mart.table("Dimension_Date", "Date", "Calendar_Year")._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in text
    assert "l_linenumber" not in QUESTIONS["q01_revenue_by_year"](mart)._jdf.queryExecution().executedPlan().toString()
