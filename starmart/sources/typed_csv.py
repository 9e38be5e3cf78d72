"""CSV in and out: text with a header, typed by casts."""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from starmart.sources.registry import TABLES, TableSpec

# Doubled quotes inside quoted values, empty text for NULL.
_FORMAT = {"header": True, "quote": '"', "escape": '"', "nullValue": "", "emptyValue": ""}

#: Holds the text of lines that do not have the header's fields.
CORRUPT = "_corrupt_record"


def cast_columns(df: DataFrame, casts: dict[str, str], on_error: str = "fail") -> DataFrame:
    """Cast the named columns in one projection; the others pass through.

    Text that does not parse is an error (``on_error="fail"``) or NULL (``"null"``).
    """
    if on_error not in ("fail", "null"):
        raise ValueError(f"on_error must be 'fail' or 'null', not {on_error!r}")
    missing = sorted(set(casts) - set(df.columns))
    if missing:
        raise ValueError(f"columns not found: {missing}")

    def typed(name: str):
        column = F.col(f"`{name}`")
        if name not in casts:
            return column
        return (column.cast(casts[name]) if on_error == "fail" else column.try_cast(casts[name])).alias(name)

    return df.select(*[typed(c) for c in df.columns])


def read_typed_csv(
    spark: SparkSession,
    path: str,
    casts: dict[str, str] | TableSpec,
    on_error: str = "fail",
    multi_line: bool = False,
) -> DataFrame:
    """Typed scan of a CSV file or folder with a header.

    Under ``on_error="fail"`` a line with more or fewer fields than the header is an
    error; under ``"null"`` its text is kept in the column CORRUPT, and `corrupt_rows` counts such lines.
    Files of a folder may have their columns in other orders, or lack some: those of one header are read
    together, by their own columns, and united by name, with NULL for what a file lacks. A column to cast that
    some header lacks is an error.
    ``multi_line`` allows line breaks inside quoted values; such files cannot be
    split, so leave it off where no value has any.
    """
    spec = casts
    reader = spark.read.options(**_FORMAT).option("multiLine", multi_line)
    frames = []
    for header, paths in _by_header(spark, path).items():
        fields = [T.StructField(c, T.StringType()) for c in header]
        if on_error != "fail":
            fields.append(T.StructField(CORRUPT, T.StringType()))
            reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
        else:
            reader = reader.option("mode", "FAILFAST")
        raw = reader.schema(T.StructType(fields)).csv(paths)
        present = spec.casts(raw.columns) if isinstance(spec, TableSpec) else spec
        frames.append(cast_columns(raw, present, on_error))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def headers(spark: SparkSession, path: str) -> dict[str, tuple[str, ...]]:
    """The header of each CSV file at a path, a file or a folder: its first line only is read, by name order of the files."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    found = [f.getPath() for f in fs.globStatus(at) or []]
    files = []
    while found:
        status = fs.getFileStatus(found.pop())
        if status.isDirectory():
            found += [f.getPath() for f in fs.listStatus(status.getPath())]
        elif status.getLen():
            files.append(status.getPath())
    files = sorted(f.toString() for f in files if not f.getName().startswith(("_", ".")))

    def header(file: str) -> tuple[str, ...]:
        stream = fs.open(jvm.org.apache.hadoop.fs.Path(file))
        try:
            codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(fs.getConf()).getCodec(jvm.org.apache.hadoop.fs.Path(file))
            plain = codec.createInputStream(stream) if codec is not None else stream
            line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine() or ""
        finally:
            stream.close()
        return tuple(next(csv.reader([line.removeprefix("\ufeff")]), []))

    with ThreadPoolExecutor(16) as pool:
        return dict(zip(files, pool.map(header, files)))


def _by_header(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files at a path by their header; where all share one, the path itself."""
    groups: dict[tuple[str, ...], list[str]] = {}
    for file, header in headers(spark, path).items():
        groups.setdefault(header, []).append(file)
    if not groups:
        raise FileNotFoundError(f"no CSV file with a header at {path}")
    for header in groups:
        if len({c.lower() for c in header}) < len(header):
            raise ValueError(f"a column occurs twice in the header {header}")
    return {header: [path] for header in groups} if len(groups) == 1 else groups


def corrupt_rows(df: DataFrame) -> int:
    """Lines that did not have the header's fields, of a scan with ``on_error="null"``."""
    return df.filter(F.col(CORRUPT).isNotNull()).count()


def exportable(df: DataFrame) -> DataFrame:
    """The columns that text can hold: binary ones are dropped, floats and booleans keep their text."""
    return df.select(*[F.col(f"`{f.name}`") for f in df.schema if not isinstance(f.dataType, T.BinaryType)])


#: Rows of a compressed file at most: such a file is read by one task.
_COMPRESSED_ROWS = 1_000_000


def export_csv(df: DataFrame, path: str, columns: list[str] | None = None, compression: str | None = None) -> int:
    """Write a CSV folder and return its row count, taken during the write.

    ``compression`` names a codec, say gzip; the text and how it is read are the same. Files of such a codec cannot be
    split, so they end after a million rows.
    """
    rows = Observation()
    picked = df.select(*[F.col(f"`{c}`") for c in columns]) if columns else exportable(df)
    counted = picked.observe(rows, F.count(F.lit(1)).alias("n"))
    writer = (
        counted.write.mode("overwrite")
        .options(**_FORMAT)
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    if compression:
        writer = writer.options(compression=compression, maxRecordsPerFile=_COMPRESSED_ROWS)
    writer.csv(path)
    return rows.get["n"]


def export_tables(spark: SparkSession, schema: str, out_dir: str, names: list[str] | None = None) -> DataFrame:
    """Export catalog tables to ``<out_dir>/<name>.csv``, with row counts and their total.

    Headers get their spaces back, so the loader can read the files. Tables whose
    spec lists columns export those; others all but binary ones.
    """
    from starmart.sources.tables import summary_frame

    def export(name: str) -> tuple[str, int]:
        stored = spark.table(f"{schema}.{name}")
        df = stored.toDF(*[c.replace("_", " ") for c in stored.columns])
        spec = TABLES.get(name)
        columns = list(_present(spec, df.columns)) if spec and spec.columns else None
        return name, export_csv(df, f"{out_dir.rstrip('/')}/{name}.csv", columns)

    # One write job a table, several at a time; small tables need not wait for large ones.
    with ThreadPoolExecutor(4) as pool:
        return summary_frame(spark, list(pool.map(export, names or list(TABLES))))


def _present(spec: TableSpec, header: list[str]):
    """A spec's export columns as this table spells them."""
    for column in spec.columns:
        yield from spec.spelled(column, header) or [column]
