"""Row sets of Spark and DuckDB, compared without order and without tolerance."""

from __future__ import annotations

import duckdb

TABLES = "region nation customer supplier part orders lineitem".split()


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def rows_of(names: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    picked = [tuple(r[i] for i in order) for r in rows]
    return [names[i] for i in order], sorted(picked, key=lambda r: tuple((v is not None, str(v)) for v in r))


def difference(df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None if equal, else what differs first."""
    got_names, got = rows_of(df.columns, df.collect())
    cursor = con.execute(sql)
    want_names, want = rows_of([c[0] for c in cursor.description], cursor.fetchall())
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{g} != {w}"
    return None
