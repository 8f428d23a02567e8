"""Comparison of a query with its SQL counterpart on the same Parquet files."""

from __future__ import annotations

from pathlib import Path

import duckdb

TYPES = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "BOOLEAN": "boolean", "TIMESTAMP": "timestamp_ntz",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def normal(columns: list[str], rows: list[tuple]) -> tuple[list[str], list[tuple]]:
    """Columns by name and rows as sorted texts, so that every bit of a double counts."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(repr(r[i]) for i in order) for r in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[int, list[str]]:
    """Number of rows and a list of what differs (empty when all is equal)."""
    got_cols, got = normal(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    described = [(c[0], str(c[1])) for c in cur.description]
    want_cols, want = normal([c for c, _ in described], cur.fetchall())
    found = []
    if got_cols != want_cols:
        found.append(f"columns {got_cols} vs {want_cols}")
    elif got != want:
        found.append(f"{len(got)} vs {len(want)} rows")
        extra, missing = set(got) - set(want), set(want) - set(got)
        found += [f"spark {r}" for r in sorted(extra)[:3]] + [f"sql   {r}" for r in sorted(missing)[:3]]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    found += [f"type of {c}: {kinds.get(c)} vs {t}" for c, t in described if TYPES.get(t, t) != kinds.get(c)]
    return len(got), found
