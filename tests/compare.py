"""Run registered queries against the oracle SQL and compare rows, columns and types."""

from __future__ import annotations

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
KINDS = {"int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN"}


def oracle_connection(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def difference(df, con, sql: str) -> str | None:
    """None if both sides agree, else what differs first."""
    names = sorted(df.columns)
    types = dict(df.dtypes)
    rel = con.sql(sql)
    if sorted(rel.columns) != names:
        return f"columns {names} / {sorted(rel.columns)}"
    other = dict(zip(rel.columns, map(str, rel.types)))
    wrong = {c: (types[c], other[c]) for c in names if KINDS.get(types[c]) != other[c]}
    key = lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    got = sorted((tuple(r[c] for c in names) for r in df.select(*[f"`{c}`" for c in names]).collect()), key=key)
    order = [rel.columns.index(c) for c in names]
    want = sorted((tuple(r[i] for i in order) for r in rel.fetchall()), key=key)
    if len(got) != len(want):
        return f"rows {len(got)} / {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{names}: {g} / {w}"
    return f"types {wrong}" if wrong else None
