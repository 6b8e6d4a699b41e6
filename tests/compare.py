"""Order-insensitive comparison of a Spark query with its DuckDB SQL."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def canonical(pdf: pd.DataFrame) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]

    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and pd.isna(v)):
            return "NULL"
        if isinstance(v, pd.Timestamp):
            return v.isoformat()
        if isinstance(v, float):
            return repr(round(v, 9))
        if hasattr(v, "item"):
            return str(v.item())
        return str(v)

    return sorted(tuple(cell(v) for v in row) for row in pdf.itertuples(index=False, name=None))


FAMILY = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "date": "DATE",
}


def mismatch(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    rel = con.sql(sql)
    want_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    have_types = {n: FAMILY.get(t, t) for n, t in spark_df.dtypes}
    if want_types != have_types:
        diff = {k: (have_types.get(k), want_types.get(k)) for k in {*want_types, *have_types}
                if have_types.get(k) != want_types.get(k)}
        return f"schema: {diff}"
    have, want = canonical(spark_df.toPandas()), canonical(rel.df())
    if len(have) != len(want):
        return f"rows: {len(have)} != {len(want)}"
    for a, b in zip(have, want):
        if a != b:
            return f"values:\n  {a}\n  {b}"
    return None
