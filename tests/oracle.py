"""Side-by-side check of a Spark query against its DuckDB oracle SQL, the way
the driver does it: row count, column names, order-insensitive values."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from tessera.sources.tables import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    return v


def _kind(series):
    """Coarse value kind as a hashing checker would see it."""
    k = series.dtype.kind
    if k in "iu" or str(series.dtype).startswith(("Int", "UInt")):
        return "int"
    if k == "f":
        return "float"
    if k == "M":
        return "datetime"
    if k == "b" or str(series.dtype) == "boolean":
        return "bool"
    vals = series.dropna()
    return type(vals.iloc[0]).__name__ if len(vals) else "empty"


def rows(pdf: pd.DataFrame):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False):
        out.append(tuple(_norm(x) for x in rec))
    return cols, sorted(out, key=repr)


def compare(spark_df, con, sql: str):
    s = spark_df.toPandas()
    d = con.execute(sql).fetchdf()
    sc, sr = rows(s)
    dc, dr = rows(d)
    problems = []
    if sc != dc:
        problems.append(f"columns differ: spark={sc} oracle={dc}")
    if len(sr) != len(dr):
        problems.append(f"row counts differ: spark={len(sr)} oracle={len(dr)}")
    kinds = {c: (_kind(s[c]), _kind(d[c])) for c in sc if c in d.columns}
    bad = {c: k for c, k in kinds.items() if k[0] != k[1] and len(s) and len(d)}
    if bad:
        problems.append(f"column kinds differ: {bad}")
    if not problems and sr != dr:
        diff = [(a, b) for a, b in zip(sr, dr) if a != b][:3]
        problems.append(f"values differ, e.g. {diff}")
    return len(sr), problems
