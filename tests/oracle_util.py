"""Spark-vs-DuckDB comparison used by the oracle tests and by hand.

Mirrors the driver's gate: same row count, same column names, and the same
multiset of rows once columns are sorted by name.
"""

from __future__ import annotations

import datetime
import math
import os

import duckdb
import pandas as pd

from candlewright.fixtures import TABLES

# ORACLE_STRICT=1 compares floats exactly (no rounding)
STRICT = os.environ.get("ORACLE_STRICT") == "1"


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    con.execute("SET TimeZone='UTC'")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if STRICT else round(v, 6)
    if isinstance(v, pd.Timestamp):
        v = v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, datetime.datetime):
        return v.isoformat(sep=" ") if (v.hour, v.minute, v.second, v.microsecond) != (0, 0, 0, 0) \
            else v.date().isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return _norm(v.item())
        except Exception:
            return v
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    pdf = pdf[cols].astype(object).where(pd.notna(pdf[cols]), None)
    rows = [tuple(_norm(v) for v in r) for r in pdf.itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[bool, str]:
    s = spark_df.toPandas()
    o = con.execute(sql).df()
    if sorted(s.columns) != sorted(o.columns):
        return False, f"columns differ: spark={sorted(s.columns)} oracle={sorted(o.columns)}"
    if len(s) != len(o):
        return False, f"row count differs: spark={len(s)} oracle={len(o)}"
    rs, ro = _rows(s), _rows(o)
    if rs != ro:
        bad = [(a, b) for a, b in zip(rs, ro) if a != b][:3]
        return False, f"values differ (cols {sorted(s.columns)}): {bad}"
    return True, f"{len(s)} rows"
