"""Parity check of a registered query against its DuckDB formulation.

Column names (order-insensitive), row counts and values (order-insensitive,
floats compared to 9 significant digits) must agree; exact agreement is
reported separately.
"""

from __future__ import annotations

import math
import time

from tadkit.session import TABLES


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, sig):
    import datetime
    import decimal
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if v == 0 or math.isinf(v) or sig is None:
            return v
        return float(f"{v:.{sig}g}")
    if isinstance(v, decimal.Decimal):
        return _norm(float(v), sig)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, sig) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, sig)) for k, x in v.items()))
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, datetime.date):
        return v.isoformat()
    if hasattr(v, "tolist"):
        return _norm(v.tolist(), sig)
    return v


def rows_of(cols, rows, sig):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i], sig) for i in order) for r in rows]
    return sorted(out, key=lambda r: repr(r))


# Spark simple type -> DuckDB type name of the same width.
TYPE_MAP = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE",
            "timestamp_ntz": "TIMESTAMP", "timestamp": "TIMESTAMP", "boolean": "BOOLEAN", "float": "FLOAT",
            "smallint": "SMALLINT", "tinyint": "TINYINT"}


def type_mismatches(sdf, rel) -> list:
    """Columns whose Spark and DuckDB types differ (decimals compared by kind)."""
    dt = dict(zip(rel.columns, [str(t) for t in rel.types]))
    out = []
    for c, t in sdf.dtypes:
        got = dt.get(c)
        if got is None:
            continue
        if t.startswith("decimal"):
            if not got.startswith("DECIMAL"):
                out.append((c, t, got))
        elif t in TYPE_MAP and TYPE_MAP[t] != got:
            out.append((c, t, got))
    return out


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    scols = sdf.columns
    srows = [tuple(r) for r in sdf.collect()]
    ts = time.time() - t0
    if not sql:
        return {"name": name, "status": "rows-only", "rows": len(srows), "spark_s": round(ts, 2)}
    types = type_mismatches(sdf, con.sql(sql))
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    st = {"name": name, "rows": len(srows), "oracle_rows": len(drows), "spark_s": round(ts, 2)}
    if types:
        st["status"] = f"TYPES {types}"
        return st
    if sorted(scols) != sorted(dcols):
        st["status"] = f"COLUMNS {sorted(scols)} vs {sorted(dcols)}"
        return st
    if len(srows) != len(drows):
        st["status"] = "ROWCOUNT"
        return st
    exact = rows_of(scols, srows, None) == rows_of(dcols, drows, None)
    a, b = rows_of(scols, srows, 9), rows_of(dcols, drows, 9)
    if a == b:
        st["status"] = "ok" if exact else "ok~"
    else:
        bad = [(x, y) for x, y in zip(a, b) if x != y][:2]
        st["status"] = f"VALUES {bad}"
    return st


