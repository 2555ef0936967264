"""Result comparison shared by the oracle tool and the tests."""

from __future__ import annotations

import datetime as dt
import decimal
import math
import re

import duckdb

from quarry.session import HARNESS_TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in HARNESS_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def norm(v, tol: bool):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}") if tol else v
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}") if tol else float(v)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x, tol) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x, tol)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return norm(v.asDict(), tol)
    return v


def canon(cols, rows, tol: bool):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(norm(r[i], tol) for i in order) for r in rows), key=repr)


_TYPES = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
          "date": "DATE", "timestamp_ntz": "TIMESTAMP", "float": "FLOAT", "smallint": "SMALLINT", "tinyint": "TINYINT",
          "timestamp": "TIMESTAMP WITH TIME ZONE"}


def duck_type(spark_type: str) -> str:
    """DuckDB name of a Spark simple type string."""
    m = re.match(r"decimal\((\d+),(\d+)\)", spark_type)
    if m:
        return f"DECIMAL({m.group(1)},{m.group(2)})"
    if spark_type.startswith("array<"):
        return duck_type(spark_type[6:-1]) + "[]"
    return _TYPES.get(spark_type, spark_type)


def type_diff(spark_schema, duck_description) -> dict:
    st = {f.name: duck_type(f.dataType.simpleString()) for f in spark_schema.fields}
    dt_ = {d[0]: str(d[1]) for d in duck_description}
    return {k: (st.get(k), dt_.get(k)) for k in set(st) | set(dt_) if st.get(k) != dt_.get(k)}


def compare(scols, srows, dcols, drows) -> str:
    """'exact', 'close' or a failure description."""
    if sorted(scols) != sorted(dcols):
        return f"columns differ: spark={scols} duck={dcols}"
    if len(srows) != len(drows):
        return f"row counts differ: spark={len(srows)} duck={len(drows)}"
    a0, b0 = canon(scols, srows, False), canon(dcols, drows, False)
    if a0 == b0:
        # exact also requires identical text forms (int vs float, -0.0 vs 0.0),
        # since a value hash may be computed from them
        return "exact" if repr(a0) == repr(b0) else "close"
    a, b = canon(scols, srows, True), canon(dcols, drows, True)
    if a == b:
        return "close"
    for x, y in zip(a, b):
        if x != y:
            return f"values differ: spark={x} duck={y}"
    return "values differ"
