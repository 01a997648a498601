"""Spark-versus-DuckDB comparison used by the tests (mirrors the driver's gate).

Columns are sorted by name, values normalised (dates and timestamps to ISO
text, doubles to 6 decimals, NaN to NULL) and rows compared as a multiset.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import math
from collections import Counter

from candela.sources.tables import TABLES, table_path


def duckdb_con(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(sf_dir, t)}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6) + 0.0
    if hasattr(v, "isoformat") and not isinstance(v, str):
        if isinstance(v, dt.datetime) or type(v).__name__ == "Timestamp":
            return v.isoformat(sep=" ")
        return v.isoformat()
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows_spark(df):
    cols = sorted(df.columns)
    return cols, [tuple(_norm(r[c]) for c in cols) for r in df.select(*[f"`{c}`" for c in cols]).collect()]


def _rows_duck(con, sql):
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    data = res.fetchall()
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], [tuple(_norm(r[i]) for i in order) for r in data]


def digest(rows) -> str:
    h = hashlib.sha256()
    for r in sorted(map(repr, rows)):
        h.update(r.encode())
    return h.hexdigest()[:16]


_SPARK_KIND = {"int": "int32", "bigint": "int64", "double": "float64", "float": "float32",
               "string": "string", "date": "date", "timestamp": "timestamp",
               "timestamp_ntz": "timestamp", "boolean": "bool", "smallint": "int16", "tinyint": "int8"}
_DUCK_KIND = {"INTEGER": "int32", "BIGINT": "int64", "DOUBLE": "float64", "FLOAT": "float32",
              "VARCHAR": "string", "DATE": "date", "TIMESTAMP": "timestamp", "BOOLEAN": "bool",
              "SMALLINT": "int16", "TINYINT": "int8", "TIMESTAMP WITH TIME ZONE": "timestamp"}


def spark_kinds(df) -> dict:
    return {f.name: _SPARK_KIND.get(f.dataType.simpleString(), f.dataType.simpleString())
            for f in df.schema.fields}


def duck_kinds(con, sql) -> dict:
    rel = con.sql(sql)
    return {n: _DUCK_KIND.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}


def compare(df, sql: str, con) -> dict:
    scols, srows = _rows_spark(df)
    ocols, orows = _rows_duck(con, sql)
    out = {"spark_rows": len(srows), "oracle_rows": len(orows),
           "schema_match": scols == ocols, "spark_cols": scols, "oracle_cols": ocols}
    sk, dk = spark_kinds(df), duck_kinds(con, sql)
    out["types_match"] = sk == dk
    if sk != dk:
        out["type_diff"] = {c: (sk.get(c), dk.get(c)) for c in set(sk) | set(dk) if sk.get(c) != dk.get(c)}
    out["values_match"] = Counter(srows) == Counter(orows)
    if not out["values_match"]:
        a, b = Counter(srows), Counter(orows)
        out["only_spark"] = list((a - b).elements())[:3]
        out["only_oracle"] = list((b - a).elements())[:3]
    out["ok"] = out["schema_match"] and out["values_match"]
    return out
