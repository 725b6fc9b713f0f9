"""Local stand-in for the driver's correctness gate: Spark query vs DuckDB SQL."""

from __future__ import annotations

import math

import duckdb
import pyarrow as pa

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm_type(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return "timestamp"
    return str(t)


def _norm_val(v, digits=9):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return v if digits >= 17 else round(v, digits)
    if isinstance(v, list):
        return tuple(_norm_val(x, digits) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm_val(x, digits)) for k, x in v.items()))
    return v


def compare(spark_df, con, sql: str, digits: int = 9) -> dict:
    s_tab = spark_df.toArrow()
    d_tab = con.sql(sql).to_arrow_table()
    out = {"rows_spark": s_tab.num_rows, "rows_oracle": d_tab.num_rows}
    s_cols, d_cols = sorted(s_tab.column_names), sorted(d_tab.column_names)
    out["columns_match"] = s_cols == d_cols
    if not out["columns_match"]:
        out["columns"] = (s_cols, d_cols)
        out["ok"] = False
        return out
    s_types = {c: _norm_type(s_tab.schema.field(c).type) for c in s_cols}
    d_types = {c: _norm_type(d_tab.schema.field(c).type) for c in d_cols}
    out["type_diff"] = {c: (s_types[c], d_types[c]) for c in s_cols if s_types[c] != d_types[c]}
    s_rows = sorted((tuple(_norm_val(r[c], digits) for c in s_cols) for r in s_tab.to_pylist()), key=repr)
    d_rows = sorted((tuple(_norm_val(r[c], digits) for c in s_cols) for r in d_tab.to_pylist()), key=repr)
    out["values_match"] = s_rows == d_rows
    if not out["values_match"]:
        diff_s = [r for r in s_rows if r not in set(d_rows)][:3]
        diff_d = [r for r in d_rows if r not in set(s_rows)][:3]
        out["sample_diff"] = {"spark_only": diff_s, "oracle_only": diff_d, "cols": s_cols}
    out["ok"] = out["rows_spark"] == out["rows_oracle"] and out["values_match"] and not out["type_diff"]
    return out
