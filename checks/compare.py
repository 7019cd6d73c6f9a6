"""Side-by-side check of a Spark DataFrame against DuckDB oracle SQL."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, Decimal):
        return ("D", str(v.normalize()) if v != 0 else "0")
    if isinstance(v, float):
        if math.isnan(v):
            return ("F", "nan")
        return ("F", repr(v))
    if isinstance(v, int):
        return ("I", v)
    if isinstance(v, dt.datetime):
        return ("T", v.replace(tzinfo=None).isoformat())
    if isinstance(v, dt.date):
        return ("DT", v.isoformat())
    if isinstance(v, dict):
        return ("M", tuple(sorted((k, _norm(x)) for k, x in v.items())))
    if isinstance(v, (list, tuple)):
        return ("L", tuple(_norm(x) for x in v))
    return v


def spark_type_name(t) -> str:
    from pyspark.sql import types as T
    m = {T.StringType: "VARCHAR", T.IntegerType: "INTEGER", T.LongType: "BIGINT", T.DoubleType: "DOUBLE",
         T.BooleanType: "BOOLEAN", T.DateType: "DATE", T.TimestampNTZType: "TIMESTAMP", T.FloatType: "FLOAT",
         T.TimestampType: "TIMESTAMP WITH TIME ZONE"}
    if isinstance(t, T.DecimalType):
        return f"DECIMAL({t.precision},{t.scale})"
    for k, v in m.items():
        if isinstance(t, k):
            return v
    return t.simpleString().upper()


def compare(spark_df, con, sql: str, show: int = 5) -> dict:
    sp_cols = spark_df.columns
    srows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    dcols = [c[0] for c in res.description]
    drows = res.fetchall()
    out = {"spark_rows": len(srows), "oracle_rows": len(drows)}
    stypes = {f.name: spark_type_name(f.dataType) for f in spark_df.schema.fields}
    dtypes = {c[0]: str(c[1]) for c in res.description}
    mism = {c: (stypes[c], dtypes.get(c)) for c in stypes if c in dtypes and stypes[c] != dtypes[c]}
    if mism:
        out["type_mismatch"] = mism
    if sorted(sp_cols) != sorted(dcols):
        out["columns"] = (sp_cols, dcols)
        out["ok"] = False
        return out
    idx = [dcols.index(c) for c in sp_cols]
    sc = Counter(tuple(_norm(v) for v in r) for r in srows)
    dc = Counter(tuple(_norm(r[i]) for i in idx) for r in drows)
    out["ok"] = sc == dc
    if not out["ok"]:
        only_s, only_d = sc - dc, dc - sc
        out["only_spark"] = list(only_s.items())[:show]
        out["only_oracle"] = list(only_d.items())[:show]
        out["n_only_spark"], out["n_only_oracle"] = sum(only_s.values()), sum(only_d.values())
        out["cols"] = sp_cols
    return out
