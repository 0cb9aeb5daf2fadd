"""Run a registered query on Spark and its oracle SQL on DuckDB; compare.

Mirrors the acceptance check: same row count, same column names, same
column types, and the same multiset of rows (order-insensitive, columns
sorted by name).

    python tests/oracle_compare.py [sf_dir] [key ...]
"""

from __future__ import annotations

import datetime
import decimal
import hashlib
import importlib.util
import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

_SPARK_TYPES = {
    "int": "int", "integer": "int", "bigint": "bigint", "long": "bigint", "double": "double",
    "string": "string", "date": "date", "boolean": "boolean", "float": "float",
    "smallint": "smallint", "tinyint": "tinyint",
}
_DUCK_TYPES = {
    "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date",
    "BOOLEAN": "boolean", "FLOAT": "float", "SMALLINT": "smallint", "TINYINT": "tinyint",
}


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return float(f"{v:.12g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.12g}")
    if isinstance(v, (datetime.date, datetime.datetime)):
        return v.isoformat()
    if isinstance(v, bool):
        return bool(v)
    return v


def _digest(names: list[str], rows: list[tuple]) -> tuple[int, str]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    normed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(normed).encode()).hexdigest()
    return len(rows), h


def compare(spark, entry, con, key: str, sf_dir: str) -> dict:
    t0 = time.time()
    df = entry.queries()[key](spark, sf_dir)
    spark_rows = [tuple(r) for r in df.collect()]
    spark_names = df.columns
    spark_types = {f.name: _SPARK_TYPES.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    t1 = time.time()
    rel = con.sql(entry.oracle_sql()[key])
    duck_names = rel.columns
    duck_types = {n: _DUCK_TYPES.get(str(t), str(t)) for n, t in zip(rel.columns, rel.types)}
    duck_rows = rel.fetchall()
    n_s, h_s = _digest(spark_names, spark_rows)
    n_d, h_d = _digest(duck_names, duck_rows)
    return {
        "key": key,
        "rows_spark": n_s,
        "rows_oracle": n_d,
        "names_match": sorted(spark_names) == sorted(duck_names),
        "types_match": spark_types == duck_types,
        "hash_match": h_s == h_d,
        "spark_types": spark_types if spark_types != duck_types else None,
        "oracle_types": duck_types if spark_types != duck_types else None,
        "spark_sec": round(t1 - t0, 2),
    }


def main(argv: list[str]) -> int:
    sys.path.insert(0, ROOT)
    from flightmart.session import get_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    spark = get_session(
        master="local[8]", shuffle_partitions=8, extra={"spark.ui.enabled": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    entry = load_entry()
    con = duck_connection(sf_dir)
    keys = argv[2:] or list(entry.queries())
    bad = 0
    for k in keys:
        try:
            res = compare(spark, entry, con, k, sf_dir)
        except Exception as exc:  # report and continue
            res = {"key": k, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        ok = res.get("hash_match") and res.get("names_match") and res.get("types_match")
        bad += not ok
        print(("OK  " if ok else "BAD ") + str(res), flush=True)
    print(f"{len(keys) - bad}/{len(keys)} match")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
