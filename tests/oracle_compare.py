"""Run registered queries in Spark and their SQL oracles in DuckDB, compare.

Usage: python tests/oracle_compare.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        if math.isnan(v):
            return "NULL"
        if v == int(v):
            return str(int(v))
        return repr(round(v, 6))
    return str(v)


def digest(columns: list[str], rows: list[tuple]) -> str:
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    lines = sorted("|".join(_norm(r[k]) for k in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def compare(spark, con, sf_dir: str, name: str, fn, sql: str | None) -> dict:
    t0 = time.time()
    df = fn(spark, sf_dir)
    s_cols = df.columns
    s_rows = [tuple(r) for r in df.collect()]
    t_spark = time.time() - t0
    out = {"name": name, "rows": len(s_rows), "spark_sec": round(t_spark, 2)}
    if sql is None:
        out["status"] = "no-oracle"
        return out
    rel = con.execute(sql)
    d_cols = [d[0] for d in rel.description]
    d_rows = rel.fetchall()
    out["oracle_rows"] = len(d_rows)
    if sorted(s_cols) != sorted(d_cols):
        out["status"] = f"COLUMNS {sorted(s_cols)} vs {sorted(d_cols)}"
    elif len(s_rows) != len(d_rows):
        out["status"] = "ROWCOUNT"
    elif digest(s_cols, s_rows) != digest(d_cols, d_rows):
        out["status"] = "VALUES"
    elif pandas_digest(df.toPandas()) != pandas_digest(con.execute(sql).df()):
        out["status"] = "PANDAS-VALUES"
    else:
        out["status"] = "ok"
    return out


def pandas_digest(pdf) -> str:
    """Hash of the cells as pandas renders them (dtype-sensitive: 5 vs 5.0)."""
    import pandas as pd

    pdf = pdf[sorted(pdf.columns)]

    def cell(v) -> str:
        return "NULL" if not isinstance(v, (list, tuple)) and pd.isna(v) is True else str(v)

    lines = sorted("|".join(cell(v) for v in row) for row in pdf.itertuples(index=False))
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]


def main(argv: list[str]) -> int:
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, oracle = entry.queries(), entry.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if names and name not in names:
            continue
        try:
            res = compare(spark, con, sf_dir, name, fn, oracle.get(name))
        except Exception as exc:  # report and go on
            res = {"name": name, "status": f"ERROR {type(exc).__name__}: {str(exc)[:300]}"}
        if res["status"] not in ("ok", "no-oracle"):
            bad += 1
        print(res, flush=True)
    print(f"{len([n for n in qs if not names or n in names])} queries, {bad} not ok")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
