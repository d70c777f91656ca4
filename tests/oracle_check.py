"""Compare registered queries with their SQL counterparts: ``python tests/oracle_check.py [sf] [names]``."""

from __future__ import annotations

import math
import sys
import time
import traceback
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from arealis.session import get_spark
from catalog import ORACLES, QUERIES

TABLES = "region nation customer supplier part orders lineitem events".split()


def canonical(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, float):
        return f"{value:.6f}" if abs(value) < 1e6 else f"{value:.6e}"
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(canonical(row[i]) for i in order) for row in rows)


def duck(folder: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def compare(con, name: str, df) -> str:
    got = rows_of(df.columns, df.collect())
    if name not in ORACLES:
        return f"rows only ({sum(got.values())})"
    result = con.execute(ORACLES[name])
    columns = [column[0] for column in result.description]
    want = rows_of(columns, result.fetchall())
    if sorted(columns) != sorted(df.columns):
        return f"FAIL columns {sorted(df.columns)} != {sorted(columns)}"
    if got != want:
        extra, missing = got - want, want - got
        return f"FAIL rows {sum(got.values())} vs {sum(want.values())}; extra {list(extra)[:2]} missing {list(missing)[:2]}"
    types = {field.name: field.dataType.simpleString() for field in df.schema.fields}
    duck_types = {column[0]: str(column[1]) for column in result.description}
    odd = [
        f"{c}:{types[c]}/{duck_types[c]}"
        for c in types
        if "HUGEINT" in duck_types[c] or (types[c] == "int") != (duck_types[c] in ("INTEGER", "INT32"))
    ]
    return f"ok {sum(got.values())}" + (f"  types? {odd}" if odd else "")


if __name__ == "__main__":
    sf = sys.argv[1] if len(sys.argv) > 1 else "sf0.01"
    folder = f"/root/testdata/{sf}"
    spark = get_spark("check", spark__master="local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(folder)
    failed = 0
    for name in sys.argv[2:] or QUERIES:
        start = time.time()
        try:
            outcome = compare(con, name, QUERIES[name](spark, folder))
        except Exception as error:
            outcome = f"FAIL {type(error).__name__}: {str(error)[:600]}"
            if len(sys.argv) > 2:
                traceback.print_exc()
        failed += outcome.startswith("FAIL")
        print(f"{name:24s} {time.time() - start:6.2f}s {outcome}", flush=True)
    print("failed:", failed)
