"""Compare named queries with their SQL: columns, rows and values.

Run as a script: ``python tests/oracle.py [sf] [name ...]``.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
DATA = Path("/root/testdata")


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return con


def _value(x):
    if x is None or (isinstance(x, float) and math.isnan(x)):
        return None
    if isinstance(x, bool):
        return x
    if isinstance(x, (int, float)):
        return float(x)
    return str(x)


def _rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return (
        [columns[i] for i in order],
        sorted((tuple(_value(r[i]) for i in order) for r in rows), key=repr),
    )


def differences(spark, con, name: str, query, sql: str, sf_dir: str) -> list[str]:
    """Empty when both sides agree; else what differs."""
    df = query(spark, sf_dir)
    mine = _rows(df.columns, df.collect())
    result = con.execute(sql)
    theirs = _rows([d[0] for d in result.description], result.fetchall())
    if mine[0] != theirs[0]:
        return [f"columns {mine[0]} / {theirs[0]}"]
    if len(mine[1]) != len(theirs[1]):
        return [f"rows {len(mine[1])} / {len(theirs[1])}"]
    return [f"{a} / {b}" for a, b in zip(mine[1], theirs[1]) if a != b][:3]


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from carlot.session import build_session

    sf = sys.argv[1] if len(sys.argv) > 1 else "0.01"
    spark = build_session(
        "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g",
                       "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    folder = str(DATA / f"sf{sf}")
    con, sqls = connect(folder), oracle_sql()
    bad = 0
    for name, query in queries().items():
        if len(sys.argv) > 2 and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            if name in sqls:
                found = differences(spark, con, name, query, sqls[name], folder)
            else:
                found = [] if query(spark, folder).count() else ["no rows"]
            note = "" if name in sqls else " (rows only)"
        except Exception as error:  # report and go on with the next query
            found, note = [str(error)[:1500]], ""
        bad += bool(found)
        print(f"{'FAIL' if found else 'ok'} {name}{note} {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("   ", line, flush=True)
    print("failed:", bad)
