"""Run registered queries next to their SQL and compare whole results.

``python tests/oracle.py <table folder> [name prefix …]`` prints one line each.
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

NAMES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
         "benchmark labels conversations").split()


def connect(folder: str):
    con = duckdb.connect()
    for n in NAMES:
        con.execute(f"create view {n} as select * from read_parquet('{folder}/{n}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, dict):
        return str(sorted(v.items()))
    if isinstance(v, (list, tuple)):
        return str(list(v))
    return v


def _table(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_cell(r[i]) for i in order) for r in rows]
    return [cols[i] for i in order], sorted(out, key=lambda r: tuple(str(x) for x in r))


def compare(df, con, sql) -> str:
    """'' when columns, value types, row count and values are equal."""
    a_cols, a = _table(df.columns, [tuple(r) for r in df.collect()])
    res = con.execute(sql)
    b_cols, b = _table([d[0] for d in res.description], res.fetchall())
    if a_cols != b_cols:
        return f"columns {a_cols} != {b_cols}"
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            return f"value {x} != {y} (columns {a_cols})"
    return ""


def main() -> None:
    from surveyloom.session import get_session
    import __spark_entry__ as entry

    folder, prefixes = sys.argv[1], sys.argv[2:]
    spark = get_session("oracle", "local[8]", spark__sql__shuffle__partitions=8, spark__ui__enabled="false",
                        spark__driver__memory="8g",
                        spark__ui__showConsoleProgress="false")
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls, bad = connect(folder), entry.oracle_sql(), 0
    for name, fn in entry.queries().items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        start = time.time()
        try:
            df = fn(spark, folder)
            if name in sqls:
                diff = compare(df, con, sqls[name])
                verdict = "ok" if not diff else f"DIFF {diff[:600]}"
            else:
                verdict = f"rows-only {len(df.collect())}"
        except Exception as exc:  # report and go on with the next query
            diff, verdict = "error", f"ERROR {type(exc).__name__} {str(exc)[:700]}"
        bad += verdict.startswith(("DIFF", "ERROR"))
        print(f"{name:42s} {time.time() - start:6.2f}s {verdict}", flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main()
