"""Compare registered queries with their SQL in DuckDB: ``python tests/oracle.py [sf] [names...]``."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def compare(df, con, sql: str) -> str | None:
    """None when rows, column names and values agree, otherwise what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    names.sort()
    order = [[d[0] for d in cur.description].index(n) for n in names]
    ours = [tuple(row) for row in df.select(*[f"`{n}`" for n in names]).collect()]
    theirs = [tuple(row[i] for i in order) for row in theirs]

    def norm(row):
        return tuple(repr(v) if not isinstance(v, float) else repr(v + 0.0) for v in row)

    a, b = sorted(map(norm, ours)), sorted(map(norm, theirs))
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first {bad[0]}" if bad else None


def main(argv: list[str]) -> int:
    import __spark_entry__ as entry
    from kairoline.session import get_session

    sf = argv[0] if argv else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    spark = get_session("oracle", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
                                                 "spark.ui.enabled": "false",
                                                 "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    qs, sqls = entry.queries(), entry.oracle_sql()
    failed = 0
    for name in argv[1:] or qs:
        start = time.time()
        try:
            df = qs[name](spark, sf_dir)
            if name in sqls:
                problem = compare(df, con, sqls[name])
            else:
                rows = df.collect()
                problem = None if rows else "no rows"
                print("   ", rows[:2])
        except Exception as e:  # noqa: BLE001 - reported per query
            problem = f"{type(e).__name__}: {str(e)[:1500]}"
        failed += bool(problem)
        print(f"{name}: {'ok' if not problem else 'FAIL ' + problem} ({time.time() - start:.1f}s)"
              f"{'' if name in sqls else ' [rows only]'}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
