"""Compare registered queries with their SQL: ``python tests/compare.py [sf] [query ...]``."""

from __future__ import annotations

import pathlib
import sys
import time

import duckdb

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    return "" if v is None else f"{v:.6f}" if isinstance(v, float) else str(v)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple((r[i] is None, _cell(r[i])) for i in order) for r in rows)


def difference(spark, con, query, sql: str, sf_dir: str) -> str:
    """Empty when both give the same rows."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if got == want:
        return "" if got else "no rows on either side"
    only_got = [r for r in got if r not in set(want)][:2]
    only_want = [r for r in want if r not in set(got)][:2]
    return f"{len(got)} rows against {len(want)}\n   got  {only_got}\n   want {only_want}"[:3000]


def main() -> None:
    from folioflow.checks import CHECKS
    from folioflow.session import build_session

    sf, names = (sys.argv[1] if len(sys.argv) > 1 else "0.001"), sys.argv[2:]
    sf_dir = f"/root/testdata/sf{sf}"
    spark = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    bad = 0
    for name, (query, sql) in CHECKS.items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            diff = difference(spark, con, query, sql, sf_dir)
        except Exception as e:  # report and go on
            diff = f"{type(e).__name__}: {str(e)[:1500]}"
        bad += bool(diff)
        print(f"{'ok  ' if not diff else 'FAIL'} {name} {time.time() - start:.1f}s {diff}", flush=True)
    print(f"{bad} failed")


if __name__ == "__main__":
    main()
