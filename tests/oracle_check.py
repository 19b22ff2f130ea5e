"""Run registered queries next to their SQL in DuckDB and compare every value.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import decimal
import math
import sys
import time
from datetime import datetime
from pathlib import Path

import duckdb

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def open_duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 9)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, build, sql: str, sf_dir: str) -> tuple[str, int]:
    """Empty text when equal, otherwise the first difference; and the row count."""
    df = build(spark, sf_dir)
    ours = rows_of(df.columns, df.collect())
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}", len(ours)
    theirs = rows_of(names, result.fetchall())
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}", len(ours)
    types = {c: t for c, t in df.dtypes}
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b} ({types})", len(ours)
    return "", len(ours)


def main(argv: list[str]) -> int:
    from tidemark import build_session
    from tidemark.plans import registry

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:] or list(registry.QUERIES)
    spark = build_session(
        "oracle-check", "local[8]", 8, {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = open_duck(sf_dir)
    bad = 0
    for name in wanted:
        q = registry.QUERIES[name]
        started = time.time()
        try:
            if q.oracle:
                problem, n = compare(spark, con, q.build, q.oracle, sf_dir)
            else:
                problem, n = "", q.build(spark, sf_dir).count()
        except Exception as exc:  # noqa: BLE001 - a failing query is reported, the others still run
            problem, n = f"{type(exc).__name__}: {str(exc)[:400]}", -1
        bad += bool(problem)
        kind = "sql" if q.oracle else "rows"
        print(f"{'BAD' if problem else 'ok '} {name} [{kind}] rows={n} {time.time() - started:.2f}s {problem[:700]}", flush=True)
    spark.stop()
    print(f"{len(wanted) - bad} of {len(wanted)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
