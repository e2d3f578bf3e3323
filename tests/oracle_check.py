"""Compare registered queries with their DuckDB SQL.

``python tests/oracle_check.py [sf_dir] [name ...]`` prints one line per query.
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def session():
    from pyspark.sql import SparkSession

    return (
        SparkSession.builder.master("local[8]")
        .appName("openbell-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.constraintPropagation.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def normal(rows: list[tuple], order: list[int]) -> list[tuple]:
    def cell(v):
        if isinstance(v, float):
            return f"{v:.8f}"
        if isinstance(v, (list, tuple)):
            return "[" + ",".join(cell(x) for x in v) + "]"
        return "\0" if v is None else str(v)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    t0 = time.time()
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    expected = normal(result.fetchall(), sorted(range(len(names)), key=lambda i: names[i]))
    compare.sql_seconds = time.time() - t0
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    actual = normal(
        [tuple(row) for row in df.collect()], sorted(range(len(names)), key=lambda i: df.columns[i])
    )
    if len(actual) != len(expected):
        return f"rows {len(actual)} != {len(expected)}"
    bad = [(a, e) for a, e in zip(actual, expected) if a != e]
    if bad:
        return f"{len(bad)} of {len(actual)} rows differ, e.g. {bad[0][0]} != {bad[0][1]}"
    return None


def main() -> int:
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    wanted = sys.argv[2:]
    spark, con = session(), connect(sf_dir)
    spark.sparkContext.setLogLevel("ERROR")
    queries, oracles, failed = entry.queries(), entry.oracle_sql(), 0
    for name, fn in queries.items():
        if wanted and name not in wanted:
            continue
        t0 = time.time()
        try:
            if name in oracles:
                problem = compare(fn(spark, sf_dir), con, oracles[name])
                note = "ok" if problem is None else f"DIFF {problem}"
                note += f" (sql {compare.sql_seconds:.2f}s)"
            else:
                note = f"rows-only {fn(spark, sf_dir).count()}"
        except Exception as e:  # noqa: BLE001 - report and go on
            note = f"ERROR {type(e).__name__}: {str(e)[:1500]}"
        failed += note.startswith(("DIFF", "ERROR"))
        print(f"{name:28s} {time.time() - t0:6.2f}s {note}", flush=True)
    print(f"{failed} failed")
    return failed


if __name__ == "__main__":
    sys.exit(main())
