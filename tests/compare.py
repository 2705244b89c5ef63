"""Run queries and their SQL side by side: python tests/compare.py [sf_dir] [name prefix ...]"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else (0.0 if value == 0 else value)
    if hasattr(value, "tolist"):
        return plain(value.tolist())
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def normal(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(plain(row[i]) for i in order) for row in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def differences(spark, con, name: str, build, sql: str | None, sf_dir: str) -> list[str]:
    df = build(spark, sf_dir)
    left = normal(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return [] if left else ["no rows"]
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    right = normal(columns, result.fetchall())
    problems = []
    if sorted(df.columns) != sorted(columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(columns)}")
    if len(left) != len(right):
        problems.append(f"rows {len(left)} != {len(right)}")
    bad = [(a, b) for a, b in zip(left, right) if a != b or list(map(type, a)) != list(map(type, b))]
    if bad:
        problems.append(f"{len(bad)} rows differ, e.g. {bad[0]}")
    if not left:
        problems.append("no rows")
    return problems


def main() -> int:
    from tidegauge.session import local_session

    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = tuple(sys.argv[2:])
    spark = local_session(8, "compare")
    spark.sparkContext.setLogLevel("OFF")
    con, oracles, failed = duck(sf_dir), entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if prefixes and not name.startswith(prefixes):
            continue
        start = time.time()
        try:
            problems = differences(spark, con, name, build, oracles.get(name), sf_dir)
        except Exception as error:  # noqa: BLE001
            problems = [f"{type(error).__name__}: {str(error)[:700]}"]
        failed += bool(problems)
        mark = "FAIL" if problems else ("ok  " if name in oracles else "rows")
        print(f"{mark} {name} {time.time() - start:.1f}s {' | '.join(problems)[:1500]}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
