"""Run registered queries against their SQL twins: ``python tests/oracle_check.py SF_DIR [name ...]``."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def cell(x: object) -> object:
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x)
    return repr(x)


def bag(columns: list[str], rows: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


def compare(spark, con, build, sql: str, sf_dir: str) -> tuple[bool, str]:
    df = build(spark, sf_dir)
    ours = df.collect()
    theirs = con.execute(sql)
    columns = [d[0] for d in theirs.description]
    expected = theirs.fetchall()
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    a, b = bag(df.columns, [tuple(r) for r in ours]), bag(columns, expected)
    if a == b:
        return True, f"{len(a)} rows"
    extra = [x for x in a if x not in set(b)][:2]
    missing = [x for x in b if x not in set(a)][:2]
    return False, f"{len(a)} vs {len(b)} rows; only ours {extra}; only SQL {missing}"


def main() -> int:
    sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
    import __spark_entry__ as entry

    from gaugeline.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session(
        master="local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    failed = 0
    sql = entry.oracle_sql()
    for name, build in entry.queries().items():
        if name not in sql or (wanted and not any(w in name for w in wanted)):
            continue
        begin = time.time()
        try:
            ok, note = compare(spark, con, build, sql[name], sf_dir)
        except Exception as error:  # report and go on
            ok, note = False, f"{type(error).__name__}: {str(error)[:600]}"
        failed += not ok
        print(f"{'ok  ' if ok else 'FAIL'} {name} {time.time() - begin:.1f}s {note}", flush=True)
    print("failed", failed)
    return failed


if __name__ == "__main__":
    sys.exit(main())
