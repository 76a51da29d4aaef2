"""Run registered queries on Spark and their oracles on DuckDB and compare all values.

Usage: python tools/check_oracles.py [sf_dir] [name or prefix* ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from lossgrid import get_session  # noqa: E402
from lossgrid.plans.catalog import all_queries  # noqa: E402


def normal_rows(columns: list[str], rows: list[tuple]) -> list[tuple]:
    """Rows with columns by name and values as text, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(v) -> str:
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "NULL"
        return repr(round(v, 10) + 0.0) if isinstance(v, float) else str(v)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


TYPES = {"BIGINT": "bigint", "DOUBLE": "double", "VARCHAR": "string", "DATE": "date", "BOOLEAN": "boolean"}


def differences(spark_types, spark_rows, oracle_types, oracle_rows) -> str | None:
    """What differs, or None. Types are (name, type) pairs."""
    expected = sorted((n, TYPES.get(str(t), str(t))) for n, t in oracle_types)
    if sorted(spark_types) != expected:
        return f"schema {sorted(spark_types)} vs {expected}"
    a = normal_rows([n for n, _ in spark_types], spark_rows)
    b = normal_rows([n for n, _ in oracle_types], oracle_rows)
    if len(a) != len(b):
        return f"rows {len(a)} vs {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(bad)} of {len(a)} rows differ, first: {bad[0]}" if bad else None


def main(argv: list[str]) -> int:
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    wanted = argv[1:]
    spark = get_session(
        "check", master="local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = oracle_connection(sf_dir)
    failed = 0
    for name, query in all_queries().items():
        if wanted and not any(name == w or (w.endswith("*") and name.startswith(w[:-1])) for w in wanted):
            continue
        started = time.time()
        try:
            df = query.run(spark, sf_dir)
            rows = df.collect()
            spark_s, started = time.time() - started, time.time()
            verdict = "rows only"
            if query.sql is not None:
                answer = con.execute(query.oracle())
                types = [(d[0], d[1]) for d in answer.description]
                verdict = differences(df.dtypes, rows, types, answer.fetchall()) or "ok"
        except Exception as error:  # report and go on with the next query
            spark_s, rows, verdict = time.time() - started, [], f"ERROR {type(error).__name__}: {str(error)[:600]}"
        failed += verdict not in ("ok", "rows only")
        print(f"{name:32s} rows={len(rows):6d} spark={spark_s:6.2f}s oracle={time.time() - started:5.2f}s {verdict}", flush=True)
    print("failed:", failed)
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
