"""Run registered queries beside their SQL and compare names, row counts and values.

    python tests/oracle_check.py [--sf 0.01] [prefix ...]
"""

from __future__ import annotations

import argparse
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(v):
        if isinstance(v, float):
            return "NaN" if v != v else repr(v + 0.0)
        if isinstance(v, bool):
            return str(int(v))
        return str(v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql: str) -> str:
    """'' when equal, else a short description of the difference."""
    mine = canonical(spark_df.columns, spark_df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    theirs = canonical(names, cursor.fetchall())
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} vs {sorted(names)}"
    if len(mine) != len(theirs):
        return f"rows {len(mine)} vs {len(theirs)}"
    if mine == theirs:
        return ""
    first = next((a, b) for a, b in zip(mine, theirs) if a != b)
    differing = {n for a, b in zip(mine, theirs) if a != b for n, x, y in zip(sorted(names), a, b) if x != y}
    count = sum(a != b for a, b in zip(mine, theirs))
    return f"{count} rows differ in {sorted(differing)[:8]}: {str(first[0])[:300]} vs {str(first[1])[:300]}"


def main() -> int:
    parser = argparse.ArgumentParser()
    parser.add_argument("--sf", default="0.01")
    parser.add_argument("prefixes", nargs="*")
    args = parser.parse_args()
    import __spark_entry__ as entry
    from riskspark.session import get_session

    spark = get_session("oracle-check", "local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir = f"/root/testdata/sf{args.sf}"
    con = connect(sf_dir)
    oracles = entry.oracle_sql()
    failures = 0
    for name, run in entry.queries().items():
        if args.prefixes and not any(name == p or name.startswith(p + "_") for p in args.prefixes):
            continue
        start = time.time()
        try:
            df = run(spark, sf_dir)
            problem = compare(df, con, oracles[name]) if name in oracles else f"rows only: {df.count()}"
        except Exception as error:
            problem = "ERROR " + str(error)[:1500]
        bad = bool(problem) and not problem.startswith("rows only")
        failures += bad
        print(f"{'FAIL' if bad else 'ok  '} {name} {time.time() - start:.1f}s {problem}", flush=True)
    print("failures", failures)
    return failures


if __name__ == "__main__":
    sys.exit(bool(main()))
