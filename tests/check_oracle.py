"""Run registered queries in Spark and their SQL in DuckDB and compare rows.

    python tests/check_oracle.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import glob
import math
import os
import sys
import time
from collections import Counter

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def duckdb_over(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con


def compare(spark, con, name, query, sql, sf_dir) -> list[str]:
    """Differences between the query's rows and the SQL's rows; empty when there are none."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    want = rows_of(columns, result.fetchall())
    problems = []
    if sorted(df.columns) != sorted(columns):
        problems.append(f"columns {sorted(df.columns)} != {sorted(columns)}")
    types = [row[:2] for row in con.execute(f"describe {sql}").fetchall()]
    if "HUGEINT" in dict(types).values():
        problems.append(f"HUGEINT in {types}")
    if got != want:
        problems.append(f"{sum(got.values())} rows vs {sum(want.values())}; only spark {list((got - want).items())[:2]}; "
                        f"only sql {list((want - got).items())[:2]}")
    return problems


if __name__ == "__main__":
    from __spark_entry__ import oracle_sql, queries
    from gridplume.session import build_session

    sf_dir, wanted = sys.argv[1], sys.argv[2:]
    spark = build_session("check", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con, bad = duckdb_over(sf_dir), 0
    for name, query in queries().items():
        if (wanted and name not in wanted) or name not in oracle_sql():
            continue
        start = time.time()
        try:
            problems = compare(spark, con, name, query, oracle_sql()[name], sf_dir)
        except Exception as error:  # noqa: BLE001 - report and go on with the next query
            problems = [f"{type(error).__name__}: {str(error)[:600]}"]
        bad += bool(problems)
        print(f"{'FAIL' if problems else 'ok  '} {name} {time.time() - start:.1f}s", *problems, sep="\n     ", flush=True)
    print(f"{bad} failing")
    sys.exit(bad > 0)
