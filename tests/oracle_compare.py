"""Compare a Spark result with its SQL text on the same parquet tables.

Usage: python tests/oracle_compare.py SF_DIR [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, bool) or value is None or isinstance(value, (str, int)):
        return value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def ordered(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    left = ordered(spark_df.columns, spark_df.collect())
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    right = ordered(names, cursor.fetchall())
    if sorted(spark_df.columns) != sorted(names):
        return [f"columns: {sorted(spark_df.columns)} against {sorted(names)}"]
    found = []
    if len(left) != len(right):
        found.append(f"rows: {len(left)} against {len(right)}")
    kinds_l = [{type(r[i]).__name__ for r in left if r[i] is not None} for i in range(len(names))]
    kinds_r = [{type(r[i]).__name__ for r in right if r[i] is not None} for i in range(len(names))]
    for name, a, b in zip(sorted(names), kinds_l, kinds_r):
        if a != b:
            found.append(f"type of {name}: {a} against {b}")
    bad = [(a, b) for a, b in zip(left, right) if a != b]
    found += [f"value: {a}\n    against {b}" for a, b in bad[:3]]
    if bad:
        found.append(f"{len(bad)} of {len(left)} rows differ; columns {sorted(names)}")
    if not left:
        found.append("empty result")
    return found


def main() -> None:
    import __spark_entry__ as entry
    from meterline.session import local_session

    sf_dir, names = sys.argv[1], sys.argv[2:]
    spark = local_session(8)
    con = duck(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    failed = []
    for name in names or list(queries):
        start = time.time()
        try:
            df = queries[name](spark, sf_dir)
            if name not in oracle:
                print(f"----  {name}: {df.count()} rows, {time.time() - start:.1f}s (no oracle)", flush=True)
                continue
            found = differences(df, con, oracle[name])
        except Exception as error:  # report and go on with the next query
            found = [f"{type(error).__name__}: {str(error)[:1500]}"]
        print(f"{'FAIL' if found else 'ok  '}  {name}: {time.time() - start:.1f}s", flush=True)
        for line in found:
            print("    " + line)
        if found:
            failed.append(name)
    print(f"{len(failed)} failed: {failed}")


if __name__ == "__main__":
    main()
