"""Run registered queries next to their SQL in DuckDB: ``python tests/compare.py FOLDER [names]``."""

import math
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(con, df, sql):
    """None when equal, else a short description of the difference."""
    return difference(con, df.columns, [tuple(r) for r in df.collect()], sql)


def difference(con, columns, rows, sql):
    spark_columns, spark_rows = rows_of(columns, rows)
    result = con.execute(sql)
    sql_columns, sql_rows = rows_of([d[0] for d in result.description], result.fetchall())
    if spark_columns != sql_columns:
        return f"columns {spark_columns} / {sql_columns}"
    if len(spark_rows) != len(sql_rows):
        return f"rows {len(spark_rows)} / {len(sql_rows)}"
    differing = [(a, b) for a, b in zip(spark_rows, sql_rows) if a != b]
    return f"{len(differing)} of {len(sql_rows)} rows differ, e.g. {differing[0]}" if differing else None


def main(folder, names):
    from marquee.checks import load_all
    from marquee.session import local_session

    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    con = database(folder)
    bad = 0
    for name, check in load_all().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = check.run(spark, folder)
            rows = [tuple(r) for r in df.collect()]
            spent = time.time() - start
            verdict = f"rows only ({len(rows)})"
            if check.sql is not None:
                different = difference(con, df.columns, rows, check.sql)
                bad += different is not None
                verdict = different or f"equal ({len(rows)} rows)"
        except Exception as error:
            bad += 1
            spent = time.time() - start
            verdict = f"ERROR {type(error).__name__}: {str(error)[:600]}"
        total = time.time() - start
        print(f"{name:34s} spark {spent:6.1f}s sql {total - spent:6.1f}s  {verdict}", flush=True)
    print("differences:", bad)


if __name__ == "__main__":
    main(sys.argv[1], set(sys.argv[2:]))
