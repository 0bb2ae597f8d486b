"""Compare registered queries with their SQL on one scale factor: ``check.py SF [name ...]``."""

import os
import sys
import tempfile
import time

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def rows(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(
        (tuple("" if r[i] is None else f"{type(r[i]).__name__}:{r[i]}" for i in order) for r in data)
    )


def compare(spark, con, name, sf_dir):
    start = time.time()
    frame = entry.queries()[name](spark, sf_dir)
    got = rows(frame.columns, frame.collect())
    took = time.time() - start
    sql = entry.oracle_sql().get(name)
    if sql is None:
        return f"rows-only {len(got[1])}", took
    result = con.execute(sql)
    want = rows([d[0] for d in result.description], result.fetchall())
    if got == want:
        return f"ok {len(got[1])}", took
    lines = [f"DIFFERENT columns {got[0]} / {want[0]}, rows {len(got[1])} / {len(want[1])}"]
    only_got, only_want = set(got[1]) - set(want[1]), set(want[1]) - set(got[1])
    lines += [f"   spark  {str(r)[:1500]}" for r in sorted(only_got)[:2]]
    lines += [f"   duckdb {str(r)[:1500]}" for r in sorted(only_want)[:2]]
    return "\n".join(lines), took


if __name__ == "__main__":
    sf_dir = f"/root/testdata/sf{sys.argv[1]}"
    names = sys.argv[2:] or list(entry.queries())
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", os.environ.get("CHECK_TZ", "UTC"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="run-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        try:
            text, took = compare(spark, con, name, sf_dir)
        except Exception as error:
            text, took = f"ERROR {type(error).__name__} {str(error)[:1500]}", 0
        print(f"{name}: {text} ({took:.1f}s)", flush=True)
