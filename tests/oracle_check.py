"""Compare registered queries with their SQL twins:
``python tests/oracle_check.py [sf_dir] [name ...]``"""

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _plain(value):
    if hasattr(value, "tzinfo") and getattr(value, "tzinfo", None) is not None:
        value = value.replace(tzinfo=None)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _key(row):
    return tuple((v is None, type(v).__name__ if isinstance(v, str) else "", str(v)) for v in row)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted((tuple(_plain(r[n]) for n in names) for r in df.collect()), key=_key)


def oracle_rows(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = [tuple(_plain(r[i]) for i in order) for r in cursor.fetchall()]
    return [names[i] for i in order], sorted(rows, key=_key)


def differences(df, con, sql):
    """An empty string if both sides agree exactly, else what differs."""
    ours, theirs = spark_rows(df), oracle_rows(con, sql)
    if ours[0] != theirs[0]:
        return f"columns {ours[0]} / {theirs[0]}"
    if len(ours[1]) != len(theirs[1]):
        return f"rows {len(ours[1])} / {len(theirs[1])}"
    for a, b in zip(ours[1], theirs[1]):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"row {a} / {b}"
    return ""


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, oracle, failed = connect(sf), entry.oracle_sql(), 0
    for name, build in entry.queries().items():
        if sys.argv[2:] and name not in sys.argv[2:]:
            continue
        start = time.time()
        try:
            result = differences(build(spark, sf), con, oracle[name])
        except Exception as error:  # report and go on with the next query
            result = f"{type(error).__name__}: {str(error)[:600]}"
        failed += bool(result)
        print(f"{name:32s} {time.time() - start:6.2f}s {'ok' if not result else result}", flush=True)
    print("failed:", failed)
