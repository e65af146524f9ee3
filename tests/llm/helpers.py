"""Small tables with awkward rows, and plain Python versions of the operators."""

import collections
import re

import duckdb
from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
DOCUMENTS = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "digest string, node long, shard int, key binary, tie long, matches string, "
    "_id long, _MATCHES string, `_lang` string, `a.b` int, _marked string, _tie long, _repeats int"
)


def rows_of(sf, table):
    return duckdb.sql(f"SELECT * FROM '{sf}/{table}.parquet'").fetchall()


def texts_of(sf):
    return {r[0]: r[1] or "" for r in rows_of(sf, "documents")}


def documents(spark, rows):
    """``rows`` of (doc_id, text[, lang[, source]]) with columns whose names operators use."""
    full = [(*r[:4], *[None] * (4 - len(r)), 7, "x", 1, 2, b"k", 3, "m", 0, "M", "l", 5, "k", 9, 1) for r in rows]
    return spark.createDataFrame(full, DOCUMENTS)


def empty(spark):
    return documents(spark, [])


def words(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower())


def bag(text, size=5):
    w = words(text)
    if 0 < len(w) < size:
        return collections.Counter([tuple(w)])
    return collections.Counter(tuple(w[i : i + size]) for i in range(len(w) - size + 1))


def similarity(a, b):
    both = sum((a & b).values())
    either = sum((a | b).values())
    return both / either if either else 0.0


def schema_names(df):
    return [f.name for f in df.schema if isinstance(f, T.StructField)]
