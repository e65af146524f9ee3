"""Copy-on-write merges: contents against a dictionary, files against their names."""

import random

import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from tidemark.sinks import keyed
from tidemark.session import remove_path
from tidemark.sinks.keyed import Conflict, KeyedTable

SCHEMA = "id long, name string, amount double"


@pytest.fixture
def table(spark, tmp_path):
    return KeyedTable(spark, str(tmp_path / "t"), "id")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def contents(table, version=None):
    rows = [tuple(r) for r in table.read(version).collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r for r in rows}


def spread(spark, table, rows=4000):
    """A table of eight files with even keys only."""
    with_files(spark, 8, lambda: table.insert_absent(
        spark.range(rows).select((F.col("id") * 2).alias("id"), F.lit("a").alias("name"), F.lit(1.0).alias("amount"))
    ))
    assert len(table.files()) == 8


def with_files(spark, count, job):
    usual = {n: spark.conf.get(n) for n in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(count))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return job()
    finally:
        for name, value in usual.items():
            spark.conf.set(name, value)


def test_random_merges_against_a_dictionary(spark, table):
    dice, known = random.Random(5), {}
    for step in range(4):
        rows = [
            (dice.choice([None, *range(40)]), dice.choice([None, "x", "y"]), dice.choice([None, float("nan"), 1.0, 2.5]))
            for _ in range(25)
        ]
        last = {}
        for row in rows:  # of several rows of a key the greatest amount counts, NaN above all
            rank = lambda r: (r[2] is not None, r[2] != r[2], 0 if r[2] != r[2] else r[2] or 0, r[1] is not None, r[1] or "")
            if row[0] is not None and (row[0] not in last or rank(row) > rank(last[row[0]])):
                last[row[0]] = row
        if step % 2:
            table.insert_absent(frame(spark, rows), [F.col("amount")])
            known = {**last, **known}
        else:
            table.upsert(frame(spark, rows), ["name"], [F.col("amount")])
            known = {**last, **{k: (k, last[k][1], v[2]) if k in last else v for k, v in known.items()}}
        assert repr(sorted(contents(table).values())) == repr(sorted(known.values()))


def test_only_files_with_changed_rows_are_written(spark, table):
    spread(spark, table)
    before = table.files()
    merged = table.upsert(frame(spark, [(10, "b", 0.0), (12, "a", 0.0), (7990, "b", 0.0)]), ["name"])
    assert merged.version == 2 and len(merged.rewritten) == 2
    assert set(before) - set(table.files()) == set(merged.rewritten)
    assert sorted(r.new.id for r in merged.changes.collect()) == [10, 7990]
    assert {r.old.name for r in merged.changes.collect()} == {"a"}
    found = contents(table)
    assert len(found) == 4000 and found[10] == (10, "b", 1.0) and found[12] == (12, "a", 1.0)
    assert contents(table, 1)[10] == (10, "a", 1.0)  # the version before is still there
    again = table.upsert(frame(spark, [(10, "b", 9.0), (7990, "b", 9.0)]), ["name"])
    assert again.version == 2 and again.rewritten == () and again.changes.count() == 0
    added = table.insert_absent(frame(spark, [(10, "c", 0.0), (11, "c", 0.0), (None, "c", 0.0)]))
    assert added.rewritten == () and contents(table)[11] == (11, "c", 0.0)
    assert set(before) - set(merged.rewritten) <= set(table.files())


def test_filters_know_every_key_and_few_others(spark, table):
    spread(spark, table)
    entry, owner = table._entry(), {}
    for row in table.read().select("id", table._file_of_row().alias("file")).collect():
        owner.setdefault(row.file, []).append(row.id)
    for file, ids in owner.items():
        assert table._candidates(entry, spark.createDataFrame([(i,) for i in ids[:5]], "id long")) == [file]
    absent = [table._candidates(entry, spark.createDataFrame([(i,)], "id long")) for i in range(1, 41, 2)]
    assert sum(map(len, absent)) <= 4
    outside = spark.createDataFrame([(-5,), (10**9,)], "id long")
    assert table._candidates(entry, outside) == []


def test_two_merges_at_a_time(spark, table):
    spread(spark, table)
    stale = table._entry()
    KeyedTable(spark, table.path, "id").upsert(frame(spark, [(2, "z", 0.0)]), ["name"])
    with pytest.raises(Conflict):
        table._commit(stale)
    assert table.versions() == [1, 2] and contents(table)[2] == (2, "z", 1.0)


def test_a_merge_that_dies_leaves_the_table(spark, table, monkeypatch):
    spread(spark, table)
    before = contents(table)

    def dies(self, entry):
        raise RuntimeError("lost")

    monkeypatch.setattr(keyed.KeyedTable, "_commit", dies)
    rows = frame(spark, [(2, "z", 0.0), (3, "new", 0.0)])
    with pytest.raises(RuntimeError):
        table.upsert(rows, ["name"])
    monkeypatch.undo()
    assert table.versions() == [1] and contents(table) == before
    table.upsert(rows, ["name"])
    assert len(table.vacuum()) == 2  # the orphan, and the file of version 1
    assert table.versions() == [2] and contents(table) == {**before, 2: (2, "z", 1.0), 3: (3, "new", 0.0)}
    stored = spark.read.parquet(f"{table.path}/data/*").count()
    assert stored == len(before) + 1


def test_a_mark_is_taken_in_once(spark, table):
    rows = frame(spark, [(1, "a", 1.0)])
    order = lambda r: [r["amount"]]
    first = table.advance(rows, order, mark={"s": 0})
    second = table.advance(frame(spark, [(1, "b", 2.0)]), order, mark={"s": 1})
    again = table.advance(frame(spark, [(1, "b", 2.0)]), order, mark={"s": 1})
    assert (first.version, second.version, again.version) == (1, 2, 2)
    assert again.changes.collect() == second.changes.collect() and again.changes.count() == 1
    assert table.advance(rows, order, mark={"s": 2}).changes.count() == 0  # older: no change
    assert table.marks() == {"s": 2} and contents(table) == {1: (1, "b", 2.0)}


def test_expired_rows_go_with_their_file(spark, table):
    spread(spark, table)
    gone = F.col("id") < 100
    table.advance(frame(spark, [(2, "b", 5.0)]), lambda r: [r["amount"]], expired=gone)
    found = contents(table)
    assert found[2] == (2, "b", 5.0) and 4 not in found and 98 not in found and 100 in found
    assert len(found) == 4000 - 49


def test_empty_input_and_missing_columns(spark, table):
    with pytest.raises(ValueError):
        table.read()
    assert table.insert_absent(frame(spark, [])).version == 0
    table.insert_absent(frame(spark, [(1, "a", 1.0)]))
    table.insert_absent(spark.createDataFrame([(2, "x", 7)], "id long, other string, more int"))
    assert contents(table) == {1: (1, "a", 1.0), 2: (2, None, None)}


def test_small_files_are_put_together(spark, table):
    spread(spark, table)
    table.insert_absent(frame(spark, [(1, "x", 0.0)]), mark={"s": 1})
    before, rows = table.files(), contents(table)
    assert table.compact(min_rows=400) == () and table.files() == before  # a single small one
    assert sorted(table.compact()) == before and len(table.files()) < 9
    assert contents(table) == rows and table.marks() == {"s": 1} and table.changes().count() == 1
    assert table.upsert(frame(spark, [(1, "y", 0.0)]), ["name"]).changes.count() == 1


def test_with_many_keys_in_its_range_a_file_needs_no_filter(spark, table):
    spread(spark, table, 20_000)
    remove_path(spark, f"{table.path}/_filters")
    odd = spark.range(20_000).select(
        (F.col("id") * 2 + 1).alias("id"), F.lit("b").alias("name"), F.lit(2.0).alias("amount")
    )
    assert table._candidates(table._entry(), odd) == table.files()
    merged = table.insert_absent(odd)
    assert merged.rewritten == () and merged.changes.count() == 20_000
    found = contents(table)
    assert len(found) == 40_000 and found[7] == (7, "b", 2.0) and found[8] == (8, "a", 1.0)


def test_rows_move_once_to_where_they_are_written(spark, table, monkeypatch):
    spread(spark, table)
    plans, write = [], DataFrameWriter.parquet

    def noted(writer, path, *args, **options):
        if "/data/" in path:
            plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return write(writer, path, *args, **options)

    monkeypatch.setattr(DataFrameWriter, "parquet", noted)
    rows = spark.range(4000).select("id", F.lit("b").alias("name"), F.lit(2.0).alias("amount"))
    merged = table.upsert(rows, ["name"])
    assert merged.rewritten
    (plan,) = plans
    assert plan.count("Exchange") == 1 and "rangepartitioning" in plan and "Join" not in plan
    found = contents(table)
    assert len(found) == 6000 and found[2] == (2, "b", 1.0) and found[3] == (3, "b", 2.0)
    assert found[7998] == (7998, "a", 1.0)
