import hashlib

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF, documents, empty
from tests.oracle_check import connect, differences
from tidemark.llm import exact_dedup, queries


def test_query(spark):
    name = "op2_exact_dedup"
    assert differences(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) == ""


ROWS = [
    (1, "a"), (2, "a"), (5, "a "), (3, "A"), (4, None), (9, ""), (None, "a"),
    (7, "rep"), (7, "rep"), (None, "n"), (None, "n"), (8, "long " * 30000), (6, "long " * 30000),
]


def expected(rows):
    groups = {}
    for doc_id, text in rows:
        groups.setdefault(text or "", []).append(doc_id)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        kept = False
        for i in ids:
            first = i == keep and not kept
            kept |= first
            out.append((i, keep, len(ids), first, hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted(
        ((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest) for r in df.collect()), key=repr
    )


def test_awkward_rows(spark):
    assert found(exact_dedup.dedup(documents(spark, ROWS))) == expected(ROWS)
    assert exact_dedup.dedup(empty(spark)).count() == 0


def test_recursion_over_spill_files(spark):
    """Tables that hold one content each spill all others, level after level."""
    rows = [(i, f"text {i % 23}") for i in range(400)] + ROWS
    levels = []
    resolve = exact_dedup.resolve
    exact_dedup.resolve = lambda records, level, size: levels.append(level) or resolve(records, level, size)
    try:
        assert found(exact_dedup.dedup(documents(spark, rows), max_bytes=1)) == expected(rows)
    finally:
        exact_dedup.resolve = resolve
    assert max(levels) >= 1


@pytest.mark.parametrize("digest", [lambda t: F.lit("same"), lambda t: F.length(t).cast("string")])
def test_contents_decide_when_digests_agree(spark, digest):
    got = [r[:4] for r in found(exact_dedup.dedup(documents(spark, ROWS), digest=digest))]
    assert sorted(got, key=repr) == sorted((r[:4] for r in expected(ROWS)), key=repr)


def test_table_grows_and_fills():
    table = exact_dedup.ContentTable(10**9)
    for round_ in range(2):
        for i in range(5000):
            assert table.add("d", f"t{i}", i + round_, 1)
    assert sorted((e[2], e[3]) for e in table.entries) == [(i + 1, 2) for i in range(5000)]
    full = exact_dedup.ContentTable(1)
    assert full.add("d", "a", 1, 1) and not full.add("d", "b", 2, 1) and full.add("d", "a", 3, 1)
