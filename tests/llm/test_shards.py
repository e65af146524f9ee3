import collections
import zlib

import pytest

from tests.llm.helpers import SF, documents, empty, rows_of
from tidemark.llm import queries, shards


def check(found, rows, n):
    """One law holds: counts differ by one at most, slots have no gaps, every row is there,
    and every shard has the mixture of sources."""
    expected = collections.Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows
    )
    assert collections.Counter((r.doc_id, r.size, r.text_crc32) for r in found) == expected
    by_shard = collections.defaultdict(list)
    for r in found:
        by_shard[r.shard].append(r)
    sizes = [len(by_shard[s]) for s in range(n)]
    assert sum(sizes) == len(found) and max(sizes) - min(sizes) <= 1
    for held in by_shard.values():
        assert sorted(r.slot for r in held) == list(range(len(held)))
    sources = collections.Counter(r.source for r in found)
    for held in by_shard.values():
        for source, count in collections.Counter(r.source for r in held).items():
            assert abs(count - sources[source] / n) <= 2


def test_query(spark):
    df = queries.QUERIES["op6_interleave"](spark, SF)
    found = df.collect()
    check(found, rows_of(SF, "documents"), 16)
    assert {(r.law, r.grown_shard) for r in found} == {("rows", None)}


@pytest.mark.parametrize("n", [1, 7, 16])
def test_hot_source_and_ties(spark, n):
    rows = [(i, f"t{i % 3}", "en", "hot") for i in range(300)]
    rows += [(5, "t2", "en", "hot")] * 40 + [(None, None, None, None)] * 50
    rows += [(i, "é" * i, "en", f"s{i % 4}") for i in range(200)] + [(1, "x", "en", "")]
    found = shards.interleave(documents(spark, rows), n)
    check(found.collect(), rows, n)


def test_fractions_decide(spark):
    """Of two sources, one three times the other, every four rows hold one of the small."""
    rows = [(i, "t", "en", "big") for i in range(90)] + [(i, "t", "en", "small") for i in range(30)]
    found = shards.interleave(documents(spark, rows), 1).collect()
    order = [r.source for r in sorted(found, key=lambda r: r.slot)]
    assert all(order[i : i + 4].count("small") == 1 for i in range(0, 120, 4))


def test_repeatable_and_empty(spark):
    rows = rows_of(SF, "documents")
    once, again = (
        shards.interleave(documents(spark, rows).repartition(k, "source"), 16).collect() for k in (1, 5)
    )
    assert sorted(once) == sorted(again)
    assert shards.interleave(empty(spark)).count() == 0
