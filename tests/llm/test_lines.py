import collections
import hashlib
import random

import numpy as np
import pytest

from tests.llm.helpers import SF, documents, empty, texts_of
from tidemark.llm import lines, queries


def key(line):
    line = line.strip(" \t\n\x0b\x0c\r")
    line = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    return line if len(line) >= 20 else None


def cleaned(rows, indexed=None):
    """(doc_id, n_lines, n_dropped, text) per row; ids may be None."""
    holders = collections.defaultdict(set)
    for doc_id, text in rows if indexed is None else indexed:
        for line in (text or "").split("\n"):
            if key(line):
                holders[key(line)].add(doc_id)
    last = {k: max((i for i in ids if i is not None), default=None) for k, ids in holders.items()}
    out = []
    for doc_id, text in rows:
        parts = (text or "").split("\n")
        kept = [
            p for p in parts
            if key(p) is None or len(holders[key(p)]) < 3 or doc_id == last[key(p)]
        ]
        out.append((doc_id, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def found(df):
    return sorted(((r.doc_id, r.n_lines, r.n_dropped, r.text) for r in df.collect()), key=repr)


def test_query(spark):
    rows = list(texts_of(SF).items())
    got = queries.QUERIES["op8_line_dedup"](spark, SF).collect()
    assert sorted((r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in got) == sorted(
        (i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in cleaned(rows)
    )


A, B = "A line of Twenty chars or more", "Éclair: another line é"
ROWS = [
    (1, f"{A}\n{B}\nshort"), (2, f"  {A.lower()}\t\nx\n{A}"), (3, A), (4, B), (5, f"{B}\n{B}\n\n"),
    (6, None), (7, ""), (8, "nineteen characters"), (9, "nineteen characters"), (10, "nineteen characters"),
    (11, "É" * 20), (12, "É" * 20), (13, "é" * 20), (14, "É" * 20), (15, " " + A), (16, "\x1c" + A),
    (None, A), (None, "only without an id here"), (None, "only without an id here"), (3, A), (3, f"{A}\nmore"),
    (20, "\n" * 500), (21, (A + "\n") * 3000), (22, "word " * 40000), (23, "\r\n" + A + "\r\n"),
]


@pytest.mark.parametrize("max_bytes", [lines.MAX_FILTER_BYTES, 0])
def test_awkward_rows(spark, max_bytes):
    docs = documents(spark, ROWS)
    index = lines.LineIndex(spark, 3).insert(docs)
    assert found(index.clean(docs, max_bytes)) == cleaned(ROWS)
    nothing = empty(spark)
    assert lines.LineIndex(spark, 3).insert(nothing).clean(nothing).count() == 0
    assert found(lines.LineIndex(spark, 3).clean(docs)) == cleaned(ROWS, [])


def test_insertions_and_deletions(spark):
    """Whatever came and went, the state is that of the documents that are there."""
    rng = random.Random(4)
    pool = [f"a common line, number {i:05}" for i in range(12)]
    rows = [(i, "\n".join(rng.choices(pool, k=4))) for i in range(40)]
    docs = documents(spark, rows)
    index = lines.LineIndex(spark, 2).insert(documents(spark, rows[:25])).insert(documents(spark, rows[25:]))
    assert found(index.clean(docs)) == cleaned(rows)
    less = index.delete(documents(spark, rows[10:])).delete(documents(spark, [(999, pool[0])]))
    assert found(less.clean(docs)) == cleaned(rows, rows[:10])
    gone = less.delete(documents(spark, rows[:10]))
    assert found(gone.clean(docs)) == cleaned(rows, [])
    assert sum(np.frombuffer(t, np.uint16).any() for r in gone.filters.collect() for t in r.tables) == 0
    assert found(index.clean(docs)) == cleaned(rows)


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**63, 5000).astype(np.uint64)
    cuckoo = lines.CuckooFilter()
    cuckoo.insert(keys[:100])
    cuckoo.insert(keys[100:])
    assert len(cuckoo.tables) > 1 and cuckoo.contains(keys).all()
    assert cuckoo.contains(rng.integers(0, 2**63, 20000).astype(np.uint64)).mean() < 0.01
    cuckoo = lines.CuckooFilter.from_rows(cuckoo.to_rows())
    cuckoo.delete(keys[:2500])
    assert cuckoo.contains(keys[2500:]).all() and cuckoo.contains(keys[:2500]).mean() < 0.01
