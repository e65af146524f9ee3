import pytest

from tests.llm.helpers import SF, documents, empty, rows_of, texts_of, words
from tidemark.llm import queries, tiling


def greedy(item, doc, least=5):
    """Greedy string tiling word by word: the longest match of unmarked words first."""
    a, b = words(item), words(doc)
    free_a, free_b, out = set(range(len(a))), set(range(len(b))), []
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k in free_a and j + k in free_b and a[i + k] == b[j + k]:
                    k += 1
                if k > best[2]:
                    best = (i, j, k)
        if best[2] < least:
            return sorted(out)
        out.append(best)
        free_a -= set(range(best[0], best[0] + best[2]))
        free_b -= set(range(best[1], best[1] + best[2]))


def covered(item, doc):
    size = len(words(item))
    return sum(t[2] for t in greedy(item, doc)) / size if size else 0.0


def test_query(spark):
    items = rows_of(SF, "benchmark")
    grams = {}
    for item_id, text in items:
        w = words(text)
        for i in range(len(w) - 4):
            grams.setdefault(tuple(w[i : i + 5]), set()).add(item_id)
    expected = {}
    for doc_id, text in texts_of(SF).items():
        w = words(text)
        near = set().union(*(grams.get(tuple(w[i : i + 5]), ()) for i in range(len(w) - 4)))
        # Of a document, what can hold a match: the words near shared windows.
        hits = [i for i in range(len(w) - 4) if tuple(w[i : i + 5]) in grams]
        part = " ".join(w[max(0, hits[0] - 1) : hits[-1] + 6]) if hits else ""
        expected[doc_id] = sorted(i for i, t in items if i in near and covered(t, part) >= tiling.COVERAGE)
    found = queries.QUERIES["op9_decontaminate"](spark, SF).collect()
    assert {r.doc_id: r.items for r in found} == expected
    assert all(r.contaminated == bool(r.items) == (r.coverage > 0) for r in found)
    assert any(expected.values())


P = "the quick brown fox jumps over the lazy dog while seven wizards brew a potion of mint and sage"
Q = "one two three four five six seven eight nine ten eleven twelve"
W = P.split()
DOCS = [
    (1, f"before it {P.upper()} after it"),
    (2, " ".join([*W[10:], "and then", *W[:10]])),  # reordered
    (3, " ".join([*W[:6], "xx yy", *W[6:12], "zz", *W[12:]])),  # interleaved
    (4, " ".join(W[:9])),  # half
    (5, None), (6, ""), (7, "!!!"), (None, P), (None, P), (8, Q), (8, "clean"), (9, (Q + " ") * 3000),
    (10, "one two three four"), (11, "ping " * 30000), (12, f"{P} {Q}"),
]
ITEMS = [(1, P), (2, Q), (2, "other text of item two given again"), (3, None), (4, ""), (5, "one two three four"),
         (None, Q), (6, "ping " * 12)]


@pytest.mark.parametrize("max_chars", [tiling.MAX_BENCHMARK_CHARS, 0])
def test_awkward_rows(spark, max_chars):
    benchmark = spark.createDataFrame([(*r, "x", 1) for r in ITEMS], "item_id long, text string, tie string, n int")
    found = tiling.find(documents(spark, DOCS), benchmark, max_chars=max_chars).collect()
    expected = []
    for doc_id, text in DOCS:
        best = {}
        for item_id, item in ITEMS:
            doc = text or ""
            share = covered(item or "", doc if len(doc) < 500 else doc[:200])
            if share >= tiling.COVERAGE:
                best[item_id] = max(share, best.get(item_id, 0))
        expected.append((doc_id, sorted(best, key=lambda i: (i is not None, i)), max(best.values(), default=0.0)))
    got = [(r.doc_id, sorted(r.items, key=lambda i: (i is not None, i)), r.coverage) for r in found]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert tiling.find(empty(spark), benchmark, max_chars=max_chars).count() == 0
    none = tiling.find(documents(spark, DOCS), benchmark.limit(0), max_chars=max_chars)
    assert none.filter("contaminated").count() == 0 and none.count() == len(DOCS)


def test_clean_keeps_columns(spark):
    benchmark = spark.createDataFrame(ITEMS[:2], "item_id long, text string")
    docs = documents(spark, DOCS)
    kept = tiling.clean(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.matches) for r in kept.collect()) == [
        (i, "m") for i in (4, 5, 6, 7, 8, 10, 11)
    ]


@pytest.mark.parametrize("seed", range(8))
def test_tiles(seed):
    """Tiles of short random word lists, with many repeats, as the plain version has them."""
    import random

    rng = random.Random(seed)
    item = " ".join(rng.choice("abc") * 2 for _ in range(30))
    doc = " ".join([item[:40], " ".join(rng.choice("abc") * 2 for _ in range(30)), item[30:]])
    items = tiling.Items([1], [item])
    found = next(items.matches([doc]))
    got = [(t["item_start"], t["doc_start"], t["length"]) for m in found for t in m["tiles"]]
    assert got == greedy(item, doc)
