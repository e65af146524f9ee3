import collections
import random

import numpy as np

from tests.llm.helpers import SF, bag, documents, empty, similarity, texts_of
from tidemark.llm import bagminhash, components, queries


def classes_of(rows, least=0.8):
    """Classes by comparing all pairs that share a shingle. ``rows``: list of texts."""
    bags = [bag(t) for t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = collections.defaultdict(list)
    for i, b in enumerate(bags):
        for key in b or {("text", rows[i]): 1}:
            holders[key].append(i)
    seen = set()
    for ids in holders.values():
        for j in ids:
            for i in ids:
                if i < j and (i, j) not in seen:
                    seen.add((i, j))
                    if rows[i] == rows[j] or similarity(bags[i], bags[j]) >= least:
                        root[find(j)] = find(i)
    return [find(i) for i in range(len(rows))]


def check(found, rows):
    roots = classes_of([t or "" for _, t in rows])
    groups = collections.defaultdict(list)
    for (doc_id, _), root in zip(rows, roots):
        groups[root].append(doc_id)
    expected = []
    for ids in groups.values():
        head = min((i for i in ids if i is not None), default=None)
        expected += [(i, head, len(ids)) for i in ids]
    assert sorted(((r.doc_id, r.class_id, r.class_size) for r in found), key=repr) == sorted(
        expected, key=repr
    )
    kept = sorted((r.class_id for r in found if r.kept), key=repr)
    assert kept == sorted((min((i for i in g if i is not None), default=None) for g in groups.values()), key=repr)
    assert all(r.doc_id == r.class_id for r in found if r.kept)


def test_query(spark):
    found = queries.QUERIES["op7_bagminhash"](spark, SF).collect()
    check(found, list(texts_of(SF).items()))


def variant(base, share, rng):
    return " ".join(w if rng.random() > share else f"z{rng.randrange(10**6)}" for w in base)


def test_chains_stars_and_shared_passages(spark):
    """Copies of one text that are like it but not like each other; chains of small
    changes; texts that share a passage and are not alike; weights that matter."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(5000)}"
    base = [word() for _ in range(300)]
    rows = [(0, " ".join(base))] + [(i, variant(base, 0.025, rng)) for i in range(1, 120)]
    chain = [word() for _ in range(200)]
    for i in range(200, 230):
        rows.append((i, " ".join(chain)))
        chain[(i * 7) % 190] = word()
    passage = [word() for _ in range(60)]
    for i in range(300, 360):
        rows.append((i, " ".join([*passage, *(word() for _ in range(60))])))
    loop = "one two three four five "
    rows += [(400, loop * 100), (401, loop * 110), (402, loop * 300), (403, loop)]
    rng.shuffle(rows)
    check(bagminhash.classes(documents(spark, rows)).collect(), rows)


def test_awkward_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "!!!"), (4, "..."), (5, "one"), (6, "One!"), (7, "one two"), (8, "two one"),
        (None, "one"), (None, "alone here we are now friends"), (None, "alone here we are now friends"),
        (9, "a b c d e f"), (9, "a b c d e f"), (10, "A, b; c. d e f"), (11, "é è ê ë ē ĕ"), (12, "ab " * 40000),
    ]
    check(bagminhash.classes(documents(spark, rows)).collect(), rows)
    assert bagminhash.classes(empty(spark)).count() == 0


def test_registers_are_unbiased():
    """Agreement of registers estimates weighted Jaccard similarity, whatever the counts."""
    m, rng = 4096, np.random.default_rng(2)
    for low, high in ((1, 2), (1, 9), (1, 600)):
        keys = np.sort(rng.integers(0, 2**63, 60).astype(np.uint64))
        a, b = (rng.integers(low, high, 60) for _ in range(2))
        b[:15] = 0
        one = bagminhash.registers(np.zeros(60, int), keys, a, 1, m)
        has = b > 0
        two = bagminhash.registers(np.zeros(has.sum(), int), keys[has], b[has], 1, m)
        true = np.minimum(a, b).sum() / np.maximum(a, b).sum()
        assert abs((one == two).mean() - true) < 4 * (true * (1 - true) / m) ** 0.5 + 0.002


def test_registers_do_not_depend_on_neighbours():
    rng = np.random.default_rng(3)
    keys, count = rng.integers(0, 2**63, 40).astype(np.uint64), rng.integers(1, 30, 40)
    text = np.sort(rng.integers(0, 5, 40))
    together = bagminhash.registers(text, keys, count, 5, 64)
    for t in range(5):
        mine = text == t
        alone = bagminhash.registers(np.zeros(mine.sum(), int), keys[mine], count[mine], 1, 64)
        assert (alone == together[t]).all()


def test_components(spark):
    rng = random.Random(1)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 160)]
    links += [(500 + rng.randrange(80), 500 + rng.randrange(80)) for _ in range(60)] + [(7, 7)]
    rng.shuffle(links)
    frame = spark.createDataFrame(links, "low long, high long")
    got = {r.node: r.root for r in components.components(frame).collect()}
    root = {n: n for link in links for n in link}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    alone = {n for n in root if all(a == b for a, b in links if n in (a, b))}
    assert got == {n: r for n, r in root.items() if n not in alone}
    assert components.components(frame.limit(0)).count() == 0


def test_block_similarities_are_those_of_bags():
    rng = random.Random(9)
    some = [" ".join(rng.choice("abcdef") for _ in range(rng.randrange(40))) for _ in range(12)]
    like = bagminhash.all_similarities(some[:5], some[5:], columns=7)
    for i, a in enumerate(some[:5]):
        for j, b in enumerate(some[5:]):
            assert abs(like[i, j] - similarity(bag(a), bag(b))) < 1e-6
        assert np.allclose(like[i], bagminhash.similarities(a, some[5:]))


def test_small_blocks_and_no_filter(spark, monkeypatch):
    """The same classes with blocks of three texts, hubs of three links, and all texts
    shuffled for the join."""
    monkeypatch.setattr(bagminhash, "GROUP_LINKS", 3)
    monkeypatch.setattr(bagminhash.BloomFilter.__init__, "__defaults__", (0,))
    rng = random.Random(8)
    rows = []
    for g in range(3):
        base = [f"w{rng.randrange(3000)}" for _ in range(120)]
        rows += [(100 * g + i, variant(base, 0.03, rng)) for i in range(25)]
    check(bagminhash.classes(documents(spark, rows)).collect(), rows)
