import collections
import re
import zlib
from math import log10

import numpy as np
import pyarrow as pa
import pytest
import zstandard

from tests.llm.helpers import SF, documents, empty, texts_of
from tidemark.llm import arrays, lbl, queries, words


def tokens(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def base(rows, modulus=7):
    """(doc_id, held_out, n_tokens, n_known, N, base_score), word by word."""
    counts = collections.Counter()
    for doc_id, text in rows:
        if doc_id is None or zlib.crc32(str(doc_id).encode()) % modulus != 2:
            counts.update([*tokens(text), None])
    n, v = counts.total(), len(counts)
    out = []
    for doc_id, text in rows:
        own = [*tokens(text), None]
        held_out = doc_id is not None and zlib.crc32(str(doc_id).encode()) % modulus == 2
        score = sum(log10((counts[t] + 1) / (n + v + 1)) for t in own)
        out.append((doc_id, held_out, len(own), sum(t in counts for t in own), n, round(score, 6)))
    return sorted(out, key=repr)


def found(rows):
    return sorted(
        (
            (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
            for r in rows
        ),
        key=repr,
    )


def test_query(spark):
    rows = queries.QUERIES["op10_log_bilinear"](spark, SF).collect()
    assert found(rows) == base(list(texts_of(SF).items()))
    held_out = [r for r in rows if r.held_out]
    assert sum(r.score for r in held_out) > sum(r.base_score for r in held_out)
    assert all(r.score < 0 for r in rows)


ODD = [
    (1, None), (2, ""), (3, " \n\x0b\x0c\r\t"), (4, "a\x1cb A B ÀÉ àé Éé"), (5, "x " * 50000), (None, "null id"),
    (None, "null id"), (6, "the the cat"), (6, "the the cat"), (7, "The cat sat."), (8, "the dog sat ..."),
    (9, "unseen words here"), (10, "y" * 100000),
]


def test_awkward_rows(spark):
    rows = lbl.score(documents(spark, ODD)).collect()
    assert found(rows) == base(ODD)
    same = [r.score for r in rows if r.doc_id == 6]
    assert same[0] == pytest.approx(same[1])
    assert lbl.score(empty(spark)).count() == 0


def test_nothing_to_learn_from(spark):
    out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 7 == 2][:5]
    rows = lbl.score(documents(spark, [(i, "a b") for i in out])).collect()
    assert found(rows) == base([(i, "a b") for i in out])


def test_probabilities_add_up_to_one(spark):
    """Over all words, one unseen word per group, and the end, in any context."""
    rows, counts = lbl.coded(documents(spark, ODD), 7)
    model = lbl.train(rows, counts)
    contexts = np.array([[lbl.BEGIN, lbl.BEGIN], [0, 3], [lbl.SHORTLIST + 5, 1]])
    by_class = np.exp(model.log_probabilities(contexts))
    assert by_class.sum(axis=1) == pytest.approx([1, 1, 1], abs=1e-4)
    learned = [t for i, t in ODD if not lbl.is_held_out(i, 7)]
    seen = collections.Counter(w for t in learned for w in tokens(t))
    top = sorted(seen, key=lambda w: (-seen[w], w.encode()))[: lbl.SHORTLIST]
    mass = collections.Counter()
    for w in seen:
        if w not in top:
            mass[lbl.group_of(w.encode())] += seen[w] + 1
    for group in range(lbl.GROUPS):
        assert 10 ** counts.group_mass[group] == pytest.approx(mass[group] + 1)


def test_scores_token_by_token(spark):
    """A document's score is the sum over its tokens, each with its own softmax."""
    rows = [(i, t) for i, t in list(texts_of(SF).items())[:25]]
    docs = documents(spark, rows)
    coded, counts = lbl.coded(docs, 7)
    model = lbl.train(coded, counts)
    learned = [t for i, t in rows if not lbl.is_held_out(i, 7)]
    seen = collections.Counter(w.encode() for t in learned for w in tokens(t))
    top = {w: k for k, w in enumerate(sorted(seen, key=lambda w: (-seen[w], w))[: lbl.SHORTLIST])}
    for row in coded.collect()[:5]:
        own = [w.encode() for w in tokens(dict(rows)[row.doc_id])]
        codes = [top.get(w, lbl.SHORTLIST + lbl.group_of(w)) for w in own]
        assert np.frombuffer(bytes(row.codes), "<u2").tolist() == codes
        shares = [
            log10(seen[w] + 1) - counts.group_mass[lbl.group_of(w)] for w in own if w not in top
        ]
        assert row.in_groups == pytest.approx(sum(shares))
        line = [lbl.BEGIN] * lbl.CONTEXT + codes + [lbl.END]
        total = 0.0
        for k in range(lbl.CONTEXT, len(line)):
            context = np.array([[line[k - 1 - j] for j in range(lbl.CONTEXT)]])
            total += model.log_probabilities(context)[0, line[k]]
        contexts, targets = lbl.windows(np.array(codes, dtype=np.int64), np.array([0, len(codes)]))
        assert lbl.class_scores(model, contexts, targets).sum() == pytest.approx(total, rel=1e-4)


def test_training_learns_contexts():
    """Words that follow each other become likelier than their frequency."""
    rng = np.random.default_rng(1)
    pairs = rng.integers(0, 20, 30000) * 2
    codes = np.stack([pairs, pairs + 1], axis=1).reshape(-1)
    unigram = np.full(lbl.CLASSES, 1e-6)
    unigram[:40] = 1
    trainer = lbl.Trainer(unigram / unigram.sum())
    contexts, targets = lbl.windows(codes, np.array([0, len(codes)]))
    trainer.learn(contexts, targets)
    after = trainer.model.log_probabilities(np.array([[6, 9], [12, 3]]))
    assert after.argmax(axis=1).tolist() == [7, 13] and np.exp(after.max()) > 0.3


def test_words_of_one_group_depend_on_the_context(spark):
    """Words of one group and one frequency, each after one of two words: as pairs are told
    apart only by what stands before, all else of the scores cancels."""
    train = [f"f{k} " * 60 for k in range(lbl.SHORTLIST - 2)]
    sides = {side: [f"{side[0]}{k}kk" for k in range(20)] for side in ("left", "right")}
    assert len({lbl.group_of(w.encode()) for own in sides.values() for w in own}) == 1
    for side, own in sides.items():
        train += [f"{side} {w} " * 2 for w in own for _ in range(10)]
    ids = iter(i for i in range(10**6) if not lbl.is_held_out(i, 7))
    rows = [(next(ids), t) for t in train]
    ids = iter(i for i in range(10**6) if lbl.is_held_out(i, 7))
    asked = {(a, w): next(ids) for a in sides for own in sides.values() for w in own}
    rows += [(i, f"{a} {w}") for (a, w), i in asked.items()]
    score = {r.doc_id: r.score for r in lbl.score(documents(spark, rows)).collect()}
    gains = [
        score[asked["left", l]] + score[asked["right", r]] - score[asked["left", r]] - score[asked["right", l]]
        for l, r in zip(sides["left"], sides["right"])
    ]
    assert min(gains) > 0.1


def test_choices_in_a_cell_add_up_to_one():
    """Over all leaves of a cell, in one context; without learning they have their shares."""
    rng = np.random.default_rng(3)
    mass = rng.integers(2, 50, 300).astype(float)
    mass[[0, 17, 200]] = 0
    leaves = np.sort(np.concatenate([np.repeat(np.arange(300), 5)] * 2))
    predicted = np.where(leaves[:, None] % 2, 1, -1) * np.ones((1, lbl.DIMENSIONS), dtype=np.float32)
    asked = np.arange(len(leaves)) % 10 == 0
    predicted[asked] = 1
    plain = lbl.tree(mass, leaves, predicted.astype(np.float32), np.zeros(len(leaves), dtype=bool))
    assert np.exp(plain[asked]) == pytest.approx(mass / mass.sum(), abs=1e-5)
    told = lbl.tree(mass, leaves, predicted.astype(np.float32), ~asked)
    assert np.exp(told[asked]).sum() == pytest.approx(1, abs=1e-4)
    assert np.exp(told[asked])[1::2].sum() > np.exp(plain[asked])[1::2].sum() + 0.1


def test_counts_beyond_32_bits():
    """Two blocks with 3e9 occurrences of a word each: the shard answers with their sum."""
    word, n = b"often", 3 * 10**9
    rows = [
        {
            "shard": 0, "block": bytes([k]), "places": arrays.compressed(np.array([0])),
            "lengths": arrays.compressed(np.array([len(word)])), "words": zstandard.compress(word),
            "weights": arrays.compressed(np.array([n])),
        }
        for k in range(2)
    ]
    answers = lbl._count_shard(pa.Table.from_pylist(rows)).to_pylist()
    for answer in answers[:2]:
        assert words.Answers(1, [answer]).numbers("counts", lbl.WIDE).tolist() == [2 * n]
    with pytest.raises(OverflowError):
        arrays.compressed(np.array([2 * n]))
