import hashlib

import numpy as np
import public_tokenizers
import tiktoken

import corpus_pipeline
from tests.llm.helpers import SF, documents, empty, rows_of, texts_of
from tests.llm.test_bagminhash import classes_of
from tests.llm.test_tiling import covered, words
from tidemark.llm import bpe, queries, tiling


def expected(texts, items):
    """The stages one after the other in plain Python: ids and texts that are kept."""
    kept = {i: t for i, t in texts.items() if any(c.isalpha() for c in t)}
    last = {t: i for i, t in sorted(kept.items())}
    kept = {i: t for i, t in kept.items() if last[t] == i}
    roots, first = classes_of(list(kept.values())), {}
    for (i, _), root in sorted(zip(kept.items(), roots)):
        first.setdefault(root, i)
    kept = {i: kept[i] for i in first.values()}
    grams = [{tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in map(words, items)]
    out = {}
    for i, t in kept.items():
        w = words(t)
        own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)}
        if not any(own & g and covered(item, t) >= tiling.COVERAGE for item, g in zip(items, grams)):
            out[i] = t
    return out


def test_run(spark):
    items = [r[1] for r in rows_of(SF, "benchmark")]
    texts = texts_of(SF)
    left = expected(texts, items)
    ranks = bpe.parse_ranks(bpe.read_ranks(public_tokenizers.path(queries.MULTI_BPE)))
    coder = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    found = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert sorted(found) == sorted(left) and 0 < len(left) < len(texts)
    for i, text in left.items():
        ids = np.array(coder.encode_ordinary(text), dtype="<u4").tobytes()
        assert bytes(found[i].ids) == ids and found[i].n_tokens == len(ids) // 4
        assert found[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_stages_keep_columns_and_clean_rows(spark):
    base = "the quick brown fox jumps over lazy dogs near a river bank " * 3
    rows = [
        (1, "un texto claro", "es"), (2, "un texto claro", "es"), (3, base + "one", "en"), (4, base + "two", "en"),
        (5, None, "en"), (6, "", None), (7, "12 !!", "de"), (None, "ohne Nummer", "de"), (8, "clean text", None),
        (9, "twice", "en"), (9, "twice", "en"), (None, "nulls twice", "en"), (None, "nulls twice", "en"),
    ]
    docs = documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == documents(spark, []).columns, name
    kept = sorted(((r.doc_id, r.text) for r in docs.collect()), key=repr)
    assert kept == sorted(
        [(2, "un texto claro"), (3, base + "one"), (None, "ohne Nummer"), (8, "clean text"), (9, "twice"),
         (None, "nulls twice")],
        key=repr,
    )
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == 6


def test_empty_table(spark):
    docs = empty(spark)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.count() == 0
