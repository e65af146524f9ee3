import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.helpers import SF, documents, empty, texts_of
from tidemark.llm import queries, simple8b

PATH = public_tokenizers.path(queries.WORD_BPE)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(tokenizer, text):
    return np.array([*tokenizer.encode(text, add_special_tokens=False).ids, 2], dtype="<u4").tobytes()


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 70000) | st.integers(0, 1), max_size=300))
def test_round_trip(values):
    assert simple8b.unpack(simple8b.pack(np.array(values, dtype=np.uint64))).tolist() == values


def test_blocks_and_sizes():
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 30000, 200_001).astype(np.uint64)
    data = simple8b.pack(ids)
    assert (simple8b.unpack(data) == ids).all() and len(data) < 2.1 * len(ids)
    assert len(simple8b.pack(np.zeros(6000, np.uint64))) < 900
    with pytest.raises(ValueError):
        simple8b.unpack(b"x" * 64)


def test_query(spark, tokenizer):
    start, expected = 0, {}
    for doc_id, text in sorted(texts_of(SF).items()):
        ids = ids_of(tokenizer, text)
        expected[doc_id] = (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    found = queries.QUERIES["op3_simple8b"](spark, SF).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in found} == expected


ODD = [
    None, "", "  \n ", "Hello, World!! don't 'S it's", "ÉCOLE école. İstanbul ŉx; ǅ? Straße,",
    "e\u0301 a\u030a. \u212b, x\u0327;", "<|endoftext|>foo<|startoftext|>.", "a\tb\x0bc\u00a0d\u2003e\x1cf",
    "Ärger, ÑANDÚ! ×2 ÷ a×b ÿÞß <|x|> a<|endoftext|>b don't-do 'twas l'été,", "(x)[y]{z}~`^ _a_ \"Q\" ... !!! é",
    "漢字 かな한국 🙂.", "1234 5,6 ²³ ½.", "x" * 5000 + ". " + "word " * 20000, "ΣΑΣ. σας", "a.b,c;d:e!f?g",
]


def test_awkward_texts(spark, tokenizer, tmp_path):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "null id"), (3, "same id"), (3, "same id")]
    random.Random(3).shuffle(rows)
    folder = str(tmp_path / "ids")
    simple8b.write(documents(spark, rows), PATH, folder)
    found = sorted(simple8b.read(spark, folder).collect(), key=lambda r: r.start)
    assert sorted((repr(r.doc_id), bytes(r.ids)) for r in found) == sorted(
        (repr(i), ids_of(tokenizer, t or "")) for i, t in rows
    )
    assert found[0].doc_id is None
    assert [r.doc_id for r in found[1:]] == sorted(i for i, _ in rows if i is not None)
    starts = np.cumsum([0, *(r.n_tokens for r in found)])[:-1]
    assert [r.start for r in found] == starts.tolist()


def test_empty_table(spark, tmp_path):
    simple8b.write(empty(spark), PATH, str(tmp_path / "ids"))
    assert simple8b.read(spark, str(tmp_path / "ids")).count() == 0


def test_memo_is_renewed(tokenizer, monkeypatch):
    monkeypatch.setattr(simple8b, "MEMO_UNITS", 3)
    coder = simple8b.WordIds(open(PATH).read())
    for text in ODD * 2:
        assert coder.encode([text or ""])[0] == ids_of(tokenizer, text or "")[:-4]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aBé ÉßÞ×÷İ'1.,<|>\n\t\u0301\u00a0Σ漢_-", max_size=60))
def test_units_give_the_ids_of_whole_texts(text):
    coder = simple8b.word_ids(open(PATH).read())
    whole = coder.tokenizer.encode(text, add_special_tokens=False).ids
    assert coder.encode([text, "", text])[2] == np.array(whole, dtype="<u4").tobytes()
