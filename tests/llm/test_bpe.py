import hashlib
import tracemalloc

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tests.llm.helpers import SF, documents, empty, texts_of
from tidemark.llm import arrays, bpe, queries, words

PATH = public_tokenizers.path(queries.MULTI_BPE)


@pytest.fixture(scope="module")
def coder():
    ranks = bpe.parse_ranks(bpe.read_ranks(PATH))
    return tiktoken.Encoding(
        "t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )


def ids_of(coder, text):
    return np.array(coder.encode_ordinary(text), dtype="<u4").tobytes()


def test_query(spark, coder):
    expected = {}
    for doc_id, text in texts_of(SF).items():
        ids = ids_of(coder, text)
        expected[doc_id] = (
            len(ids) // 4,
            hashlib.sha256(ids).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest(),
        )
    found = queries.QUERIES["op1_byte_bpe"](spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in found} == expected
    assert len(found) == len(expected)


def test_awkward_texts(spark, coder):
    odd = [
        None,
        "",
        " ",
        "\n\n \t\u00a0\u2003x\u0085y\u3000",
        "it's we'll 'sfoo ''s don't",
        "ÀÉß 漢字かな 한국어 🙂🙂👨‍👩‍👧 e\u0301 \u0600\u0661",
        "<|endoftext|> a\x00b\x1c\x1d",
        "lang " * 20000 + "x" * 3000,
    ]
    rows = [(i, t) for i, t in enumerate(odd)] + [(3, odd[3]), (None, "null id"), (None, "null id")]
    found = bpe.decode(bpe.encode(documents(spark, rows), PATH, public_tokenizers.PATTERN), PATH)
    got = sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids), bytes(r.decoded)) for r in found.collect())
    want = sorted(
        (i is None, i or 0, ids_of(coder, t or ""), (t or "").encode()) for i, t in rows
    )
    assert got == want
    both = bpe.encode(documents(spark, rows), PATH, public_tokenizers.PATTERN, decoded=True)
    assert sorted((r.doc_id is None, r.doc_id or 0, bytes(r.ids), bytes(r.decoded)) for r in both.collect()) == want
    assert bpe.encode(empty(spark), PATH, public_tokenizers.PATTERN).count() == 0


def test_many_blocks(spark, coder, monkeypatch):
    """Blocks of few tokens give the same ids."""
    cut = words.cut
    monkeypatch.setattr(words, "cut", lambda batch, tokenise: cut(batch, tokenise, 50))
    rows = [(i, t) for i, t in list(texts_of(SF).items())[:40]]
    found = bpe.encode(documents(spark, rows).coalesce(2), PATH, public_tokenizers.PATTERN)
    assert {r.doc_id: bytes(r.ids) for r in found.collect()} == {i: ids_of(coder, t) for i, t in rows}


def test_missing_answer_is_an_error():
    with pytest.raises(RuntimeError):
        words.Answers(3, [])


def peak_of(function, *args):
    tracemalloc.start()
    result = function(*args)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return result, peak


def test_decoding_holds_little_besides_the_bytes():
    """Before: the place of every byte at once, thrice in 64 bits, 24 bytes a byte."""
    table = bpe.TokenBytes(bpe.read_ranks(PATH))
    rng = np.random.default_rng(1)
    ids = rng.integers(0, len(table.lengths), 1 << 19).astype("<u4")
    bounds = np.array([0, 5, 5, 200_000, len(ids)])
    found, peak = peak_of(table.join, ids, bounds)
    tokens = [table.data[a : a + n].tobytes() for a, n in zip(table.starts, table.lengths)]
    assert found == [b"".join(tokens[i] for i in ids[a:b]) for a, b in zip(bounds, bounds[1:])]
    size = sum(map(len, found))
    assert peak < 6 * size + (16 << 20), (peak, size)


def test_ragged_take_in_parts():
    """Parts, values longer than a part and empty values give the same; only parts are held."""
    rng = np.random.default_rng(2)
    data = rng.integers(0, 256, 4 * arrays.TAKE).astype(np.uint8)
    lengths = np.array([0, 1, 7, 300, arrays.TAKE, 2 * arrays.TAKE + 1])
    starts = np.array([5, 0, 11, 400, 900, 1000])
    for size in (0, 1, 5, 1000):
        which = rng.choice(6, size, p=[0.3, 0.3, 0.3, 0.08, 0.01, 0.01])
        want = b"".join(data[starts[i] : starts[i] + lengths[i]].tobytes() for i in which)
        assert arrays.ragged_take(data, starts, lengths, which).tobytes() == want
    which = np.full(20_000, 3)
    found, peak = peak_of(arrays.ragged_take, data, starts, lengths, which)
    assert len(found) == 6_000_000 and peak < 2 * len(found) + (4 << 20)


def test_long_blocks_come_back_in_batches(spark, coder, monkeypatch):
    """A block of many slices, with documents longer than a slice between short ones."""
    monkeypatch.setattr(bpe, "SLICE_TOKENS", 20)
    rows = [(i, t) for i, t in list(texts_of(SF).items())[:30]] + [(-1, ""), (-2, None)]
    found = bpe.encode(documents(spark, rows).coalesce(1), PATH, public_tokenizers.PATTERN, decoded=True)
    assert {r.doc_id: (bytes(r.ids), bytes(r.decoded)) for r in found.collect()} == {
        i: (ids_of(coder, t or ""), (t or "").encode()) for i, t in rows
    }
