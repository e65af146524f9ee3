import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import SF, documents, empty, rows_of
from tidemark.llm import langid, queries


def test_query(spark):
    langs = {r[0]: r[2] for r in rows_of(SF, "documents")}
    found = queries.QUERIES["op4_language_id"](spark, SF).collect()
    assert {r.doc_id: r.held_out for r in found} == {
        i: zlib.crc32(str(i).encode()) % 4 == 2 for i in langs
    }
    held_out = [r for r in found if r.held_out]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held_out]) >= 0.97
    assert all(0 <= r.score <= 1 for r in found) and len(found) == len(langs)


def brute_margins(model, text):
    """Byte pairs and triples one by one."""
    data = ("  " + text.lower() + " ").encode()
    data = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in data)
    found = []
    for i in range(len(data) - 2):
        found.append(data[i] << 8 | data[i + 1])
        triple = data[i] << 16 | data[i + 1] << 8 | data[i + 2]
        found.append(langid.PAIRS + (triple * 0x9E3779B1 % 2**32 >> 16))
    return model.weights[found].astype(float).mean(axis=0)


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit(spark.read.parquet(f"{SF}/documents.parquet"), per_language=12)


def test_margins_of_many_texts(model):
    texts = ["The end of it", "", "Über die Straße", "x", "de la " * 3000, "\n\n", "ñ"]
    assert np.allclose(model.margins(texts), [brute_margins(model, t) for t in texts], atol=1e-4)


def test_awkward_rows(spark, model):
    rows = [
        (1, None), (2, ""), (3, "123 !!! ١ ²"), (4, "the and of that"), (None, "der die und das"),
        (4, "the and of that"), (5, "a"), (6, "漢字"), (7, "les des une dans " * 20000),
    ]
    docs = documents(spark, rows)
    found = langid.predict(docs, model).collect()
    by_id = {r.doc_id: r for r in found}
    assert len(found) == len(rows)
    for k in (1, 2, 3):
        assert by_id[k].lang_pred == "und" and by_id[k].score == 0 and by_id[k].ambiguous
    assert all(by_id[k].lang_pred in model.languages for k in (4, None, 5, 6, 7))
    kept = langid.reject(docs, model)
    assert kept.columns == docs.columns
    assert sorted(kept.toPandas().doc_id.fillna(0)) == [0, 4, 4, 5, 6, 7]
    assert langid.predict(empty(spark), model).count() == 0


def test_few_languages(spark):
    docs = documents(spark, [(1, "one text"), (2, None)])
    nothing = langid.fit(docs)
    assert {(r.lang_pred, r.score) for r in langid.predict(docs, nothing).collect()} == {("und", 0.0)}
    one = langid.fit(documents(spark, [(1, "one text", "en"), (2, None, "de"), (3, "12", "fr")]))
    assert {(r.doc_id, r.lang_pred, r.score) for r in langid.predict(docs, one).collect()} == {
        (1, "en", 1.0),
        (2, "und", 0.0),
    }


def test_sample_is_bounded_and_leaves_others_out(spark):
    rows = [(i, f"t{i}", "en") for i in range(900)] + [(i, "t", "de") for i in range(900, 905)]
    rows += [(i, "t", None) for i in range(20)]
    sample = langid._sample(documents(spark, rows), 30)
    assert dict(sample.groupBy("lang").count().collect()) == {"en": 30, "de": 5}
    held = documents(spark, rows).withColumn("h", langid.held_out(4)).filter("h").select("doc_id")
    assert {r.doc_id for r in held.collect()} == {
        i for i, *_ in rows if zlib.crc32(str(i).encode()) % 4 == 2
    }
    assert documents(spark, [(None, "x")]).select(langid.held_out(4)).first()[0] is False


@pytest.mark.parametrize("n", [2, 3, 4, 9, 40])
def test_codewords_correct_errors(n):
    words = langid.codewords(n)
    apart = (words.shape[1] - words @ words.T) // 2 + np.eye(n, dtype=int) * 99
    assert apart.min() >= (1 if n == 2 else 2 if n == 3 else 4)
    assert (np.abs(words.sum(axis=0)) < n).all()
    bits = words.shape[1]
    model = langid.Model([str(i) for i in range(n)], words, None, np.ones(bits), np.zeros(bits), np.ones(bits))
    flips = (int(apart.min()) - 1) // 2
    margins = 3.0 * words
    margins[:, :flips] *= -1
    nearest, score = model.decode(margins)
    assert (nearest == np.arange(n)).all() and (score <= 1).all()
    _, unsure = model.decode(np.zeros((1, bits)))
    assert unsure[0] < langid.CERTAIN


def test_texts_in_no_learned_language_are_rejected(spark):
    rows = rows_of(SF, "documents")
    full = langid.fit(spark.read.parquet(f"{SF}/documents.parquet"))
    foreign = [
        "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan",
        "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw",
        "Все люди рождаются свободными и равными в своем достоинстве и правах",
        "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心",
        "xkq zzvw qqj wxk vvq jjz kqx zxw qjv wqz xvk qzj kwx vqj zkw",
        "12 !!! " * 50 + "x" + " ??? 7" * 50,
    ]
    asked = [(-k - 1, t) for k, t in enumerate(foreign)] + [(r[0], r[1]) for r in rows]
    kept = {r.doc_id for r in langid.reject(documents(spark, asked), full).collect()}
    assert kept == {r[0] for r in rows if any(c.isalpha() for c in r[1] or "")}


def test_training_texts_are_held_against_the_others(spark):
    texts = ["the end of the house by the river", "sand and wind and hand and land", "quiz"]
    model = langid.fit(documents(spark, [(i, t, "en") for i, t in enumerate(texts)]))
    for k, text in enumerate(texts):
        others = langid.grams(texts[:k] + texts[k + 1 :])[0]
        own = langid.grams([text])[0]
        own = own[~langid._BLANKS[own]]
        share = np.mean(~np.isin(own, others))
        assert model.familiarity([text], own=True)[0, 2] == pytest.approx(share)
    assert model.familiarity(texts)[:, 2].tolist() == [0, 0, 0]


def test_without_a_language_only_texts_without_letters_are_rejected(spark):
    docs = documents(spark, [(1, "one text"), (2, None), (3, "12 !!"), (4, "ein Text " * 20), (5, "")])
    kept = langid.reject(docs, langid.fit(docs))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4]


def test_the_classifier_decides_what_is_rejected(spark):
    rows = rows_of(SF, "documents")
    given = spark.read.parquet(f"{SF}/documents.parquet")
    full = langid.fit(given)
    # Known n-grams only, but as many of one language as of another.
    by_lang = [[r[1] for r in rows if r[2] == lang and 300 < len(r[1] or "") < 3000] for lang in full.languages]
    streams = [" ".join(texts).split() for texts in by_lang]
    mixed = [" ".join(sum(four, ())) for four in [list(zip(*streams))[k : k + 50] for k in range(0, 400, 50)]]
    assert (full.familiarity(mixed)[:, 2] <= full.most_unseen).all()
    far = full.distance(full.margins(mixed)) > full.farthest
    assert far.any()
    asked = documents(spark, [(-k, t) for k, t in enumerate(mixed, 1)] + [(r[0], r[1]) for r in rows])
    kept = {r.doc_id for r in langid.reject(asked, full).collect()}
    assert {-k for k, odd in enumerate(far, 1) if not odd} == {i for i in kept if i < 0}
    # A classifier that knows nothing rejects; one whose limit is off does not.
    full.weights[:] = 0
    full.shift[:] = 0
    assert langid.reject(given, full).count() < len(rows) / 2
    full.farthest = np.inf
    assert langid.reject(given, full).count() == len(rows)


def test_margins_of_a_training_text_by_the_others(spark):
    rows = [("the end of the house by the river", "en"), ("sand and wind and hand", "en"), ("der Fluss am Haus", "de")]
    whole = langid.fit(documents(spark, [(i, t, lang) for i, (t, lang) in enumerate(rows)]))
    counts = langid._counts(spark.createDataFrame(rows, "text string, lang string"))[1]
    others = langid.fit(documents(spark, [(i, t, lang) for i, (t, lang) in enumerate(rows) if i != 1]))
    found = langid._own_margins(whole, counts, langid._totals(counts), "en", rows[1][0])
    assert np.allclose(found, others.margins([rows[1][0]])[0], atol=1e-5)
