import itertools
import re

import pytest

from tests.llm.helpers import SF, documents, empty
from tests.oracle_check import connect, differences
from tidemark.llm import audit, queries

LABELS = "doc_id long, quality int, toxic int, part string, n int"


def test_query(spark):
    name = "op12_filter_audit"
    assert differences(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) == ""


LONG = " ".join(f"w{i}" for i in range(250))
ROWS = [
    (1, LONG, "en"), (2, LONG, "en"), (3, LONG, "de"), (3, LONG, "de"), (None, LONG, "en"), (0, LONG + " #", None),
    (4, None, None), (5, "", ""), (6, "A" * 3 + "b" * 97, "en"), (7, "A" * 4 + "b" * 97, "en"),
    (8, "w w\tw\x0bx " * 100, "en"), (9, "w x " * 100, "fr"), (9, "W X y" * 90, "fr"), (9, "w x " * 100, "fr"),
    (10, "é ß " * 40000, "fr"), (11, "a&b", "en"), (12, "w x " * 99 + "z z", "fr"),
    *[(100 + i, "copy", "en") for i in range(60)], *[(None, "null copy", "en")] * 5,
]
MARKS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, 0, 1), (None, 1, 1), (105, 1, None), (106, None, 1), (9999, 1, 1)]


def failing(rows):
    for doc_id, text, lang in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        smaller = [i for i, t, _ in rows if (t or "") == text and i is not None]
        yield doc_id, lang or "", {
            letter
            for letter, fails in zip(
                "ABCDE",
                (
                    len(words) < 200,
                    100 * len(set(words)) < 50 * len(words),
                    100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
                    bool(re.search("[#$%&*|]", text)),
                    doc_id is not None and any(i < doc_id for i in smaller),
                ),
            )
            if fails
        }


def expected(rows, marks):
    good = {i for i, q, _ in marks if q == 1 and i is not None}
    toxic = {i for i, _, t in marks if t == 1 and i is not None}
    found, shapley = [], {}
    docs = list(failing(rows))
    for part in {p for _, p, _ in docs}:
        for order in itertools.permutations("ABCDE"):
            left = [(i, f) for i, p, f in docs if p == part]
            inside = list(left)
            for step, letter in enumerate(order, 1):
                lost = [i for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                redundant = sum(letter in f for _, f in inside) - len(lost)
                once = sum(f == {letter} for _, f in inside)
                good_lost, toxic_lost = sum(i in good for i in lost), sum(i in toxic for i in lost)
                key = part, letter
                shapley[key] = shapley.get(key, 0) + len(lost)
                found.append((key, ("".join(order), step, len(left), len(lost), redundant, once, good_lost, toxic_lost)))
    return sorted((key[0], *row, shapley[key]) for key, row in found)


NAMES = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


@pytest.mark.parametrize("max_broadcast, per_salt", [(1 << 20, 500), (0, 7)])
def test_awkward_rows(spark, max_broadcast, per_salt, monkeypatch):
    monkeypatch.setattr(audit.with_earlier_copy, "__defaults__", (max_broadcast, per_salt))
    labels = spark.createDataFrame([(*m, "x", 1) for m in MARKS], LABELS)
    found = audit.audit(documents(spark, ROWS), labels)
    assert sorted(tuple(r[n] for n in NAMES) for r in found.collect()) == expected(ROWS, MARKS)


def test_empty_tables(spark):
    assert audit.audit(empty(spark), spark.createDataFrame([], LABELS)).count() == 0
    found = audit.audit(documents(spark, ROWS), spark.createDataFrame([], LABELS))
    assert sorted(tuple(r[n] for n in NAMES) for r in found.collect()) == expected(ROWS, [])


def test_hot_text_is_dealt_to_many_keys(spark):
    rows = [(i, "same") for i in range(4000)] + [(9000 + i, f"t{i}") for i in range(50)]
    found = audit.failures(documents(spark, rows))
    assert found.filter("bits >= 16").count() == 3999
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "LeftSemi" in plan and "salt" in plan and "Cartesian" not in plan
