import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.helpers import SF, documents, empty, texts_of
from tidemark.llm import pii, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, text):
    number = re.sub("[^0-9]", "", text)
    if kind == "ip":
        return all(int(part) <= 255 for part in text.split("."))
    if kind == "card":
        odd = sum(map(int, number[-1::-2]))
        even = sum(sum(map(int, str(2 * int(d)))) for d in number[-2::-2])
        return 16 <= len(number) <= 19 and (odd + even) % 10 == 0
    return kind == "email" or 8 <= len(number) <= 15


def plain(text):
    return [
        (kind, *m.span()) for kind, p in PATTERNS.items() for m in re.finditer(p, text or "") if passes(kind, m[0])
    ]


def base(spans):
    return [(s.kind, s.start, s.end) for s in spans if s.base]


CARD = "4556737586899855"
PIECES = ["a", "é", "@", ".", "..", "-", "%", "+", "(", ")", " ", "\n", "1", "255", "256", "007", CARD, "9" * 20, "x.y", "٣"]


@settings(max_examples=600, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=25).map("".join))
def test_base_spans(text):
    assert base(pii.spans_of(text)) == plain(text)


def test_query(spark):
    found = queries.QUERIES["op13_personal_data"](spark, SF).collect()
    texts = texts_of(SF)
    assert sorted(r.doc_id for r in found) == sorted(texts)
    for r in found:
        want = plain(texts[r.doc_id])
        listed = ",".join("{}:{}:{}".format(*s) for s in want)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        counts = [sum(s[0] == kind for s in want) for kind in PATTERNS]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts
        assert set(filter(None, listed.split(","))) <= set(r.spans.split(","))


def kinds(text):
    return [(s.kind, text[s.start : s.end]) for s in pii.spans_of(text) if not s.base]


def test_what_the_method_adds():
    assert kinds(f"{CARD} {CARD}") == [("card", CARD)] * 2
    assert kinds(f"order {CARD} {CARD}") == []  # words of other numbers
    assert kinds("visa 378282246310005 ok") == [("card", "378282246310005")]
    assert kinds("37828224631000 5 and 378282246310005") == []
    assert kinds("my 4556-7375-8689-9855-123 4556") == []
    assert kinds("card 1 4556 7375 8689 9855 1") == [("card", "4556 7375 8689 9855")]
    assert kinds("Konto DE89 3704 0044 0532 0130 00 AB") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("GB82WEST12345698765432.") == [("iban", "GB82WEST12345698765432")]
    assert kinds("GB82WEST12345698765433 XX89 3704 0044 0532 0130 00") == []
    assert kinds("Tel. (030) 123 4567, fax") == [("phone", "(030) 123 4567")]
    assert kinds("between 030 123 4567 and 2.0") == []


def test_scores_follow_the_words_nearby():
    low, plainly, high = (
        pii.spans_of(f"{word} 10.0.0.1")[0].score for word in ("version", "and", "server")
    )
    assert low < plainly < high


@pytest.mark.parametrize("unit", ["1", "a", "1.", "1 ", "+1(", "@a", "a@", "a.", "DE89 ", "1111 ", "AA11"])
def test_long_runs_take_linear_time(unit):
    start = time.time()
    pii.spans_of(unit * (400_000 // len(unit)))
    assert time.time() - start < 5


ROWS = [
    (1, None), (2, ""), (3, "a@b.c"), (3, "a@b.c"), (3, "x +49 30 1234567 y"), (None, "1.2.3.4 a@b.c@d.e"),
    (4, "é" * 5 + " a@b.c"), (5, f"{CARD} " * 3000), (6, "+1 (2) 3456789@x.y"),
]


def test_awkward_rows(spark):
    found = pii.find(documents(spark, ROWS)).collect()
    got = sorted(repr((r.doc_id, base(r.spans))) for r in found)
    assert got == sorted(repr((i, plain(t))) for i, t in ROWS)
    assert all(len(r.spans) == 3000 for r in found if r.doc_id == 5)
    assert pii.find(empty(spark)).count() == 0


def test_masked(spark):
    frame = documents(spark, ROWS)
    found = pii.mask(frame)
    assert found.columns == frame.columns
    texts = sorted(r.text for r in found.collect() if r.doc_id == 3)
    assert texts == ["<email>", "<email>", "x <phone> y"]
    got = {r.doc_id: r.text for r in found.collect()}
    assert got[1] is None and got[2] == "" and got[4] == "ééééé <email>"
    assert got[None] == "<ip> <email>@d.e"
    assert got[6] == "<phone>@x.y" or got[6].startswith("<phone>")
