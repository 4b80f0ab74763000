"""Base spans against plain patterns; the field; masking."""
import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from feedrank.llm import pii as q
from feedrank.llm.common import documents

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")


def brute(text):
    text = text or ""
    out = [(0, *m.span()) for m in EMAIL.finditer(text)]
    out += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[ -]", "", m.group())
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
        if 13 <= len(d) <= 19 and total % 10 == 0:
            out.append((2, *m.span()))
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


@given(st.text(alphabet="a.@-+1 2(4)0", max_size=50))
@settings(max_examples=500, deadline=None)
def test_base_spans(text):
    assert q.base_spans(text) == brute(text)


@pytest.mark.parametrize("text", [
    "a@b@c.de f@@g.hi x.y@z", "1.2.3.4.5.6.7.8", "0.0.0.0256 1.1.1.0000000255", "4242 4242-4242 4242x",
    "+1 (706) 555-3138 +49 30 1234567 +1-2", "é@x.org ñ1.2.3.4", "٣.1.2.3 +١ 706 555 3138"])
def test_base_spans_by_example(text):
    assert q.base_spans(text) == brute(text)


def test_long_runs_take_linear_time():
    text = "a" * 200_000 + " " + "1" * 200_000 + " " + "@" * 50_000 + "." * 50_000
    assert q.base_spans(text) == []


@pytest.fixture(scope="module")
def field(spark):
    return q.train(documents(spark, "/root/testdata/sf0.1"))


def test_repeats_share_their_label(field):
    card = "4845168114407329"
    text = f"pay {card} now and later 7536784127813050 {card} again"
    base, added = q.label_texts([text], field)[0]
    assert [text[s:e] for _, s, e in base] == [card]
    assert card in [text[s:e] for k, s, e in added if k == 2]


@pytest.mark.parametrize("clear,other,kind", [
    ("4111111111111111", "1234 4111 1111 1111 1111", 2), ("4111 1111 1111 1111", "4111  1111  1111  1111", 2),
    ("4111-1111-1111-1111", "77 4111 1111 1111 1111 77", 2), ("4111 1111 1111 1111", "12 4111111111111111", 2),
    ("+1 (017) 555-7713", "(017) 555-7713", 3), ("+1 (017) 555-7713", "1 017 555 7713", 3)])
def test_forms_of_one_number_share_their_label(field, clear, other, kind):
    text = f"we wrote to {clear} once, then it was {other} and that is all"
    base, added = q.label_texts([text], field)[0]
    assert [(k, text[s:e]) for k, s, e in base] == [(kind, clear)]
    assert [k for k, _, _ in added] == [kind]
    digits, got = (re.sub("[^0-9]", "", t) for t in (clear, text[added[0][1]:added[0][2]]))
    assert digits.endswith(got) and len(got) >= 10


def test_spaced_and_plain_forms_share_a_star():
    clear = "+1 (017) 555-7713"
    keys = q.candidates(f"a {clear} b 017 555 7713 c 4111 1111 1111 1112 d 4111111111111112", [(3, 2, 2 + len(clear))]).keys
    assert len(keys) == 4 and set(keys[0]) & set(keys[1]) and set(keys[2]) & set(keys[3])


def test_clean_text_gets_nothing(field):
    for text in ("section 3.14 of 2024 has 12 items", "version 10.20.30.400 of 1234", "no digits at all"):
        assert q.label_texts([text], field) == [([], [])]


def test_skip_messages_raise_a_marginal(field):
    one = q.candidates("see 5550001112 here", [])
    base = [(3, 0, 12)]
    both = q.candidates("+5 550001112 x then 5550001112 and 550001112", base)
    alone = q.marginals([one], field)[0][0]
    linked = q.marginals([both], field)[0]
    assert linked[-1][4] > alone[4]


def test_query_base_columns(spark, sf):
    texts = {r["doc_id"]: r["text"] for r in documents(spark, sf).collect()}
    for r in q.op1_pii(spark, sf).collect():
        b = brute(texts[r["doc_id"]])
        assert (r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]) == tuple(
            sum(k == kind for k, *_ in b) for kind in range(4))
        assert r["base_sha256"] == hashlib.sha256(q.listed(b).encode()).hexdigest()
        assert set(q.listed(b).split(",")) <= set(r["spans"].split(","))


def test_masked():
    assert q.masked("mail a@b.cd now", [(0, 5, 11)]) == "mail [EMAIL] now"
    assert q.masked("ab1.2.3.4x", [(1, 2, 9), (2, 4, 10)]) == "ab[IP]"


def test_odd_rows(spark, odd_docs):
    field = q.train(odd_docs)
    got = q.detect(odd_docs, field).collect()
    assert len(got) == odd_docs.count() and sum(r["n_email"] for r in got) == 1
    out = q.mask_documents(odd_docs, field)
    assert out.columns == odd_docs.columns
    texts = {r["doc_id"]: r["text"] for r in out.collect()}
    assert texts[None] == "mail [EMAIL] now" and texts[2] is None and texts[3] == ""
    assert q.detect(odd_docs.limit(0), q.train(odd_docs.limit(0))).count() == 0
    assert np.isfinite(field.chain).all()
