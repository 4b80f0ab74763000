"""Elias-Fano coding and the token store against the tokenizers library."""
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from feedrank.llm import chunks
from feedrank.llm import token_store as ts
from feedrank.llm.common import documents
from feedrank.llm.elias_fano import EliasFano
from feedrank.session import scratch_dir


@given(st.lists(st.integers(0, 2**64 - 1), max_size=300))
@settings(max_examples=60, deadline=None)
def test_elias_fano_round_trip(values):
    values = sorted(values)
    coded = EliasFano.encode(values)
    assert coded.all().tolist() == values
    if values:
        k = np.arange(0, len(values), 7)
        assert coded.get(k).tolist() == values[::7]


@pytest.mark.parametrize("n,top", [(1, 0), (64, 3), (65, 10**9), (5000, 10**6), (9000, 9000)])
def test_elias_fano_size_is_near_minimal(n, top):
    v = np.sort(np.random.default_rng(0).integers(0, top + 1, n))
    e = EliasFano.encode(v)
    assert (e.all() == v.astype(np.uint64)).all()
    bits = 8 * (len(e.low) + len(e.high) + len(e.samples))
    assert bits <= n * (3 + max(0, np.log2((top + 1) / n))) + 32 * (n // 64 + 1) + 64


def expected(rows, raw):
    tok = Tokenizer.from_str(raw.decode())
    tok.encode_special_tokens = True
    out, at = [], 0
    for doc_id, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_query_equals_library(spark, sf):
    rows = [(r["doc_id"], r["text"]) for r in documents(spark, sf).orderBy("doc_id").collect()]
    got = [tuple(r) for r in ts.op10_token_store(spark, sf).orderBy("start").collect()]
    assert got == expected(rows, ts.public_tokenizer())


def test_odd_rows_small_blocks_and_empty(spark, odd_docs, monkeypatch):
    raw = ts.public_tokenizer()
    path = ts.write_store(odd_docs, scratch_dir(spark, "t"), raw)
    got = [tuple(r) for r in ts.read_store(spark, path, ts.crc32_of, ts.RESULT).orderBy("start").collect()]
    assert [g[0] for g in got] == sorted((g[0] for g in got), key=lambda x: (x is not None, x or 0))
    by_place = {g[0]: g for g in got}
    assert by_place[2][2] == 1 and by_place[3][2] == 1
    assert sorted((g[0] or 0, g[2], g[3]) for g in got) == sorted(
        (e[0] or 0, e[2], e[3]) for e in expected([(r["doc_id"], r["text"]) for r in odd_docs.collect()], raw))
    empty = ts.write_store(odd_docs.limit(0), scratch_dir(spark, "t"), raw)
    assert ts.read_store(spark, empty, ts.crc32_of, ts.RESULT).count() == 0


def test_special_tokens_in_texts_as_the_library_does(spark):
    raw, end = ts.public_tokenizer(), "<|endoftext|>"
    texts = ["before", f"end {end} next", end, f"a{end}b", f" {end} ", f"x  {end}  y", f"{end}{end} {end}",
             f"é{end}\n {end}. {end}\t", f"many words {end} in one text {end} of several {end}", "after all"]
    tok = Tokenizer.from_str(raw.decode())
    ids = [tok.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids[1] == [437, 220, 50256, 1306]
    joined = ts.encoder_of(raw)(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in joined] == ids
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    path = ts.write_store(docs, scratch_dir(spark, "t"), raw)
    got = [tuple(r) for r in ts.read_store(spark, path, ts.crc32_of, ts.RESULT).orderBy("start").collect()]
    start = np.cumsum([0, *(len(i) + 1 for i in ids)]).tolist()
    assert got == [(d, start[d], len(i) + 1, zlib.crc32(np.array(i + [2], "<u4").tobytes())) for d, i in enumerate(ids)]


def test_plain_words_go_to_the_model_and_equal_the_library():
    raw = ts.public_tokenizer()
    words = [" word", " Words,", " many!!", " it'", " a", " rare%%%", " x_y", " don't", " 12.", " caf\u00e9.",
             " a.\nB.", " \u2026", " w\u0301.", " z\x00"]
    tok = Tokenizer.from_str(raw.decode())
    want = [np.array(tok.encode(w, add_special_tokens=False).ids, "<u2").tobytes() for w in words]

    class Counted:
        """The tokenizer, with the texts that went the long way."""
        seen: list[str] = []

        def __getattr__(self, name):
            return getattr(tok, name)

        def encode_batch_fast(self, texts, add_special_tokens):
            self.seen += texts
            return tok.encode_batch_fast(texts, add_special_tokens=add_special_tokens)

    assert ts._JoinedEncoder(Counted(), "<u2", lambda texts: [])(words) == want
    assert Counted.seen == ["".join(words[6:])]


def test_known_words_and_lines_cost_no_new_call(monkeypatch):
    raw = ts.public_tokenizer()
    monkeypatch.setattr(ts, "_encoders", {})
    encode, tok = ts.encoder_of(raw), Tokenizer.from_str(raw.decode())
    calls: list[str] = []
    pieces, library = ts._JoinedEncoder._piece, chunks.Memo._values

    def counted(self, piece):
        calls.append(piece)
        return pieces(self, piece)

    def fresh(self, distinct):
        held, self.encode = self.encode, lambda c: (seen.append(sorted(c)), held(c))[1]
        try:
            return library(self, distinct)
        finally:
            self.encode = held

    seen: list[list[str]] = []
    monkeypatch.setattr(ts._JoinedEncoder, "_piece", counted)
    monkeypatch.setattr(chunks.Memo, "_values", fresh)
    texts = ["x zorble caf\u00e9", "x zorble!! caf\u00e9!! zorble.\nx zorble!!\nx",
             "x zorble \n\nx zorble\n\nx zorble\u2003\nx \nx\n", "\nx zorble's caf\u00e9's \u01c5a!!"]
    for text in texts:
        got = np.frombuffer(next(iter(encode([text]))), "<u2").tolist()
        assert got == tok.encode(text, add_special_tokens=False).ids
    assert calls.count(encode_space(tok) + "zorble") == 1
    assert seen[1] == ["\nx", " caf\u00e9!!", " zorble!!", " zorble."]


def encode_space(tok):
    return tok.pre_tokenizer.pre_tokenize_str(" a")[0][0][:-1]


@pytest.mark.parametrize("token", ["ab.", "!!", "word"])
def test_added_tokens_inside_plain_words(token):
    tok = Tokenizer.from_str(ts.public_tokenizer().decode())
    tok.add_special_tokens([token])
    texts = ["an ab. cab. words! word!! ab", " word ab.. swords", "x\0 y word. \0", "\0", " ", "  a"]
    joined = ts.encoder_of(tok.to_str().encode())(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in joined] == [
        tok.encode(t, add_special_tokens=False).ids for t in texts]


def test_block_row_round_trip():
    b = ts._Block()
    b.add(None, b"\1\0", 2)
    for d in (-5, -5, 7):
        b.add(d, b"\2\0\3\0", 2)
    row = b.row(0, 10, 2)
    assert row["n_ids"] == 7 and row["n_null"] == 1
    assert ts._sequence(row["ends"]).all().tolist() == [1, 3, 5, 7]
    assert [int(x) + row["first_id"] for x in ts._sequence(row["doc_ids"]).all()] == [-5, -5, 7]
