"""Operator 10 against the library's own encoding, and exact round trips."""

import os
import random

import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from anchorline.llm.pieces import MARK, MODEL, Encoder, Vocabulary, decode, decode_ids, encode

pytestmark = pytest.mark.skipif(not os.path.exists(MODEL), reason="no vocabulary file")
if os.path.exists(MODEL):
    ENC = Encoder(Vocabulary.load(MODEL))
    LIB = sentencepiece.SentencePieceProcessor(model_file=MODEL)


def same(t):
    ids = ENC(t).tolist()
    assert ids == LIB.encode(t), t
    assert decode(ids, ENC.vocabulary.decoded) == t.replace(MARK, " ")


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(blacklist_categories=["Cs"]), max_size=60))
def test_any_text(t):
    if "\0" not in t:
        same(t)


@settings(max_examples=300, deadline=None)
@given(st.text("abehinorst eéß.\n▁", max_size=80))
def test_prose_like(t):
    same(t)


def test_spaces_and_long_stretches():
    for n in range(0, 70):
        for t in (" " * n, " " * n + "x", "x" + " " * n + "é y", " " * n + "\n", "ab" + " " * n):
            same(t)
    r = random.Random(2)
    for n in (200, 3000, 20000):
        same("".join(r.choice("abcdefghinorst") for _ in range(n)))
        same("".join(r.choice("0123456789éλ漢字🙂") for _ in range(n)))
    same("the" * 4000)
    same("a" * 5000)


def test_commits_early():
    """The window stays short on a stretch without spaces."""
    v = ENC.vocabulary
    seen = []
    meet = v._meet
    v._meet = lambda last: seen.append(len(last)) or meet(last)
    try:
        v.viterbi("internationalisation" * 500)
    finally:
        del v._meet
    assert seen and max(seen) < 64 + 6 * v.longest


def test_frames(spark):
    rows = [(1, "Hello  wörld\n"), (2, None), (3, ""), (4, " x"), (4, " x"), (None, "漢字" * 10), (5, "a " * 30000)]
    df = spark.createDataFrame([(i, t, "en") for i, t in rows], "doc_id long, text string, ids string")
    out = decode_ids(encode(df)).collect()
    assert [(r.doc_id, r.text) for r in out] == rows
    assert all(r.exact or r.text is None for r in out)
    assert [r.ids for r in out if r.doc_id == 1] == [LIB.encode("Hello  wörld\n")]
    assert encode(df.limit(0)).count() == 0
