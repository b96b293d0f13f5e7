"""Operators 5 and 6 against brute force over all windows."""

import hashlib
import random

import numpy as np
import pandas as pd
import pytest

from anchorline.llm import chunks, substring_dedup as s6, suffix_dedup as s5
from anchorline.llm.substring_dedup import substring_dedup, substring_dedup_docs
from anchorline.llm.suffix_dedup import suffix_dedup, suffix_dedup_text

SP = b" \t\n\r\x0b\x0c"


def brute_bytes(rows, w=50):
    rows = [(i, (t or "").encode()) for i, t in rows]
    least = {}
    big = 1 << 63
    for i, b in rows:
        for q in range(len(b) - w + 1):
            k = b[q : q + w]
            least[k] = min(least.get(k, big), big if i is None else i)
    out = []
    for i, b in rows:
        m = [False] * len(b)
        for q in range(len(b) - w + 1):
            if least[b[q : q + w]] < (big if i is None else i):
                m[q : q + w] = [True] * w
        spans = sum(x and not y for x, y in zip(m, [False, *m]))
        kept = bytes(c for c, x in zip(b, m) if not x)
        out.append((i, len(b), sum(m), spans, hashlib.sha256(kept).hexdigest()))
    return out


def brute_words(rows, w=35):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    n = {}
    for _, x in docs:
        for q in range(len(x) - w + 1):
            k = tuple(x[q : q + w])
            n[k] = n.get(k, 0) + 1
    out = []
    for i, x in docs:
        m = [False] * len(x)
        for q in range(len(x) - w + 1):
            if n[tuple(x[q : q + w])] > 1:
                m[q : q + w] = [True] * w
        out.append((i, len(x), sum(m), hashlib.sha256(b" ".join(c for c, y in zip(x, m) if not y)).hexdigest()))
    return out


def corpus(seed):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 5)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(n) for n in (10, 34, 35, 36, 60, 200)]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(r.randint(0, 5)):
            parts.append(r.choice([lambda: r.choice(passages), lambda: prose(r.randint(1, 60)), lambda: r.choice(passages)[r.randint(0, 30) :][: r.randint(10, 250)]])())
        rows.append((i * 3 % 61, r.choice([" ", "\n", "  "]).join(parts)))
    rows += [(100, None), (101, ""), (102, " \n "), (103, "a " * 500), (104, "x a " * 300), (105, "a " * 40 + "b"), (106, "a" * 300), (107, "ab" * 200)]
    rows += [(108, "p q r " * 50 + prose(20)), (109, "z " + "p q r " * 13), (110, passages[5]), (110, passages[5]), (None, passages[5] + " tail"), (111, "a" * 51), (112, rows[5][1])]
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_matches_brute_force(spark, seed, monkeypatch):
    rows = corpus(seed)
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, k string")
    key = lambda x: tuple((y is None, y) for y in x)
    got = [tuple(x) for x in suffix_dedup(df).collect()]
    assert sorted(got, key=key) == sorted(brute_bytes(rows), key=key)
    got = [tuple(x) for x in substring_dedup(df).collect()]
    assert sorted(got, key=key) == sorted(brute_words(rows), key=key)


def off_spark(rows, chunks_of=4, n=3):
    """Both operators without Spark, over several chunks and buckets: rows of each, as the queries give them."""
    cat = lambda fs: pd.concat(list(fs), ignore_index=True)
    frame = lambda part: pd.DataFrame({"doc_id": pd.Series([r[0] or 0 for r in part], dtype="int64"), "_null": [r[0] is None for r in part], "_text": [(r[1] or "").encode() for r in part]})
    parts = [frame(rows[c::chunks_of]) for c in range(chunks_of)]
    got = lambda told, c: {(s, b): x for d, s, b, x in told.itertuples(index=False) if d == c}
    settled = lambda fn, sent: cat([fn(g) for _, g in sent.groupby("_bucket")] or [pd.DataFrame([], columns=["_chunk", "stage", "_bucket", "codes"])])
    tidy = lambda out: [(None if r[1] else r[0], *r[2:]) for r in out.itertuples(index=False)]
    state = [s5._condense(p) for p in parts]
    told = settled(chunks.shared_keys(0), cat(s5._ask_keys(50, n)(c, s, {}) for c, s in enumerate(state)))
    sent = cat(s5._send_texts(50, n)(c, s, got(told, c)) for c, s in enumerate(state))
    told = cat([told, settled(s5.settle(50), sent)])
    first = tidy(cat(s5._finish(50, n, s5._digest)(c, s, got(told, c)) for c, s in enumerate(state)))
    state = [s6.condense(p) for p in parts]
    told = settled(s6.name_words, cat(s6._ask_words(35, n)(c, s, {}) for c, s in enumerate(state)))
    for r in (1, 2, 3):
        asked = cat(s6._ask_blocks(35, n, r)(c, s, got(told, c)) for c, s in enumerate(state))
        told = cat([told, settled(s6.name_blocks(r), asked)])
    told = cat([told, settled(chunks.shared_keys(s6.REVEAL), cat(s6._ask_pairs(35, n, 3)(c, s, got(told, c)) for c, s in enumerate(state)))])
    sent = cat(s6._send_contents(35, n, 3)(c, s, got(told, c)) for c, s in enumerate(state))
    told = cat([told, settled(s6.settle(35), sent)])
    return first, tidy(cat(s6._finish(35, n, 3, s6._digest)(c, s, got(told, c)) for c, s in enumerate(state)))


@pytest.mark.parametrize("hot,piece", [(1, 1 << 19), (1 << 16, 97), (3, 61)])
def test_small_pieces_and_hot_keys(hot, piece, monkeypatch):
    """Several chunks, pieces that cut documents, and keys that go by single windows."""
    monkeypatch.setattr(chunks, "HOT", hot)
    monkeypatch.setattr(chunks, "PIECE", piece)
    rows = corpus(7)
    key = lambda x: tuple((y is None, y) for y in x)
    for got, want in zip(off_spark(rows), (brute_bytes(rows), brute_words(rows))):
        assert sorted(got, key=key) == sorted(want, key=key)


def thue(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def test_words_of_equal_polynomial_hash_are_different(spark):
    """A long word and its complement share sums modulo 2**64 under any odd base; nothing is removed for that."""
    x, y = thue(1024), thue(1024).translate(str.maketrans("ab", "ba"))
    words = [f"w{i}" for i in range(40)]
    a, b = ([*words[:20], z, *words[20:]] for z in (x, y))
    rows = [(1, " ".join(a)), (2, " ".join(b))]
    got = sorted(tuple(r) for r in substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted(brute_words(rows)) and [r[2] for r in got] == [0, 0]


def test_ids_at_the_ends_of_their_range(spark):
    big = (1 << 63) - 1
    p = "abcdefghij" * 6
    rows = [(big, p + "1"), (None, p + "2"), (-(1 << 63), "x" + p), (0, "y" + p)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    key = lambda x: tuple((y is None, y) for y in x)
    assert sorted(map(tuple, suffix_dedup(df).collect()), key=key) == sorted(brute_bytes(rows), key=key)
    assert sorted(map(tuple, substring_dedup(df).collect()), key=key) == sorted(brute_words(rows), key=key)
    rows = [(big, p), (None, p)]
    assert {r.doc_id: r.n_removed for r in suffix_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == {big: 0, None: 60}


def test_long_texts(spark):
    """Texts beyond a chunk, with repeats inside and between them."""
    r = random.Random(3)
    prose = lambda n: " ".join("".join(r.choice("abcdefgh") for _ in range(r.randint(2, 7))) for _ in range(n))
    p = prose(400)
    rows = [(1, prose(30_000) + " " + p), (2, p + " " + prose(20_000) + " " + p), (3, prose(50))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, suffix_dedup(df).collect())) == sorted(brute_bytes(rows))
    assert sorted(map(tuple, substring_dedup(df).collect())) == sorted(brute_words(rows))


def test_longest_previous_factors():
    """Values, not only whether they reach the window, against all pairs."""
    r = random.Random(5)
    docs = ["".join(r.choice("ab") for _ in range(r.randint(0, 40))) for _ in range(12)]
    text = "".join(docs).encode()
    doc = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    depth, starts = 8, np.arange(len(text) - 8 + 1)
    order, lcp = s5.suffix_order(np.frombuffer(text, np.uint8), starts, depth)
    got = dict(zip(starts[order].tolist(), s5.longest_previous_factor(lcp, doc[starts[order]]).tolist()))
    for i in starts.tolist():
        common = [next((k for k in range(depth) if text[i + k] != text[j + k]), depth) for j in starts.tolist() if doc[j] < doc[i]]
        assert got[i] == max(common, default=0)


def test_names_are_global():
    """Names differ where contents differ, are equal where they are equal in two chunks, and are missing where nothing repeats."""
    rows = [(1, "a b c d e f g h"), (2, "z a b c d e f g y")]
    state = [s6.condense(pd.DataFrame({"doc_id": [i], "_null": [False], "_text": [t.encode()]})) for i, t in rows]
    told = pd.concat([s6.name_words(g) for _, g in pd.concat([s6._ask_words(35, 2)(c, s, {}) for c, s in enumerate(state)]).groupby("_bucket")])
    got = [{(s, b): x for d, s, b, x in told.itertuples(index=False) if d == c} for c in range(2)]
    one, two = (s6.Words(s, 35, 2, g, 0).names for s, g in zip(state, got))
    assert one[:7].tolist() == two[1:8].tolist() and len(set(one[:7].tolist())) == 7 and one[7] == two[0] == two[8] == 0


def test_empty_and_documents(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, _chunk long")
    assert suffix_dedup(empty).count() == 0 and substring_dedup(empty).count() == 0
    p = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, p, "en", "s", 3), (2, "a  " + p, None, "s", None), (3, "a  b", None, None, 4), (4, None, None, None, 4)], "doc_id long, text string, lang string, source string, n_chars long")
    out = substring_dedup_docs(df)
    assert out.columns == df.columns
    assert {r.doc_id: r.text for r in out.collect()} == {1: "", 2: "a", 3: "a  b", 4: None}
    assert {r.doc_id: r.n_chars for r in out.collect()} == {1: 3, 2: None, 3: 4, 4: 4}
    kept = {r.doc_id: bytes(r.kept) for r in suffix_dedup_text(df).collect()}
    assert kept == {1: p.encode(), 2: b"a  ", 3: b"a  b", 4: b""}
