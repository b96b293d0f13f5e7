"""Operator 6: removal of word windows that occur more than once, by recompression.

Names are given globally, in Spark rounds: chunks of documents send their distinct words, and in each round after that
their distinct blocks, to buckets, which number them; so a name is a number that stands for one content only, and equal
names mean equal words. A round replaces every run of one symbol, and every pair of a left-class and a right-class run
beside it, by the name of that block (the classes come from a hash of the run). Each boundary that is left carries the
stretch of words its survival depends on; a window may use the boundaries whose stretch it holds, so equal windows, and
all equal substrings, have the same symbols inside.

Words and blocks that occur once in the whole corpus get no name (0), nor does any block that holds one: they cannot
lie in a repeated window, and nothing more is asked about them. What keeps a name to the last round is shared.
The least pair of neighbouring symbols of the highest round in a window reveals it. Around pairs that occur more than
once, the names of the words go to the bucket of the pair,
which compares them and counts how often each window occurs. Windows in periodic text, where a round leaves no
boundary, use the round below. Hashes choose anchors and buckets only; nothing is removed because hashes are equal.

A pair with over ``HOT`` different surroundings has its windows dealt out one by one. Null and empty texts have no
words. Every row is a document of its own: repeated rows are copies of each other, and all copies of a repeated window
go, in the same document too. Under 35 words nothing is removed. An empty table gives an empty result. A text is parsed
in one worker, which needs about sixty times its bytes; other columns are passed on or ignored, whatever their names.
"""

from __future__ import annotations

import hashlib
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline.llm import chunks as C
from anchorline.llm._common import table

WIDTH = 35
ROUNDS = 3
U = np.uint64
OUT = "doc_id long, _null boolean, n_words long, n_removed long, kept_sha256 string"
#: Stages of replies: 0 to ROUNDS are names, then come shared pairs and windows.
REVEAL, VERIFY = 100, 101


# -- global names ----------------------------------------------------------------------------------------------------

NAMES = ["_bucket", "_chunk", "size", "block", "often"]


def name_words(pdf: pd.DataFrame) -> pd.DataFrame:
    """Numbers the words of a bucket that occur more than once, from 1; others get 0."""
    words = [b.split(b"\n") for b in pdf["block"]]
    flat = [w for ws in words for w in ws]
    rank = {w: i for i, w in enumerate(sorted(set(flat)))}
    of = np.array([rank[w] for w in flat], np.int64)
    return _named(pdf, [len(w) for w in words], of, 0)


def name_blocks(round_: int):
    """Numbers the blocks (symbol, times, symbol, times) of a bucket that occur more than once, from 1; others get 0."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        cols = np.concatenate([C.unplanes(b).reshape(4, -1) for b in pdf["block"]], 1)
        return _named(pdf, pdf["size"].tolist(), _distinct(cols)[1], round_)

    return run


def _named(pdf: pd.DataFrame, size: list[int], of: np.ndarray, round_: int) -> pd.DataFrame:
    often = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8))[:s] for x, s in zip(pdf["often"], size, strict=True)])
    shared = np.bincount(of, weights=1 + often) > 1
    return C.reply(pdf, size, np.where(shared, np.cumsum(shared), 0).astype("<u4")[of], round_)


def names_of(got: dict, round_: int, bucket: np.ndarray, n: int) -> np.ndarray:
    """Global names: round, number in the bucket and bucket, so that names of different contents differ."""
    number = C.answers(got, round_, bucket, "<u4").astype(U)
    return np.where(number > 0, U((round_ + 1) << 60) | (number * U(n) + bucket.astype(U)), U(0))


def _new(cols: np.ndarray) -> np.ndarray:
    """Where a sorted column differs from the one before."""
    out = np.ones(cols.shape[1], bool)
    out[1:] = (cols[:, 1:] != cols[:, :-1]).any(0)
    return out


class Parse:
    """Symbols of a chunk's documents, round by round: boundaries, symbols between them, the words each hangs on."""

    def __init__(self, names: np.ndarray, lengths: np.ndarray):
        n = len(names)
        self.edge = np.zeros(n + 1, bool)
        self.edge[np.concatenate([[0], np.cumsum(lengths), [n]])] = True
        self.edges = np.flatnonzero(self.edge)
        self.own = self.edges[np.cumsum(self.edge) - 1]  # the edge at or before each boundary
        self.pos, self.sym = np.arange(n + 1), names
        self.left, self.right = self.pos.copy(), self.pos.copy()
        self.levels = [(self.pos, self.sym, self.left, self.right)]

    def _keep(self, inner: np.ndarray) -> np.ndarray:
        """Drops the inner boundaries that are not kept; which symbols begin a block."""
        e = self.edge[self.pos]
        keep = e.copy()
        keep[1:-1] |= inner
        left, right = self.left.copy(), self.right.copy()
        left[1:], right[:-1] = self.left[:-1], self.right[1:]
        left[e], right[e] = self.pos[e] - 1, self.pos[e] + 1  # at an edge it hangs on what lies beyond
        first = np.flatnonzero(keep)
        self.pos, left, self.right = self.pos[first], left[first], right[first]
        # what hangs on words beyond an edge stays out of every window there
        self.left = np.maximum(left, self.own[self.pos] - 1)
        return first

    def blocks(self, round_: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The round's boundaries: first symbols of the blocks, which of them need a name, and their contents (4 x n)."""
        s = self.sym
        first = self._keep(s[1:] != s[:-1])
        run, times = s[first[:-1]], np.diff(first).astype(U)
        is_left = C.mix(run + C.mix(times) + U(round_)) & U(1) == 0
        pair = self._keep(~(is_left[:-1] & ~is_left[1:]))
        a, size = pair[:-1], np.diff(pair)
        b = np.minimum(a + 1, len(run) - 1)
        two = size > 1
        cols = np.stack([run[a], times[a], np.where(two, run[b], U(0)), np.where(two, times[b], U(0))]) if len(a) else np.zeros((4, 0), U)
        many = two | (cols[1] > 1)
        need = many & (cols[0] > 0) & (~two | (cols[2] > 0))  # a block that holds something unique is unique
        return np.where(many, U(0), cols[0]), need, cols[:, need]

    def rename(self, kept: np.ndarray, need: np.ndarray, names: np.ndarray) -> None:
        self.sym = kept.copy()
        self.sym[need] = names
        self.levels.append((self.pos, self.sym, self.left, self.right))


def _hash(cols: np.ndarray) -> np.ndarray:
    h = cols[0]
    for c in cols[1:]:
        h = C.mix(h * U(3) + c)
    return h


def _bucket_of(cols: np.ndarray, n: int) -> np.ndarray:
    return (_hash(cols) % U(n)).astype(np.int64)


def _compact(cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns without most repeats, and where each went. Blocks of one hash that differ can leave a repeat, which is asked twice."""
    order = np.argsort(_hash(cols))
    new = _new(cols[:, order]) if cols.shape[1] else np.zeros(0, bool)
    of = np.empty(cols.shape[1], np.int64)
    of[order] = np.cumsum(new) - 1
    return cols[:, order[new]], of


def _distinct(cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort(cols[::-1])
    new = _new(cols[:, order]) if cols.shape[1] else np.zeros(0, bool)
    of = np.empty(cols.shape[1], np.int64)
    of[order] = np.cumsum(new) - 1
    return cols[:, order[new]], of


class Words:
    """One chunk: its distinct words, the words of its documents as numbers of these, and the parse so far."""

    def __init__(self, state, width: int, n: int, got: dict, rounds: int | None):
        """Reads the names of ``rounds`` rounds (None: not even those of words)."""
        self.ids, self.null, self.words, flat, self.lengths = state[:5]
        self.width, self.n = width, n
        self.bucket = np.fromiter(map(crc32, self.words), np.int64, len(self.words)) % n
        if rounds is None:
            return
        self.names = names_of(got, 0, self.bucket, n)[flat]
        self.parse = Parse(self.names, self.lengths)
        for r in range(1, rounds + 1):
            kept, need, cols = self.parse.blocks(r)
            found, of = _compact(cols)
            self.parse.rename(kept, need, names_of(got, r, _bucket_of(found, n), n)[of])

    def slices(self) -> C.Slices:
        return C.Slices(len(self.names), self.lengths, self.width, self._anchors, self.names == 0)

    def _anchors(self, q: np.ndarray):
        """The least pair of neighbouring symbols, of the highest round that has one in the window: its hash and place.

        A pair with a symbol that has no name sends its windows away (key 0).
        """
        key, at = np.zeros(len(q), U), q.copy()
        todo = np.arange(len(q))
        for r in range(len(self.parse.levels) - 1, -1, -1):
            pos, sym, left, right = self.parse.levels[r]
            if len(pos) < 3 or not len(todo):
                continue
            lo = np.searchsorted(left[:-2], q[todo], "left")
            hi = np.searchsorted(right[2:], q[todo] + self.width, "right")
            ok = hi > lo
            mine, lo, hi = todo[ok], lo[ok], hi[ok]
            todo = todo[~ok]
            if not len(mine):
                continue
            low, high = int(lo.min()), int(hi.max())
            h = C.mix(sym[low:high] * U(5) + C.mix(sym[low + 1 : high + 1] + U(r))) | U(1)
            h[(sym[low:high] == 0) | (sym[low + 1 : high + 1] == 0)] = 0  # the least of all
            best = _least_in((h & ~C.LOW) | np.arange(len(h), dtype=U), lo - low, hi - low)
            i = (best & C.LOW).astype(np.int64)
            key[mine], at[mine] = h[i], pos[1:-1][low + i]
        return key, at

    def entries(self, got: dict):
        """Units; per entry: content, times, bucket, key, number of windows; the entry of each unit."""
        s = self.slices()
        q, m, key, _, alone = s.units(got, self.n, REVEAL)
        data = self.names.tobytes()
        seen: dict[bytes, int] = {}
        entry, first = [0] * len(q), []
        for i, (a, z) in enumerate(zip((8 * q).tolist(), (8 * (q + m + self.width - 1)).tolist(), strict=True)):
            e = entry[i] = seen.setdefault(data[a:z], len(first))
            if e == len(first):
                first.append(i)
        first, entry, contents = np.array(first, np.int64), np.array(entry, np.int64), list(seen)
        bucket = (key[first] % U(self.n)).astype(np.int64)
        for e in np.flatnonzero(alone[first]):  # single windows go by their own words
            bucket[e] = xxhash.xxh64_intdigest(contents[e]) % self.n
        return s, (q, m), contents, np.bincount(entry, minlength=len(first)), bucket, key[first], m[first], entry


def _least_in(x: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of x over [lo, hi) for each pair."""
    out = np.empty(len(lo), U)
    k = np.frexp((hi - lo).astype(np.float64))[1] - 1
    for level in range(int(k.max()) + 1):
        i = np.flatnonzero(k == level)
        out[i] = np.minimum(x[lo[i]], x[hi[i] - (1 << level)])
        step = 1 << level
        x = np.minimum(x[:-step], x[step:]) if len(x) > step else x
    return out


# -- passes ------------------------------------------------------------------------------------------------------------


def condense(pdf: pd.DataFrame):
    lengths, some, parts = np.zeros(len(pdf), np.int64), [], []
    for i, t in enumerate(pdf["_text"]):
        words = t.split()
        lengths[i] = len(words)
        some += words
        if len(some) >= 1 << 16 or i == len(pdf) - 1:  # few words are Python objects at a time
            parts.append(pa.array(some, pa.binary()))
            some = []
    coded = (pa.concat_arrays(parts) if parts else pa.array([], pa.binary())).dictionary_encode()
    state = (pdf["doc_id"].to_numpy(np.int64), pdf["_null"].to_numpy(bool), coded.dictionary.to_pylist(), coded.indices.to_numpy().astype(np.uint32), lengths)
    if "_json" in pdf:
        state += (list(pdf["_json"]), list(pdf["_none"]), list(pdf["_text"]))
    return state


def _ask_words(width, n):
    def run(chunk, state, got):
        w = Words(state, width, n, got, None)
        often = np.bincount(state[3], minlength=len(w.words)) > 1
        rows = [(b, chunk, len(i), b"\n".join([w.words[j] for j in i.tolist()]), np.packbits(often[i]).tobytes()) for b, i in C.by_bucket(w.bucket)]
        return pd.DataFrame(rows, columns=NAMES)

    return run


def _ask_blocks(width, n, round_):
    def run(chunk, state, got):
        w = Words(state, width, n, got, round_ - 1)
        found, of = _compact(w.parse.blocks(round_)[2])
        often = np.bincount(of, minlength=found.shape[1]) > 1
        rows = [(b, chunk, len(i), C.planes(found[:, i].ravel()), np.packbits(often[i]).tobytes()) for b, i in C.by_bucket(_bucket_of(found, n))]
        return pd.DataFrame(rows, columns=NAMES)

    return run


def _ask_pairs(width, n, rounds):
    def run(chunk, state, got):
        return Words(state, width, n, got, rounds).slices().send_keys(chunk, n, lambda of, k: np.bincount(of, minlength=k) > 1)

    return run


CONTENTS = ["_bucket", "_chunk", "names", "size", "key", "times"]


def _send_contents(width, n, rounds):
    def run(chunk, state, got):
        _, _, contents, times, bucket, key, m, _ = Words(state, width, n, got, rounds).entries(got)
        rows = []
        for b, i in C.by_bucket(bucket):
            names = np.frombuffer(b"".join([contents[j] for j in i.tolist()]), U)
            rows.append((b, chunk, C.planes(names), m[i].astype("u1").tobytes(), key[i].astype("<u4").tobytes(), np.minimum(times[i], 2).astype("u1").tobytes()))
        return pd.DataFrame(rows, columns=CONTENTS)

    return run


def settle(width: int):
    """Masks of the windows of each entry that occur more than once: contents are compared name by name."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        size = [len(x) for x in pdf["size"]]
        m = np.concatenate([np.frombuffer(x, "u1") for x in pdf["size"]]).astype(np.int64)
        key = np.concatenate([np.frombuffer(x, "<u4") for x in pdf["key"]])
        times = np.concatenate([np.frombuffer(x, "u1") for x in pdf["times"]]).astype(np.int64)
        data = np.concatenate([C.unplanes(x) for x in pdf["names"]])
        raw, end = data.tobytes(), np.cumsum(m + width - 1)
        seen: dict[bytes, int] = {}
        of, first = np.empty(len(m), np.int64), []
        for i, (a, z) in enumerate(zip((8 * (end - m - width + 1)).tolist(), (8 * end).tolist(), strict=True)):
            of[i] = seen.setdefault(raw[a:z], len(first))
            if of[i] == len(first):
                first.append(i)
        first = np.array(first, np.int64)
        total = np.bincount(of, weights=times).astype(np.int64)
        masks = np.where(total > 1, (U(1) << m[first].astype(U)) - U(1), U(0))
        _, k, per = np.unique(key[first], return_inverse=True, return_counts=True)
        open_ = np.flatnonzero(per[k] > 1)  # several contents around one pair
        if len(open_):
            count = m[first[open_]]
            long = count + width - 1
            whose = np.repeat(np.arange(len(open_)), count)
            at = np.cumsum(long) - long
            words = np.concatenate([data[z - x : z] for z, x in zip(end[first[open_]].tolist(), long.tolist(), strict=True)])
            number = C.window_numbers(np.unique(words, return_inverse=True)[1].astype(np.int64), width)
            j = np.arange(len(whose)) - np.repeat(np.cumsum(count) - count, count)
            mine = number[at[whose] + j]
            often = np.bincount(mine, weights=total[open_][whose])[mine] > 1
            np.bitwise_or.at(masks, open_[whose[often]], U(1) << j[often].astype(U))
        return C.reply(pdf, size, masks[of], VERIFY)

    return run


def _finish(width, n, rounds, report):
    def run(chunk, state, got):
        w = Words(state, width, n, got, rounds)
        s, (q, m), _, _, bucket, _, _, entry = w.entries(got)
        masks = C.answers(got, VERIFY, bucket, "<u8")[entry]
        return report(state, s, s.covered(len(w.names), q, m, masks))

    return run


def _kept_words(state, s, gone):
    """Number of words, number removed, and the words left, of each document."""
    for a, b in zip(s.starts.tolist(), s.ends.tolist(), strict=True):
        left = state[3][a:b][~gone[a:b]]
        yield b - a, b - a - len(left), b" ".join(map(state[2].__getitem__, left.tolist()))


def _digest(state, s, gone) -> pd.DataFrame:
    rows = [(i, null, n, k, hashlib.sha256(t).hexdigest()) for i, null, (n, k, t) in zip(state[0].tolist(), state[1].tolist(), _kept_words(state, s, gone), strict=True)]
    return pd.DataFrame(rows, columns=["doc_id", "_null", "n_words", "n_removed", "kept_sha256"])


def _documents(state, s, gone) -> pd.DataFrame:
    rows = [(j, None if none else t if k else text) for j, none, text, (_, k, t) in zip(*state[5:8], _kept_words(state, s, gone), strict=True)]
    return pd.DataFrame(rows, columns=["_json", "_kept"])


def _removed(docs: DataFrame, width: int, rounds: int, report, schema: str) -> DataFrame:
    """docs: doc_id, binary ``_text`` and what ``report`` passes on."""
    total = C.text_bytes(docs)
    n = C.sizes(total)
    rounds_ = C.Rounds(C.packed(docs, condense), total)
    rounds_.ask(_ask_words(width, n), NAMES, name_words)
    for r in range(1, rounds + 1):
        rounds_.ask(_ask_blocks(width, n, r), NAMES, name_blocks(r))
    rounds_.ask(_ask_pairs(width, n, rounds), C.Slices.COLUMNS, C.shared_keys(REVEAL))
    rounds_.ask(_send_contents(width, n, rounds), CONTENTS, settle(width))
    return rounds_.finish(_finish(width, n, rounds, report), schema)


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, rounds: int = ROUNDS) -> DataFrame:
    """One row a document: words removed, and a digest of those that are left."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("_text"))
    out = _removed(docs, width, rounds, _digest, OUT)
    return out.withColumn("doc_id", F.when(~F.col("_null"), F.col("doc_id"))).drop("_null")


#: All digits of a timestamp survive the way through JSON.
_JSON = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def substring_dedup_docs(docs: DataFrame, text_col: str = "text", width: int = WIDTH, rounds: int = ROUNDS) -> DataFrame:
    """The same columns and rows with the repeated windows cut out of the text (what is left joined by one space).

    A document that loses nothing keeps its text as it is, null included; one that loses every word is left empty.
    """
    cols = docs.columns
    rest = F.struct(*[F.col(f"`{c}`") for c in cols if c != text_col]) if len(cols) > 1 else F.struct(F.lit(0).alias("_none"))
    text = F.col(f"`{text_col}`")
    held = docs.select(F.lit(0).cast("long").alias("doc_id"), rest.alias("_rest"), text.isNull().alias("_none"), F.coalesce(text, F.lit("")).cast("binary").alias("_text"))
    flat = held.select("doc_id", "_text", F.to_json("_rest", {"ignoreNullFields": "false", **_JSON}).alias("_json"), "_none")
    schema = held.schema["_rest"].dataType
    out = _removed(flat, width, rounds, _documents, "_json string, _kept binary")
    out = out.select(F.from_json("_json", schema, _JSON).alias("_rest"), F.col("_kept").cast("string").alias("_kept"))
    return out.select(*[F.col("_kept").alias(c) if c == text_col else F.col(f"_rest.`{c}`").alias(c) for c in cols])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: All windows of 35 words, as strings, with the number of places where they start.
SQL = r"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, q, array_to_string(w[q:q + 34], ' ') AS s FROM d, LATERAL unnest(range(1, CAST(greatest(len(w) - 33, 1) AS BIGINT))) AS u(q)),
hit AS (SELECT r, q FROM win QUALIFY count(*) OVER (PARTITION BY s) > 1),
gone AS (SELECT DISTINCT r, q + j AS i FROM hit, LATERAL unnest(range(0, 35)) AS u(j)),
word AS (SELECT r, i, w[i] AS x FROM d, LATERAL unnest(range(1, CAST(len(w) + 1 AS BIGINT))) AS u(i)),
kept AS (SELECT r, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM word ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""
