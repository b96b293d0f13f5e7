"""Operator 5: removal of byte strings that an earlier document already holds, by longest previous factors.

A suffix order over every byte of the corpus would shuffle a record a byte, so the order is built in buckets, each of
which holds all suffixes that can match one another. Every window of 50 bytes chooses one anchor inside it by its
content alone (the 24-byte gram with the least hash), so equal windows choose the same gram at the same distance.

1.  Chunks of documents ask which grams other documents hold too; only those can start an earlier match.
2.  Stretches of text around shared anchors go to the bucket of their gram, once a chunk and content, with the least
    doc_id that holds them there. The bucket sorts all window starts by their bytes (a suffix order, cut at 50 bytes),
    takes common prefixes of neighbours, and from the previous and the next smaller document in that order gets each
    window's longest previous factor. Where it reaches 50 bytes, an earlier document has the whole window.
3.  Chunks remove what such windows cover. Everything is compared byte by byte; hashes only choose anchors and buckets.

A gram with over ``HOT`` different surroundings has its windows dealt out one by one, by their own bytes, so that no
bucket holds more than that many entries of one key, besides one entry a chunk for a content.

Null text counts as empty. A null doc_id counts as larger than any other. Rows with equal doc_id are not earlier than
each other. Documents of under 50 bytes lose nothing. Very long texts are one chunk, handled in bounded pieces. An empty
table gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline.llm import chunks as C
from anchorline.llm._common import table

WIDTH = 50
GRAM = 24
U = np.uint64
_LIFT = C.mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15))
OUT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    m, s = x, 1
    while 2 * s <= w:
        m = np.minimum(m[:-s], m[s:])
        s *= 2
    return np.minimum(m[: len(x) - w + 1], m[w - s :]) if s < w else m


def gram_hashes(b: np.ndarray, gram: int) -> np.ndarray:
    """A hash of each gram, by doubling: of halves of equal length, joined by a mixing step."""
    h, size = _LIFT[b], 1
    out, done = None, 0
    rest = gram
    while rest:
        if rest & 1:
            part = h if out is None else C.mix(out[: len(h) - done] * U(3) + h[done : done + len(out)])
            out, done = (part, done + size) if out is None else (part, done + size)
        rest >>= 1
        if rest:
            h = C.mix(h[:-size] * U(3) + h[size:])
            size *= 2
    return out[: len(b) - gram + 1]


def minimizers(x: np.ndarray, gram: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The gram with the least hash in each window, the leftmost of equals."""
    h = gram_hashes(x, gram)
    packed = sliding_min((h & ~C.LOW) | np.arange(len(h), dtype=U), width - gram + 1)
    at = (packed & C.LOW).astype(np.int64)
    return h[at], at


# -- suffix order and longest previous factors ---------------------------------------------------------------------


def suffix_order(text: np.ndarray, starts: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the suffixes at ``starts`` by their first ``depth`` bytes, and the common prefix with the one before."""
    rows = np.lib.stride_tricks.sliding_window_view(text, depth)[starts]
    padded = np.zeros((len(starts), -(-depth // 8) * 8), np.uint8)
    padded[:, :depth] = rows
    words = padded.view(">u8").astype(U)
    order = np.lexsort(words.T[::-1])
    lcp = np.zeros(len(starts), np.int64)
    for a in range(1, len(order), 1 << 16):
        b = min(a + (1 << 16), len(order))
        differ = rows[order[a:b]] != rows[order[a - 1 : b - 1]]
        lcp[a:b] = np.where(differ.any(1), differ.argmax(1), depth)
    return order, lcp


def previous_smaller(v: np.ndarray) -> np.ndarray:
    """Position of the nearest smaller value before each, -1 if none: descent in a table of minima."""
    n = len(v)
    table_ = [v]
    while 1 << len(table_) <= n:
        m, s = table_[-1], 1 << (len(table_) - 1)
        table_.append(np.minimum(m[:-s], m[s:]))
    at = np.arange(n)  # all of [at, i) is known not to be smaller
    for k in range(len(table_) - 1, -1, -1):
        ok = at >= 1 << k
        i = np.flatnonzero(ok)
        i = i[table_[k][at[i] - (1 << k)] >= v[i]]
        at[i] -= 1 << k
    return at - 1


def least_between(lcp: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Minimum of lcp over (lo, hi] for each pair with lo < hi."""
    table_ = [lcp]
    while 1 << len(table_) <= len(lcp):
        m, s = table_[-1], 1 << (len(table_) - 1)
        table_.append(np.minimum(m[:-s], m[s:]))
    out = np.zeros(len(lo), np.int64)
    k = np.frexp((hi - lo).astype(np.float64))[1] - 1
    for level in np.unique(k):
        i = np.flatnonzero(k == level)
        out[i] = np.minimum(table_[level][lo[i] + 1], table_[level][hi[i] + 1 - (1 << int(level))])
    return out


def longest_previous_factor(lcp: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """In suffix order: the longest match of each suffix with one of a smaller document.

    It is with the previous or the next suffix of a smaller document; all between have no smaller one.
    """
    n = len(doc)
    if not n:
        return np.zeros(0, np.int64)
    i = np.arange(n)
    before = previous_smaller(doc)
    after = n - 1 - previous_smaller(doc[::-1])[::-1]
    out = np.zeros(n, np.int64)
    ok = before >= 0
    out[ok] = least_between(lcp, before[ok], i[ok])
    ok = after < n
    out[ok] = np.maximum(out[ok], least_between(lcp, i[ok], after[ok]))
    return out


# -- chunks and buckets ----------------------------------------------------------------------------------------------


class Texts:
    """The documents of one chunk: bytes end to end, ranks of their ids (null last)."""

    def __init__(self, state, width: int):
        self.ids, self.null, texts = state
        self.text = b"".join(texts)
        self.data = np.frombuffer(self.text, np.uint8)
        order = np.lexsort((self.ids, self.null))
        new = np.ones(len(order), bool)
        new[1:] = (self.ids[order][1:] != self.ids[order][:-1]) | (self.null[order][1:] != self.null[order][:-1])
        self.rank = np.empty(len(order), np.int64)
        self.rank[order] = np.cumsum(new) - 1
        self.of_rank = order[new]  # a row with that rank
        self.width, self.gram = width, min(max(GRAM, width - C.MOST), width)
        self.slices = C.Slices(len(self.data), np.array([len(t) for t in texts], np.int64), width, self._anchors)

    def _anchors(self, q):
        a, b = int(q[0]), int(q[-1]) + self.width
        key, at = minimizers(self.data[a:b], self.gram, self.width)
        return key[q - a] | U(1), at[q - a] + a

    def several(self, of, n):
        """Keys that two documents of the chunk hold."""
        rank = self.rank[self.slices.doc]
        least, most = np.full(n, 1 << 62), np.full(n, -1)
        np.minimum.at(least, of, rank)
        np.maximum.at(most, of, rank)
        return least < most

    def entries(self, got, n):
        """Units; contents by entry with least rank, bucket and number of windows; the entry of each unit."""
        q, m, key, doc, alone = self.slices.units(got, n, 0)
        rank, text, width = self.rank[doc].tolist(), self.text, self.width - 1
        seen: dict[bytes, int] = {}
        entry, least, first = [0] * len(q), [], []
        for i, (a, z) in enumerate(zip(q.tolist(), (q + m + width).tolist(), strict=True)):
            content = text[a:z]
            e = seen.setdefault(content, len(least))
            if e == len(least):
                least.append(rank[i])
                first.append(i)
            elif rank[i] < least[e]:
                least[e] = rank[i]
            entry[i] = e
        contents = list(seen)
        first = np.array(first, np.int64)
        bucket = (key[first] % U(n)).astype(np.int64)
        for e in np.flatnonzero(alone[first]):  # single windows go by their own bytes
            bucket[e] = xxhash.xxh64_intdigest(contents[e]) % n
        return (q, m, doc), contents, np.array(least, np.int64), bucket, m[first], np.array(entry, np.int64)


def _condense(pdf: pd.DataFrame):
    return pdf["doc_id"].to_numpy(np.int64), pdf["_null"].to_numpy(bool), list(pdf["_text"])


def _ask_keys(width, n):
    def run(chunk, state, got):
        x = Texts(state, width)
        return x.slices.send_keys(chunk, n, x.several)

    return run


TEXTS = "_bucket long, _chunk long, text binary, size binary, id binary, null binary"


def _send_texts(width, n):
    def run(chunk, state, got):
        x = Texts(state, width)
        _, contents, least, bucket, m, _ = x.entries(got, n)
        row = x.of_rank[least]
        rows = [(b, chunk, b"".join([contents[j] for j in i.tolist()]), m[i].astype("u1").tobytes(), C.planes(x.ids[row[i]]), np.packbits(x.null[row[i]]).tobytes()) for b, i in C.by_bucket(bucket)]
        return pd.DataFrame(rows, columns=["_bucket", "_chunk", "text", "size", "id", "null"])

    return run


def settle(width: int):
    """Masks of the windows of each entry that an earlier document holds."""
    gram = min(max(GRAM, width - C.MOST), width)

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        size = [len(x) for x in pdf["size"]]
        m = np.concatenate([np.frombuffer(x, "u1") for x in pdf["size"]]).astype(np.int64)
        ids = np.concatenate([C.unplanes(x) for x in pdf["id"]]).view(np.int64)
        null = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8))[:s] for x, s in zip(pdf["null"], size, strict=True)])
        order = np.lexsort((ids, null))
        new = np.ones(len(order), bool)
        new[1:] = (ids[order][1:] != ids[order][:-1]) | (null[order][1:] != null[order][:-1])
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new) - 1
        # equal contents are one text of the order, with the least document that holds it
        seen: dict[bytes, int] = {}
        of, text = np.empty(len(m), np.int64), b"".join(pdf["text"])
        end = np.cumsum(m + width - 1)
        for i, (a, z) in enumerate(zip((end - m - width + 1).tolist(), end.tolist(), strict=True)):
            of[i] = seen.setdefault(text[a:z], len(seen))
        contents = list(seen)
        least = np.full(len(contents), 1 << 62, np.int64)
        np.minimum.at(least, of, rank)
        count = np.array([len(c) for c in contents], np.int64) - width + 1
        data = np.frombuffer(b"".join(contents), np.uint8)
        at = np.cumsum(count + width - 1) - count - width + 1
        own = np.zeros(len(contents), U)
        # of contents with one anchor gram, only those can match an earlier document that differ in their least one
        grams = at[:, None] + np.arange(width - gram + 1)
        h = gram_hashes(data, gram)
        key = np.take_along_axis(h[grams], (h[grams] & ~C.LOW).argmin(1)[:, None], 1)[:, 0]
        _, key = np.unique(key, return_inverse=True)
        low, high = np.full(len(contents), 1 << 62), np.full(len(contents), -1)
        np.minimum.at(low, key, least)
        np.maximum.at(high, key, least)
        open_ = np.flatnonzero((low < high)[key])
        if len(open_):
            many = count[open_]
            start = np.repeat(at[open_] - np.cumsum(many) + many, many) + np.arange(many.sum())
            whose = np.repeat(open_, many)
            order, lcp = suffix_order(data, start, width)
            factor = longest_previous_factor(lcp, least[whose[order]])
            hit = order[factor >= width]
            np.bitwise_or.at(own, whose[hit], U(1) << (start[hit] - at[whose[hit]]).astype(U))
        full = (U(1) << m.astype(U)) - U(1)
        return C.reply(pdf, size, np.where(rank > least[of], full, own[of]), 1)

    return run


def _finish(width, n, report):
    def run(chunk, state, got):
        x = Texts(state, width)
        (q, m, doc), _, least, bucket, _, entry = x.entries(got, n)
        masks = C.answers(got, 1, bucket, "<u8")[entry]
        masks[x.rank[doc] > least[entry]] = ~U(0)  # an earlier document of the chunk has the same
        masks &= (U(1) << m.astype(U)) - U(1)
        return report(x, x.slices.covered(len(x.data), q, m, masks))

    return run


def _digest(x, gone) -> pd.DataFrame:
    rows = []
    for i, null, a, b in zip(x.ids.tolist(), x.null.tolist(), x.slices.starts.tolist(), x.slices.ends.tolist(), strict=True):
        g = gone[a:b]
        n = int(np.count_nonzero(g))
        runs = int(g[0]) + int(np.count_nonzero(g[1:] & ~g[:-1])) if n else 0
        kept = x.data[a:b][~g].tobytes() if n else x.text[a:b]
        rows.append((i, null, b - a, n, runs, hashlib.sha256(kept).hexdigest()))
    return pd.DataFrame(rows, columns=["doc_id", "_null", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _kept(x, gone) -> pd.DataFrame:
    kept = [x.data[a:b][~gone[a:b]].tobytes() for a, b in zip(x.slices.starts, x.slices.ends, strict=True)]
    return pd.DataFrame({"doc_id": x.ids, "_null": x.null, "kept": kept})


def _removed(docs: DataFrame, id_col: str, text_col: str, width: int, report, schema: str) -> DataFrame:
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary").alias("_text"))
    n = C.sizes(C.text_bytes(docs))
    state = C.packed(docs, _condense).repartition("_chunk")
    asked = C.each(state, _ask_keys(width, n), C.Slices.KEYS)
    shared = C.mail(asked.groupBy("_bucket").applyInPandas(C.shared_keys(0), C.REPLY))
    sent = C.with_replies(state, [shared], _send_texts(width, n), TEXTS)
    told = C.mail(sent.groupBy("_bucket").applyInPandas(settle(width), C.REPLY))
    out = C.with_replies(state, [shared, told], _finish(width, n, report), schema)
    return out.withColumn("doc_id", F.when(~F.col("_null"), F.col("doc_id"))).drop("_null")


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """One row a document: what was removed, and a digest of what is left."""
    return _removed(docs, id_col, text_col, width, _digest, "doc_id long, _null boolean, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def suffix_dedup_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """The bytes that are left: doc_id, kept binary (a cut may fall inside a character)."""
    return _removed(docs, id_col, text_col, width, _kept, "doc_id long, _null boolean, kept binary")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))


#: Every 50-byte window of every text, as hexadecimal digits, with the least document that holds it.
SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
part AS (SELECT doc_id, 250 * k AS a, substr(h, 500 * k + 1, 598) AS p FROM d, LATERAL unnest(range(0, CAST(len(h) // 500 + 1 AS BIGINT))) AS u(k)),
w AS (SELECT doc_id, a + j AS q, substr(p, 2 * j + 1, 100) AS s FROM part, LATERAL unnest(range(0, greatest(0, CAST(len(p) // 2 - 49 AS BIGINT)))) AS u(j)),
least AS (SELECT s, min(doc_id) AS first_id FROM w GROUP BY s HAVING count(DISTINCT doc_id) > 1),
hit AS (SELECT w.doc_id, w.q FROM w JOIN least USING (s) WHERE w.doc_id > least.first_id),
step AS (SELECT doc_id, q, lag(q) OVER (PARTITION BY doc_id ORDER BY q) AS p FROM hit),
span AS (SELECT doc_id, q, sum(CASE WHEN p IS NULL OR q > p + 50 THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id ORDER BY q) AS k FROM step),
run AS (SELECT doc_id, k, min(q) AS a, max(q) + 50 AS b FROM span GROUP BY doc_id, k),
gap AS (SELECT doc_id, a, b, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS next_a, row_number() OVER (PARTITION BY doc_id ORDER BY a) AS k FROM run),
kept AS (
  SELECT d.doc_id, string_agg(substr(h, 2 * b + 1, 2 * (coalesce(next_a, len(h) // 2) - b)), '' ORDER BY a) AS tail, min(a) AS first_a, sum(b - a) AS gone, count(*) AS spans
  FROM gap JOIN d USING (doc_id) GROUP BY d.doc_id
)
SELECT d.doc_id, CAST(len(h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, CAST(coalesce(spans, 0) AS BIGINT) AS n_spans,
  sha256(unhex(CASE WHEN gone IS NULL THEN h ELSE substr(h, 1, 2 * first_a) || tail END)) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""
