"""Chunks of documents that talk to buckets of keys: how the two operators on repeated passages are spread.

``packed`` cuts the rows of each input partition, in their order, into chunks of bounded bytes (a longer document is a
chunk of its own), compresses them and deals them out; all later passes read that one exchange. A pass sends rows
``(_bucket, _chunk, ...)``, one for each bucket that a chunk has something for, and buckets reply ``(_chunk, stage,
_bucket, codes)``: a code for each entry, in the order in which the chunk sent them. A common passage or key costs one
entry a chunk, whatever the number of documents that hold it.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.llm._common import give_back

U = np.uint64
#: Positions handled at once inside a chunk.
PIECE = 1 << 19
CHUNK_BYTES = 4 << 20
#: Slices of one key, over all chunks, beyond which its windows are dealt out one by one.
HOT = 1 << 16
#: The bits of a hash that give way to a position below 2 * PIECE, the same in all chunks.
LOW = U(4 * PIECE - 1)
#: Windows of one slice at most, so that a code is one 64-bit mask.
MOST = 60
REPLY = "_chunk long, stage int, _bucket long, codes binary"


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them (for order and placement, never for equality)."""
    h = h ^ (h >> U(30))
    h = h * U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


def window_numbers(names: np.ndarray, width: int) -> np.ndarray:
    """A number for the window at each position, equal for equal windows only: that of its two halves, which may overlap."""
    x, size = names, 1
    while size < width:
        step = min(size, width - size)
        x = np.unique(x[:-step] * (int(x.max()) + 1) + x[step:], return_inverse=True)[1].astype(np.int64)
        size += step
    return x


def planes(v: np.ndarray) -> bytes:
    """Bytes of the same rank together, which shuffle compression shortens."""
    return np.ascontiguousarray(v.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unplanes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view("<u8").ravel()


def freeze(x) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps(x, protocol=5))


def thaw(b: bytes):
    return pickle.loads(zstandard.ZstdDecompressor().decompress(b))


def text_bytes(docs: DataFrame) -> int:
    """Bytes of the texts, counted: estimates of compressed or joined tables say little."""
    return docs.agg(F.sum(F.octet_length("_text").cast("long"))).first()[0] or 0


def packed(docs: DataFrame, condense: Callable, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """docs: nullable doc_id, binary ``_text``, other columns -> ``_chunk``, ``pack`` (what ``condense`` makes of some rows)."""

    def run(batches):
        part, n = TaskContext.get().partitionId(), 0
        give_back()  # what the stage before left in this worker
        for batch in batches:
            size = pc.binary_length(batch.column("_text")).to_numpy().astype(np.int64)
            group = (np.cumsum(size) - size) // chunk_bytes
            edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])) if len(size) else []
            for a, b in zip(edges[:-1], edges[1:], strict=True):  # only one chunk's texts are Python objects at a time
                pack = freeze(condense(batch.slice(a, b - a).to_pandas()))
                yield pa.RecordBatch.from_arrays([pa.array([(part << 32) | n], pa.int64()), pa.array([pack], pa.binary())], names=["_chunk", "pack"])
                n += 1
                del pack
                give_back()  # workers wait idle while the rounds have workers of their own

    flat = docs.withColumn("_null", F.col("doc_id").isNull()).withColumn("doc_id", F.coalesce("doc_id", F.lit(0)).cast("long"))
    return flat.mapInArrow(run, "_chunk long, pack binary")


def sizes(total: int, chunk_bytes: int = CHUNK_BYTES) -> int:
    """Number of buckets: it grows with the input, so a bucket does not."""
    return int(max(8, -(-total // chunk_bytes)))


def each(state: DataFrame, fn: Callable, schema: str) -> DataFrame:
    return state.groupBy("_chunk").applyInPandas(lambda pdf: fn(int(pdf["_chunk"].iloc[0]), thaw(pdf["pack"].iloc[0]), {}), schema)


def mail(told: DataFrame) -> DataFrame:
    """Replies of one stage, one row a chunk: their exchange is made once, whatever the number of passes that read it."""
    return told.groupBy("_chunk").agg(F.collect_list(F.struct("stage", "_bucket", "codes")).alias("_mail"))


def with_replies(state: DataFrame, mails: list[DataFrame], fn: Callable, schema: str) -> DataFrame:
    """fn(chunk, state, {(stage, bucket): codes}) for each chunk; both sides are dealt by chunk already."""
    names = [f"_m{i}" for i in range(len(mails))]
    for name, m in zip(names, mails, strict=True):
        state = state.join(m.withColumnRenamed("_mail", name).hint("merge"), "_chunk", "left")

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        row = pdf.iloc[0]
        got = {(m["stage"], m["_bucket"]): m["codes"] for name in names if row[name] is not None for m in row[name]}
        return fn(int(row["_chunk"]), thaw(row["pack"]), got)

    return state.groupBy("_chunk").applyInPandas(run, schema)


#: Bytes of texts in one partition of ``Rounds``, and most partitions.
PART_BYTES, MOST_PARTS = 16 << 20, 100_000


def _place(key: int) -> int:
    """Where a chunk or bucket lies (one function object, so that all of one side lie alike)."""
    return (key >> 32) * 31 + (key & 0xFFFFFFFF)


class Rounds:
    """Questions and replies over many rounds, each of which needs the replies of all before.

    As one tree of frames this would double with every round, and as a job a round it would deal the chunks out again
    each time. Shuffles of RDDs are kept instead: chunks and the replies of each round are dealt out once, by chunk,
    and every later round reads them where they lie; what an executor loses is made again from its lineage.
    Spark keeps shuffles as long as a result can be read. ``release`` deletes those of results that are no longer needed.
    """

    #: The JVM's RDDs below finished results, held weakly: Spark cleans up after results that are gone.
    finished: list = []

    def __init__(self, state: DataFrame, total: int):
        self.spark = state.sparkSession
        self.parts = int(np.clip(-(-total // PART_BYTES), 8, MOST_PARTS))
        self.state = state.rdd.map(tuple).partitionBy(self.parts, _place)
        self.parts = self.state.getNumPartitions()  # all of the following must lie alike
        self.told: list = []

    def each(self, fn: Callable):
        """Rows of fn(chunk, state, {(stage, bucket): codes}), a frame, for each chunk."""

        def run(rows):
            mail: dict[int, dict] = {}
            for chunk, x in rows:  # replies come before chunks
                if isinstance(x, tuple):
                    mail.setdefault(chunk, {})[x[0], x[1]] = x[2]
                else:
                    yield from fn(chunk, thaw(x), mail.pop(chunk, {})).itertuples(index=False, name=None)
                    give_back()

        self.read = self.spark.sparkContext.union([*self.told, self.state])
        assert self.read.getNumPartitions() == self.parts
        return self.read.mapPartitions(run)

    def ask(self, fn: Callable, columns: list[str], settle: Callable) -> None:
        """fn: rows (bucket, chunk, ...) of each chunk; settle: replies of one bucket to its rows."""

        def settled(rows):
            held: dict[int, list] = {}
            for b, row in rows:
                held.setdefault(b, []).append((b, *row))
            for b in list(held):
                for chunk, stage, b_, codes in settle(pd.DataFrame(held.pop(b), columns=columns)).itertuples(index=False, name=None):
                    yield chunk, (stage, b_, codes)

        asked = self.each(fn).map(lambda r: (r[0], r[1:])).partitionBy(self.parts, _place)
        self.told.append(asked.mapPartitions(settled).partitionBy(self.parts, _place))

    def finish(self, fn: Callable, schema: str) -> DataFrame:
        out = self.spark.createDataFrame(self.each(fn), schema, verifySchema=False)
        Rounds.finished.append(self.spark._jvm.java.lang.ref.WeakReference(self.read._jrdd.rdd()))
        return out

    @classmethod
    def release(cls) -> None:
        """Deletes the shuffles of all finished results; one that is read again is made again from its lineage."""
        while cls.finished:
            rdd = cls.finished.pop().get()
            if rdd is not None:
                rdd.cleanShuffleDependencies(True)


def by_bucket(bucket: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(bucket, entries that go there, in order)."""
    if not len(bucket):
        return []
    small = bucket.astype(np.uint16) if int(bucket.max()) < 1 << 16 else bucket  # 16 bits are sorted by counting
    order = np.argsort(small, kind="stable")
    b = bucket[order]
    at = np.flatnonzero(np.concatenate([[True], b[1:] != b[:-1]]))
    return [(int(b[i]), order[i:j]) for i, j in zip(at, [*at[1:], len(b)], strict=True)]


def answers(got: dict, stage: int, bucket: np.ndarray, dtype: str) -> np.ndarray:
    """The codes of a chunk's entries, 0 where a bucket had nothing to say."""
    out = np.zeros(len(bucket), dtype)
    for b, i in by_bucket(bucket):
        if (stage, b) in got:
            out[i] = unplanes(got[stage, b]).astype(dtype) if dtype == "<u8" else np.frombuffer(got[stage, b], dtype)
    return out


def reply(pdf: pd.DataFrame, size: list[int], codes: np.ndarray, stage: int) -> pd.DataFrame:
    edges = np.concatenate([[0], np.cumsum(size)])
    wide = codes.dtype == np.uint64
    rows = [
        (int(c), stage, int(b), planes(codes[x:y]) if wide else codes[x:y].tobytes())
        for c, b, x, y in zip(pdf["_chunk"], pdf["_bucket"], edges[:-1], edges[1:], strict=True)
        if codes[x:y].any()
    ]
    return pd.DataFrame(rows, columns=["_chunk", "stage", "_bucket", "codes"])


class Slices:
    """Maximal stretches of windows that chose the same anchor: first window, number of windows, key, document."""

    def __init__(self, n: int, lengths: np.ndarray, width: int, anchors: Callable, alone: np.ndarray | None = None):
        """anchors(windows) -> keys and positions of the anchors of the windows that start there, in order; key 0: none.

        ``alone``: symbols that no other place holds, whose windows are left out.
        """
        gone = None if alone is None else np.concatenate([[0], np.cumsum(alone)])
        self.width, self.ends = width, np.cumsum(lengths)
        self.starts = self.ends - lengths
        found = [[np.zeros(0, np.int64)] * 2 + [np.zeros(0, U)] + [np.zeros(0, np.int64)]]
        for a in range(0, max(0, n - width + 1), PIECE):
            b = min(a + PIECE, n - width + 1)
            q = np.arange(a, b)
            lo, hi = np.searchsorted(self.ends, [a, b - 1], side="right")
            cut = np.clip(self.ends[lo : hi + 1], a, b)
            doc = np.repeat(np.arange(lo, hi + 1), np.diff(cut, prepend=a))
            valid = self.ends[doc] - q >= width
            if gone is not None:
                valid &= gone[q + width] == gone[q]
            q, doc = q[valid], doc[valid]
            if not len(q):
                continue
            key, at = anchors(q)
            if not key.all():
                q, doc, at, key = q[key != 0], doc[key != 0], at[key != 0], key[key != 0]
                if not len(q):
                    continue
            part = (at - q) // MOST  # wide windows: slices are cut by the distance to the anchor, which equal windows share
            new = np.ones(len(q), bool)
            new[1:] = (at[1:] != at[:-1]) | (doc[1:] != doc[:-1]) | (q[1:] != q[:-1] + 1) | (part[1:] != part[:-1])
            first = np.flatnonzero(new)
            found.append([q[first], np.diff(np.append(first, len(q))), mix(key[first] ^ part[first].astype(U)), doc[first]])
        self.q, self.m, self.key, self.doc = (np.concatenate(c) for c in zip(*found, strict=True))

    def keys(self):
        """Distinct keys, the key number of each slice."""
        return np.unique(self.key, return_inverse=True)

    def send_keys(self, chunk: int, n: int, several: Callable) -> pd.DataFrame:
        """First question: which keys does anyone else hold? 32 bits a key inside its bucket; ``several(key number)``: held twice here."""
        uniq, of = self.keys()
        count = np.bincount(of, minlength=len(uniq))
        flag = several(of, len(uniq))
        rows = [
            (b, chunk, (uniq[i] // U(n)).astype("<u4").tobytes(), np.minimum(count[i], HOT + 1).astype("<u4").tobytes(), np.packbits(flag[i]).tobytes())
            for b, i in by_bucket((uniq % U(n)).astype(np.int64))
        ]
        return pd.DataFrame(rows, columns=self.COLUMNS)

    COLUMNS = ["_bucket", "_chunk", "k", "c", "f"]
    KEYS = "_bucket long, _chunk long, k binary, c binary, f binary"

    def units(self, got: dict, n: int, stage: int):
        """What is compared: slices of keys that others hold, and the single windows of keys that very many hold.

        First window, number of windows, key, document, and whether it is a single window of a hot key.
        """
        uniq, of = self.keys()
        code = answers(got, stage, (uniq % U(n)).astype(np.int64), "u1")[of]
        whole, hot = np.flatnonzero(code == 1), np.flatnonzero(code == 2)
        m = self.m[hot]
        q = np.repeat(self.q[hot] - np.cumsum(m) + m, m) + np.arange(m.sum())
        again = np.repeat(hot, m)
        at = np.concatenate([whole, again])
        return np.concatenate([self.q[whole], q]), np.concatenate([self.m[whole], np.ones(len(q), np.int64)]), self.key[at], self.doc[at], np.arange(len(at)) >= len(whole)

    def covered(self, n: int, q: np.ndarray, m: np.ndarray, masks: np.ndarray) -> np.ndarray:
        """Which symbols the marked windows of the units cover."""
        full = (U(1) << m.astype(U)) - U(1)
        whole = masks == full
        starts, ends = [q[whole]], [q[whole] + m[whole] + self.width - 1]
        for i in range(int(m.max(initial=0))):
            p = q[~whole & ((masks >> U(i)) & U(1) == 1)] + i
            starts.append(p)
            ends.append(p + self.width)
        diff = np.bincount(np.concatenate(starts), minlength=n + 1).astype(np.int32)
        diff -= np.bincount(np.concatenate(ends), minlength=n + 1).astype(np.int32)
        return np.cumsum(diff[:n]) > 0


def shared_keys(stage: int):
    """Replies to ``send_keys``: 1 where a key occurs elsewhere, 2 where very many slices have it."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        size = [len(x) // 4 for x in pdf["k"]]
        k = np.concatenate([np.frombuffer(x, "<u4") for x in pdf["k"]])
        c = np.concatenate([np.frombuffer(x, "<u4") for x in pdf["c"]]).astype(np.int64)
        f = np.concatenate([np.unpackbits(np.frombuffer(x, np.uint8))[:s] for x, s in zip(pdf["f"], size, strict=True)])
        order = np.argsort(k, kind="stable")
        new = np.ones(len(k), bool)
        new[1:] = k[order][1:] != k[order][:-1]
        at = np.flatnonzero(new)
        held = (np.diff(np.append(at, len(k))) > 1) | (np.add.reduceat(f[order], at) > 0)
        many = np.add.reduceat(c[order], at) > HOT
        codes = np.empty(len(k), np.uint8)
        codes[order] = np.where(many, 2, 1).astype(np.uint8)[np.cumsum(new) - 1] * held[np.cumsum(new) - 1]
        return reply(pdf, size, codes, stage)

    return run
