"""Operator 10: SentencePiece encoding and decoding by a streaming Viterbi over a given vocabulary.

The lattice has a node at each character boundary and an edge for each vocabulary piece (single characters
outside the vocabulary fall back to bytes). In a BPE vocabulary an edge survives at a boundary only if the
merge order would leave it beside the piece that survives where it starts (``compatible``); exactly one does,
so each boundary keeps one backpointer and the path is the one that merging by score gives. The forward pass
holds backpointers for no more than the longest piece, plus what is not committed yet: whenever the paths of
all boundaries in that window meet, ids up to there are committed and forgotten. No piece goes on with a
space mark after another character, so all paths meet before each such mark: what stands between two of them
is encoded once and kept in a cache of bounded size.

The result equals the library's own encoding; tests compare them. Null text gives null ids and a null
decoding; empty text no ids. Decoding gives back every text except that a space mark (U+2581) in it becomes
a space. Repeated rows are kept. U+0000 is encoded by its byte piece like any other character outside the vocabulary.
A very long text is encoded in one worker, which holds its ids (four bytes each) until the row is written. An empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline.llm._common import table

MARK = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Entries of each of the two generations of a worker's cache.
CACHE = 200_000
_SEGMENT = re.compile(f"\n|{MARK}*[^{MARK}\n]+|{MARK}+")
INF = 1 << 60


def _little(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}i", *ids)


class Vocabulary:
    """Pieces, their merge order and their ids; plain data that is shipped to the workers."""

    def __init__(self, pieces: list[tuple[str, float, int]]):
        self.ids = {p: i for i, (p, _, kind) in enumerate(pieces) if kind == 1}
        self.byte = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == 6}
        self.unknown = next(i for i, (_, _, kind) in enumerate(pieces) if kind == 2)
        marks = {len(p) for p in self.ids if set(p) == {MARK}}
        self.marks = marks | {1}
        if any(MARK in p.lstrip(MARK) or (p.startswith(MARK * 2) and set(p) != {MARK}) for p in self.ids):
            raise ValueError("pieces with a space mark after another character are not supported")
        #: rank of each piece of two characters or more, space runs apart; less is merged earlier
        merged = sorted((p for p in self.ids if len(p) > 1 and set(p) != {MARK}), key=lambda p: (-pieces[self.ids[p]][1], self.ids[p]))
        self.rank = {p: r for r, p in enumerate(merged)}
        self.longest = max(map(len, self.ids))
        self.decoded = [b"" if kind in (2, 3) else bytes([int(p[3:5], 16)]) if kind == 6 else p.replace(MARK, " ").encode() for p, _, kind in pieces]
        self.split: dict[str, tuple[str, str]] = {}
        for p in merged:
            parts = self._merge(p)
            if parts:
                self.split[p] = parts
        self.rank = {p: r for p, r in self.rank.items() if p in self.split}
        self.pair: dict[tuple[str, str], bool] = {}
        self.tails = {p[i:] for p in self.rank for i in range(len(p))}
        #: neighbours inside some piece; the paths meet between any others
        self.joined = {p[i : i + 2] for p in self.rank for i in range(len(p) - 1)}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        from sentencepiece import sentencepiece_model_pb2 as pb

        model = pb.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        n = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or n.precompiled_charsmap or not n.add_dummy_prefix or n.remove_extra_whitespaces:
            raise ValueError("a BPE model without normalisation is asked for")
        return cls([(p.piece, p.score, p.type) for p in model.pieces])

    def _merge(self, piece: str) -> tuple[str, str] | None:
        """The last merge that makes the piece; None if merging never does."""
        parts = list(piece)
        while len(parts) > 2:
            r, i = min(((self.rank.get(a + b, INF), i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False))))
            if r == INF:
                return None
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def compatible(self, a: str, b: str) -> bool:
        """Whether merging leaves the two as neighbours: undo their merges, latest first, and see if one across came earlier."""
        rank, split, limit = self.rank, self.split, INF
        while True:
            if rank.get(a + b, INF) < limit:
                return False
            ra, rb = rank.get(a, -1), rank.get(b, -1)
            if ra > rb:
                limit, a = ra, split[a][1]
            elif rb >= 0:
                limit, b = rb + 1, split[b][0]
            else:
                return True

    def viterbi(self, text: str, window: int = 64) -> list[str]:
        """Pieces of one stretch; commits whenever all surviving paths meet."""
        rank, pair, longest, tails = self.rank, self.pair, self.longest, self.tails
        out: list[str] = []
        base = 0  # boundary up to which pieces are committed
        last: list[str] = [""]  # surviving piece at boundary base + i
        for end in range(1, len(text) + 1):
            at = end - 1
            p = last[-1] + text[at]  # one survives: if the piece before, one longer, does, no other is looked at
            if p in rank:
                before = last[end - len(p) - base]
                if not before or pair.get((before, p)):
                    last.append(p)
                    continue
            p = text[at]
            while True:  # longer and longer pieces that end here, as long as any piece ends so
                if at == end - 1 or p in rank:
                    before = last[at - base]
                    if not before:
                        break
                    ok = pair.get((before, p))
                    if ok is None:
                        if len(pair) > 2 * CACHE:
                            pair.clear()
                        ok = pair[before, p] = self.compatible(before, p)
                    if ok:
                        break
                at -= 1
                p = text[at:end]
                if at < base or p not in tails:
                    raise AssertionError(f"no piece survives at {end} of {text!r}")
            last.append(p)
            if len(last) > window + longest:
                meet = self._meet(last)
                if meet > 1:
                    out += self._trace(last, meet)
                    base += meet
                    # the piece that ends there still decides what may follow
                    last = last[meet:]
                    if out and not last[0]:
                        last[0] = out[-1]
        return out + self._trace(last, len(last) - 1)

    def _meet(self, last: list[str]) -> int:
        open_ = set(range(len(last) - self.longest, len(last)))
        while len(open_) > 1:
            top = max(open_)
            open_.remove(top)
            open_.add(max(0, top - len(last[top])))
        return open_.pop()

    @staticmethod
    def _trace(last: list[str], end: int) -> list[str]:
        out = []
        while end > 0:
            out.append(last[end])
            end -= len(last[end])
        return out[::-1]

    def run(self, n: int) -> list[int]:
        """Lengths of the pieces of n space marks: equal scores, so the leftmost pair merges first."""
        out = []
        while n:
            now = 1
            while True:
                if now + 1 <= n and now + 1 in self.marks:
                    now += 1
                    continue
                next_ = 1
                while now + next_ + 1 <= n and next_ + 1 in self.marks and now + next_ not in self.marks:
                    next_ += 1
                if now + next_ <= n and now + next_ in self.marks:
                    now += next_
                    continue
                break
            out.append(now)
            n -= now
        return out

    def cuts(self, s: str) -> list[str]:
        """Parts between neighbours that no piece has side by side (a run of space marks stays whole)."""
        joined, out, at = self.joined, [], 0
        if s.lstrip(MARK).isalpha():  # letters rarely part, and need not
            return [s]
        for i in range(1, len(s)):
            if s[i - 1 : i + 1] not in joined and s[i] != MARK and s[i - 1] != MARK:
                out.append(s[at:i])
                at = i
        out.append(s[at:])
        return out

    def segment(self, s: str) -> bytes:
        """Ids of one cached stretch as little-endian 32-bit numbers."""
        body = s.lstrip(MARK)
        marks = len(s) - len(body)
        parts: list[str] = []
        if body:
            parts = self.viterbi(MARK * min(1, marks) + body)
            if marks:
                if parts[0] == MARK:
                    parts = parts[1:]
                else:
                    marks -= 1
        if marks:
            parts = [MARK * k for k in self.run(marks)] + parts
        ids = [self.ids.get(p) for p in parts]
        if None in ids:
            ids = [i for p, known in zip(parts, ids, strict=True) for i in ([known] if known is not None else [self.byte[c] for c in p.encode()] if self.byte else [self.unknown])]
        return _little(ids)


class Encoder:
    """A vocabulary with a cache of two generations."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.young, self.old = vocabulary, {}, {}

    def __call__(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, "<i4")
        segments = _SEGMENT.findall(MARK + text.replace(" ", MARK))
        try:
            return np.frombuffer(b"".join(map(self.young.__getitem__, segments)), "<i4")
        except KeyError:
            return np.frombuffer(b"".join(map(self._get, segments)), "<i4")

    def _get(self, s: str) -> bytes:
        got = self.young.get(s)
        if got is None:
            got = self.old.get(s)
            if got is None:
                parts = self.vocabulary.cuts(s)
                got = self.vocabulary.segment(s) if len(parts) == 1 else b"".join(map(self._get, parts))
            if len(s) <= 64:
                if len(self.young) >= CACHE:
                    self.old, self.young = self.young, {}
                self.young[s] = got
        return got


def decode(ids, decoded: list[bytes]) -> str:
    """Text of ids: bytes joined, marks to spaces, the space put before the text taken away."""
    text = b"".join(map(decoded.__getitem__, ids)).decode("utf-8", "replace")
    return text[1:] if text[:1] == " " else text


_encoders: dict[str, Encoder] = {}
_PART = 1 << 22


def _encoder(key: str, pieces) -> Encoder:
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(Vocabulary(pieces))
    return _encoders[key]


def _pieces(path: str):
    from sentencepiece import sentencepiece_model_pb2 as pb

    with open(path, "rb") as f:
        data = f.read()
    Vocabulary.load(path)
    model = pb.ModelProto()
    model.ParseFromString(data)
    return hashlib.sha256(data).hexdigest(), [(p.piece, p.score, p.type) for p in model.pieces]


def encode(docs: DataFrame, model_path: str = MODEL, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_ids, ids, decoded_sha256 (of the decoding of the ids) and exact (it equals the text)."""
    key, pieces = _pieces(model_path)
    schema = pa.schema([("doc_id", pa.int64()), ("n_ids", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded_sha256", pa.string()), ("exact", pa.bool_())])

    def run(batches):
        encoder = _encoder(key, pieces)
        table_ = encoder.vocabulary.decoded

        def part(rows):
            ids = [None if x is None else x[1] for x in rows]
            offsets = np.concatenate([[0], np.cumsum([0 if x is None else len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate([x for x in ids if x is not None] or [np.zeros(0, "<i4")])
            empty = [x is None for x in ids]
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32()), mask=pa.array(empty))
            return lists

        for batch in batches:
            doc, text = batch.column(0), batch.column(1)
            rows, held, at = [], 0, 0
            for i in range(len(text)):
                t = text[i].as_py()
                if t is None:
                    rows.append(None)
                else:
                    ids = encoder(t)
                    back = decode(ids.tolist(), table_)
                    rows.append((len(ids), ids, hashlib.sha256(back.encode()).hexdigest(), back == t))
                    held += len(ids)
                if held > _PART or i == len(text) - 1:
                    cols = [doc.slice(at, len(rows)), pa.array([None if r is None else r[0] for r in rows], pa.int64()), part(rows), pa.array([None if r is None else r[2] for r in rows], pa.string()), pa.array([None if r is None else r[3] for r in rows], pa.bool_())]
                    yield pa.RecordBatch.from_arrays(cols, schema=schema)
                    at, rows, held = i + 1, [], 0

    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("_text"))
    return docs.mapInArrow(run, "doc_id long, n_ids long, ids array<int>, decoded_sha256 string, exact boolean")


def decode_ids(encoded: DataFrame, model_path: str = MODEL, ids_col: str = "ids", out: str = "text") -> DataFrame:
    """Adds the decoded text; null ids decode to null."""
    table_ = Vocabulary.load(model_path).decoded

    @F.pandas_udf("string")
    def text(ids):
        return ids.map(lambda x: None if x is None else decode(x, table_))

    return encoded.withColumn(out, text(F.col(ids_col)))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
