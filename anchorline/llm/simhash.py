"""Operator 7: SimHash near-duplicates through a Gray-order hierarchical index.

Fingerprints follow the contract of ``fingerprints``. Equal fingerprints are merged first. At three
differing bits or fewer, one of four 16-bit blocks is equal, and one of four 12-bit parts of the rest: each
fingerprint goes to 16 places keyed by 28 equal bits, so linked ones meet at least once. There the
fingerprints, permuted so that the shared bits lead, are sorted by Gray rank; a tree over that order keeps in
each node the bits its members share. A search adds up the differing bits that each node fixes anew, drops
the node with all its members beyond three, and takes them all where the bits still open cannot exceed three.
Only a spanning forest of the links leaves a task, never all pairs. Components follow by large-star and
small-star rounds, which keep hot stars in partial aggregates and splittable joins.

Null text counts as empty; empty texts have fingerprint zero and link as any other. Repeated rows are kept.
A component whose doc_ids are all null has a null id. An empty table gives an empty result. A text is hashed in one
worker, in stretches of 65,536 shingles, whatever its length. Other columns are not read, whatever their names. A task
holds a stretch of sorted fingerprints, and whole groups of equal 28-bit heads: some 75 fingerprints at 2 * 10^10
documents with even heads; equal fingerprints are merged before, so copies do not make a group larger.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline.llm._common import Tables, stored, table

U = np.uint64
BITS = 3
SHINGLE = 3
SEED = 42
FAN = 8


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """A bit is set if over half of the shingles' XXH64 values have it."""
    words = text.lower().split()  # bytes: A-Z only, and exactly the six separators
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = np.concatenate([[0], ends[:-shingle]]).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    counts, n = np.zeros(64, np.int64), len(starts)
    for a in range(0, n, 1 << 16):
        h = np.array([digest(joined[s:e], SEED) for s, e in zip(starts[a : a + (1 << 16)], stops[a : a + (1 << 16)], strict=True)], U)
        counts += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view("<u8")[0])


def fingerprint_of(text: Column) -> Column:
    """The fingerprint of a text column as a signed long; only texts go to Python."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t or b"") for t in texts], U).view(np.int64))

    return run(text.cast("binary"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the fingerprint as a signed long."""
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), fingerprint_of(F.col(f"`{text_col}`")).alias("fp"))


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of each code word in the reflected Gray order."""
    for s in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> U(s))
    return x


def places(fp: np.ndarray) -> np.ndarray:
    """The 16 permutations of each fingerprint, the 28 bits that must be equal first: shape (16, n)."""
    out = []
    for i in range(4):
        r = (fp << U(16 * i)) | (fp >> U(64 - 16 * i)) if i else fp
        head, rest = r >> U(48), r & U((1 << 48) - 1)
        for j in range(4):
            t = ((rest << U(12 * j)) | (rest >> U(48 - 12 * j))) & U((1 << 48) - 1) if j else rest
            out.append((head << U(48)) | t)
    return np.stack(out) if len(out) else np.zeros((16, 0), U)


class GrayIndex:
    """Nodes by level: the bits all members share, their values; level 0 are the fingerprints."""

    def __init__(self, sorted_codes: np.ndarray):
        full = np.full(len(sorted_codes), ~U(0), U)
        self.levels = [(full, sorted_codes)]
        while len(self.levels[-1][1]) > FAN:
            mask, value = self.levels[-1]
            at = np.arange(0, len(value), FAN)
            ones, any_ = np.bitwise_and.reduceat(value, at), np.bitwise_or.reduceat(value, at)
            shared = ~(ones ^ any_) & np.bitwise_and.reduceat(mask, at)
            self.levels.append((shared, ones & shared))

    def components(self, bits: int, fixed: np.ndarray | int) -> np.ndarray:
        """The least index reachable within ``bits`` differences and none among the ``fixed`` bits."""
        codes = self.levels[0][1]
        n = len(codes)
        comp = np.arange(n)
        head = codes & U(fixed)
        edges = np.flatnonzero(np.concatenate([[True], head[1:] != head[:-1], [True]]))
        block = int(np.clip((1 << 21) // max(1, np.diff(edges).max(initial=1)), 64, 4096))
        for a in range(0, n, block):
            q = np.arange(a, min(a + block, n))
            tops = len(self.levels[-1][1])
            query, node = np.repeat(q, tops), np.tile(np.arange(tops), len(q))
            spent, known = np.zeros(len(query), np.uint8), np.zeros(len(query), U)
            low, high = self._uniform(comp)
            for level in range(len(self.levels) - 1, -1, -1):
                mask, value = self.levels[level]
                m = mask[node]
                differ = (codes[query] ^ value[node]) & m & ~known
                spent = spent + np.bitwise_count(differ)
                keep = (spent <= bits) & ((differ & U(fixed)) == 0)
                keep &= (low[level][node] != comp[query]) | (high[level][node] != comp[query])
                query, node, spent, m = query[keep], node[keep], spent[keep], m[keep]
                taken = spent + np.bitwise_count(~m) <= bits
                if taken.any():
                    first = node[taken] * FAN**level
                    comp = _union(comp, query[taken], first)
                    if level:  # all members link to the query, so to each other
                        size = np.minimum(FAN**level, n - first)
                        member = np.repeat(first - np.cumsum(size) + size, size) + np.arange(size.sum())
                        comp = _union(comp, np.repeat(first, size), member)
                        query, node, spent, m = query[~taken], node[~taken], spent[~taken], m[~taken]
                if not level:
                    break
                child = (node[:, None] * FAN + np.arange(FAN)).ravel()
                query, spent, known = np.repeat(query, FAN), np.repeat(spent, FAN), np.repeat(m, FAN)
                real = child < len(self.levels[level - 1][1])
                query, node, spent, known = query[real], child[real], spent[real], known[real]
        return comp

    def _uniform(self, comp: np.ndarray):
        low, high = [comp], [comp]
        for level in range(1, len(self.levels)):
            at = np.arange(0, len(low[-1]), FAN)
            low.append(np.minimum.reduceat(low[-1], at))
            high.append(np.maximum.reduceat(high[-1], at))
        return low, high


def _union(comp: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    while True:
        x, y = comp[a], comp[b]
        differ = x != y
        if not differ.any():
            return comp
        a, b = a[differ], b[differ]
        lo, hi = np.minimum(x[differ], y[differ]), np.maximum(x[differ], y[differ])
        np.minimum.at(comp, hi, lo)
        while True:
            up = comp[comp]
            if (up == comp).all():
                break
            comp = up


#: Rows of a sorted partition that are indexed together, and whole groups beyond.
SLAB = 1 << 17


def _slabs(batches):
    """Sorted rows in stretches that end between groups, so that a task holds one stretch and not its partition."""
    held, n = [], 0
    for pdf in batches:
        if not len(pdf):
            continue
        held.append(pdf)
        n += len(pdf)
        if n < SLAB:
            continue
        all_ = pd.concat(held, ignore_index=True) if len(held) > 1 else pdf
        t, k = all_["t"].to_numpy(), all_["k"].to_numpy()
        at = int(np.flatnonzero((t != t[-1]) | (k != k[-1]))[-1]) + 1 if (t[0], k[0]) != (t[-1], k[-1]) else 0
        if at:
            yield all_.iloc[:at]
        held, n = [all_.iloc[at:]], len(all_) - at
    if held:
        yield pd.concat(held, ignore_index=True)


def _forest(bits: int):
    def run(batches):
        for pdf in _slabs(batches):
            for t, part in pdf.groupby("t"):
                fp = part["fp"].to_numpy().view(U)
                code = places(fp)[int(t)]
                order = np.argsort(gray_rank(code), kind="stable")
                comp = GrayIndex(code[order]).components(bits, ((1 << 28) - 1) << 36)
                fp = fp[order].view(np.int64)
                linked = comp != np.arange(len(comp))
                yield pd.DataFrame({"a": fp[linked], "b": fp[comp[linked]]})

    return run


def _placed(batches):
    for pdf in batches:
        fp = pdf["fp"].to_numpy()
        head = (places(fp.view(U)) >> U(36)).astype(np.int64)
        yield pd.DataFrame({"t": np.repeat(np.arange(16, dtype=np.int32), len(fp)), "k": head.ravel(), "fp": np.tile(fp, 16)})


def links(distinct: DataFrame, bits: int = BITS) -> DataFrame:
    """A spanning forest (a, b) of the links among distinct fingerprints."""
    if not 0 <= bits <= 3:
        raise ValueError("four blocks of four parts find up to three differing bits")
    placed = distinct.select("fp").mapInPandas(_placed, "t int, k long, fp long")
    return placed.repartition("t", "k").sortWithinPartitions("t", "k").mapInPandas(_forest(bits), "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(a, root) of every linked node but the roots, by alternating large-star and small-star."""
    now = Tables()
    edges = now.stored(edges.select("a", "b").where("a <> b").distinct())
    before = None
    while True:
        next_ = Tables()
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        between = Tables()
        large = between.stored(large.where("a <> b").distinct())
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        least = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = next_.stored(small.union(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
        between.drop()
        now.drop()
        now = next_
        sign = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if sign == before:
            return edges.select("a", F.col("b").alias("root"))
        before = sign


def grouped(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """doc_id, fp, root (a fingerprint that names the component) and component_id (the least doc_id that links reach)."""
    fps = stored(fingerprints(docs, id_col, text_col))
    distinct = fps.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(links(distinct, bits))
    named = distinct.join(roots.withColumnRenamed("a", "fp"), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = named.where("root <> fp").groupBy("root").agg(F.min("least").alias("below"))
    top = named.join(least.withColumnRenamed("root", "_root"), F.col("root") == F.col("_root"), "left")
    label = stored(top.select("fp", F.col("root"), "least", "below"))
    # a root's own least is in its own row only: bring it to its members
    own = label.where("fp = root").select(F.col("root").alias("_root"), F.least("least", "below").alias("component_id"))
    members = label.where("fp <> root").join(own, F.col("root") == F.col("_root")).select("fp", "root", "component_id")
    label = stored(members.union(label.where("fp = root").select("fp", "root", F.least("least", "below").alias("component_id"))))
    return fps.join(label, "fp").select("doc_id", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (the least doc_id that links reach)."""
    out = grouped(docs, id_col, text_col, bits)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
