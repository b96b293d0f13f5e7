"""Operator 3: language identification with language-bitmask n-gram filters.

Slots of a bit-sliced Bloom filter hold one bit a language; the conjunction of an n-gram's slots gives all
languages that contain it at once. A text's n-grams are counted by language (population counts of the
masks), each count is corrected for the filter's share of false positives, and the highest share decides
(ties: the language with more training texts, then the lesser name).

A language contains an n-gram if its frequency there is at least ``RELATIVE`` of its frequency in the
language where it is most frequent, so mislabelled and mixed texts do not put it everywhere. Training reads
at most ``SAMPLE`` labelled texts, chosen by a hash of the id; their n-grams are counted in Spark.

Null text, or text without a letter, is ``und`` with score 0. Without any training text all is ``und``.
Repeated rows are kept. Very long texts are counted in stretches; n-grams across their ends are not seen.
An empty table gives an empty result. Columns named lang_pred, score and coverage are replaced by ``identify``; others
are passed on. ``most`` bounds the n-grams of a language (the most frequent ones): its filters then hold a bounded share
of their slots, which keeps false positives few whatever the training texts are.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anchorline.llm._common import fold, table
from anchorline.llm.chunks import mix

U = np.uint64
#: Bound of the labelled texts that the filters are made from.
SAMPLE = 20_000
#: Bound of the n-grams that each language keeps (its most frequent ones).
GRAMS = 60_000
LEAST = 3
RELATIVE = 0.4
SLOTS = 1 << 21
HASHES = 2
ORDERS = (2, 3, 4)
#: A text whose best language has a smaller corrected share of its n-grams is not in any known language.
COVERAGE = 0.15
STRETCH = 1 << 18
_letters: np.ndarray | None = None


def letters() -> np.ndarray:
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _letters


def grams(texts: list[str]):
    """Hash and text number of each n-gram, and whether each text has a letter."""
    joined = "\0".join(t.replace("\0", " ") for t in texts).lower() + "\0"
    c = np.frombuffer(joined.encode("utf-32-le", "replace"), "<u4")
    end = c == 0
    letter = letters()[c]
    c = np.where(letter, c, np.where(end, 0, 32)).astype(np.uint32)
    keep = np.ones(len(c), bool)
    keep[1:] = (c[1:] != 32) | (c[:-1] != 32)
    doc = (np.cumsum(end) - end)[keep]
    has = np.bincount(doc[letter[keep]], minlength=len(texts))[: len(texts)] > 0
    c = c[keep].astype(U)
    out = []
    h = c.copy()
    ok = c != U(0)
    for n in range(2, max(ORDERS) + 1):
        h = h[:-1] * U(0x9E3779B97F4A7C15) + c[n - 1 :]
        ok = ok[:-1] & (c[n - 1 :] != U(0))
        if n in ORDERS:
            out.append((mix(h[ok] ^ U(n << 56)), doc[: len(h)][ok]))
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out]), has


def _slots(h: np.ndarray, m: int) -> list[np.ndarray]:
    return [((h >> U(21 * i)) % U(m)).astype(np.int64) for i in range(HASHES)]


def batches_of(texts, most: int = STRETCH):
    """Lists of (text number, stretch) of bounded size."""
    held, size = [], 0
    for i, t in enumerate(texts):
        if t is None:
            continue
        for a in range(0, max(1, len(t)), most):
            held.append((i, t[a : a + most]))
            size += len(held[-1][1])
            if size >= most:
                yield held
                held, size = [], 0
    if held:
        yield held


class Filters:
    def __init__(self, languages: list[str], grams_of: dict[str, np.ndarray], slots: int = SLOTS):
        self.languages = languages
        words = -(-len(languages) // 8)
        self.slices = np.zeros((words, slots), np.uint8)
        self.wrong = np.zeros(len(languages))
        for i, name in enumerate(languages):
            bit = np.uint8(1 << i % 8)
            for s in _slots(grams_of[name], slots):
                self.slices[i // 8, s] |= bit
            self.wrong[i] = ((self.slices[i // 8] & bit) != 0).mean() ** HASHES

    def counts(self, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per text: n-grams, those of each language, whether there is a letter."""
        n, L = len(texts), len(self.languages)
        total, hits, has = np.zeros(n, np.int64), np.zeros((n, L), np.int64), np.zeros(n, bool)
        for part in batches_of(texts):
            h, doc, letter = grams([t for _, t in part])
            at = np.array([i for i, _ in part])
            np.logical_or.at(has, at, letter)
            np.add.at(total, at, np.bincount(doc, minlength=len(at)))
            where = _slots(h, self.slices.shape[1])
            for w, plane in enumerate(self.slices):
                mask = plane[where[0]]
                for s in where[1:]:
                    mask &= plane[s]
                by = np.bincount(doc * 256 + mask, minlength=len(at) * 256).reshape(len(at), 256)
                for b in range(min(8, L - 8 * w)):
                    np.add.at(hits[:, 8 * w + b], at, by[:, (np.arange(256) >> b) & 1 == 1].sum(1))
        return total, hits, has

    def decide(self, texts):
        """Language, score (its part of all corrected shares) and corrected share."""
        total, hits, has = self.counts(texts)
        if not self.languages:
            return ["und"] * len(total), np.zeros(len(total)), np.zeros(len(total))
        share = np.clip((hits / np.maximum(total, 1)[:, None] - self.wrong) / np.maximum(1 - self.wrong, 1e-9), 0, 1)
        best = share.argmax(1)
        top = share[np.arange(len(best)), best]
        score = np.where(share.sum(1) > 0, top / np.maximum(share.sum(1), 1e-12), 1 / len(self.languages))
        names = [self.languages[i] if ok else "und" for i, ok in zip(best, has, strict=True)]
        return names, np.where(has, np.clip(score, 0, 1), 0.0), np.where(has, top, 0.0)


def train(labelled: DataFrame, text_col: str = "text", label_col: str = "lang", id_col: str = "doc_id", sample: int = SAMPLE, most: int = GRAMS) -> Filters:
    """Filters from labelled rows; those without label or text are left out."""
    rows = labelled.where(F.col(label_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(F.col(label_col).cast("string")).count().collect()}
    total = sum(sizes.values())
    if not total:
        return Filters([], {})
    chosen = rows if total <= sample else rows.where(F.pmod(F.xxhash64(F.col(id_col)), F.lit(1 << 30)) < int((1 << 30) * (sample / total)))

    def count(batches):
        for pdf in batches:
            for lang, part in pdf.groupby("lang"):
                for stretch in batches_of(list(part["text"])):
                    h, n = np.unique(grams([t for _, t in stretch])[0], return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": h.view(np.int64), "n": n})

    found = chosen.select(F.col(label_col).cast("string").alias("lang"), F.col(text_col).alias("text")).mapInPandas(count, "lang string, gram long, n long")
    found = found.groupBy("lang", "gram").agg(F.sum("n").alias("n")).where(f"n >= {LEAST}")
    sums = found.groupBy("lang").agg(F.sum("n").alias("total"))
    per = found.join(sums, "lang").withColumn("f", F.col("n") / F.col("total"))
    top = per.groupBy("gram").agg(F.max("f").alias("most"))
    kept = per.join(top, "gram").where(F.col("f") >= RELATIVE * F.col("most"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), F.desc("gram"))  # ranks are cut before the shuffle
    kept = kept.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= most)
    got = {r[0]: np.array(r[1], np.int64).view(U) for r in kept.groupBy("lang").agg(F.collect_list("gram")).collect()}
    names = sorted(got, key=lambda x: (-sizes[x], x))
    return Filters(names, got)


def identify(docs: DataFrame, filters: Filters, text_col: str = "text") -> DataFrame:
    """The rows with lang_pred, score and coverage; columns of these names are replaced."""
    keep = [c for c in docs.columns if c not in ("lang_pred", "score", "coverage")]
    shared = docs.sparkSession.sparkContext.broadcast(filters)  # SLOTS bytes for each eight languages

    @F.pandas_udf("lang_pred string, score double, coverage double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        names, score, coverage = shared.value.decide(list(texts))
        return pd.DataFrame({"lang_pred": names, "score": score, "coverage": coverage})

    out = docs.select(*[F.col(f"`{c}`") for c in keep], judge(F.col(text_col)).alias("_judged"))
    return out.select(*[F.col(f"`{c}`") for c in keep], "_judged.*")


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(fold("doc_id", 4) != 2)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = train(training_rows(docs))
    out = identify(docs.select("doc_id", "text"), filters)
    return out.select("doc_id", F.coalesce(fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "coverage")
