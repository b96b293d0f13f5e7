"""Operator 9: quality rules as learned decision lists.

Statistics of whole texts are counted in Arrow batches. From those of labelled rows, sequential covering
learns an ordered list of rules for low quality: each is a conjunction of thresholds grown on two thirds of
the rows that are left by information gain, pruned on the last third, and kept only while it is precise
there. The list becomes one ordered conditional expression that Spark evaluates.

``BASE`` columns follow the operator's contract. Words are numbered by a dictionary and windows by doubling (the number
of a window is that of its two halves), so equal numbers mean equal words: no hash decides. Null and empty texts have no
words. At most ``SAMPLE`` labelled rows are used, chosen by a hash of the id. Without labelled rows of both classes no
rule is learned and only the base rule decides. Repeated rows are kept; an id that is labelled twice counts once, as
low if either label is; of rows with one labelled id the least statistics are learned from. An empty table gives an
empty result. Texts are taken in groups of half a megabyte; a longer text is a group of its own, and needs about forty
times its bytes in one worker. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline.llm._common import fold, stored, table
from anchorline.llm.chunks import window_numbers

#: Bound of the labelled rows that rules are learned from.
SAMPLE = 20_000
#: Bytes of texts counted together.
PIECE = 1 << 19
WINDOW = 8
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE = ["n_upper", "n_lower", "n_digits", "n_punct", "n_bytes", "n_lines", "n_distinct_words"]
_SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\r\x0b\x0c"
_CLASS = np.zeros(256, np.int64)
_CLASS[list(range(65, 91))] = 1
_CLASS[list(range(97, 123))] = 2
_CLASS[list(range(48, 58))] = 3
_CLASS[list(b"!\"'()+,-./:;=?@[]\\^_`{}~")] = 4
_CLASS[list(_SYMBOLS)] = 5
_CLASS[list(_SPACE)] = 6
_CLASS[0x80:0xC0] = 7
#: Ratios that rules test: (name, numerator, denominator).
RATIOS = [
    ("symbols_per_word", "n_symbols", "n_words"),
    ("dup_lines", "n_dup_lines", "n_lines"),
    ("repeat_words", "n_repeat_words", "n_words"),
    ("upper_share", "n_upper", "word_chars"),
    ("digit_share", "n_digits", "word_chars"),
    ("punct_share", "n_punct", "word_chars"),
    ("distinct_words", "n_distinct_words", "n_words"),
    ("word_length", "word_chars", "n_words"),
    ("words_per_line", "n_words", "n_lines"),
]
FEATURES = ["n_words", *[r[0] for r in RATIOS]]


def statistics(texts: list[bytes]) -> dict[str, np.ndarray]:
    n = len(texts)
    out = {c: np.zeros(n, np.int64) for c in BASE + MORE}
    group, size = [], 0
    for i in range(n + 1):
        if group and (i == n or size + len(texts[i]) > PIECE):
            _statistics(texts[group[0] : group[-1] + 1], group[0], out)
            group, size = [], 0
        if i < n:
            group.append(i)
            size += len(texts[i])
    return out


def _statistics(texts: list[bytes], at: int, out: dict[str, np.ndarray]) -> None:
    n = len(texts)
    s = slice(at, at + n)
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    doc = np.repeat(np.arange(n), sizes)
    by = np.bincount(doc * 8 + _CLASS[data], minlength=8 * n).reshape(n, 8)
    out["n_bytes"][s] = sizes
    out["n_upper"][s], out["n_lower"][s], out["n_digits"][s], out["n_punct"][s], out["n_symbols"][s] = by[:, 1:6].T
    out["word_chars"][s] = sizes - by[:, 6] - by[:, 7]
    seen: dict[bytes, int] = {}
    numbers = [[seen.setdefault(w, len(seen)) for w in t.split()] for t in texts]
    words = np.array([len(x) for x in numbers], np.int64)
    out["n_words"][s] = words
    owner = np.repeat(np.arange(n), words)
    names = np.array([x for part in numbers for x in part], np.int64)
    out["n_distinct_words"][s] = np.bincount(np.unique(owner * len(seen) + names) // max(1, len(seen)), minlength=n)
    if len(names) >= WINDOW:
        starts = np.arange(len(names) - WINDOW + 1)
        starts = starts[owner[starts] == owner[starts + WINDOW - 1]]
        g = owner[starts] * (len(names) + 1) + window_numbers(names, WINDOW)[starts]
        _, of, count = np.unique(g, return_inverse=True, return_counts=True)
        first = starts[count[of] > 1]
        diff = np.bincount(first, minlength=len(names) + 1) - np.bincount(first + WINDOW, minlength=len(names) + 1)
        out["n_repeat_words"][s] = np.bincount(owner[np.cumsum(diff[:-1]) > 0], minlength=n)
    for i, t in enumerate(texts):
        lines = [x for x in t.split(b"\n") if x.strip(_SPACE)]
        out["n_lines"][at + i] = len(lines)
        out["n_dup_lines"][at + i] = len(lines) - len(set(lines))


def with_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the counts of each text."""

    @F.pandas_udf(", ".join(f"{c} long" for c in BASE + MORE))
    def count(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(statistics(list(texts)))

    text = F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), count(text).alias("_s")).select("doc_id", "_s.*")


def features() -> dict[str, Column]:
    out = {"n_words": F.col("n_words").cast("double")}
    for name, a, b in RATIOS:
        out[name] = F.col(a) / F.greatest(F.col(b), F.lit(1))
    return out


Rule = list[tuple[str, str, float]]


def _covers(rule: Rule, x: pd.DataFrame) -> np.ndarray:
    m = np.ones(len(x), bool)
    for f, op, t in rule:
        m &= (x[f].to_numpy() >= t) if op == ">=" else (x[f].to_numpy() <= t)
    return m


def _grow(x: pd.DataFrame, y: np.ndarray, deepest: int) -> Rule:
    rule: Rule = []
    inside = np.ones(len(x), bool)
    while len(rule) < deepest:
        p, n = y[inside].sum(), (~y[inside]).sum()
        if not n or not p:
            break
        now, best = np.log2(p / (p + n)), (0.0, None)
        for f in FEATURES:
            v = x[f].to_numpy()[inside]
            for t in np.unique(np.quantile(v, np.linspace(0.02, 0.98, 49), method="nearest")):
                for op, m in ((">=", v >= t), ("<=", v <= t)):
                    a, b = (m & y[inside]).sum(), (m & ~y[inside]).sum()
                    if a:
                        gain = a * (np.log2(a / (a + b)) - now)
                        if gain > best[0] + 1e-9:
                            best = (gain, (f, op, float(t)))
        if best[1] is None:
            break
        rule.append(best[1])
        inside &= _covers([best[1]], x)
    return rule


def _worth(rule: Rule, x: pd.DataFrame, y: np.ndarray) -> tuple[float, int]:
    m = _covers(rule, x)
    p, n = int((m & y).sum()), int((m & ~y).sum())
    return (p - n) / max(1, p + n), p


def learn(x: pd.DataFrame, low: np.ndarray, most: int = 12, deepest: int = 4, precise: float = 0.9, least: int = 3) -> list[Rule]:
    """Ordered rules for low quality."""
    rules: list[Rule] = []
    third = np.arange(len(x)) % 3 == 2
    left = np.ones(len(x), bool)
    while len(rules) < most and (low & left).any():
        g, p = left & ~third, left & third
        rule = _grow(x[g], low[g], deepest)
        if not rule:
            break
        cuts = [(*_worth(rule[:k], x[p], low[p]), -k) for k in range(1, len(rule) + 1)]
        rule = rule[: -max(cuts)[2]]
        m = _covers(rule, x) & left
        hit, size = int((m & low).sum()), int(m.sum())
        worth, seen = _worth(rule, x[p], low[p])
        if hit < least or hit < precise * size or not seen or worth < 2 * precise - 1:
            break
        rules.append(rule)
        left &= ~m
    return rules


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds (from 1), 0 if none does."""
    f, out = features(), F
    for i, rule in enumerate(rules):
        tests = [(f[name] >= t) if op == ">=" else (f[name] <= t) for name, op, t in rule]
        cond = tests[0]
        for c in tests[1:]:
            cond &= c
        out = out.when(cond, i + 1)
    return out.otherwise(0) if rules else F.lit(0)


def train(stats: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> list[Rule]:
    known = labels.where(F.col(label).isNotNull() & (fold("doc_id", 5) != 0)).groupBy("doc_id").agg(F.min(label).alias("label"))
    total = known.count()
    if total > sample:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * (sample / total)))
    once = stats.join(F.broadcast(known), "doc_id")  # ``sample`` ids and labels
    once = once.groupBy("doc_id", "label").agg(F.min(F.struct(*BASE, *MORE)).alias("_s")).select("doc_id", "label", "_s.*")
    got = once.select("doc_id", "label", *[v.alias(k) for k, v in features().items()]).toPandas()
    got = got.sort_values(["doc_id", *FEATURES]).reset_index(drop=True)
    got = got.iloc[np.random.default_rng(9).permutation(len(got))].reset_index(drop=True)
    return learn(got, got["label"].to_numpy() == 0) if len(got) else []


def judge(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    out = stats.withColumn("base_failed", failed).withColumn("rule", verdict(rules))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("rule") == 0))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    stats = stored(with_statistics(docs))
    rules = train(stats, table(spark, sf_dir, "labels"))
    return judge(stats, rules).select("doc_id", *BASE, "base_failed", "kept", "rule")


def base_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the operator does not depend on learning, as SQL can express it."""
    stats = with_statistics(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judge(stats, []).select("doc_id", *BASE, "base_failed")


BASE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, q, array_to_string(w[q:q + 7], ' ') AS s FROM d, LATERAL unnest(range(1, CAST(greatest(len(w) - 6, 1) AS BIGINT))) AS u(q)),
twice AS (SELECT doc_id, q FROM win QUALIFY count(*) OVER (PARTITION BY doc_id, s) > 1),
covered AS (SELECT doc_id, count(DISTINCT q + j) AS n FROM twice, LATERAL unnest(range(0, 8)) AS u(j) GROUP BY doc_id),
lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(lines.n, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(covered.n, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base
"""
