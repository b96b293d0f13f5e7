"""Operator 8: toxicity by weak supervision.

Voters speak for toxic text: lexicon entries (words) and patterns (several distinct words with one beginning), mined from
labelled rows by their document frequencies, which Spark counts. Two more speak for clean text: where no entry is met,
and where no pattern is. A generative label model explains their votes by a hidden class: one vote distribution a class
and voter, given the vote of the voter it depends on most (a maximum spanning tree of conditional mutual information),
fitted by expectation maximisation. It sees no row's label: labels only say how large the toxic class is and which of
the two it is. How accurate the voters are, and how they correlate, follows from how they agree. A logistic regression on the votes
and their density is then trained on the posterior labels.

At most ``sample`` labelled rows are used, chosen by a hash of the id; ``voters`` bounds the voters (None: all
that stand out; the label model's work grows with the square of their number). Null text counts as empty; an empty text
gets the score of a text without any vote. Without labelled rows of both classes the score is the share of toxic labels
(0 without any). Repeated rows are kept; a document labelled twice counts as toxic if once so; voters of equal worth are
ordered by name. Very long texts are read whole, one at a time; only their distinct words are held. An empty table gives
an empty result; columns named score and predicted are replaced by ``score``, others are passed on.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline.llm._common import fold, table

#: Bound of the labelled rows.
SAMPLE = 20_000
#: Most voters of the label model, the strongest first.
VOTERS = 160
#: A voter hangs on another in the label model if this part of what it can tell is told by the other, given the class.
DEPENDS = 0.8
#: Lengths of word beginnings, and how many distinct words of a text must share one.
PREFIXES = (3, 4, 5, 6, 7)
TIMES = (1, 2, 3)
LEAST = 5
#: Keys a task holds before it hands them on.
HELD = 200_000
_WORDS = re.compile(r"\w+")


def tokens(text: str | None) -> list[str]:
    return _WORDS.findall((text or "").lower())


def keys(words: set[str]) -> set[str]:
    """Lexicon keys of distinct words: the words, and beginnings as ``beginning*times``."""
    n = Counter(w[:k] for w in words for k in PREFIXES if len(w) > k)
    return words | {f"{p}*{t}" for p, c in n.items() for t in TIMES if c >= t}


class Model:
    """Voters (word or beginning*times), and the linear classifier over their votes."""

    def __init__(self, voters: list[str], weights: np.ndarray, bias: float):
        self.voters, self.weights, self.bias = voters, weights, bias
        self.words = {v: i for i, v in enumerate(voters) if "*" not in v}
        self.stems: dict[str, list[tuple[int, int]]] = {}
        for i, v in enumerate(voters):
            if "*" in v:
                stem, times = v.split("*")
                self.stems.setdefault(stem, []).append((int(times), i))
        self.lengths = sorted({len(p) for p in self.stems})
        self.heads = {p[: PREFIXES[0]] for p in self.stems}

    def votes(self, text: str | None) -> tuple[list[int], float]:
        """Voters that speak for toxic, and the share of words they fire on."""
        distinct = set(tokens(text))
        hits = [self.words[w] for w in distinct & self.words.keys()]
        near = [w for w in distinct if w[: PREFIXES[0]] in self.heads] if self.stems else []
        for p, c in Counter(w[:k] for w in near for k in self.lengths if len(w) > k).items():
            hits += [i for t, i in self.stems.get(p, ()) if c >= t]
        return hits, min(1.0, len(hits) / 10)

    def features(self, texts) -> np.ndarray:
        x = np.zeros((len(texts), len(self.voters) + 2))
        for i, t in enumerate(texts):
            hits, density = self.votes(t)
            x[i, hits] = 1
            x[i, -2] = density
            x[i, -1] = not hits
        return x

    def score(self, texts) -> np.ndarray:
        out = np.empty(len(texts))
        w, clean, dense = self.weights[:-2], self.weights[-1], self.weights[-2]
        for i, t in enumerate(texts):
            hits, density = self.votes(t)
            out[i] = self.bias + w[hits].sum() + dense * density + clean * (not hits)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


class LabelModel:
    """P(class) and P(vote of j | class, vote of the parent of j); votes are -1, 0 and 1."""

    def __init__(self, votes: np.ndarray, start: np.ndarray, prior: float | None = None, rounds: int = 40, again: int = 10):
        """Expectation maximisation from the posterior ``start``; the tree is found there, and once more after ``again`` rounds."""
        n, m = votes.shape
        z = np.stack([votes == v for v in (-1, 0, 1)], 2).astype(float).reshape(n, 3 * m)
        self.parents = np.full(m, -1)
        post = start
        for r in range(rounds):
            self.prior = float(np.clip(post.mean() if prior is None else prior, 1e-4, 1 - 1e-4))
            if r in (0, again):
                pairs = [(z * w[:, None]).T @ z for w in (1 - post, post)]
                self.parents = self._tree(pairs, n)
            self._fit(votes, (1 - post, post))
            new = self.posterior(votes)
            done = np.abs(new - post).max() < 1e-5 and r > again
            post = new
            if done:
                break
        self.fitted = post
        # how often a voter that speaks is right, and residual correlations given the class
        spoke = np.maximum(1e-9, (votes != 0).sum(0))
        self.accuracy = (((votes == 1) * post[:, None]).sum(0) + ((votes == -1) * (1 - post)[:, None]).sum(0)) / spoke
        mean = [(votes * w[:, None]).sum(0) / max(w.sum(), 1e-9) for w in (1 - post, post)]
        rest = votes - (np.outer(1 - post, mean[0]) + np.outer(post, mean[1]))
        self.correlation = (rest.T @ rest) / n / (np.outer(rest.std(0), rest.std(0)) + 1e-12)
        np.fill_diagonal(self.correlation, 0)

    @staticmethod
    def _tree(pairs: list[np.ndarray], n: int) -> np.ndarray:
        """Parents in the maximum spanning forest of the mutual information of votes given the class; -1: none."""
        m = len(pairs[0]) // 3
        info = np.zeros((m, m))
        for c in pairs:
            total = max(c.trace() / m, 1e-9)
            p = (c.reshape(m, 3, m, 3).transpose(0, 2, 1, 3) + 0.05) / (total + 0.45)
            alone = np.stack([c[3 * j : 3 * j + 3, 3 * j : 3 * j + 3].diagonal() for j in range(m)])
            alone = (alone + 0.15) / (total + 0.45)
            info += total / n * (p * np.log(p / (alone[:, None, :, None] * alone[None, :, None, :]))).sum((2, 3))
        np.fill_diagonal(info, 0)
        # what each voter could tell at most
        own = sum(max(c.trace() / m, 1e-9) / n * -(q * np.log(q)).sum(1) for c in pairs for q in [(np.stack([c[3 * j : 3 * j + 3, 3 * j : 3 * j + 3].diagonal() for j in range(m)]) + 0.15) / (max(c.trace() / m, 1e-9) + 0.45)])
        share = info / np.maximum(np.minimum(own[:, None], own[None, :]), 1e-12)
        parents, best, inside = np.full(m, -1), np.full(m, -1.0), np.zeros(m, bool)
        to = np.full(m, -1)
        for _ in range(m):
            j = int(np.where(inside, -np.inf, best).argmax())
            inside[j] = True
            if to[j] >= 0 and share[j, to[j]] > DEPENDS:
                parents[j] = to[j]
            better = ~inside & (info[j] > best)
            best[better], to[better] = info[j][better], j
        return parents

    def _fit(self, votes: np.ndarray, weights) -> None:
        n, m = votes.shape
        own = votes.astype(np.int64) + 1
        given = np.where(self.parents >= 0, own[:, self.parents], 0)
        cell = (np.arange(m) * 3 + given) * 3 + own
        self.log = []
        for w in weights:
            c = np.bincount(cell.ravel(), weights=np.repeat(w, m), minlength=9 * m).reshape(m, 3, 3)
            every = c.sum(1, keepdims=True) + 0.1
            c = c + every / every.sum(2, keepdims=True)  # towards the distribution without a parent
            self.log.append(np.log(c / c.sum(2, keepdims=True)))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        m = votes.shape[1]
        own = votes.astype(np.int64) + 1
        given = np.where(self.parents >= 0, own[:, self.parents], 0)
        gain = self.log[1] - self.log[0]
        logit = np.log(self.prior / (1 - self.prior)) + gain[np.arange(m), given, own].sum(1)
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def majority(votes: np.ndarray) -> np.ndarray:
    """Where expectation maximisation starts: the share of voters that speak for class 1, among those that speak."""
    yes, no = (votes == 1).sum(1), (votes == -1).sum(1)
    return (yes + 0.5) / (yes + no + 1.0)


def label_model(votes: np.ndarray, labels: np.ndarray | None = None, rounds: int = 40) -> tuple[np.ndarray, LabelModel]:
    """Posterior of class 1 and the fitted model. Labels only tell how large class 1 is, and which of the two it is."""
    prior = float(np.mean(labels)) if labels is not None and len(np.unique(labels)) == 2 else None
    model = LabelModel(votes, majority(votes), prior, rounds)
    post = model.fitted
    if prior is not None and post[labels == 1].mean() < post[labels == 0].mean():  # voters speak for the other class
        model = LabelModel(votes, majority(votes), 1 - prior, rounds)
        post = 1 - model.fitted
    return post, model


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, rounds: int = 30) -> tuple[np.ndarray, float]:
    """Ridge logistic regression on soft labels by Newton steps."""
    z = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(z.shape[1])
    reg = np.full(len(w), ridge)
    reg[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        h = (z * (p * (1 - p) + 1e-6)[:, None]).T @ z + np.diag(reg)
        step = np.linalg.solve(h, z.T @ (y - p) - reg * w)
        w += step
        if np.abs(step).max() < 1e-6:
            break
    return w[:-1], float(w[-1])


def mine(rows: DataFrame, voters: int | None = None) -> list[str]:
    """Keys whose document frequency among toxic rows stands out, greatest first; one of several that always meet."""

    def count(batches):
        for pdf in batches:
            n: tuple[Counter, Counter] = (Counter(), Counter())
            for i, (text, label) in enumerate(zip(pdf["text"], pdf["label"], strict=True)):
                n[label].update(keys(set(tokens(text))))
                if len(n[0]) + len(n[1]) > HELD or i == len(pdf) - 1:
                    yield pd.DataFrame([(k, c * (1 - y), c * y) for y in (0, 1) for k, c in n[y].items()], columns=["key", "clean", "toxic"])
                    n = (Counter(), Counter())

    sizes = {r[0]: r[1] for r in rows.groupBy("label").count().collect()}
    a, b = sizes.get(1, 0), sizes.get(0, 0)
    if not a or not b:
        return []
    found = rows.mapInPandas(count, "key string, clean long, toxic long").groupBy("key").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    rate = (F.col("toxic") + 0.1) / (a + 0.2) / ((F.col("clean") + 0.1) / (b + 0.2))
    ranked = found.where(f"toxic >= {LEAST}").withColumn("rate", rate).where("rate >= 8")
    ranked = ranked.select("key", (F.log("rate") * F.sqrt("toxic")).alias("worth")).orderBy(F.desc("worth"), "key")
    return [r[0] for r in (ranked if voters is None else ranked.limit(voters)).collect()]  # of a bounded sample


def train(labelled: DataFrame, sample: int = SAMPLE, voters: int | None = VOTERS) -> Model:
    """labelled: doc_id, text, label (0 or 1)."""
    rows = labelled.where("label in (0, 1)").select("doc_id", "text", F.col("label").cast("long").alias("label"))
    total = rows.count()
    if total > sample:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * (sample / total)))
    voters = mine(rows, voters)
    model = Model(voters, np.zeros(len(voters) + 2), 0.0)

    def vote(batches):  # sparse: the driver gets numbers, no texts
        for pdf in batches:
            yield pd.DataFrame({"label": pdf["label"], "hits": [sorted(model.votes(t)[0]) for t in pdf["text"]]})

    got = rows.mapInPandas(vote, "label long, hits array<int>").collect()
    y = np.array([r[0] for r in got], float)
    prior = float(y.mean()) if len(y) else 0.0
    if not voters or prior in (0.0, 1.0):
        p = min(max(prior, 1e-6), 1 - 1e-6)
        return Model([], np.zeros(2), float(np.log(p / (1 - p))))
    hits = np.zeros((len(got), len(voters)))
    for i, r in enumerate(got):
        hits[i, r[1]] = 1
    none = hits.sum(1) == 0
    post, fitted = label_model(votes_of(hits, voters), y)
    x = np.hstack([hits, np.minimum(1.0, hits.sum(1) / 10)[:, None], none[:, None]])
    out = Model(voters, *logistic(x, post))
    out.accuracy, out.correlation = fitted.accuracy, fitted.correlation
    return out


def votes_of(hits: np.ndarray, voters: list[str]) -> np.ndarray:
    """Votes for toxic of the entries, and for clean where no word, and where no beginning, is met."""
    stem = np.array(["*" in v for v in voters])
    silent = [-(hits[:, kind].sum(1) == 0).astype(float) for kind in (~stem, stem) if kind.any()]
    return np.hstack([hits, np.stack(silent, 1)])


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows with score and predicted; columns of these names are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # words and numbers that a bounded sample gave

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(shared.value.score(list(texts)))

    keep = [F.col(f"`{c}`") for c in docs.columns if c not in ("score", "predicted")]
    out = docs.select(*keep, run(F.col(text_col)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def training_rows(docs: DataFrame, labels: DataFrame, label: str, n: int = 5) -> DataFrame:
    """doc_id, text, label of labelled rows outside the held-out fold; a document labelled twice counts as 1 if once so."""
    known = labels.where((fold("doc_id", n) != 0) & F.col(label).isNotNull()).groupBy("doc_id").agg(F.max(label).alias("label"))
    return docs.select("doc_id", "text").join(known, "doc_id")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    total = labels.count()
    if total > SAMPLE:  # the same hash bound as in train, before the join
        labels = labels.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * (SAMPLE / total)))
    model = train(training_rows(docs, labels, "toxic"))
    out = score(docs, model)
    return out.select("doc_id", F.coalesce(fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")
