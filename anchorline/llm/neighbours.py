"""Operator 4: approximate nearest neighbours by an inverted file with product-quantised residuals.

Coarse centroids and residual codebooks are fitted by k-means on at most ``SAMPLE`` vectors (chosen by a hash of the
id); every vector is indexed: its list, and its residual as one byte a subspace. At most ``MEASURED`` of the queries
(by a hash of the id) meet every vector exactly, and what they find decides how far all queries look: as many lists are
visited as held ``recall`` of the true neighbours, and the short list reaches down to the lowest code score of a true
neighbour in these lists. Queries unlike the vectors, long vectors and coarse codes so cost work, not neighbours.

1.  Codes alone meet the queries. Asymmetric distance tables give every visited code a score; what leaves a task are the
    k (or ``rerank``) best different codes of each query, which rows of other ids have. The least of the best of all tasks, less the measured margin
    (a multiple of the query's length; none with a stated ``rerank``), is the query's threshold: one short list a query,
    over all lists.
2.  Vectors whose code reaches the threshold are scored exactly, in double precision, where they lie; what leaves a task
    are k rows a query. All vectors of a code are on the short list or none is, so a group of near copies that share
    codes is never cut, however large it is; no pair leaves a task.

Lists are dealt out in shards of about ``CHUNK`` vectors (a larger list is several shards by a hash of the row), queries
in shares of about ``SHARE`` by their nearest list, so that a shard goes only to the shares that visit it.

Queries are the stated ids, one query an id (of rows with one id, the least vector asks); rows of its own id are no
candidates for it. Rows without id, null vectors, zero vectors, other lengths than the most frequent one and null or
non-finite components take no part, as query or candidate. Ties go to the smaller id; of rows that repeat an id and
vector each is a candidate. An empty table gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anchorline.llm._common import Tables, stored, table
from anchorline.llm.chunks import U, mix

#: Bounds: vectors for the fit, and of those for each list; vectors in a shard; queries in a share; queries scored at once.
SAMPLE, PER_LIST, CHUNK, SHARE, BLOCK = 32_768, 16, 16_384, 16_384, 128
PARTS = 16
#: Queries that measure how many lists must be visited and how long short lists must be.
MEASURED = 256
#: Pairs scored exactly at once.
PAIRS = 1 << 15
#: Bytes of vectors, and as many of queries, that a task of all pairs holds.
BYTES = 8 << 20
K = 20
SCHEMA = "query_id long, rank int, vec_id long, score double"


def kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = nearest(x, c)
        n = np.bincount(near, minlength=k)
        order = np.argsort(near, kind="stable")
        some = np.flatnonzero(n)
        c[some] = np.add.reduceat(x[order], np.concatenate([[0], np.cumsum(n[some])[:-1]]), axis=0) / n[some, None]
        c[n == 0] = x[rng.choice(len(x), int((n == 0).sum()))]
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    half = (c**2).sum(1) / 2
    return np.concatenate([(half - x[a : a + 8192] @ c.T).argmin(1) for a in range(0, len(x), 8192)] or [np.zeros(0, np.int64)])


class Index:
    """Coarse centroids and one codebook for each part of the residual."""

    def __init__(self, x: np.ndarray, lists: int, seed: int = 5):
        self.dim = x.shape[1]
        self.centroids = kmeans(x, lists, 10, seed)
        rest = x - self.centroids[nearest(x, self.centroids)]
        parts = min(PARTS, self.dim)
        self.cuts = [slice(int(a[0]), int(a[-1]) + 1) for a in np.array_split(np.arange(self.dim), parts)]
        self.books = [kmeans(rest[:, s], min(256, max(1, len(x))), 6, seed + 1 + i) for i, s in enumerate(self.cuts)]

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = nearest(x, self.centroids)
        rest = x - self.centroids[at]
        return at, np.stack([nearest(rest[:, s], b) for s, b in zip(self.cuts, self.books, strict=True)], 1).astype(np.uint8)

    def approximate(self, q: np.ndarray, at: int, codes: np.ndarray) -> np.ndarray:
        """Asymmetric inner products (queries x vectors) in one list."""
        out = np.repeat((q @ self.centroids[at])[:, None], len(codes), 1)
        for i, (s, b) in enumerate(zip(self.cuts, self.books, strict=True)):
            out += (q[:, s] @ b.T)[:, codes[:, i]]
        return out

    def visits(self, x: np.ndarray, k: int, recall: float) -> int:
        """Lists that must be visited for ``recall`` of the k nearest, measured on the fitted vectors."""
        asks = np.unique(np.linspace(0, len(x) - 1, MEASURED).astype(np.int64))
        at, found = nearest(x, self.centroids), []
        for a in range(0, len(asks), 64):
            i = asks[a : a + 64]
            score = x[i] @ x.T
            score[np.arange(len(i)), i] = -np.inf
            top = np.argpartition(-score, min(k, len(x) - 1) - 1, axis=1)[:, : min(k, len(x) - 1)] if len(x) > 1 else np.zeros((len(i), 1), np.int64)
            found.append(np.take_along_axis(self.places(x[i]), at[top], 1).ravel())
        return int(np.quantile(np.concatenate(found), recall, method="higher")) + 1

    def places(self, q: np.ndarray) -> np.ndarray:
        """Place of each list in the order in which a query visits them (queries x lists)."""
        return np.argsort(np.argsort(-(q @ self.centroids.T), axis=1, kind="stable"), axis=1)

    def margin(self, q: np.ndarray, truth: pd.DataFrame, kth: np.ndarray) -> float:
        """How far below a query's k-th best code score a true neighbour's lies at most, in lengths of the query."""
        length, most = np.sqrt((q**2).sum(1)), 0.0
        for (m, at), part in truth.groupby(["m", "at"]):
            codes = np.frombuffer(b"".join(part["codes"]), np.uint8).reshape(len(part), -1)
            if np.isfinite(kth[m]):
                most = max(most, float(kth[m] - self.approximate(q[m : m + 1], at, codes).min()) / length[m])
        return most

    def visited(self, q: np.ndarray, visits: int, held: np.ndarray, least: int) -> np.ndarray:
        """Which lists each query visits (queries x lists): the first ones, and more until they hold ``least`` vectors."""
        out = np.zeros((len(q), len(self.centroids)), bool)
        order = np.argsort(-(q @ self.centroids.T), axis=1, kind="stable")
        before = np.cumsum(held[order], axis=1) - held[order]
        np.put_along_axis(out, order, (np.arange(len(self.centroids)) < visits) | (before < least), 1)
        return out


def best_scores(q: np.ndarray, x: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query and vector positions, and exact scores, of the marked pairs."""
    at_q, at_x = np.nonzero(keep)
    score = [np.einsum("nd,nd->n", x[at_x[a : a + PAIRS]], q[at_q[a : a + PAIRS]]) for a in range(0, len(at_q), PAIRS)]
    return at_q, at_x, np.concatenate(score or [np.zeros(0)])


def hide_own(near: np.ndarray, own: np.ndarray, ids: np.ndarray, which: np.ndarray) -> np.ndarray:
    """Scores (queries x codes), with -inf for codes that only rows of the query's own id have."""
    mine, rows = np.flatnonzero(np.isin(ids, own)), np.bincount(which, minlength=near.shape[1])
    for i in np.unique(ids[mine]):
        alone = np.bincount(which[mine[ids[mine] == i]], minlength=near.shape[1])
        near[np.ix_(own == i, (alone > 0) & (alone == rows))] = -np.inf
    return near


def first_of(by: np.ndarray, order: np.ndarray, k: int) -> np.ndarray:
    """Of rows in ``order`` (sorted by ``by`` first), the first k of each value of ``by``."""
    g = by[order]
    return order[np.arange(len(g)) - np.searchsorted(g, g) < k]


def deal(sizes: dict[int, int], lists: int, most: int) -> tuple[np.ndarray, np.ndarray, int]:
    """First part and number of parts of each list, and parts in all: small lists share one, larger ones are split."""
    first, parts, at, held = np.zeros(lists, np.int64), np.ones(lists, np.int64), 0, 0
    for i in range(lists):
        n = sizes.get(i, 0)
        if n > most:
            at, held = at + (held > 0), 0
            first[i], parts[i] = at, -(-n // most)
            at += int(parts[i])
            continue
        if held + n > most:
            at, held = at + 1, 0
        first[i] = at
        held += n
    return first, parts, at + 1


def _usable(c: Column, dim: int | None = None) -> Column:
    fine = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(c, lambda x: x != 0)
    return c.isNotNull() & F.coalesce(fine, F.lit(False)) & ((F.size(c) == dim) if dim else (F.size(c) > 0))


def usable_rows(vectors: DataFrame, is_query: Column, id_col: str, vector_col: str) -> tuple[DataFrame, int, int]:
    """vec_id, v, is_query of the rows that take part; their length, and how many they are (0, 0 if none)."""
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("v"), F.coalesce(is_query, F.lit(False)).alias("is_query"))
    rows = rows.where(F.col("vec_id").isNotNull() & _usable(F.col("v")))
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    dim, n = sizes[0] if sizes else (0, 0)
    return rows.where(F.size("v") == dim), dim, n


def ranked(pairs: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return pairs.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")


def exact(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score by all pairs, with the rules of ``search``.

    Each share of the queries meets each shard of the vectors in one task, which holds both (at most ``BYTES`` of vectors
    each) and scores ``BLOCK`` queries at a time; what leaves it are k rows a query. Time grows with the pairs, memory does not.
    """
    rows, dim, n = usable_rows(vectors, is_query, id_col, vector_col)
    if not n:
        return vectors.sparkSession.createDataFrame([], SCHEMA)

    def packed(batches):
        for pdf in batches:
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "v": [np.asarray(r, float).tobytes() for r in pdf["v"]], "is_query": pdf["is_query"]})

    rows = stored(rows.mapInPandas(packed, "vec_id long, v binary, is_query boolean").withColumn("row", F.monotonically_increasing_id()))
    asks = stored(rows.where("is_query").groupBy("vec_id").agg(F.min("v").alias("v")).withColumnRenamed("vec_id", "query_id"))
    most = max(BLOCK, min(CHUNK, BYTES // (8 * dim)))
    shards, shares = max(-(-n // most), min(32, -(-n // 2048))), max(1, -(-asks.count() // most))  # small tables have many tasks too
    part = lambda c, many: F.pmod(F.xxhash64(c), F.lit(many)).cast("int")
    every = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    asked = asks.select(part("query_id", shares).alias("share"), every(shards).alias("shard"), "query_id", "v")
    cells = rows.select(part("row", shards).alias("shard"), every(shares).alias("share"), "vec_id", "v")

    def best_here(queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(found):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        found = found.sort_values("vec_id", kind="stable")
        ids, x = found["vec_id"].to_numpy(), np.frombuffer(b"".join(found["v"]), float).reshape(-1, dim)
        own, length, out = queries["query_id"].to_numpy(), np.sqrt((x**2).sum(1).max()), []
        for a in range(0, len(queries), BLOCK):
            q = np.frombuffer(b"".join(queries["v"].iloc[a : a + BLOCK]), float).reshape(-1, dim)
            near = q @ x.T
            near[own[a : a + BLOCK, None] == ids[None, :]] = -np.inf
            least = np.partition(near, max(0, len(ids) - k), axis=1)[:, max(0, len(ids) - k)]
            slack = 1e-12 * dim * length * np.sqrt((q**2).sum(1))  # products of matrices are rounded otherwise than sums of one pair
            for b in range(0, len(q), 8):  # of copies all are kept, so few queries at once
                c = slice(b, b + 8)
                at_q, at_x, score = best_scores(q[c], x, (near[c] >= (least - slack)[c, None]) & (near[c] > -np.inf))
                first = first_of(at_q, np.lexsort((at_x, -score, at_q)), k)  # found is sorted: smaller ids first
                out.append((own[a + b + at_q[first]], ids[at_x[first]], score[first]))
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, zip(*out, strict=True)), strict=True)))

    key = ["shard", "share"]
    return ranked(asked.groupBy(*key).cogroup(cells.groupBy(*key)).applyInPandas(best_here, "query_id long, vec_id long, score double"), k)


def measure(placed: DataFrame, ids: np.ndarray, q: np.ndarray, k: int) -> pd.DataFrame:
    """The k truly nearest of a few queries among all placed vectors: position of the query, list and code of the vector."""
    few = placed.sparkSession.sparkContext.broadcast((ids, q))  # MEASURED vectors
    dim = q.shape[1]

    def nearest_here(batches):
        ids, q = few.value
        best, at, codes = np.full((len(q), 0), -np.inf), np.zeros((len(q), 0), np.int64), np.zeros((len(q), 0), object)
        for pdf in batches:
            for a in range(0, len(pdf), 4096):
                part = pdf.iloc[a : a + 4096]
                score = q @ np.frombuffer(b"".join(part["v"]), float).reshape(-1, dim).T
                score[ids[:, None] == part["vec_id"].to_numpy()[None, :]] = -np.inf
                top = np.argpartition(-score, min(k, score.shape[1]) - 1, axis=1)[:, :k]
                best = np.hstack([best, np.take_along_axis(score, top, 1)])
                at, codes = np.hstack([at, part["at"].to_numpy()[top]]), np.hstack([codes, part["codes"].to_numpy()[top]])
                top = np.argpartition(-best, min(k, best.shape[1]) - 1, axis=1)[:, :k]
                best, at, codes = (np.take_along_axis(t, top, 1) for t in (best, at, codes))
        who, where = np.nonzero(best > -np.inf)
        yield pd.DataFrame({"m": who, "score": best[who, where], "at": at[who, where], "codes": codes[who, where]})

    near = placed.select("vec_id", "v", "at", "codes").mapInPandas(nearest_here, "m int, score double, at int, codes binary")
    near = near.withColumn("_rn", F.row_number().over(Window.partitionBy("m").orderBy(F.desc("score")))).where(F.col("_rn") <= k)
    return near.select("m", "at", "codes").toPandas()  # MEASURED x k rows


def search(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, probe: float | None = None, recall: float = 0.97, rerank: int | None = None, lists: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score. ``probe``: the part of the lists that each query visits, instead of a measured one.

    ``rerank``: different codes on the short list of a query, instead of a measured margin below the k best.
    """
    spark, mine = vectors.sparkSession, Tables()
    rows, dim, n = usable_rows(vectors, is_query, id_col, vector_col)
    if not n:
        return spark.createDataFrame([], SCHEMA)
    sample = rows if n <= SAMPLE else rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < int((1 << 30) * (SAMPLE / n)))
    fitted = sample.select("vec_id", "v").toArrow().sort_by("vec_id").column("v").combine_chunks()
    x = np.asarray(fitted.flatten()).reshape(-1, dim)
    many = lists or int(np.clip(2 ** round(np.log2(2 * n**0.5)), 1, max(1, SAMPLE // PER_LIST)))
    index = Index(x, min(many, max(1, len(x) // 2) if lists is None else len(x)))
    lists = len(index.centroids)
    shared = spark.sparkContext.broadcast(index)  # SAMPLE / PER_LIST + 256 vectors

    def place(batches):
        for pdf in batches:
            x = np.array(pdf["v"].tolist(), float).reshape(-1, dim)
            at, codes = shared.value.encode(x)
            yield pd.DataFrame({"vec_id": pdf["vec_id"], "at": at, "codes": [c.tobytes() for c in codes], "v": [r.tobytes() for r in x], "is_query": pdf["is_query"]})

    placed = stored(rows.mapInPandas(place, "vec_id long, at int, codes binary, v binary, is_query boolean").withColumn("row", F.monotonically_increasing_id()))
    asks = placed.where("is_query").groupBy("vec_id").agg(F.min(F.struct("v", "at")).alias("_q"), F.count("*").alias("rows")).select(F.col("vec_id").alias("query_id"), "_q.*", "rows")
    asks = mine.stored(asks)
    some = asks.orderBy(F.xxhash64("query_id"), "query_id").limit(MEASURED).toPandas()
    few = np.frombuffer(b"".join(some["v"]), float).reshape(-1, dim)
    truth = measure(placed, some["query_id"].to_numpy(), few, k) if len(few) else pd.DataFrame({"m": [], "at": []}, dtype=int)
    reach = index.places(few)[truth["m"], truth["at"]]
    visits = int(np.ceil(probe * lists)) if probe is not None else int(np.quantile(reach, recall, method="higher")) + 1 if len(reach) else 1
    visits = min(lists, max(1, visits))
    short, margin = k if rerank is None else rerank, 0.0
    held = {r[0]: r[1] for r in placed.groupBy("at").count().collect()}  # one number a list
    full_lists, enough = np.array([held.get(i, 0) for i in range(lists)]), k + (asks.agg(F.max("rows")).first()[0] or 0)
    asked = {r[0]: r[1] for r in asks.groupBy("at").count().collect()}
    groups = max(8, -(-sum(asked.values()) // 4096))
    shard, shard_parts, shards = deal(held, lists, CHUNK)
    share, share_parts, _ = deal(asked, lists, SHARE)
    plan = spark.createDataFrame([(i, int(shard[i]), int(shard_parts[i]), int(share[i]), int(share_parts[i])) for i in range(lists)], "at int, _s int, _sp int, _h int, _hp int")
    at_shard = (F.col("_s") + F.pmod(F.xxhash64("row"), F.col("_sp"))).cast("int").alias("shard")
    at_share = (F.col("_h") + F.pmod(F.xxhash64("query_id"), F.col("_hp"))).cast("int").alias("share")
    cells = placed.join(F.broadcast(plan), "at").select(at_shard, "row", "vec_id", "at", "codes", "v")

    def visit(batches):
        for pdf in batches:
            for a in range(0, len(pdf), BLOCK):
                part = pdf.iloc[a : a + BLOCK]
                seen = shared.value.visited(np.frombuffer(b"".join(part["v"]), float).reshape(-1, dim), visits, full_lists, enough)
                to = np.zeros((len(part), shards), bool)
                for i in range(lists):
                    for j in range(int(shard[i]), int(shard[i] + shard_parts[i])):
                        to[:, j] |= seen[:, i]
                who, where = np.nonzero(to)
                yield pd.DataFrame({"shard": where, "share": part["share"].to_numpy()[who], "query_id": part["query_id"].to_numpy()[who], "v": part["v"].to_numpy()[who]})

    asks = asks.join(F.broadcast(plan), "at").select("query_id", at_share, "v")
    asked = stored(asks.mapInPandas(visit, "shard int, share int, query_id long, v binary"))
    mine.drop()
    need = asked.select("shard", "share").distinct().toDF("shard", "share")
    key = ["shard", "share"]

    def scored(queries: pd.DataFrame, found: pd.DataFrame):
        """For blocks of queries and each list here: positions of the queries, rows of the list, its different codes by hash, their scores."""
        codes = np.frombuffer(b"".join(found["codes"]), np.uint8).reshape(len(found), -1)
        of = found["at"].to_numpy()
        order = np.argsort(of, kind="stable")
        edges = np.flatnonzero(np.concatenate([[True], of[order][1:] != of[order][:-1], [True]]))
        parts = []
        for lo, hi in zip(edges[:-1], edges[1:], strict=True):
            i = order[lo:hi]
            different, which = np.unique(codes[i].view(f"V{codes.shape[1]}").ravel(), return_inverse=True)
            different = different.view(np.uint8).reshape(len(different), -1)
            words = np.zeros((len(different), 16), np.uint8)
            words[:, : different.shape[1]] = different
            a, b = words.view(np.uint64).T
            parts.append((int(of[i[0]]), i, different, which, mix(a * U(3) + mix(b + U(int(of[i[0]])))).astype(np.uint32)))
        for a in range(0, len(queries), BLOCK):
            q = np.frombuffer(b"".join(queries["v"].iloc[a : a + BLOCK]), float).reshape(-1, dim)
            seen = shared.value.visited(q, visits, full_lists, enough)
            for at, i, different, which, names in parts:
                who = np.flatnonzero(seen[:, at])
                if len(who):
                    yield a, q, who, i, which, names, shared.value.approximate(q[who], at, different)

    def shortlist(queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        """The best different codes of each query: scores and hashes of the codes."""
        if not len(queries) or not len(found):
            return pd.DataFrame({"query_id": [], "best": []})
        best = np.full((len(queries), short), -np.inf, np.float32)
        name = np.zeros((len(queries), short), np.uint32)
        own, ids = queries["query_id"].to_numpy(), found["vec_id"].to_numpy()
        for a, _, who, i, which, h, near in scored(queries, found):
            both = np.hstack([best[a + who], hide_own(near, own[a + who], ids[i], which).astype(np.float32)])
            names = np.hstack([name[a + who], np.tile(h, (len(who), 1))])
            top = np.argpartition(-both, short - 1, axis=1)[:, :short]
            best[a + who], name[a + who] = np.take_along_axis(both, top, 1), np.take_along_axis(names, top, 1)
        out = [np.stack([b.view(np.uint32), m])[:, b > -np.inf].tobytes() for b, m in zip(best, name, strict=True)]
        return pd.DataFrame({"query_id": queries["query_id"], "best": out})

    def threshold(pdf: pd.DataFrame) -> pd.DataFrame:
        ids, least = [], []
        for i, part in pdf.groupby("query_id"):
            both = np.hstack([np.frombuffer(b, np.uint32).reshape(2, -1) for b in part["best"]])
            _, first = np.unique(both[1], return_index=True)
            score = np.sort(both[0, first].view(np.float32))[::-1]
            ids.append(i)
            least.append(float(score[short - 1]) if len(score) >= short else -np.inf)
        return pd.DataFrame({"query_id": ids, "least": least})

    def rescore(queries: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        if not len(queries) or not len(found):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        found = found.sort_values(["vec_id", "row"], kind="stable").reset_index(drop=True)
        ids, x = found["vec_id"].to_numpy(), np.frombuffer(b"".join(found["v"]), float).reshape(-1, dim)
        own, least = queries["query_id"].to_numpy(), queries["least"].to_numpy()
        least = least - margin * np.sqrt((np.frombuffer(b"".join(queries["v"]), float).reshape(-1, dim) ** 2).sum(1)) if margin else least
        slack = 1e-5 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))  # scores of the first pass are rounded
        out: list[tuple] = []
        block, held = 0, 0  # first query of the block, and how many of ``out`` other blocks have

        def fold() -> None:
            """Of a block's lists only k rows a query stay, however many lists lie here."""
            if len(out) > held:
                at_q, at_x, score = (np.concatenate(c) for c in zip(*out[held:], strict=True))
                first = first_of(at_q, np.lexsort((at_x, -score, at_q)), k)
                out[held:] = [(at_q[first], at_x[first], score[first])]

        for a, q, who, i, which, _, near in scored(queries, found):
            if a != block:
                fold()
                block, held = a, len(out)
            keep = (near >= (least - slack)[a + who, None])[:, which] & (ids[i][None, :] != own[a + who, None])
            at_q, at_x, score = best_scores(q[who], x[i], keep)
            at_q, at_x = a + who[at_q], i[at_x]
            first = first_of(at_q, np.lexsort((at_x, -score, at_q)), k)  # found is sorted: smaller ids first
            out.append((at_q[first], at_x[first], score[first]))
        fold()
        at_q, at_x, score = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        return pd.DataFrame({"query_id": own[at_q], "vec_id": ids[at_x], "score": score})

    codes = cells.select("shard", "vec_id", "at", "codes").join(need, "shard")
    listed = asked.groupBy(*key).cogroup(codes.groupBy(*key)).applyInPandas(shortlist, "query_id long, best binary")
    least = stored(listed.withColumn("_g", F.pmod(F.xxhash64("query_id"), F.lit(groups))).groupBy("_g").applyInPandas(threshold, "query_id long, least double"))
    if rerank is None and len(few):
        kth = least.where(F.col("query_id").isin(some["query_id"].tolist())).toPandas().set_index("query_id")["least"]
        margin = index.margin(few, truth[reach < visits], kth.reindex(some["query_id"]).to_numpy(float))
    ready = asked.join(least, "query_id")
    full = cells.join(need, "shard")
    pairs = ready.groupBy(*key).cogroup(full.groupBy(*key)).applyInPandas(rescore, "query_id long, vec_id long, score double")
    return ranked(pairs, k)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def exact_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs: what SQL gives."""
    return exact(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0).withColumn("score", F.round("score", 9))


EXACT_SQL = """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE embedding IS NOT NULL),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_dot_product(a.v, b.v) AS score FROM e a JOIN e b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, round(score, 9) AS score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20
"""
