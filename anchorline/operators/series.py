"""Repairs of a per-frame series, roles and matching."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from anchorline.functions.scalars import iou


def consensus_reject(df: DataFrame, key: str, width: str, centre: str, columns: Sequence[str], least: int = 5, low: float = 0.6, high: float = 1.5, off: float = 0.75, reason: str = "inconsistent_with_consensus") -> DataFrame:
    """Rows that differ from the entity's median width or centre lose their values and say why."""
    w = Window.partitionBy(key)
    found = F.col(width).isNotNull()
    n, mw, mc = F.count(width).over(w), F.median(width).over(w), F.median(centre).over(w)
    df = df.withColumn("_bad", found & (n >= least) & (~F.col(width).between(low * mw, high * mw) | (F.abs(F.col(centre) - mc) > off * mw)))
    df = df.withColumn("missing_reason", F.when(F.col("_bad"), reason).otherwise(F.col("missing_reason") if "missing_reason" in df.columns else F.lit(None).cast("string")))
    return df.select(*[F.when(~F.col("_bad"), F.col(c)).alias(c) if c in columns else F.col(c) for c in df.columns if c != "_bad"])


def gap_fill(df: DataFrame, key: str, order: str, values: Sequence[str], max_gap: int = 15, confidence: str | None = None) -> DataFrame:
    """Linear between found neighbours at most ``max_gap`` rows apart, weighted by row position; never beyond the ends."""
    w = Window.partitionBy(key).orderBy(order)
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    df = df.withColumn("_i", F.row_number().over(w))
    found = F.col(values[0]).isNotNull()
    cols = [*values, *([confidence] if confidence else [])]
    mark = F.when(found, F.struct("_i", *cols))
    df = df.withColumn("_b", F.last(mark, True).over(back)).withColumn("_a", F.first(mark, True).over(ahead))
    gap = F.col("_a._i") - F.col("_b._i")
    fill = ~found & (gap <= max_gap)
    t = (F.col("_i") - F.col("_b._i")) / gap
    out = df.withColumn("filled", F.coalesce(fill, F.lit(False)))
    for c in values:
        out = out.withColumn(c, F.when(F.col("filled"), F.col(f"_b.{c}") * (F.lit(1.0) - t) + F.col(f"_a.{c}") * t).otherwise(F.col(c)))
    if confidence:
        ends = F.coalesce(F.least(f"_b.{confidence}", f"_a.{confidence}"), F.lit(0.3)) * 0.7
        out = out.withColumn(confidence, F.when(F.col("filled"), ends).otherwise(F.col(confidence)))
    return out.drop("_i", "_b", "_a")


def separation(df: DataFrame, key: str, score: str, label: str) -> DataFrame:
    """Best label (least score, ties by label) and how far the runner-up is: clip(|second-best|/|second|, .1, .95); alone .3."""
    w = Window.partitionBy(key).orderBy(score, label)
    top = df.withColumn("_rn", F.row_number().over(w)).where("_rn <= 2")
    out = top.groupBy(key).agg(
        F.max(F.when(F.col("_rn") == 1, F.col(label))).alias(label), F.max(F.when(F.col("_rn") == 1, F.col(score))).alias("_best"), F.max(F.when(F.col("_rn") == 2, F.col(score))).alias("_second")
    )
    conf = F.abs(F.col("_second") - F.col("_best")) / F.greatest(F.abs(F.col("_second")), F.lit(1e-6))
    conf = F.when(F.col("_second").isNull(), 0.3).otherwise(F.greatest(F.lit(0.1), F.least(F.lit(0.95), conf)))
    return out.select(key, label, F.col("_best").alias("score"), conf.alias("confidence"))


#: Distinct boxes of a frame, of either side, in one task of ``best_overlap``; boxes in a node of its tree; left boxes looked up at once.
BOXES, NODE, BATCH = 16_384, 16, 1024


class BoxTree:
    """Boxes by position under bounding boxes; finds each asked box the box of greatest IoU, the least id of equals.

    A node's bound is the IoU of its best imaginable box, by the operations that score a box. Rounding keeps their order, so the
    bound is never below a score to the last bit, and what is left out can neither be better nor an equal of smaller id.
    """

    def __init__(self, box: np.ndarray, ids: np.ndarray):
        x1, y1, x2, y2 = box
        c = (x2 - x1) * (y2 - y1)
        alike = np.unique(np.stack([c, x1, x2]), axis=1, return_inverse=True)[1].ravel()
        if alike.max() >= len(ids) // NODE:  # few boxes share area and columns: tiles of the plane
            slab = np.empty(len(ids), np.int64)
            slab[np.argsort(x1, kind="stable")] = np.arange(len(ids)) // int(NODE * np.ceil(np.sqrt(len(ids) / NODE)))
            alike = slab
        order = np.lexsort((y1, alike))
        rows = np.stack([x1, y1, x2, y2, x2 - x1, y2 - y1, c, ids])[:, order]
        self.levels = []  # from boxes to at most NODE nodes: x1, y1, x2, y2, width, height, area, id
        while True:
            nodes = -(-rows.shape[1] // NODE)
            none = np.array([np.inf, np.inf, -np.inf, -np.inf, 0, 0, np.inf, np.inf])
            rows = np.hstack([rows, np.repeat(none[:, None], nodes * NODE - rows.shape[1], 1)]).reshape(8, nodes, NODE)
            self.levels.append(rows)
            if nodes == 1:
                break
            rows = np.stack([f(r, axis=1) for f, r in zip((np.min, np.min, np.max, np.max, np.max, np.max, np.min, np.min), rows, strict=True)])

    @staticmethod
    def bound(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        w = np.maximum(0.0, np.minimum(np.minimum(a[2], b[2]) - np.maximum(a[0], b[0]), b[4]))
        h = np.maximum(0.0, np.minimum(np.minimum(a[3], b[3]) - np.maximum(a[1], b[1]), b[5]))
        both = w * h
        total = (a[2] - a[0]) * (a[3] - a[1]) + b[6] - both
        return np.divide(both, total, out=np.full(both.shape, np.inf), where=total > 0)

    def best(self, a: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Greatest IoU of each box (4 x boxes) and the id that has it; an id of inf where none reaches ``least``."""
        score, found = np.full(a.shape[1], least), np.full(a.shape[1], np.inf)

        def look(who: np.ndarray, leaf: np.ndarray) -> None:  # one leaf a box at most
            rows = self.levels[0][:, leaf]
            u, ids = self.bound(a[:, who, None], rows), rows[7]
            top = u.max(1)
            first = np.where(u == top[:, None], ids, np.inf).min(1)
            better = (top > score[who]) | ((top == score[who]) & (first < found[who]))
            score[who[better]], found[who[better]] = top[better], first[better]

        every = np.arange(a.shape[1])
        node = np.zeros(a.shape[1], np.int64)
        for rows in self.levels[:0:-1]:  # straight down to a first answer
            u = self.bound(a[:, :, None], rows[:, node])
            ids = np.where(u == u.max(1)[:, None], rows[7][node], np.inf)
            node = node * NODE + np.where(np.isfinite(ids.min(1)), ids.argmin(1), 0)
        look(every, node)
        who, node, u = every, np.zeros(a.shape[1], np.int64), np.full(a.shape[1], np.inf)
        for rows in self.levels[:0:-1]:  # then all that could do better
            u, ids = self.bound(a[:, who, None], rows[:, node]), rows[7][node]
            i, j = np.nonzero((u > score[who, None]) | ((u == score[who, None]) & (ids < found[who, None])))
            who, node, u, ids = who[i], node[i] * NODE + j, u[i, j], ids[i, j]
        if len(self.levels) > 1:
            order = np.lexsort((ids, -u, who))
            who, node, u, ids = who[order], node[order], u[order], ids[order]
            while len(who):
                first = np.concatenate([[True], who[1:] != who[:-1]])
                look(who[first], node[first])
                keep = ~first & ((u > score[who]) | ((u == score[who]) & (ids < found[who])))
                who, node, u, ids = who[keep], node[keep], u[keep], ids[keep]
        return score, found


def best_overlap(left: DataFrame, right: DataFrame, on: Sequence[str], left_id: str, right_id: str, a: Sequence[str], b: Sequence[str], least: float) -> DataFrame:
    """For each left row the right row of the same frame with the greatest IoU, if it reaches ``least`` (above 0); ties to the least id.

    Equal boxes are looked up once, and a tree of a frame's right boxes leaves out what cannot be best, so pairs are not formed.
    Boxes that are not finite, which no tree can hold, are compared in pairs.
    """
    if not least > 0:
        raise ValueError("least must be above 0")
    finite = lambda box: reduce(and_, [F.abs(F.col(c)) < float("inf") for c in box])
    fine_l, fine_r = left.where(finite(a)), right.where(finite(b))
    most = [df.groupBy(*on).count().agg(F.max("count")).first()[0] or 1 for df in (left, right)]
    parts = [-(-n // BOXES) for n in most]
    every = lambda many: F.explode(F.sequence(F.lit(0), F.lit(many - 1)))
    dealt = lambda box, many: F.pmod(F.xxhash64(*box), F.lit(many)).cast("int")
    asks = fine_l.select(*on, *a).distinct().select(*on, *a, dealt(a, parts[0]).alias("_l"), every(parts[1]).alias("_r"))
    cells = fine_r.groupBy(*on, *b).agg(F.min(right_id).alias("_id")).select(*on, *b, "_id", dealt(b, parts[1]).alias("_r"), every(parts[0]).alias("_l"))

    def match(asked: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        box = held[list(b)].to_numpy(float).T
        plain = lambda x: (x[2] > x[0]) & (x[3] > x[1]) & ((x[2] - x[0]) * (x[3] - x[1]) > 0)  # noqa: E731 (others overlap nothing)
        area, asked = plain(box), asked[plain(asked[list(a)].to_numpy(float).T)]
        if not len(asked) or not area.any():
            return asked[[*on, *a]].iloc[:0].assign(score=[], _id=[])
        ids, names = np.unique(held["_id"].to_numpy()[area], return_inverse=True)
        tree, q = BoxTree(box[:, area], names.astype(float)), asked[list(a)].to_numpy(float).T
        score, found = (np.concatenate(c) for c in zip(*[tree.best(q[:, i : i + BATCH], least) for i in range(0, q.shape[1], BATCH)], strict=True))
        hit = np.isfinite(found)
        return asked.loc[hit, [*on, *a]].assign(score=score[hit], _id=ids[found[hit].astype(np.int64)])

    key = [*on, "_l", "_r"]
    schema = T.StructType([*[left.schema[c] for c in (*on, *a)], T.StructField("score", T.DoubleType()), T.StructField("_id", right.schema[right_id].dataType)])
    best = asks.groupBy(*key).cogroup(cells.groupBy(*key)).applyInPandas(match, schema)
    pairs = fine_l.join(best, [*on, *a]).select(left_id, F.col("_id").alias(right_id), "score")
    score = iou([F.col(c) for c in a], [F.col(c) for c in b])
    for x, y in ((left.where(~finite(a)), right), (fine_l, right.where(~finite(b)))):
        pairs = pairs.unionByName(x.join(y, list(on)).withColumn("score", score).where(F.col("score") >= least).select(left_id, right_id, "score"))
    # the first by score from above (NaN is above all), then by id, is combined before the shuffle
    best = pairs.groupBy(left_id).agg(F.min(F.struct((~F.isnan("score")).alias("n"), (-F.col("score")).alias("s"), F.col(right_id).alias("i"))).alias("_b"))
    return best.select(left_id, F.col("_b.i").alias(right_id), (-F.col("_b.s")).alias("score"))


def near_hits(points: DataFrame, lit: DataFrame, on: Sequence[str], tol: int, point_id: str) -> DataFrame:
    """Points with a lit pixel within ``tol`` in both directions: equi-join on tol-sized cells and their neighbours."""
    cell = lambda c, d=0: (F.floor(F.col(c) / max(tol, 1)) + d).cast("long")
    around = F.array(*[F.struct(cell("x", i).alias("cx"), cell("y", j).alias("cy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    p = points.select(*on, point_id, "x", "y", F.explode(around).alias("c")).select(*on, point_id, F.col("x").alias("px"), F.col("y").alias("py"), "c.cx", "c.cy")
    q = lit.select(*on, "x", "y", cell("x").alias("cx"), cell("y").alias("cy"))
    hit = (F.abs(F.col("px") - F.col("x")) <= tol) & (F.abs(F.col("py") - F.col("y")) <= tol)
    return p.join(q, [*on, "cx", "cy"]).where(hit).select(*on, point_id).distinct()


def modal(df: DataFrame, key: str, label: str) -> DataFrame:
    """Most frequent label of each entity, the smallest of equals."""
    w = Window.partitionBy(key).orderBy(F.desc("n"), label)
    return df.groupBy(key, label).agg(F.count("*").alias("n")).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def middle_row(df: DataFrame, key: str, order: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(order)
    n = F.count("*").over(Window.partitionBy(key))
    return df.withColumn("_rn", F.row_number().over(w)).withColumn("_n", n).where(F.col("_rn") == F.floor(F.col("_n") / 2) + 1).drop("_rn", "_n")


def track_diagnostics(df: DataFrame, key: str, track: str, frame: str, x: str, y: str, confidence: str, top: int | None = None) -> DataFrame:
    """Length, frame range, mean confidence and extent of each track; the ``top`` longest of an entity, ties by track."""
    out = df.groupBy(key, track).agg(
        F.count("*").alias("n"), F.min(frame).alias("first_frame"), F.max(frame).alias("last_frame"), F.avg(confidence).alias("mean_confidence"),
        F.min(x).alias("x_min"), F.max(x).alias("x_max"), F.min(y).alias("y_min"), F.max(y).alias("y_max"),
    )
    if top is None:
        return out
    w = Window.partitionBy(key).orderBy(F.desc("n"), track)
    return out.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= top).drop("_rn")


def longest_track(df: DataFrame, key: str, track: str) -> DataFrame:
    """Rows of an entity and length of its longest track."""
    per = df.groupBy(key, track).agg(F.count("*").alias("n"))
    return per.groupBy(key).agg(F.sum("n").alias("n_rows"), F.max("n").alias("longest"))


def speed_profile(df: DataFrame, key: str, speed: str) -> DataFrame:
    """Exact quartile, ninth decile and maximum of a speed; nulls take no part."""
    return df.groupBy(key).agg(F.percentile(speed, F.lit(0.25)).alias("p25"), F.percentile(speed, F.lit(0.9)).alias("p90"), F.max(speed).alias("max_speed"))
