"""Roles of tracks in a clip, medians of its geometry, and the first commit of a keeper."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from anchorline.functions.scalars import distance
from anchorline.operators.kinematics import central_difference
from anchorline.operators.series import separation


def clip_geometry(geometry: DataFrame, anchors: DataFrame) -> DataFrame:
    """pk_id, goal_width, goal_cx, goal_cy: medians of found frames; the centre from frames before the anchor where there are any."""
    g = geometry.where("not is_missing").join(anchors.select("pk_id", "anchor_frame"), "pk_id", "left")
    cx, cy = (F.col("post_left_x") + F.col("post_right_x")) / 2, (F.col("crossbar_y") + F.greatest("post_left_y", "post_right_y")) / 2
    pre = F.col("frame_idx") <= F.col("anchor_frame")
    out = g.groupBy("pk_id").agg(
        F.median("goal_width_px").alias("goal_width"), F.count_if(pre).alias("_pre"), F.median(F.when(pre, cx)).alias("_px"), F.median(F.when(pre, cy)).alias("_py"), F.median(cx).alias("_ax"), F.median(cy).alias("_ay")
    )
    pick = lambda p, a: F.when(F.col("_pre") > 0, F.col(p)).otherwise(F.col(a))
    return out.select("pk_id", F.when(F.col("goal_width") > 0, F.col("goal_width")).alias("goal_width"), pick("_px", "_ax").alias("goal_cx"), pick("_py", "_ay").alias("goal_cy"))


def track_stats(persons: DataFrame, share: float = 0.08) -> DataFrame:
    """Tracks of at least max(3, share of the clip's frames) rows: medians, spans and travel in box heights."""
    frames = persons.groupBy("pk_id").agg(F.count_distinct("frame_idx").alias("_frames"))
    t = persons.groupBy("pk_id", "track_id").agg(
        F.count("*").alias("n"), F.median("cx").alias("cx_med"), F.median("cy").alias("cy_med"), (F.max("cx") - F.min("cx")).alias("cx_span"), (F.max("cy") - F.min("cy")).alias("cy_span"), F.median("h").alias("h_med")
    )
    t = t.join(frames, "pk_id").where(F.col("n") >= F.greatest(F.lit(3), (F.col("_frames") * share).cast("int"))).drop("_frames")
    return t.withColumn("travel", distance(F.col("cx_span"), F.col("cy_span")) / F.greatest("h_med", F.lit(1.0)))


def _fallback(main: DataFrame, rest: DataFrame) -> DataFrame:
    """Entities without a main pick take the fallback at half its confidence."""
    other = rest.join(main.select("pk_id"), "pk_id", "left_anti").withColumn("confidence", F.col("confidence") * 0.5)
    return main.unionByName(other).select("pk_id", "track_id", "confidence")


def keeper(persons: DataFrame, stats: DataFrame, geometry: DataFrame, anchors: DataFrame) -> DataFrame:
    """The track closest to the goal's centre before the anchor, in goal widths; without geometry the highest in the picture."""
    p = persons.join(stats.select("pk_id", "track_id"), ["pk_id", "track_id"]).join(geometry.where("goal_width is not null"), "pk_id").join(anchors.select("pk_id", "anchor_frame"), "pk_id", "left")
    p = p.where(F.col("anchor_frame").isNull() | (F.col("frame_idx") <= F.col("anchor_frame")))
    d = distance(F.col("cx") - F.col("goal_cx"), F.col("cy") - F.col("goal_cy")) / F.col("goal_width")
    near = p.groupBy("pk_id", "track_id").agg(F.median(d).alias("score"))
    return _fallback(separation(near, "pk_id", "score", "track_id"), separation(stats.select("pk_id", "track_id", F.col("cy_med").alias("score")), "pk_id", "score", "track_id"))


def kicker(persons: DataFrame, stats: DataFrame, ball: DataFrame, anchors: DataFrame, keepers: DataFrame, band: int = 5) -> DataFrame:
    """The track that comes closest to the last ball seen before the anchor, around it; else the one that travels most."""
    free = stats.join(keepers.select("pk_id", "track_id"), ["pk_id", "track_id"], "left_anti")
    last = ball.join(anchors.where("anchor_frame is not null"), "pk_id").where("frame_idx <= anchor_frame").groupBy("pk_id").agg(F.max_by(F.struct("x", "y"), "frame_idx").alias("b"), F.max("anchor_frame").alias("a"))
    p = persons.join(free.select("pk_id", "track_id"), ["pk_id", "track_id"]).join(last, "pk_id").where(F.col("frame_idx").between(F.col("a") - band, F.col("a") + band))
    near = p.groupBy("pk_id", "track_id").agg(F.min(distance(F.col("cx") - F.col("b.x"), F.col("cy") - F.col("b.y"))).alias("score"))
    return _fallback(separation(near, "pk_id", "score", "track_id"), separation(free.select("pk_id", "track_id", (-F.col("travel")).alias("score")), "pk_id", "score", "track_id"))


def with_roles(persons: DataFrame, keepers: DataFrame, kickers: DataFrame) -> DataFrame:
    named = keepers.select("pk_id", "track_id", F.lit("keeper").alias("role")).unionByName(kickers.select("pk_id", "track_id", F.lit("kicker").alias("role")))
    return persons.join(named, ["pk_id", "track_id"], "left").withColumn("role", F.coalesce("role", F.lit("other")))


def split_detections(detections: DataFrame, person: float = 0.35, ball: float = 0.15) -> tuple[DataFrame, DataFrame]:
    """Persons and balls above their confidence; rows without a track id are skipped."""
    d = detections.where("track_id is not null")
    return d.where((F.col("cls") == "person") & (F.col("conf") >= person)), d.where((F.col("cls") == "ball") & (F.col("conf") >= ball))


def keeper_commit(track: DataFrame, anchors: DataFrame, before_s: float = 1.2, after_s: float = 0.6, limit: float = 0.35, least: int = 4) -> DataFrame:
    """First frame around the anchor whose sideways speed exceeds ``limit`` box heights a second, or why there is none.

    track: pk_id, frame_idx, cx, h; anchors: pk_id, anchor_frame, fps. Speeds are computed inside the window.
    """
    n = track.groupBy("pk_id").agg(F.count("*").alias("n_all"))
    x = track.join(anchors.where("anchor_frame is not null"), "pk_id")
    x = x.where((F.col("frame_idx") >= F.col("anchor_frame") - before_s * F.col("fps")) & (F.col("frame_idx") <= F.col("anchor_frame") + after_s * F.col("fps")))
    x = x.withColumn("_t", F.col("frame_idx") / F.col("fps")).withColumn("vx", central_difference("cx", "_t", ["pk_id"], "frame_idx"))
    x = x.withColumn("_h", F.median("h").over(Window.partitionBy("pk_id"))).withColumn("rel", F.abs("vx") / F.col("_h"))
    hit = x.groupBy("pk_id").agg(F.count("*").alias("n"), F.max("_h").alias("_h"), F.min(F.when(F.col("rel") > limit, F.struct("frame_idx", "rel"))).alias("hit"))
    out = anchors.select("pk_id", "anchor_frame").join(n, "pk_id", "left").join(hit, "pk_id", "left")
    reason = (
        F.when(F.col("anchor_frame").isNull(), "no_anchor").when(F.coalesce("n_all", F.lit(0)) < least, "track_too_short").when(F.coalesce("n", F.lit(0)) < least, "track_absent_around_anchor")
        .when(F.col("_h").isNull() | (F.col("_h") <= 0), "no_scale").when(F.col("hit").isNull(), "no_commit_seen")
    )
    ok = reason.isNull()
    conf = F.greatest(F.lit(0.15), F.least(F.lit(0.9), F.col("hit.rel") / (2 * limit)))
    return out.select("pk_id", F.when(ok, F.col("hit.frame_idx")).alias("frame_idx"), F.when(ok, conf).alias("confidence"), reason.alias("missing_reason"))


def mask_keypoints(poses: DataFrame, least: float = 0.3) -> DataFrame:
    low = F.coalesce(F.col("confidence") < least, F.lit(True))
    out = poses.withColumns({c: F.when(~low, F.col(c)) for c in ("x", "y")})
    return out.withColumns({"is_missing": low, "missing_reason": F.when(low, "keypoint_low_confidence")})


def first_scale(contacts: DataFrame, ordinal: str = "scale_ord") -> DataFrame:
    """Of contacts found at several input sizes, that of the first size with one."""
    found = F.when(F.col("anchor_frame").isNotNull(), F.col(ordinal))
    return contacts.groupBy("pk_id").agg(F.min_by("anchor_frame", found).alias("anchor_frame"), F.min(found).alias(ordinal))
