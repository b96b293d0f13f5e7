"""From a table of detections to rows: anchor, roles, tracks, ball and events, all entities in one plan."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.operators import anchor, kinematics, roles, timeline

# What counts as resting (share of the goal's width, seconds), and the reasons of failures.
STILL_TOL, STILL_S = 0.02, 0.8


def contacts(balls: DataFrame, clips: DataFrame, goal: DataFrame) -> DataFrame:
    """pk_id, scale_ord, anchor_frame, confidence, method: the resting ball's departure at each input size.

    clips: pk_id, fps; goal: pk_id, goal_width, and its centre. A ball that rests inside the goal is no anchor.
    """
    x = balls.join(clips.select("pk_id", "fps"), "pk_id").join(goal.where("goal_width is not null").select("pk_id", "goal_width"), "pk_id")
    x = x.withColumn("_at", F.concat_ws("|", "pk_id", "scale_ord"))
    least = F.greatest(F.floor(F.col("fps") * STILL_S), F.lit(5))
    out = anchor.stationary_departure(x, "_at", "track_id", "frame_idx", "cx", "cy", F.col("goal_width") * STILL_TOL, least)
    return out.join(x.select("_at", "pk_id", "scale_ord").distinct(), "_at").drop("_at")


def run(detections: DataFrame, clips: DataFrame, geometry: DataFrame) -> dict[str, DataFrame]:
    """tracks, ball, events and failures. clips: pk_id, source, source_identifier, fps."""
    persons, balls = roles.split_detections(detections)
    goal = roles.clip_geometry(geometry, clips.select("pk_id", F.lit(None).cast("int").alias("anchor_frame")))
    found = contacts(balls, clips, goal)
    # of several input sizes the first with an anchor, else the first
    first = roles.first_scale(found).where("anchor_frame is not null")
    least = detections.groupBy("pk_id").agg(F.min("scale_ord").alias("_first"))
    chosen = least.join(first.select("pk_id", "scale_ord"), "pk_id", "left").select("pk_id", F.coalesce("scale_ord", "_first").alias("scale_ord"), (F.col("scale_ord") > F.col("_first")).alias("retried"))
    anchors = chosen.join(found, ["pk_id", "scale_ord"], "left").select("pk_id", "scale_ord", "retried", F.col("anchor_frame").cast("int").alias("anchor_frame"), "confidence", "method")
    persons, balls = (x.join(chosen.select("pk_id", "scale_ord"), ["pk_id", "scale_ord"], "left_semi") for x in (persons, balls))
    goal = roles.clip_geometry(geometry, anchors)
    stats = roles.track_stats(persons)
    keepers = roles.keeper(persons, stats, goal, anchors)
    ball_at = balls.select("pk_id", "frame_idx", F.col("cx").alias("x"), F.col("cy").alias("y"))
    kickers = roles.kicker(persons, stats, ball_at, anchors, keepers)
    timed = lambda x: x.join(clips, "pk_id").join(anchors.select("pk_id", "anchor_frame"), "pk_id", "left").withColumns({"t_s": F.col("frame_idx") / F.nullif("fps", F.lit(0.0)), "t_ms_rel_contact": timeline.relative_ms(F.col("frame_idx"), F.col("anchor_frame"), F.nullif("fps", F.lit(0.0)))})
    speed = lambda c, keys: kinematics.central_difference(c, "t_s", keys, "frame_idx")
    per = ["pk_id", "track_id"]
    tracks = timed(roles.with_roles(persons, keepers, kickers)).select(
        "pk_id", "source", "source_identifier", "role", F.col("track_id").cast("string").alias("track_id"), "frame_idx", "t_s", "t_ms_rel_contact", F.col("cx").alias("bbox_cx"), F.col("cy").alias("bbox_cy"),
        F.col("w").alias("bbox_w"), F.col("h").alias("bbox_h"), speed("cx", per).alias("vx_px_s"), speed("cy", per).alias("vy_px_s"), F.col("conf").alias("confidence"), F.lit(False).alias("is_missing"),
    )
    ball = timed(balls).select("pk_id", "source", "frame_idx", "t_s", "t_ms_rel_contact", F.col("cx").alias("x"), F.col("cy").alias("y"), speed("cx", per).alias("vx_px_s"), speed("cy", per).alias("vy_px_s"), F.col("conf").alias("confidence"), F.lit(False).alias("is_missing"))
    track = persons.join(keepers.select(*per), per, "left_semi").select("pk_id", "frame_idx", "cx", "h")
    commit = roles.keeper_commit(track, clips.select("pk_id", "fps").join(anchors.select("pk_id", "anchor_frame"), "pk_id", "left"))
    has_ball = balls.select("pk_id").distinct().withColumn("_ball", F.lit(True))
    state = clips.join(anchors, "pk_id", "left").join(goal.select("pk_id", "goal_width"), "pk_id", "left").join(has_ball, "pk_id", "left")
    reason = F.when(F.col("_ball").isNull(), "no_ball_detections").when(F.col("goal_width").isNull(), "no_goal_geometry_for_scale").when(F.col("anchor_frame").isNull(), "no_stationary_ball_track_found")
    contact = state.select("pk_id", "source", F.lit("ball_contact").alias("event_name"), F.when(reason.isNull(), F.col("anchor_frame")).alias("frame_idx"), F.col("confidence"), F.coalesce("method", F.lit("none")).alias("method"), reason.isNotNull().alias("is_missing"), reason.alias("missing_reason"))
    moved = commit.join(clips.select("pk_id", "source"), "pk_id").select("pk_id", "source", F.lit("keeper_commit").alias("event_name"), F.col("frame_idx").cast("int").alias("frame_idx"), "confidence", F.lit("lateral_speed").alias("method"), F.col("missing_reason").isNotNull().alias("is_missing"), "missing_reason")
    no_one = clips.select("pk_id").join(persons.select("pk_id").distinct(), "pk_id", "left_anti").select("pk_id", F.lit("no_person_detections").alias("reason"))
    failures = no_one.unionByName(contact.where("is_missing").select("pk_id", F.concat(F.lit("contact:"), "missing_reason").alias("reason")))
    failures = failures.unionByName(anchors.where("retried").select("pk_id", F.concat(F.lit("contact_recovered_at_scale_"), "scale_ord").alias("reason")))
    return {"tracks": tracks, "ball": ball, "events": contact.unionByName(moved), "failures": failures}
