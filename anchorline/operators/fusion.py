"""Frames of one entity: the main track with pose, keeper and ball beside it, and the checks over all tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.functions.scalars import distance
from anchorline.operators.kinematics import backward_difference, pivot_keypoints, pose_features
from anchorline.contracts import KEYPOINTS
from anchorline.operators.timeline import collapse_identity, input_order, keep_last

# Thresholds of the checks.
LIMITS = {"coverage": 0.80, "pose_pass": 0.90, "pose_warn": 0.70, "fps": (10, 120), "frames": 10, "snapshots": 0.50, "near_pass": 1.5, "near_warn": 3.0, "scale_pass": 85, "scale_warn": 50, "geometry": 0.60, "run_up_s": 2.0, "band": 4}
NUMERIC = (
    "kicker_cx", "kicker_cy", "kicker_h", "kicker_vx", "kicker_vy", "kicker_speed", "hip_shoulder_angle_deg", "pelvis_orientation_deg", "ankle_separation_n",
    "plant_ankle_x_n", "kick_ankle_x_n", "kick_ankle_vx_n", "torso_lean_deg", "keeper_cx", "keeper_cy", "keeper_vx", "keeper_vy", "ball_x", "ball_y", "ball_vx",
    "ball_vy", "kicker_ball_dist_n", "keeper_goal_offset_n",
)
#: Labels that check 12 counts.
LABELS = ("label_kick_direction", "label_goal", "label_footedness")
FLAGS = ("kicker_available", "pose_available", "keeper_available", "ball_available")
_NAMES = {"l_shoulder": 5, "r_shoulder": 6, "l_hip": 11, "r_hip": 12, "l_ankle": 15, "r_ankle": 16}


def one_identity(kicker: DataFrame) -> DataFrame:
    """One track of an entity that has several; rows without a track belong to an entity that has one at most."""
    several = kicker.groupBy("pk_id").agg(F.count_distinct("track_id").alias("_n")).where("_n > 1").select("pk_id")
    named = collapse_identity(kicker.where("track_id is not null"), "pk_id", "track_id", "t_ms_rel_contact", "_ord")
    return named.unionByName(kicker.where("track_id is null").join(several, "pk_id", "left_anti"))


def build_frames(metadata: DataFrame, tracks: DataFrame, poses: DataFrame, ball: DataFrame) -> DataFrame:
    """One row an observed frame of the kicker with an anchor time; frames that only others have are dropped."""
    key = ["pk_id", "frame_idx"]
    t = tracks.withColumn("_ord", input_order(tracks)).where("frame_idx >= 0")
    k = keep_last(one_identity(t.where("role = 'kicker'")), key, "_ord")
    k = k.select(
        *key, "source", "t_s", "t_ms_rel_contact", F.col("bbox_cx").alias("kicker_cx"), F.col("bbox_cy").alias("kicker_cy"), F.col("bbox_h").alias("kicker_h"),
        F.col("vx_px_s").alias("kicker_vx"), F.col("vy_px_s").alias("kicker_vy"), distance(F.col("vx_px_s"), F.col("vy_px_s")).alias("kicker_speed"), (~F.col("is_missing")).alias("kicker_available"),
    )
    p = poses.where("role = 'kicker' and frame_idx >= 0")
    seen = p.groupBy(*key).agg(F.count_if(~F.col("is_missing")).cast("byte").alias("pose_n_visible_kp"))
    xy = p.withColumn("_ord", input_order(poses)).select(*key, "kp_index", F.col("x_n").alias("x"), F.col("y_n").alias("y"), "_ord")
    wide = pivot_keypoints(xy, key, "kp_index", sorted(KEYPOINTS), "_ord")  # a frame stays if any of its points has a value
    meta = metadata.select("pk_id", "fps", "label_footedness")
    f = pose_features(F.col("label_footedness"), {n: (F.col(f"x_{i}"), F.col(f"y_{i}")) for n, i in _NAMES.items()})
    feats = wide.join(meta, "pk_id").select(
        *key, "fps", f["hip_shoulder_deg"].alias("hip_shoulder_angle_deg"), f["pelvis_deg"].alias("pelvis_orientation_deg"), f["ankle_separation"].alias("ankle_separation_n"),
        f["plant_ankle_x"].alias("plant_ankle_x_n"), f["kick_ankle_x"].alias("kick_ankle_x_n"), f["torso_lean_deg"].alias("torso_lean_deg"),
    )
    feats = feats.withColumn("kick_ankle_vx_n", backward_difference("kick_ankle_x_n", ["pk_id"], "frame_idx", F.col("fps"))).drop("fps").join(seen, key)
    none = F.lit(0).cast("byte")
    feats = feats.withColumn("pose_available", F.col("pose_n_visible_kp") > 0)
    keeper = keep_last(t.where("role = 'keeper'"), key, "_ord").select(*key, F.col("bbox_cx").alias("keeper_cx"), F.col("bbox_cy").alias("keeper_cy"), F.col("vx_px_s").alias("keeper_vx"), F.col("vy_px_s").alias("keeper_vy"), (~F.col("is_missing")).alias("keeper_available"))
    b = keep_last(ball.withColumn("_ord", input_order(ball)).where("frame_idx >= 0"), key, "_ord").select(*key, F.col("x").alias("ball_x"), F.col("y").alias("ball_y"), F.col("vx_px_s").alias("ball_vx"), F.col("vy_px_s").alias("ball_vy"), (~F.col("is_missing")).alias("ball_available"))
    out = k.join(feats, key, "left").join(keeper, key, "left").join(b, key, "left")
    out = out.withColumns({c: F.coalesce(c, F.lit(False)) for c in FLAGS} | {"pose_n_visible_kp": F.coalesce("pose_n_visible_kp", none)})
    gap = distance(F.col("ball_x") - F.col("kicker_cx"), F.col("ball_y") - F.col("kicker_cy"))
    out = out.withColumns({"kicker_ball_dist_n": F.when(F.col("kicker_h") > 0, gap / F.col("kicker_h")), "keeper_goal_offset_n": F.lit(None).cast("double"), "is_observed_frame": F.lit(True)})
    return out.where("t_ms_rel_contact is not null")


def entity_checks(metadata: DataFrame, tracks: DataFrame, poses: DataFrame, ball: DataFrame, geometry: DataFrame, events: DataFrame, snapshots: DataFrame) -> DataFrame:
    """pk_id, check_ord, check, status, value, threshold: one aggregate an input, joined on the entity, then unfolded."""
    L, c = LIMITS, F.col
    labels = [n for n in LABELS if n in metadata.columns]
    m = metadata.select("pk_id", "fps", "n_frames", "media_kind", "label_provenance", *labels)
    con = events.where("event_name = 'ball_contact'").groupBy("pk_id").agg(F.max(F.when(~c("is_missing"), c("frame_idx"))).alias("cf"), F.max("method").alias("c_method"), F.max("confidence").alias("c_conf"))
    x = m.join(con, "pk_id", "left")
    kick = tracks.where("role = 'kicker' and frame_idx >= 0")
    run_up = x.select("pk_id", "cf", F.when((c("cf") - c("fps")).isNotNull(), F.greatest(c("cf") - (L["run_up_s"] * c("fps")).cast("int"), F.lit(0))).alias("lo"))
    near = c("frame_idx").between(c("cf") - L["band"], c("cf") + L["band"])
    w = kick.join(run_up, "pk_id").groupBy("pk_id").agg(
        F.count("*").alias("rows"), F.count_if(~c("is_missing")).alias("seen"), F.count_distinct("track_id").alias("tracks"), F.count_if(~c("is_missing") & c("frame_idx").between(c("lo"), c("cf"))).alias("in_run"),
        F.max(F.when(c("lo").isNotNull(), F.greatest(c("cf") - c("lo") + 1, F.lit(1)))).alias("span"), F.sort_array(F.collect_list(F.when(near, F.struct("frame_idx", "bbox_cx", "bbox_cy", "bbox_h")))).alias("band"),
    )
    at = F.get("band", F.floor(F.size("band") / 2).cast("int"))
    w = w.select("pk_id", "rows", "seen", "tracks", "in_run", "span", at.alias("mid"))
    scale = tracks.where("frame_idx >= 0 and bbox_h is not null").groupBy("pk_id", "role").agg(F.median("bbox_h").alias("h")).groupBy("pk_id").agg(F.max("h").alias("scale"))
    pose = poses.where("frame_idx >= 0").groupBy("pk_id").agg(F.avg((~c("is_missing")).cast("double")).alias("complete"))
    keeper = tracks.where("role = 'keeper' and frame_idx >= 0 and not is_missing").groupBy("pk_id").agg(F.count("*").alias("n_keeper"))
    real = ball.where("frame_idx >= 0 and not is_missing")
    bl = real.join(con.select("pk_id", "cf"), "pk_id", "left").groupBy("pk_id").agg(F.count("*").alias("n_ball"), F.max(F.when(c("frame_idx") <= c("cf"), F.struct("frame_idx", "x", "y"))).alias("b"), F.count_if(c("frame_idx") <= c("cf")).alias("before"))
    geo = geometry.groupBy("pk_id").agg(F.avg((~c("is_missing")).cast("double")).alias("goal"))
    sn = snapshots.groupBy("pk_id").agg(F.avg(c("snapshot_available").cast("double")).alias("avail"), F.max(F.when(c("offset_ms") == 0, c("snapshot_available"))).alias("at0"))
    for part in (w, scale, pose, keeper, bl, geo, sn):
        x = x.join(part, "pk_id", "left")
    flat = c("media_kind").isin("pose_table", "render_only", "none")
    none = F.lit(None).cast("double")
    span = F.when(c("span").isNotNull(), c("in_run") / c("span")).otherwise(c("seen") / F.greatest(F.coalesce("n_frames", F.lit(0)), F.lit(1)))
    d = distance(c("b.x") - c("mid.bbox_cx"), c("b.y") - c("mid.bbox_cy")) / F.greatest(c("mid.bbox_h"), F.lit(1.0))
    n = F.when(F.coalesce("n_frames", F.lit(0)) > 0, c("n_frames")).otherwise(F.coalesce("rows", F.lit(0)))
    ok = lambda cond, bad: F.when(cond, "pass").otherwise(bad)
    rows = [
        ("contact_anchor", F.when(c("cf").isNull(), "fail").when(c("c_method").contains("latest_of_multiple"), "warn").otherwise("pass"), c("c_conf"), none),
        ("kicker_track", F.when(c("seen").isNull(), "fail").otherwise(ok(span >= L["coverage"], "warn")), span, F.lit(L["coverage"])),
        ("kicker_track_single_identity", F.when(c("seen").isNotNull(), ok(c("tracks") <= 1, "warn")), c("tracks"), F.lit(1.0)),
        ("pose_completeness", F.when(c("complete") >= L["pose_pass"], "pass").when(c("complete") >= L["pose_warn"], "warn").otherwise("fail"), c("complete"), F.lit(L["pose_warn"])),
        ("keeper_track", F.when(flat, "na").otherwise(ok(c("n_keeper") > 0, "fail")), none, none),
        ("ball_track", F.when(flat, "na").otherwise(ok(c("n_ball") > 0, "fail")), none, none),
        ("fps_plausible", ok(c("fps").between(*L["fps"]), "fail"), c("fps"), none),
        ("min_frames", ok(n >= L["frames"], "fail"), n, F.lit(float(L["frames"]))),
        ("snapshot_coverage", F.when(c("avail").isNull(), "fail").otherwise(ok(c("avail") >= L["snapshots"], "warn")), c("avail"), F.lit(L["snapshots"])),
        ("snapshot_at_contact", F.when(c("avail").isNotNull(), ok(c("at0"), "fail")), none, none),
        ("kicker_at_ball", F.when(flat | c("cf").isNull(), "na").when(F.coalesce("before", F.lit(0)) == 0, "fail").when(c("mid").isNull(), "fail").when(d <= L["near_pass"], "pass").when(d <= L["near_warn"], "warn").otherwise("fail"), d, F.lit(L["near_pass"])),
        ("labels_present", F.when(c("label_kick_direction").isNotNull(), "pass").when(c("label_provenance").startswith("none"), "warn").otherwise("fail"), sum((c(n).isNotNull().cast("int") for n in labels), F.lit(0)), F.lit(1.0)),
        ("scene_scale", F.when(flat, "na").when(c("scale") >= L["scale_pass"], "pass").when(c("scale") >= L["scale_warn"], "warn").otherwise("fail"), c("scale"), F.lit(float(L["scale_pass"]))),
        ("goal_geometry", F.when(flat, "na").when(c("goal") >= L["geometry"], "pass").when(c("goal") > 0, "warn").otherwise("fail"), c("goal"), F.lit(L["geometry"])),
    ]
    facts = F.array(*[F.struct(F.lit(i).alias("check_ord"), F.lit(name).alias("check"), s.alias("status"), v.cast("double").alias("value"), t.cast("double").alias("threshold")) for i, (name, s, v, t) in enumerate(rows, 1)])
    return x.select("pk_id", F.explode(facts).alias("f")).select("pk_id", "f.*").where("status is not null")
