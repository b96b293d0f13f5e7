"""From a raw pose table to a published set, replayed; and roles of tracks."""

import pytest
from pyspark.sql import functions as F

from anchorline import engine, store
from anchorline.operators import roles


def raw_table(spark):
    kp = {f"kp_{k}_{s}": "1" for k in range(5, 17) for s in ("x", "y", "xc", "yc")}
    rows = []
    for kick, n, marks in (("01", 60, {59}), ("2", 30, {20, 25}), ("3", 12, set())):
        for f in range(n):
            rows.append({"kick_id": kick, "frame": str(f), "last_touch": "1" if f in marks else "", "track_id": "a" if f < 50 or kick != "2" else "b", "camera_direction": "L", "r_or_l": "R", "kick_direction": "C" if kick != "3" else "", "goal": "1", "bbox_cx": str(100 + f), "bbox_cy": "200", "bbox_w": "40", "bbox_h": "100", **kp})
    cols = list(rows[0])
    return spark.createDataFrame([tuple(r[c] for c in cols) for r in rows], ", ".join(f"{c} string" for c in cols))


def test_end_to_end(spark, tmp_path):
    cfg = engine.Config(str(tmp_path))
    for _ in range(2):  # replaying changes nothing
        engine.ingest_pose_table(spark, cfg, raw_table(spark), "poses-v1", "fam", "2024-01-01T00:00:00Z")
        engine.process(spark, cfg)
        summary = {r.check: r for r in engine.grade(spark, cfg).collect()}
    read = lambda t: store.read_table(spark, cfg.path(t), t)
    assert {t: read(t).count() for t in ("metadata", "tracks", "poses", "ball", "geometry", "events", "temporal_snapshots")} == {"metadata": 3, "tracks": 105, "poses": 102 * 12, "ball": 3, "geometry": 3, "events": 9, "temporal_snapshots": 21}
    m = {r.source_identifier: r for r in read("metadata").collect()}
    assert m["01"].pk_id == "poses-v1:1" and m["3"].qc_status == "fail" and "contact_anchor:warn" in m["2"].qc_reasons
    s = {(r.pk_id, r.offset_ms): r for r in read("temporal_snapshots").collect()}
    assert s["poses-v1:1", -2000].snapshot_available and s["poses-v1:2", -2000].unavailable_reason == "before_clip_start" and s["poses-v1:3", 0].unavailable_reason == "no_anchored_frames"
    assert s["poses-v1:1", 0].frame_idx == 59 and s["poses-v1:3", 0].frame_idx == -1 and summary["ball_track"].n_na == 3
    assert [r.pk_id for r in engine.worst_first(read("metadata"), 1).collect()] == ["poses-v1:3"]
    man = engine.publish(spark, cfg, str(tmp_path / "out"), F.col("source_identifier") != "2")
    assert man["tables"]["metadata"] == {"rows": 2, "rows_withheld": 1} and man["withheld"][0]["count"] == 1
    assert {r.offset_ms: r.share for r in engine.report(spark, cfg)["availability"].collect()}[0] == pytest.approx(2 / 3)
    assert "## checks" in engine.card(spark, cfg)


def test_roles(spark):
    person = [("k", t, f, x + dx * f, y, 100.0) for t, x, y, dx in (("keeper", 400.0, 200.0, 0.0), ("kicker", 100.0, 500.0, 8.0), ("fan", 900.0, 900.0, 0.0)) for f in range(40)] + [("k", "blip", 1, 0.0, 0.0, 1.0)]
    p = spark.createDataFrame(person, "pk_id string, track_id string, frame_idx int, cx double, cy double, h double")
    ball = spark.createDataFrame([("k", f, 360.0, 520.0) for f in range(31)], "pk_id string, frame_idx int, x double, y double")
    a = spark.createDataFrame([("k", 30, 25.0), ("none", None, 25.0)], "pk_id string, anchor_frame int, fps double")
    g = spark.createDataFrame([("k", f, False, 100.0, 300.0, 700.0, 300.0, 50.0, 600.0) for f in range(5)], "pk_id string, frame_idx int, is_missing boolean, post_left_x double, post_left_y double, post_right_x double, post_right_y double, crossbar_y double, goal_width_px double")
    stats = roles.track_stats(p)
    assert stats.count() == 3
    k = roles.keeper(p, stats, roles.clip_geometry(g, a), a)
    s = roles.kicker(p, stats, ball, a, k)
    assert k.first().track_id == "keeper" and s.first().track_id == "kicker" and 0.1 <= s.first().confidence <= 0.95
    assert {(r.track_id, r.role) for r in roles.with_roles(p, k, s).select("track_id", "role").distinct().collect()} == {("keeper", "keeper"), ("kicker", "kicker"), ("fan", "other"), ("blip", "other")}
    none = roles.keeper(p, stats, roles.clip_geometry(g.limit(0), a), a).first()
    assert none.track_id == "keeper" and none.confidence <= 0.5
    move = spark.createDataFrame([("k", f, 400.0 + max(0, f - 28) * 5, 100.0) for f in range(40)], "pk_id string, frame_idx int, cx double, h double")
    c = {r.pk_id: r for r in roles.keeper_commit(move, a).collect()}
    assert c["k"].frame_idx == 28 and c["none"].missing_reason == "no_anchor"
    still = roles.keeper_commit(move.withColumn("cx", F.lit(1.0)), a).where("pk_id = 'k'").first()
    assert still.missing_reason == "no_commit_seen" and still.frame_idx is None


def test_detections(spark):
    d = spark.createDataFrame([("person", 0.4, "1"), ("person", 0.3, "1"), ("ball", 0.2, "2"), ("ball", 0.2, None)], "cls string, conf double, track_id string")
    a, b = roles.split_detections(d)
    assert (a.count(), b.count()) == (1, 1)
    p = roles.mask_keypoints(spark.createDataFrame([(1.0, 2.0, 0.2), (1.0, 2.0, 0.9)], "x double, y double, confidence double")).collect()
    assert [(r.x, r.is_missing) for r in p] == [(None, True), (1.0, False)]
    c = spark.createDataFrame([("k", 0, None), ("k", 1, 7), ("k", 2, 9)], "pk_id string, scale_ord int, anchor_frame int")
    assert tuple(roles.first_scale(c).first()) == ("k", 7, 1)
