"""Operators on small tables with known answers. Names carry the inventory's handles."""

import json

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from anchorline import contracts, store
from anchorline.functions import scalars as S
from anchorline.operators import anchor as A
from anchorline.operators import corpus as C
from anchorline.operators import fusion, series, timeline
from anchorline.operators.kinematics import backward_difference, central_difference
from anchorline.sources import readers
from anchorline.streaming.anchoring import align_stream

TRACKS = "pk_id string, source string, role string, track_id string, frame_idx int, t_s double, t_ms_rel_contact double, bbox_cx double, bbox_cy double, bbox_w double, bbox_h double, vx_px_s double, vy_px_s double, is_missing boolean"
POSES = "pk_id string, role string, frame_idx int, kp_index byte, x_n double, y_n double, is_missing boolean"
BALL = "pk_id string, frame_idx int, x double, y double, vx_px_s double, vy_px_s double, is_missing boolean"
META = "pk_id string, source string, media_kind string, fps double, n_frames int, label_kick_direction string, label_provenance string, label_footedness string"


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize("raw,want", [("07-03", "7-3"), ("7-3", "7-3"), ("1", "1"), ("england_epl/2015#1#900", "england-epl-2015#1#900"), ("a.b_c", "a-b-c"), ("a/b c", "a-b-c"), ("000", "0"), ("--", "--")])
def test_d1_identifiers(spark, raw, want):
    assert one(spark, S.normalise_identifier, raw) == want
    assert len(one(spark, lambda c: S.entity_uid(S.entity_id(F.lit("x"), c)), raw)) == 16


def test_d9_s5_p9_p10_scalars(spark):
    assert [one(spark, S.hms_seconds, v) for v in ("01:02:03.5", "1:2", "x:1:2", None)] == [3723.5, None, None, None]
    assert [one(spark, lambda c: S.has_token(c, "8"), v) for v in ("3 8", "18", "8")] == [True, False, True]
    assert [one(spark, S.side, v) for v in (" l", "x", None)] == ["L", None, None]
    assert [one(spark, S.goal_flag, v) for v in ("1.9", "0", "no", None)] == [1, 0, None, None]


def test_d5_level_segment_points_left(spark):
    r = spark.range(1).select(S.segment_angle(F.lit(-1.0), F.lit(0.0)).alias("a"), S.segment_angle(F.lit(1.0), F.lit(0.0)).alias("b"), S.wrapped(F.lit(-350.0)).alias("c"), S.wrapped(F.lit(180.0)).alias("d")).first()
    assert tuple(r) == (-180.0, 0.0, 10.0, -180.0)


def tracks(spark, frames, contact, fps, ids=None, role="kicker"):
    rows = [("t:1", "test", role, ids(f) if ids else "a", f, f / fps, None if contact is None else (f - contact) / fps * 1000.0, 100.0 + f, 200.0, 40.0, 100.0, 1.0, 0.0, False) for f in frames]
    return spark.createDataFrame(rows, TRACKS)


def frames_of(spark, t, fps, poses=None, ball=None, foot="R"):
    meta = spark.createDataFrame([("t:1", "test", "pose_table", fps, 20, "L", "source", foot)], META)
    return meta, fusion.build_frames(meta, t, poses or spark.createDataFrame([], POSES), ball or spark.createDataFrame([], BALL))


def snaps(meta, f):
    out = timeline.snapshots(f, meta, contracts.OFFSETS_MS, "pk_id", "t_ms_rel_contact", fusion.NUMERIC, fusion.FLAGS, ["frame_idx"], F.coalesce(1000.0 / F.col("fps") / 2.0, F.lit(20.0)))
    return {int(r.off): r for r in out.collect()}


def test_d4_short_clip_is_not_clamped(spark):
    s = snaps(*frames_of(spark, tracks(spark, range(26), 25, 25.0), 25.0))
    assert len(s) == 7
    for off in (-2000, -1500):
        assert s[off].unavailable_reason == "before_clip_start" and s[off].kicker_cx is None and not s[off].kicker_available
    assert all(s[o].snapshot_available for o in (-1000, -500, 0))


def test_d4_dense_clip_is_exact(spark):
    s = snaps(*frames_of(spark, tracks(spark, range(76), 75, 25.0), 25.0))
    assert {r.snapshot_method for r in s.values()} == {"exact"} and {r.derivation for r in s.values()} == {"derived"}


def test_d4_hole_is_refused(spark):
    s = snaps(*frames_of(spark, tracks(spark, [f for f in range(76) if not 45 <= f <= 67], 75, 25.0), 25.0))
    assert s[-750].unavailable_reason == "gap_exceeds_interpolation_limit" and s[-750].gap_ms is not None and s[0].snapshot_available


def test_d4_float_tie_at_30_fps(spark):
    s = snaps(*frames_of(spark, tracks(spark, range(91), 90, 30.0), 30.0))
    assert [o for o, r in s.items() if r.snapshot_method == "interp"] == [-750]
    assert s[-750].derivation == "interpolated" and not s[-750].is_observed_frame and s[-750].kicker_cx == pytest.approx(167.5)


def test_w5_fragments_collapse_to_the_anchored_one(spark):
    t = tracks(spark, [*range(30), *range(40, 76)], 75, 25.0, ids=lambda f: "a" if f < 30 else "b")
    r = frames_of(spark, t, 25.0)[1].agg(F.count("*"), F.min("frame_idx")).first()
    assert tuple(r) == (36, 40)


def test_d4_without_anchor(spark):
    meta, f = frames_of(spark, tracks(spark, range(20), None, 25.0), 25.0)
    assert f.count() == 0 and {r.unavailable_reason for r in snaps(meta, f).values()} == {"no_anchored_frames"}


@pytest.mark.parametrize("foot,want", [("R", 0.3), ("L", -0.2), (None, None)])
def test_d5_ankles_follow_the_foot(spark, foot, want):
    x = {15: -0.2, 16: 0.3, 5: -0.1, 11: -0.1, 6: 0.1, 12: 0.1}
    poses = spark.createDataFrame([("t:1", "kicker", f, k, x.get(k, 0.0), 0.5, False) for f in range(3) for k in range(5, 17)], POSES)
    rows = frames_of(spark, tracks(spark, range(3), 2, 25.0), 25.0, poses, foot=foot)[1].orderBy("frame_idx").collect()
    assert [r.kick_ankle_x_n for r in rows] == [want] * 3 and {r.pose_n_visible_kp for r in rows} == {12}
    assert [r.kick_ankle_vx_n for r in rows] == ([None, 0.0, 0.0] if foot else [None] * 3)


def test_j3_ball_and_keeper_beside_the_kicker(spark):
    ball = spark.createDataFrame([("t:1", 1, 101.0, 300.0, 0.0, 0.0, False), ("t:1", 9, 1.0, 1.0, 0.0, 0.0, False)], BALL)
    t = tracks(spark, range(3), 2, 25.0).union(tracks(spark, [1, 7], 2, 25.0, role="keeper"))
    rows = frames_of(spark, t, 25.0, ball=ball)[1].orderBy("frame_idx").collect()
    assert [r.ball_available for r in rows] == [False, True, False] == [r.keeper_available for r in rows]
    assert rows[1].kicker_ball_dist_n == pytest.approx(1.0) and len(rows) == 3


def test_w1_w3_differences(spark):
    df = spark.createDataFrame([("a", 0, 0.0), ("a", 1, 1.0), ("a", 3, 5.0), ("b", 0, 1.0)], "k string, t int, x double")
    r = {(x.k, x.t): (x.c, x.b) for x in df.select("k", "t", central_difference("x", "t", ["k"], "t").alias("c"), backward_difference("x", ["k"], "t", F.lit(10.0)).alias("b")).collect()}
    assert r[("a", 0)] == (1.0, None) and r[("a", 1)] == (pytest.approx(5 / 3), 10.0) and r[("a", 3)] == (2.0, 40.0) and r[("b", 0)] == (None, None)


def checks(spark, media="pose_table", frame=15, missing=False, method="source_label", available=True, kick="L"):
    meta = spark.createDataFrame([("t:1", "test", media, 25.0, 20, kick, "source", "R")], META)
    events = spark.createDataFrame([("t:1", "ball_contact", frame, 1.0, method, missing)], "pk_id string, event_name string, frame_idx int, confidence double, method string, is_missing boolean")
    s = spark.createDataFrame([("t:1", o, available) for o in contracts.OFFSETS_MS], "pk_id string, offset_ms int, snapshot_available boolean")
    poses = spark.createDataFrame([("t:1", "kicker", f, k, 0.0, 0.0, False) for f in range(20) for k in (5, 6)], POSES)
    geo = spark.createDataFrame([], "pk_id string, frame_idx int, is_missing boolean")
    t = tracks(spark, range(20), 15, 25.0).withColumn("bbox_h", F.lit(120.0))
    return fusion.entity_checks(meta, t, poses, spark.createDataFrame([], BALL), geo, events, s)


def test_d6_checks(spark):
    r = {x.check: x.status for x in checks(spark).collect()}
    assert len(r) == 14 and r["ball_track"] == r["keeper_track"] == r["kicker_at_ball"] == r["scene_scale"] == "na"
    assert r["contact_anchor"] == r["kicker_track"] == r["pose_completeness"] == r["min_frames"] == r["labels_present"] == "pass"
    r = {x.check: x.status for x in checks(spark, media="video").collect()}
    assert r["ball_track"] == r["kicker_at_ball"] == r["goal_geometry"] == "fail" and r["scene_scale"] == "pass"
    assert {x.check: x.status for x in checks(spark, method="source_latest_of_multiple").collect()}["contact_anchor"] == "warn"


def test_a14_roll_up(spark):
    r = C.roll_up(checks(spark, frame=None, missing=True, available=False), "pk_id").first()
    assert r.qc_status == "fail" and r.qc_reasons.startswith("contact_anchor:fail") and "snapshot_coverage:warn" in r.qc_reasons
    assert tuple(C.roll_up(checks(spark), "pk_id").select("qc_status", "qc_reasons").first()) == ("pass", None)
    assert {x.check: x.success_rate for x in C.check_summary(checks(spark)).collect()}["ball_track"] is None


def departure(spark, rows, least=20, tol=18.0, inside=None):
    df = spark.createDataFrame([("k", str(t), f, float(x), float(y)) for t, f, x, y in rows], "pk string, track string, frame int, x double, y double")
    return A.stationary_departure(df, "pk", "track", "frame", "x", "y", F.lit(tol), F.lit(least), inside=inside).collect()


def test_w7_departure(spark):
    end = departure(spark, [(1, f, 500 + 0.02 * f, 600) for f in range(60)])[0]
    assert (end.anchor_frame, end.method, end.confidence) == (60, "ends_on_spot", 0.45)
    seen = departure(spark, [(1, f, 500, 600) for f in range(50)] + [(1, 50 + i, 580 + 80 * i, 580 - 20 * i) for i in range(20)])[0]
    assert (seen.anchor_frame, seen.method) == (50, "departure_observed") and 0.3 <= seen.confidence <= 0.9
    assert departure(spark, [(1, f, 500 + 40 * f, 600) for f in range(60)]) == []
    quad = [(F.lit(float(a)), F.lit(float(b))) for a, b in ((100, 50), (700, 50), (700, 300), (100, 300))]
    inside = S.in_quad(F.col("spot_x"), F.col("spot_y"), quad)
    rows = [(1, f, 400, 150) for f in range(80)]
    assert departure(spark, rows, inside=inside) == []
    assert departure(spark, rows + [(2, f, 500, 600) for f in range(40)], inside=inside)[0].anchor_frame == 40
    mover = departure(spark, [(1, f, 500, 600) for f in range(40)] + [(1, 40 + i, 600 + 30 * i, 600) for i in range(80)])
    assert mover[0].anchor_frame == 40


def test_w9_episodes(spark):
    def run(rows, tol=18.0):
        df = spark.createDataFrame([("k", str(t), f, float(x), 600.0) for t, f, x in rows], "pk string, track string, frame int, x double, y double")
        return sorted((e.anchor_frame, e.departed) for e in A.episodes(df, "pk", "track", "frame", "x", "y", tol, 50.0).collect())

    kick = lambda t, a, n=100: [(t, a + i, 500) for i in range(n)] + [(t, a + n + i, 580 + 80 * i) for i in range(8)]
    assert run([r for i in range(4) for r in kick(1, 600 * i)]) == [(100, True), (700, True), (1300, True), (1900, True)]
    assert run([(1, f, 500) for f in range(400)]) == [(400, False)]
    assert run(kick(1, 0) + [(2, i, 500) for i in range(95)]) == [(100, True)]
    assert run(kick(1, 0, 10)) == []
    assert run([(1, f, 500 + 0.05 * f) for f in range(120)] + [(1, 120 + i, 600 + 80 * i) for i in range(8)]) == [(120, True)]


def fill(spark, found, n, gap=15):
    df = spark.createDataFrame([("k", f, 100.0 + f / 2 if f in found else None, 0.8 if f in found else None) for f in range(n)], "k string, f int, x double, c double")
    return {r.f: r for r in series.gap_fill(df, "k", "f", ["x"], gap, "c").collect()}


def test_w11_gap_fill(spark):
    r = fill(spark, {0, 6}, 7)
    assert [f for f in r if r[f].filled] == [1, 2, 3, 4, 5] and r[3].x == 101.5 and r[3].c == pytest.approx(0.56)
    assert sum(x.x is None for x in fill(spark, {0, 40}, 41).values()) == 39
    assert [f for f, x in fill(spark, {4, 5}, 12).items() if x.x is None] == [0, 1, 2, 3, 6, 7, 8, 9, 10, 11]


def test_w12_consensus(spark):
    df = spark.createDataFrame([("k", float(w), float(c)) for w, c in [(600, 400)] * 6 + [(1200, 400), (600, 900)]] + [("few", 1.0, 1.0), ("few", 9.0, 9.0)], "k string, w double, c double")
    out = series.consensus_reject(df, "k", "w", "c", ["w", "c"]).collect()
    assert sum(x.w is None for x in out) == 2 and all(x.w for x in out if x.k == "few")


def test_d2_dedup(spark):
    rows = [("a", "s1", "fam/1", "render_only", None, 160), ("b", "s2", "fam/1", "pose_table", "L", 80), ("c", "s1", "other/1", "video", None, None)]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "pk_id string, source string, dedup_key string, media_kind string, label string, n_frames int, ord int")
    score = [F.col("label").isNotNull().cast("int"), C.rank_of(F.col("media_kind"), C.MEDIA), F.coalesce("n_frames", F.lit(0)), F.col("source")]
    out = C.elect_primary(df, "dedup_key", "pk_id", score, "ord")
    assert {r.pk_id: (r.is_primary, r.duplicate_of) for r in out.collect()} == {"a": (False, "b"), "b": (True, None), "c": (True, None)}
    assert C.duplicate_report(out, "dedup_key", "pk_id").count() == 1


@pytest.mark.parametrize("table", sorted(contracts.SCHEMAS))
def test_contracts(table):
    s = contracts.SCHEMAS[table]
    n = {"metadata": 46, "tracks": 22, "poses": 22, "ball": 19, "geometry": 28, "events": 14, "temporal_frames": 39, "temporal_snapshots": 44, "qc": 8}[table]
    assert len(s) == n and not s["pk_id"].nullable
    assert all(f.nullable for f in s if f.dataType.typeName() == "double" and not f.name.startswith("t_"))


def test_p1_coerce(spark):
    df = spark.createDataFrame([("a:1", "s", "ball_contact", "m", None, float("nan"), 1)], "pk_id string, source string, event_name string, method string, is_missing boolean, confidence double, extra int")
    df = contracts.with_provenance(df, "derived", "here")
    r = contracts.coerce(df, "events").first()
    assert r.is_missing is False and r.confidence is None and r.frame_idx is None and "extra" not in r.asDict()
    with pytest.raises(ValueError):
        contracts.coerce(df.drop("method"), "events")
    with pytest.raises(Exception, match="method is null"):
        contracts.coerce(df.withColumn("method", F.lit(None).cast("string")), "events").collect()


def test_k2_upsert_replays(spark, tmp_path):
    path = str(tmp_path / "qc.parquet")
    row = lambda pk, status: spark.createDataFrame([(pk, "s", "c", status, "1")], "pk_id string, source string, check string, status string, processing_version string")
    assert store.read_table(spark, path, "qc").count() == 0
    store.upsert_table(row("a:1", "pass"), path, "qc")
    for _ in range(2):
        store.upsert_table(row("b:1", "fail"), path, "qc")
    store.upsert_table(row("a:1", "warn"), path, "qc")
    store.upsert_table(row("a:1", "warn").limit(0), path, "qc")
    assert {r.pk_id: r.status for r in store.read_table(spark, path, "qc").collect()} == {"a:1": "warn", "b:1": "fail"}
    store.write_manifest(spark, str(tmp_path / "m.json"), {"b": 1, "a": [2]})
    assert store.read_manifest(spark, str(tmp_path / "m.json")) == {"a": [2], "b": 1} and store.read_manifest(spark, str(tmp_path / "none"), {"x": 0}) == {"x": 0}


def test_s2_s3_p4_pose_table(spark, tmp_path):
    kp = [f"kp_{k}_{s}" for k in range(5, 17) for s in ("x", "y", "xc", "yc")]
    head = ["kick_id", "frame", "last_touch", "track_id", "camera_direction", "kick_direction", "goal", "bbox_h", *kp]
    line = lambda f, touch, cam: ["07-3", f, touch, "t", cam, "l", "1.0", "100"] + ["", "1", "50", "20"] + ["2", "3", "50", "20"] * 11
    (tmp_path / "v1.csv").write_text("\n".join(",".join(x) for x in [head, line("0", "", "L"), line("", "1", "L"), line("2", "1.0", "R")]))
    raw = readers.read_strings(spark, str(tmp_path / "v1.csv"))
    df = readers.pose_table(raw)
    assert [(r.frame_num, r.last_touch, r.goal, r.kick_direction) for r in df.orderBy("frame_num").collect()] == [(0, 0, 1, "L"), (2, 1, 1, "L")]
    assert readers.dropped_rows(raw).first()[0] == 1
    p = {(r.frame_num, r.kp_index): r for r in readers.unpivot_keypoints(df, ["kick_id_raw", "frame_num"]).collect()}
    assert len(p) == 24 and p[0, 5].is_missing and p[0, 6].x_n == -0.5 and p[2, 6].x_n == 0.5 and p[2, 6].y_n == 0.2
    assert readers.first_entities(df.withColumn("o", F.col("frame_num")), "frame_num", "o", 1).count() == 1


def test_s4_annotations(spark, tmp_path):
    d = tmp_path / "league" / "2015" / "match"
    d.mkdir(parents=True)
    (d / "Labels-v2.json").write_text(json.dumps({"UrlLocal": "x", "annotations": [{"label": "Goal", "gameTime": "1 - 0:1", "position": "1"}, {"label": "Penalty", "gameTime": "2 - 12:34", "position": "754000", "team": "home", "visibility": "v"}]}))
    bad = tmp_path / "league" / "2015" / "other"
    bad.mkdir()
    (bad / "Labels-v2.json").write_text("{broken")
    r = readers.annotations(spark, str(tmp_path)).collect()
    assert [(x.game, x.idx, x.half, x.position) for x in r] == [("league/2015/match", 1, 2, 754000)]


def test_s5_s6_s8_s9(spark):
    seg = spark.createDataFrame([("v.mkv", "3 8", "00:00:01", "00:00:03.5"), ("w", "18", "0", "0"), ("x", "8", "bad", "00:00:01")], "video string, cls_id string, event_start_time string, event_end_time string")
    walk = spark.createDataFrame([("v", "old", 1), ("v.mkv", "new", 2), ("x", None, 3)], "name string, target string, ord int")
    out = readers.crosswalk(readers.segments(seg), walk, F.col("video")).collect()
    assert {(r.video, r.duration_s, r.target) for r in out} == {("v.mkv", 2.5, "new"), ("x", None, None)}
    a, b = spark.createDataFrame([("t1", 1)], "title string, n int"), spark.createDataFrame([("t1", 2), ("t2", 2)], "title string, n int")
    assert {(r.title, r.n) for r in readers.union_first([a, b], "title").collect()} == {("t1", 1), ("t2", 2)}
    c = spark.createDataFrame([("rugby", 100, 1, None), ("ok", 100, 1, "x"), ("ok", 700, 300, "x"), ("ok", 700, 100, ""), ("ok", 700, 100, "CC BY")], "t string, w int, d int, l string")
    why = readers.exclusion(F.col("t").rlike("(?i)rugby"), F.col("w"), F.col("d"), F.col("l"))
    assert [r[0] for r in c.select(why).collect()] == ["other_sport", "too_narrow", "too_long", "no_licence", None]


def test_j5_matched_null_overwrites(spark):
    base = spark.createDataFrame([("a", "x"), ("b", "y")], "k string, v string")
    out = C.update_from(base, spark.createDataFrame([("a", None)], "k string, v string"), "k", ["v"])
    assert {r.k: r.v for r in out.collect()} == {"a": None, "b": "y"}


def test_stream_equals_batch(spark, tmp_path):
    rows = [("u", f"2024-01-01 0{h}:{m:02}:00", "purchase" if (h, m) == (3, 0) else "view") for h in range(1, 6) for m in (0, 30)]
    df = spark.createDataFrame(rows, "user string, ts string, kind string").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    want = sorted((r.ts, r.t_ms) for r in align_stream(df, "user", "ts", "kind = 'purchase'").collect())
    live = align_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), "user", "ts", "kind = 'purchase'")
    q = live.writeStream.format("memory").queryName("aligned").option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted((r.ts, r.t_ms) for r in spark.table("aligned").collect()) == want and len(want) == 5


@pytest.mark.parametrize("kind", ["grid", "anywhere", "odd"])
def test_best_overlap_against_all_pairs(spark, monkeypatch, kind):
    """Scores to the last bit, ties to the least id, over several parts of a frame; boxes that no tree holds too."""
    monkeypatch.setattr(series, "BOXES", 300)
    monkeypatch.setattr(series, "BATCH", 64)
    r = np.random.default_rng(len(kind))

    def boxes(n):
        if kind == "grid":
            at, size = r.integers(0, 12, (n, 2)) / 3, r.integers(1, 4, (n, 2)) / 7
        else:
            at, size = r.random((n, 2)) * 4, r.random((n, 2))
        out = np.hstack([at, at + size]).tolist()
        if kind == "odd":
            out[3], out[4], out[5], out[6] = [2.0, 2.0, 1.0, 1.0], [1.0, 1.0, 1.0, 3.0], [None, 1.0, 2.0, 2.0], [0.5, 0.5, float("inf"), float("inf")]
        return [(i, i % 3 if i % 11 else None, *b) for i, b in enumerate(out)]

    a = spark.createDataFrame(boxes(700), "l long, f long, ax1 double, ay1 double, ax2 double, ay2 double")
    b = spark.createDataFrame(boxes(1300), "r long, f long, bx1 double, by1 double, bx2 double, by2 double")
    a, b = a.union(a.withColumn("l", F.col("l") + 5000)), b.union(b.withColumn("r", F.col("r") - 5000))
    p, q = ["ax1", "ay1", "ax2", "ay2"], ["bx1", "by1", "bx2", "by2"]
    score = S.iou([F.col(c) for c in p], [F.col(c) for c in q])
    w = Window.partitionBy("l").orderBy(F.desc("score"), "r")
    pairs = a.join(b, "f").withColumn("score", score).where("score >= 0.1")
    want = {t.l: repr((t.score, t.r)) for t in pairs.withColumn("n", F.row_number().over(w)).where("n = 1").collect()}
    got = {t.l: repr((t.score, t.r)) for t in series.best_overlap(a, b, ["f"], "l", "r", p, q, 0.1).collect()}
    assert len(want) > 900 and got == want


def test_few_boxes_are_looked_at(monkeypatch):
    """Of forty times as many boxes of a frame about the same number is scored for each box."""
    seen = []

    def looked(n):
        r = np.random.default_rng(1)
        at = np.stack([r.integers(0, 25, n) * 2.0, r.random(n) * 22 - 2])
        tree = series.BoxTree(np.concatenate([at, at + [[12.0], [6.0]]]), r.permutation(n).astype(float))
        bound = series.BoxTree.bound
        monkeypatch.setattr(tree, "bound", lambda x, y: (seen.append(np.broadcast(x[0], y[0]).size), bound(x, y))[1])
        q = np.stack([r.integers(1, 51, 200).astype(float), r.random(200) + 9])
        seen.clear()
        tree.best(np.concatenate([q, q + [[10.0], [5.0]]]), 0.1)
        return sum(seen) / 200

    assert looked(40_000) < 8 * looked(1000) and looked(40_000) < 4000
