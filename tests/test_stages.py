"""Frames, checks, detections, storage after a crash, report and command line."""

import json
import statistics

import pytest
from pyspark.sql import functions as F

from anchorline import __main__ as cli
from anchorline import engine, store
from anchorline.operators import anchor, corpus, fusion, series, vision
from anchorline.sources import readers
from tests.test_engine import raw_table

TRACK = "pk_id string, source string, role string, track_id string, frame_idx int, t_s double, t_ms_rel_contact double, bbox_cx double, bbox_cy double, bbox_w double, bbox_h double, vx_px_s double, vy_px_s double, is_missing boolean, ingest_ord long"
POSE = "pk_id string, role string, frame_idx int, kp_index int, x_n double, y_n double, is_missing boolean"


def frames_of(spark, tracks, poses, foot="R"):
    meta = spark.createDataFrame([("k", 25.0, foot)], "pk_id string, fps double, label_footedness string")
    rows = [("k", "s", "kicker", t, f, f / 25, (f - 10) * 40.0, x, 1.0, 40.0, 100.0, 1.0, 0.0, False, i) for i, (t, f, x) in enumerate(tracks)]
    ball = spark.createDataFrame([], "pk_id string, frame_idx int, x double, y double, vx_px_s double, vy_px_s double, is_missing boolean")
    out = fusion.build_frames(meta, spark.createDataFrame(rows, TRACK), spark.createDataFrame(poses, POSE), ball)
    return {r.frame_idx: r for r in out.collect()}


def test_a_row_without_track_is_no_rival(spark):
    got = frames_of(spark, [("a", 8, 1.0), ("a", 9, 1.0), (None, 10, 2.0)], [])
    assert sorted(got) == [8, 9, 10]
    got = frames_of(spark, [("a", 8, 1.0), ("b", 9, 1.0), ("b", 11, 1.0), (None, 10, 2.0)], [])
    assert sorted(got) == [9, 11]


def test_poses_of_any_point_and_last_duplicate(spark):
    got = frames_of(spark, [("a", 8, 1.0), ("a", 9, 5.0), ("a", 9, 3.0), ("a", 10, 1.0)], [("k", "kicker", 8, 7, 0.5, 0.5, False), ("k", "kicker", 9, 16, 0.1, 0.2, False), ("k", "kicker", 10, 16, 0.3, 0.2, True)])
    assert got[9].kicker_cx == 3.0  # the later row of a frame counts
    assert got[8].pose_available and got[8].pose_n_visible_kp == 1
    assert not got[10].pose_available and got[10].pose_n_visible_kp == 0
    assert got[8].kick_ankle_vx_n is None and got[9].kick_ankle_vx_n is None and got[10].kick_ankle_vx_n == pytest.approx(5.0)
    none = frames_of(spark, [("a", 8, 1.0)], [])
    assert none[8].pose_n_visible_kp == 0 and not none[8].pose_available


def test_running_median_and_rests():
    m, seen = anchor.RunningMedian(), []
    for v in [5, 1, 9, 9, 2, 7, 7, 0, 3]:
        m.add(v)
        seen.append(v)
        assert m.value() == statistics.median(seen)
    track = [(i, 500.0 + 0.05 * i, 600.0) for i in range(120)] + [(120 + i, 900.0 + 80 * i, 600.0) for i in range(5)]
    assert [r[0] for r in anchor.rests(track, 9.0, 40)] == [120] and next(iter(anchor.rests(track, 9.0, 40)))[5]
    assert anchor.spaced([(10, 0, 9, 0.0, 0.0, False), (60, 40, 59, 0.0, 0.0, True), (200, 150, 199, 0.0, 0.0, False)], 100) == [(60, 40, 59, 0.0, 0.0, True), (200, 150, 199, 0.0, 0.0, False)]


def test_primaries_of_a_hot_group(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(-1).alias("g"), F.concat(F.lit("i"), "id").alias("i"), (F.col("id") % 7).alias("n"), "id")
    got = corpus.elect_primary(df, "g", "i", [F.col("n")], "id")
    assert got.count() == 4000 and got.where("is_primary and g = -1").first().i == "i13" and got.where("g = -1 and duplicate_of = 'i13'").count() == got.where("g = -1").count() - 1
    assert got.where("is_primary").count() == df.select("g").distinct().count()


def test_no_tolerance_is_allowed(spark):
    a = spark.createDataFrame([(1, 5, 5), (2, 6, 5)], "p int, x int, y int")
    assert [r.p for r in series.near_hits(a.withColumn("f", F.lit(0)), spark.createDataFrame([(0, 5, 5)], "f int, x int, y int"), ["f"], 0, "p").collect()] == [1]


def test_tables_survive_a_crash_between_renames(spark, tmp_path):
    path = str(tmp_path / "qc")
    row = lambda pk, s: (pk, "s", "c", s, "1")
    df = lambda *rows: spark.createDataFrame([dict(zip(("pk_id", "source", "check", "status", "processing_version"), r)) for r in rows])
    assert store.upsert_table(df(row("a", "pass")), path, "qc") == 1
    (tmp_path / "qc").rename(tmp_path / "qc.old-dead")  # a writer died here
    assert [r.pk_id for r in store.read_table(spark, path, "qc").collect()] == ["a"]
    assert store.upsert_table(df(row("b", "fail")), path, "qc") == 2
    assert store.upsert_table(df(row("a", "warn")), path, "qc") == 2
    assert {r.pk_id: r.status for r in store.read_table(spark, path, "qc").collect()} == {"a": "warn", "b": "fail"}
    assert [p.name for p in tmp_path.iterdir() if p.name.startswith("qc.")] == []
    store.write_manifest(spark, str(tmp_path / "m.json"), {"a": 1})
    store.write_manifest(spark, str(tmp_path / "m.json"), {"a": 2})
    assert store.read_manifest(spark, str(tmp_path / "m.json")) == {"a": 2}


def detections(spark):
    rows = []
    for f in range(60):
        for scale in (0, 1):
            rows += [("v", scale, f, "p1", "person", 400.0, 150.0, 40.0, 100.0, 0.9), ("v", scale, f, "p2", "person", 300.0 + 3 * f, 580.0, 40.0, 120.0, 0.9)]
        x = 500.0 if f < 50 else 500.0 + 60 * (f - 49)
        rows += [("v", 1, f, "b", "ball", x, 600.0, 10.0, 10.0, 0.5), ("v", 0, f, "b", "ball", 40.0 * f, 600.0, 10.0, 10.0, 0.5)]
    return spark.createDataFrame(rows, "pk_id string, scale_ord int, frame_idx int, track_id string, cls string, cx double, cy double, w double, h double, conf double")


def test_detections_to_rows(spark):
    clips = spark.createDataFrame([("v", "s", "1", 50.0), ("empty", "s", "2", 50.0)], "pk_id string, source string, source_identifier string, fps double")
    geo = spark.createDataFrame([("v", f, False, 100.0, 300.0, 700.0, 300.0, 50.0, 600.0) for f in range(5)], "pk_id string, frame_idx int, is_missing boolean, post_left_x double, post_left_y double, post_right_x double, post_right_y double, crossbar_y double, goal_width_px double")
    out = vision.run(detections(spark), clips, geo)
    e = {(r.pk_id, r.event_name): r for r in out["events"].collect()}
    assert e["v", "ball_contact"].frame_idx == 50 and e["v", "ball_contact"].method == "departure_observed"
    assert e["empty", "ball_contact"].missing_reason == "no_ball_detections"
    role = {r.track_id: r.role for r in out["tracks"].select("track_id", "role").distinct().collect()}
    assert role == {"p1": "keeper", "p2": "kicker"}
    assert out["tracks"].where("frame_idx = 50").select("t_ms_rel_contact").distinct().collect()[0][0] == 0.0
    reasons = {(r.pk_id, r.reason) for r in out["failures"].collect()}
    assert ("empty", "no_person_detections") in reasons and ("v", "contact_recovered_at_scale_1") in reasons


def test_mirror_match(spark):
    renders = spark.createDataFrame([("7-3",), ("9",)], "source_identifier string")
    rows = spark.createDataFrame([("m:7-3", False), ("m:7-3", True), ("m:9", True)], "pk_id string, is_missing boolean")
    got = {r.source_identifier: (r.n_rows, r.status) for r in corpus.mirror_match(renders, rows, "m").collect()}
    assert got == {"7-3": (1, "matched"), "9": (0, "no matching rows")}


def test_command_line(spark, tmp_path, capsys):
    raw = raw_table(spark)
    bad = raw.limit(1).withColumn("frame", F.lit("?"))
    raw.unionByName(bad).coalesce(1).write.option("header", True).csv(str(tmp_path / "raw"))
    args = lambda *a: ["--root", str(tmp_path), *a]

    def call(*a):
        assert cli.main(args(*a)) == 0
        return capsys.readouterr().out

    assert json.loads(call("inventory", "--table", str(tmp_path / "raw"))) == {"entities": 3, "rows": 102, "dropped_rows": 1}
    got = json.loads(call("ingest", "--table", str(tmp_path / "raw"), "--source", "poses-v1", "--family", "fam"))
    assert got["dropped_rows"] == 1 and got["rows"]["metadata"] == 3
    assert json.loads(call("process", "--all"))["entities"] == 3 and json.loads(call("process", "--all"))["entities"] == 0
    assert {r["check"]: r["n_na"] for r in json.loads(call("qc"))}["ball_track"] == 3
    dry = json.loads(call("publish", "--out", str(tmp_path / "pub"), "--dry-run"))
    assert dry["dry_run"] and dry["tables"]["metadata"]["rows"] == 3 and not (tmp_path / "pub").exists()
    rep = json.loads(call("report", "--json"))
    assert rep["corpus"] == {"records": 3.0, "unique": 3.0, "usable": 3.0} and rep["label_coverage"]["label_camera_direction"] == 1.0 and rep["contact"]["resolved"] == 2.0
    text = call("report")
    assert "LABEL COVERAGE" in text and "label_footedness" in text
    cfg = engine.Config(str(tmp_path))
    few = engine.Config(str(tmp_path / "few"))
    engine.ingest_pose_table(spark, few, raw.orderBy(F.desc("kick_id")).coalesce(1), "poses-v1", "fam", "now", limit=1)
    assert [r.source_identifier for r in store.read_table(spark, few.path("metadata"), "metadata").collect()] == ["3"]
    assert readers.dropped_rows(raw).first().dropped == 0 and engine.grade(spark, cfg, ["poses-v1:1"]).count() == 14
