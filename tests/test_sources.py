"""Adapters, settings and file scans. Names carry the inventory's handles."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from anchorline import config, contracts
from anchorline.functions import scalars as S
from anchorline.operators import corpus, timeline
from anchorline.sources import adapters, readers


class Poses(adapters.PoseTables):
    slug = family = "poses"


class Listed(adapters.Catalogue):
    slug = family = "listed"


def test_s15_registry():
    r = adapters.Registry([Poses, Listed], {"both": ["listed", "poses"]})
    assert r.resolve() == ["poses", "listed"] and r.resolve(["both", "all"]) == ["listed", "poses"]
    with pytest.raises(KeyError):
        r.resolve(["poses", "nothing"])


def test_s14_inventory_counts_and_never_raises(spark, tmp_path):
    (tmp_path / "p.csv").write_text("kick_id,frame,last_touch\n2-1,1,0\n2-1,x,0\n1-1,1,\n1-1,2,1\n")
    r = adapters.Registry([Poses, Listed])
    got = r.inventory(spark, {"poses": str(tmp_path / "p.csv"), "listed": str(tmp_path / "absent")}, now="2000-01-01")
    assert (got["poses"].access, got["poses"].discovered, got["poses"].accessible) == ("open", 2, 2)
    assert got["listed"].access == "error" and got["listed"].notes and got["listed"].to_dict()["discovered"] is None
    assert {(x.kick_id_raw, x.frame_num) for x in Poses(spark, str(tmp_path / "p.csv")).ingest(1).collect()} == {("2-1", 1)}


def test_s16_settings(tmp_path, monkeypatch):
    monkeypatch.delenv(config.ROOT_VARIABLE, raising=False)
    (tmp_path / "c.yaml").write_text("data_root: d\ntemporal: {max_interp_gap_ms: 80, offsets: [-10, 0]}\nsources: {poses: {fps: 30}, none: }\n")
    cfg, sources = config.load(str(tmp_path / "c.yaml"))
    assert cfg.root == str(tmp_path / "d") and cfg.max_interp_gap_ms == 80 and cfg.offsets == (-10, 0) and sources == {"poses": {"fps": 30}, "none": {}}
    (tmp_path / "c.json").write_text(json.dumps({"data_root": "d"}))
    monkeypatch.setenv(config.ROOT_VARIABLE, "/elsewhere")
    assert config.load(str(tmp_path / "c.json"))[0].root == "/elsewhere"


def test_s11_catalogue_rows_fit_the_contract(spark, tmp_path):
    entries = [{"title": "File:A  b!.webm", "artist": "<i>x</i>", "credit": "", "license": "CC BY-SA 4.0", "relpath": "a.mp4", "fps": 25.0, "n_frames": 50}, {"title": "File:c.webm", "fps": 0.0}]
    (tmp_path / "e.json").write_text("\n".join(json.dumps(e) for e in entries))
    a = Listed(spark, str(tmp_path / "e.json"), now="2000-01-01")
    got = {r.source_identifier: r for r in contracts.coerce(contracts.with_provenance(a.rows(), "source_provided", "listed"), "metadata").collect()}
    one, two = got["File:A  b!.webm"], got["File:c.webm"]
    assert (one.pk_id, one.attribution, one.clip_duration_s, one.redistribute_video, one.has_video) == ("listed:a-b", "x", 2.0, True, True)
    assert (two.attribution, two.license, two.clip_duration_s, two.redistribute_video, two.has_video) == ("File:c.webm", "unknown", None, False, False)
    assert (a.inventory().discovered, a.inventory().accessible) == (2, 1)


def test_s12_media_files(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.mp4").write_bytes(b"abc")
    (tmp_path / "b.txt").write_bytes(b"x")
    assert [tuple(r) for r in readers.media_files(spark, str(tmp_path)).collect()] == [("a.mp4", 3, hashlib.sha256(b"abc").hexdigest())]
    assert [r[0] for r in spark.createDataFrame([(0.01,), (0.5,), (None,)], "v double").select(readers.render_only(F.col("v"))).collect()] == ["render_only", "video", "video"]


def test_s7_coverage(spark):
    segs = spark.createDataFrame([("a.mkv",), ("a.mkv",), ("b.mkv",)], "video_name string")
    walk = spark.createDataFrame([("a", "x"), ("a.mkv", "y"), ("b", None), ("c", "z")], "name string, target string")
    assert tuple(readers.crosswalk_coverage(segs, walk).first()) == (3, 2, 2)
    assert tuple(readers.crosswalk_coverage(segs.where("false"), walk).first()) == (0, 0, 0)


def test_s10_slug_and_share_alike(spark):
    row = spark.range(1).select(S.catalogue_slug(F.lit("File:" + "Ab-" * 40 + ".ogv")).alias("s"), *[S.licence_share_alike(F.lit(t)) for t in ("CC BY-SA 4.0", "CC BY 4.0", "usa")]).first()
    assert row.s == ("ab_" * 20) and tuple(row)[1:] == (True, False, False)


def test_w10_earlier_of_equals(spark):
    f = spark.createDataFrame([("k", 1, -10.0), ("k", 2, 10.0), ("k", 3, None)], "pk_id string, frame_idx int, t double")
    s = spark.createDataFrame([("k", 0.0, True), ("k", 9.0, True), ("k", 5.0, False)], "pk_id string, off double, snapshot_available boolean")
    assert sorted(tuple(r) for r in timeline.nearest_observed(f, s, "pk_id", "frame_idx", "t").collect()) == [("k", 0.0, 1), ("k", 9.0, 2)]


def test_j16_j17(spark):
    meta = spark.createDataFrame([("a", "pass", "video"), ("b", "fail", "video"), ("c", None, "none")], "pk_id string, qc_status string, media_kind string")
    snaps = spark.createDataFrame([("a", True), ("a", False), ("b", True), ("c", True)], "pk_id string, snapshot_available boolean")
    assert sorted(r.pk_id for r in corpus.analysis_view(snaps, meta, "pk_id", ["qc_status"]).collect()) == ["a", "c"]
    facts = spark.createDataFrame([("a", "contact_anchor", "pass"), ("b", "contact_anchor", "warn"), ("c", "contact_anchor", "pass")], "pk_id string, check string, status string")
    assert [r.pk_id for r in corpus.passing(facts, meta, "contact_anchor").collect()] == ["a"]
