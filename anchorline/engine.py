"""The stages: ingest a pose table, process, grade, publish, report. Each is one lazy plan a table and an idempotent upsert."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline import contracts, store
from anchorline.functions import scalars as S
from anchorline.operators import anchor, corpus, fusion, kinematics, timeline, vision
from anchorline.sources import readers


@dataclass
class Config:
    root: str
    fps: float = 25.0
    offsets: tuple[int, ...] = contracts.OFFSETS_MS
    max_interp_gap_ms: float = 120.0
    emit_for_trackless: bool = False
    provenance: dict[str, str] = field(default_factory=dict)

    def path(self, table: str) -> str:
        return f"{self.root}/processed/{table}"


def ingest_pose_table(spark: SparkSession, cfg: Config, raw: DataFrame, slug: str, family: str, now: str, licence: str = "CC BY 4.0", limit: int | None = None) -> dict:
    """Raw rows (as strings) to metadata, tracks, poses, ball, geometry and events; absent estimates are rows with a reason.

    Returns counters: rows written a table, and rows dropped because their frame is no number.
    """
    df = readers.pose_table(raw)
    if "fps" not in df.columns:
        df = df.withColumn("fps", F.lit(None).cast("double"))
    df = df.withColumn("pk_id", S.entity_id(F.lit(slug), F.col("kick_id_raw"))).withColumn("_fps", F.coalesce(F.nullif("fps", F.lit(0.0)), F.lit(cfg.fps)))
    dropped = readers.dropped_rows(raw).first()["dropped"]
    if limit is not None:  # the first in file order
        df = readers.first_entities(df.withColumn("_at", F.monotonically_increasing_id()), "pk_id", "_at", limit).drop("_at")
    con = anchor.resolve_markers(df, "pk_id", "frame_num", F.col("last_touch") == 1, "track_id", "source_last_touch")
    first = lambda c: F.min_by(c, "frame_num").alias(c)
    base = df.groupBy("pk_id").agg(first("kick_id_raw"), first("_fps"), first("kick_direction"), first("goal"), first("r_or_l"), first("camera_direction"), F.count_distinct("frame_num").cast("int").alias("n_frames"), F.min("frame_num").alias("f0"))
    base = base.join(con, "pk_id")
    spine = lambda x, how="source_provided": contracts.with_provenance(x.withColumn("source", F.lit(slug)), how, slug)
    frag = F.when((F.col("n_markers") > 1) | (F.col("n_tracks") > 1), F.concat(F.lit("fragmented_track("), F.col("n_tracks"), F.lit(" tracks, "), F.col("n_markers"), F.lit(" markers)")))
    reasons = F.nullif(F.concat_ws(";", F.when(F.col("n_markers") == 0, "no_contact_frame"), frag), F.lit(""))
    meta = base.select(
        "pk_id", S.entity_uid(F.col("pk_id")).alias("pk_uid"), F.col("kick_id_raw").alias("source_identifier"), S.dedup_key(F.lit(family), F.col("kick_id_raw")).alias("dedup_key"), F.lit(True).alias("is_primary"),
        F.lit("pose_table").alias("media_kind"), F.lit(False).alias("has_video"), F.col("_fps").alias("fps"), "n_frames", F.col("kick_direction").alias("label_kick_direction"), F.col("goal").alias("label_goal"),
        F.upper("r_or_l").alias("label_footedness"), F.col("camera_direction").alias("label_camera_direction"), F.lit("source").alias("label_provenance"), F.lit(licence).alias("license"), F.lit(slug).alias("attribution"),
        S.licence_open(F.lit(licence)).alias("redistribute_derived"), F.lit(False).alias("redistribute_video"), F.lit(now).alias("ingested_at_utc"), F.lit("pending").alias("qc_status"), reasons.alias("qc_reasons"),
    )
    x = df.join(base.select("pk_id", "f0", "anchor_frame"), "pk_id")
    x = x.withColumn("frame_idx", F.col("frame_num")).withColumn("t_s", (F.col("frame_num") - F.col("f0")) / F.col("_fps")).withColumn("t_ms_rel_contact", timeline.relative_ms(F.col("frame_num"), F.col("anchor_frame"), F.col("_fps")))
    gone = F.col("bbox_cx").isNull()
    vel = lambda c: kinematics.central_difference(c, "t_s", ["pk_id"], "frame_idx")
    tr = x.select("pk_id", F.col("kick_id_raw").alias("source_identifier"), F.lit("kicker").alias("role"), F.col("track_id").cast("string").alias("track_id"), "frame_idx", "t_s", "t_ms_rel_contact", "bbox_cx", "bbox_cy", "bbox_w", "bbox_h", vel("bbox_cx").alias("vx_px_s"), vel("bbox_cy").alias("vy_px_s"), gone.alias("is_missing"), F.when(gone, "source_bbox_absent").alias("missing_reason"))
    absent = lambda why, at=-1: base.select("pk_id", F.lit(at).cast("int").alias("frame_idx"), F.lit(True).alias("is_missing"), F.lit(why).alias("missing_reason"))
    keepers = absent("keeper_not_in_source").join(base.select("pk_id", F.col("kick_id_raw").alias("source_identifier")), "pk_id").withColumn("role", F.lit("keeper"))
    names = F.create_map(*[F.lit(v) for k, n in contracts.KEYPOINTS.items() for v in (k, n)])
    po = readers.unpivot_keypoints(x, ["pk_id", "frame_idx", "t_s", "t_ms_rel_contact"]).withColumn("role", F.lit("kicker")).withColumn("kp_name", names[F.col("kp_index").cast("int")])
    hit = F.col("anchor_frame").isNotNull()
    rows = [F.struct(F.lit("ball_contact").alias("event_name"), F.col("anchor_frame").alias("frame_idx"), F.col("confidence").alias("confidence"), F.col("method").alias("method"), (~hit).alias("is_missing"), F.col("missing_reason").alias("missing_reason"))]
    rows += [F.struct(F.lit(n).alias("event_name"), F.lit(None).cast("int").alias("frame_idx"), F.lit(None).cast("double").alias("confidence"), F.lit("not_attempted").alias("method"), F.lit(True).alias("is_missing"), F.lit("not_attempted").alias("missing_reason")) for n in contracts.EVENTS[1:]]
    ev = base.select("pk_id", F.explode(F.array(*rows)).alias("e")).select("pk_id", "e.*")
    out = {"metadata": meta, "tracks": tr.unionByName(keepers, allowMissingColumns=True), "poses": po, "ball": absent("ball_not_in_source"), "geometry": absent("goal_not_in_source", None), "events": ev}
    counts = {}
    for table, rows_ in out.items():
        new = spine(rows_)
        counts[table] = store.upsert_table(new, cfg.path(table), table)
    elect(spark, cfg)
    return {"source": slug, "dropped_rows": dropped, "rows": counts}


def _read(spark: SparkSession, cfg: Config, table: str) -> DataFrame:
    return store.read_table(spark, cfg.path(table), table)


def elect(spark: SparkSession, cfg: Config) -> None:
    """Primary election over all metadata; ties go to the smaller id."""
    m = _read(spark, cfg, "metadata")
    score = [F.col("label_kick_direction").isNotNull().cast("int"), corpus.rank_of(F.col("media_kind"), corpus.MEDIA), F.coalesce("n_frames", F.lit(0)), F.col("source")]
    e = corpus.elect_primary(m, "dedup_key", "pk_id", score, "pk_id")
    e = e.withColumn("duplicate_of_pk_id", F.col("duplicate_of")).withColumn("duplicate_evidence", F.when(~F.col("is_primary"), F.concat(F.lit("same dedup_key: "), F.col("dedup_key"))).otherwise(F.col("duplicate_evidence")))
    store.write_table(e, cfg.path("metadata"), "metadata")


def select_entities(meta: DataFrame, ids: list[str] | None = None, limit: int | None = None, every: bool = False) -> DataFrame:
    m = meta.where("is_primary")
    m = m.where(F.col("pk_id").isin(ids)) if ids else m.where(F.col("media_kind").isin("video", "pose_table"))
    return m if every else m.orderBy("pk_id").limit(limit or 5)


def process(spark: SparkSession, cfg: Config, ids: list[str] | None = None, limit: int | None = None, every: bool = True, force: bool = False) -> dict:
    """Anchored frames and snapshots of entities that have none yet; returns how many entities and rows."""
    m = select_entities(_read(spark, cfg, "metadata"), ids, limit, every)
    if not force:
        m = corpus.not_yet(m, _read(spark, cfg, "temporal_snapshots"), "pk_id")
    only = lambda t: _read(spark, cfg, t).join(m.select("pk_id"), "pk_id", "left_semi")
    tr = only("tracks")
    selected = m.count()
    frames = contracts.with_provenance(fusion.build_frames(m, tr, only("poses"), only("ball")), "derived", "timeline")
    # written first and read back, so that snapshots do not build them a second time
    n_frames = store.upsert_table(frames, cfg.path("temporal_frames"), "temporal_frames")
    frames = _read(spark, cfg, "temporal_frames").join(m.select("pk_id"), "pk_id", "left_semi")
    if not cfg.emit_for_trackless:
        m = m.join(tr.where("role = 'kicker' and frame_idx >= 0").select("pk_id").distinct(), "pk_id", "left_semi")
    tol = F.coalesce(1000.0 / F.nullif("fps", F.lit(0.0)) / 2.0, F.lit(20.0))
    s = timeline.snapshots(frames, m, cfg.offsets, "pk_id", "t_ms_rel_contact", fusion.NUMERIC, fusion.FLAGS, ["frame_idx", "t_s", "pose_n_visible_kp"], tol, cfg.max_interp_gap_ms)
    how = F.col("derivation")
    s = s.join(m.select("pk_id", "source"), "pk_id").withColumns({"offset_ms": F.col("off").cast("int"), "t_ms_rel_contact": F.col("off"), "frame_idx": F.when(F.col("snapshot_available"), F.col("frame_idx")).otherwise(-1), "pose_n_visible_kp": F.when(F.col("snapshot_available"), F.col("pose_n_visible_kp")).otherwise(0)})
    s = contracts.with_provenance(s.withColumn("_how", how), "derived", "timeline").withColumn("derivation", F.col("_how"))
    return {"entities": selected, "frames": n_frames, "snapshots": store.upsert_table(s, cfg.path("temporal_snapshots"), "temporal_snapshots")}


def detect(spark: SparkSession, cfg: Config, detections: DataFrame) -> dict:
    """A table of detections to tracks with roles, ball and events of the entities in it.

    detections: pk_id, scale_ord, frame_idx, track_id, cls (person or ball), cx, cy, w, h, conf. Geometry is read from its
    stored table: it gives the scale that the anchor needs, and the anchor the instant that roles need. Of several input
    sizes the first with an anchor counts, else the first.
    """
    m = _read(spark, cfg, "metadata").join(detections.select("pk_id").distinct(), "pk_id", "left_semi").select("pk_id", "source", "source_identifier", "fps")
    geo = _read(spark, cfg, "geometry").join(m.select("pk_id"), "pk_id", "left_semi")
    found = vision.run(detections, m, geo)
    counts = {}
    for table in ("tracks", "ball", "events"):
        counts[table] = store.upsert_table(contracts.with_provenance(found[table], "model_inferred", "detections"), cfg.path(table), table)
    failures = [r.asDict() for r in found["failures"].groupBy("reason").count().orderBy("reason").collect()]  # a row a reason
    return {"rows": counts, "failures": failures}


def grade(spark: SparkSession, cfg: Config, ids: list[str] | None = None) -> DataFrame:
    """Checks of every primary entity with media (or of the given ones), the roll-up into metadata; returns the summary."""
    m = _read(spark, cfg, "metadata")
    scope = m.where("is_primary").where(F.col("media_kind").isin("video", "pose_table"))
    scope = scope.where(F.col("pk_id").isin(ids)) if ids else scope
    facts = fusion.entity_checks(scope, *[_read(spark, cfg, t) for t in ("tracks", "poses", "ball", "geometry", "events", "temporal_snapshots")])
    rows = facts.join(m.select("pk_id", "source"), "pk_id").withColumn("processing_version", F.lit(contracts.PROCESSING_VERSION))
    store.upsert_table(rows, cfg.path("qc"), "qc")
    store.write_table(corpus.update_from(m, corpus.roll_up(facts, "pk_id"), "pk_id", ["qc_status", "qc_reasons"]), cfg.path("metadata"), "metadata")
    return corpus.check_summary(_read(spark, cfg, "qc"))


worst_first = corpus.worst_first


def publish(spark: SparkSession, cfg: Config, out: str, allowed: Column | None = None, dry_run: bool = False) -> dict:
    """Rows of entities whose licence allows it; the manifest counts rows kept and withheld. Empty tables are skipped.

    ``dry_run`` counts and writes nothing.
    """
    m = _read(spark, cfg, "metadata")
    ok = m.where(allowed if allowed is not None else F.col("redistribute_derived")).select("pk_id")
    tables = {}
    for t in contracts.SCHEMAS:
        df = _read(spark, cfg, t)
        n = df.count()
        if n:
            kept = corpus.publishable(df, ok, "pk_id")
            rows = kept.count() if dry_run else store.write_table(kept, f"{out}/{t}", t)
            tables[t] = {"rows": rows, "rows_withheld": n - rows}
    v = m.agg(F.count_if(F.col("redistribute_video") & F.col("video_relpath").isNotNull()).alias("files"), F.count_if(F.col("has_video") & ~F.col("redistribute_video")).alias("withheld")).first()
    held = corpus.withheld(m.select("pk_id", "source"), ok, "pk_id").groupBy("source", "reason").count().collect()
    manifest = {"tables": tables, "video_files": v["files"], "video_withheld": v["withheld"], "withheld": [r.asDict() for r in held]}
    manifest["dry_run"] = dry_run
    if not dry_run:
        store.write_manifest(spark, f"{out}/manifest.json", manifest)
    return manifest


def report(spark: SparkSession, cfg: Config) -> dict[str, DataFrame]:
    """Every number from the stored tables: counts, label coverage, anchors, availability, reasons, checks."""
    m, s, e = (_read(spark, cfg, t) for t in ("metadata", "temporal_snapshots", "events"))
    labels = ("label_kick_direction", "label_goal", "label_footedness", "label_camera_direction")
    usable = F.col("is_primary") & F.col("media_kind").isin("video", "pose_table")
    return {
        "counts": m.agg(F.count("*").alias("records"), F.count_if("is_primary").alias("primary"), F.count_if(usable).alias("usable"), *[F.avg(F.when(usable, F.col(c).isNotNull().cast("double"))).alias(c) for c in labels]),
        "sources": m.groupBy("source").agg(F.count("*").alias("records"), F.count_if("is_primary").alias("unique"), F.mode("media_kind", True).alias("media_kind"), F.min_by("license", "pk_id").alias("license")),
        "anchors": e.where("event_name = 'ball_contact'").agg(F.avg((~F.col("is_missing")).cast("double")).alias("resolved")),
        "availability": s.groupBy("offset_ms").agg(F.avg(F.col("snapshot_available").cast("double")).alias("share")),
        "reasons": s.where("not snapshot_available").groupBy("unavailable_reason").count(),
        "checks": corpus.check_summary(_read(spark, cfg, "qc")),
        "checks_by_source": corpus.source_matrix(_read(spark, cfg, "qc"), m),
    }


def report_json(spark: SparkSession, cfg: Config) -> dict:
    """The report as nested values: section, key, number."""
    rows = corpus.report(*[_read(spark, cfg, t) for t in ("metadata", "events", "temporal_snapshots", "qc")])
    out: dict = {}
    for r in rows.orderBy("section", "key").collect():  # a row a check, source, offset and reason
        at = out.setdefault(r["section"], {})
        *path, last = r["key"].split("/")
        for p in path:
            at = at.setdefault(p, {})
        at[last] = r["value"]
    return out


def report_text(spark: SparkSession, cfg: Config) -> str:
    """The report for people: a line a number, sections apart."""
    lines: list[str] = []

    def put(values: dict, depth: int) -> None:
        for k, v in values.items():
            if isinstance(v, dict):
                lines.append("  " * depth + k)
                put(v, depth + 1)
            else:
                lines.append(f"{'  ' * depth}{k:<32}{'-' if v is None else f'{v:g}'}")

    for section, values in report_json(spark, cfg).items():
        lines += [section.upper().replace("_", " ")]
        put(values, 1)
        lines.append("")
    return "\n".join(lines)


def card(spark: SparkSession, cfg: Config) -> str:
    """A short markdown card rendered from the report's aggregates."""
    lines = ["# Anchored event tables", ""]
    for name, df in report(spark, cfg).items():
        rows = df.orderBy(*df.columns[:1]).collect()
        lines += [f"## {name}", "| " + " | ".join(df.columns) + " |", "|" + "---|" * len(df.columns)]
        lines += ["| " + " | ".join("-" if v is None else f"{v:.3f}" if isinstance(v, float) else str(v) for v in r) + " |" for r in rows] + [""]
    return "\n".join(lines)


