"""Fixed schemas of the nine tables, enumerations, projection onto a schema and provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PROCESSING_VERSION = "0.1.0"

# Ladder of offsets, keypoints, roles, events, ways of derivation.
OFFSETS_MS = (-2000, -1500, -1000, -750, -500, -250, 0)
KEYPOINTS = {
    5: "left_shoulder", 6: "right_shoulder", 7: "left_elbow", 8: "right_elbow", 9: "left_wrist", 10: "right_wrist",
    11: "left_hip", 12: "right_hip", 13: "left_knee", 14: "right_knee", 15: "left_ankle", 16: "right_ankle",
}
ROLES = ("kicker", "keeper")
EVENTS = ("ball_contact", "keeper_commit", "plant_foot")
DERIVATIONS = ("source_provided", "derived", "interpolated")

# Columns of each table in order. ``!`` after a name: never null. Types: s string, b boolean,
# t tinyint, i int, d double.
_SPINE = "processing_version! s, derivation! s, model_name s, model_version s, provenance! s"
_FRAMES = """pk_id! s, source! s, frame_idx! i, t_s! d, t_ms_rel_contact! d, kicker_cx d, kicker_cy d, kicker_h d, kicker_vx d, kicker_vy d, kicker_speed d,
kicker_available! b, hip_shoulder_angle_deg d, pelvis_orientation_deg d, ankle_separation_n d, plant_ankle_x_n d, kick_ankle_x_n d, kick_ankle_vx_n d,
torso_lean_deg d, pose_n_visible_kp t, pose_available! b, keeper_cx d, keeper_cy d, keeper_vx d, keeper_vy d, keeper_available! b, ball_x d, ball_y d,
ball_vx d, ball_vy d, ball_available! b, kicker_ball_dist_n d, keeper_goal_offset_n d, is_observed_frame! b"""
_COLUMNS = {
    "metadata": f"""pk_id! s, pk_uid! s, source! s, source_identifier! s, source_dataset_doi s, source_version s, dedup_key! s, is_primary! b, duplicate_of_pk_id s,
duplicate_evidence s, media_kind! s, has_video! b, video_relpath s, video_sha256 s, fps d, n_frames i, frame_width i, frame_height i, clip_duration_s d,
competition s, gender s, level s, season s, match_context s, kicker_ref s, label_kick_direction s, label_keeper_direction s, label_outcome s, label_goal t,
label_footedness s, label_camera_direction s, label_provenance! s, license! s, license_url s, attribution! s, redistribute_derived! b, redistribute_video! b,
redistribution_note s, ingested_at_utc! s, qc_status! s, qc_reasons s, {_SPINE}""",
    "tracks": f"""pk_id! s, source! s, source_identifier! s, role! s, track_id s, frame_idx! i, t_s d, t_ms_rel_contact d, bbox_cx d, bbox_cy d, bbox_w d, bbox_h d,
vx_px_s d, vy_px_s d, confidence d, is_missing! b, missing_reason s, {_SPINE}""",
    "poses": f"""pk_id! s, source! s, role! s, frame_idx! i, t_s d, t_ms_rel_contact d, kp_index! t, kp_name! s, x d, y d, x_c d, y_c d, x_n d, y_n d, confidence d,
is_missing! b, missing_reason s, {_SPINE}""",
    "ball": f"""pk_id! s, source! s, frame_idx! i, t_s d, t_ms_rel_contact d, x d, y d, bbox_w d, bbox_h d, vx_px_s d, vy_px_s d, confidence d, is_missing! b,
missing_reason s, {_SPINE}""",
    "geometry": f"""pk_id! s, source! s, frame_idx i, post_left_x d, post_left_y d, post_right_x d, post_right_y d, crossbar_y d, quad_tl_x d, quad_tl_y d, quad_tr_x d,
quad_tr_y d, quad_br_x d, quad_br_y d, quad_bl_x d, quad_bl_y d, net_edge_density d, goal_width_px d, goal_height_px d, px_per_m d, confidence d, is_missing! b,
missing_reason s, {_SPINE}""",
    "events": f"pk_id! s, source! s, event_name! s, frame_idx i, t_s d, confidence d, method! s, is_missing! b, missing_reason s, {_SPINE}",
    "temporal_frames": f"{_FRAMES}, {_SPINE}",
    "qc": "pk_id! s, source! s, check! s, status! s, value d, threshold d, message s, processing_version! s",
}
_TYPES = {"s": T.StringType(), "b": T.BooleanType(), "t": T.ByteType(), "i": T.IntegerType(), "d": T.DoubleType()}


def _schema(text: str) -> T.StructType:
    fields = [f.split() for f in text.replace("\n", " ").split(",")]
    return T.StructType([T.StructField(n.rstrip("!"), _TYPES[t], not n.endswith("!")) for n, t in fields])


SCHEMAS = {name: _schema(text) for name, text in _COLUMNS.items()}
_KEPT = {"pk_id", "source", "t_ms_rel_contact", "processing_version", "derivation", "provenance"}
SCHEMAS["temporal_snapshots"] = T.StructType(
    [T.StructField(f.name, f.dataType, f.nullable or f.name not in _KEPT) for f in SCHEMAS["temporal_frames"]]
    + _schema("offset_ms! i, snapshot_available! b, snapshot_method! s, gap_ms d, unavailable_reason s").fields
)


def coerce(df: DataFrame, table: str) -> DataFrame:
    """Projects onto the table's schema: absent nullable columns are NULL, extra ones go, null booleans are false.

    An absent column that may not be null raises at once; null values in one raise when rows are computed.
    """
    out: list[Column] = []
    for f in SCHEMAS[table]:
        if f.name not in df.columns:
            if not f.nullable:
                raise ValueError(f"{table}.{f.name} is required")
            out.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f.name)
        if f.dataType == T.DoubleType() and dict(df.dtypes)[f.name] in ("double", "float"):
            c = F.when(~F.isnan(c), c)
        c = c.try_cast(f.dataType)
        if f.dataType == T.BooleanType():
            c = F.coalesce(c, F.lit(False))
        elif not f.nullable:
            c = F.when(c.isNull(), F.raise_error(F.lit(f"{table}.{f.name} is null")).cast(f.dataType)).otherwise(c)
        out.append(c.alias(f.name))
    return df.select(*out)


def with_provenance(df: DataFrame, derivation: str, provenance: str, model: str | None = None, version: str | None = None) -> DataFrame:
    if derivation not in DERIVATIONS:
        raise ValueError(derivation)
    text = lambda x: F.lit(x).cast("string")
    return df.withColumns({"processing_version": text(PROCESSING_VERSION), "derivation": text(derivation), "model_name": text(model), "model_version": text(version), "provenance": text(provenance)})
