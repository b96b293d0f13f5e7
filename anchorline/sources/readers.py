"""Raw files to rows. CSV is read as strings and cast with NULL for what does not parse."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anchorline.functions.scalars import catalogue_slug, dedup_key, entity_id, entity_uid, goal_flag, has_token, hms_seconds, licence_open, licence_share_alike, nan_to_null, side

# Names in the second release of the pose table and those they become.
RENAMES = {"kick_id": "kick_id_raw", "kicker_track_id_main": "track_id", "frame": "frame_num"}
KEYPOINTS = range(5, 17)
#: A catalogue entry with what was probed of its file.
ENTRY = "title string, artist string, credit string, descriptionurl string, license string, license_url string, relpath string, sha256 string, fps double, n_frames int, width int, height int"


def read_strings(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings; no inference pass over the data."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def pose_table(raw: DataFrame) -> DataFrame:
    """One row a kick and frame; rows without a numeric frame go (count them with ``dropped_rows``)."""
    df = raw.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in raw.columns})
    number = lambda c: nan_to_null(F.col(c).try_cast("double"))
    cols = {c: number(c) for c in df.columns if c.startswith(("bbox_", "kp_")) or c == "fps"}
    cols |= {"frame_num": number("frame_num").cast("int"), "last_touch": F.coalesce(number("last_touch"), F.lit(0.0)).cast("int")}
    cols |= {c: side(F.col(c)) for c in ("camera_direction", "kick_direction") if c in df.columns}
    if "goal" in df.columns:
        cols["goal"] = goal_flag(F.col("goal"))
    return df.withColumns(cols).where(F.col("frame_num").isNotNull())


def dropped_rows(raw: DataFrame) -> DataFrame:
    name = "frame" if "frame" in raw.columns else "frame_num"
    return raw.agg(F.count_if(F.col(name).try_cast("double").isNull()).alias("dropped"))


def unpivot_keypoints(df: DataFrame, keys: Sequence[str], points: Sequence[int] = KEYPOINTS) -> DataFrame:
    """Twelve rows a frame; normalised by the box height and mirrored for a camera on the left."""
    h = F.when(F.col("bbox_h") > 0, F.col("bbox_h"))
    flip = F.when(F.col("camera_direction") == "L", -1.0).otherwise(1.0)
    c = lambda k, s: F.col(f"kp_{k}_{s}")
    rows = [F.struct(F.lit(k).cast("byte").alias("kp_index"), c(k, "x").alias("x"), c(k, "y").alias("y"), c(k, "xc").alias("x_c"), c(k, "yc").alias("y_c"), (c(k, "xc") / h * flip).alias("x_n"), (c(k, "yc") / h).alias("y_n")) for k in points]
    out = df.select(*keys, F.explode(F.array(*rows)).alias("p")).select(*keys, "p.*")
    missing = F.col("x").isNull() | F.col("y").isNull()
    return out.withColumn("is_missing", missing).withColumn("missing_reason", F.when(missing, "source_keypoint_absent"))


def first_entities(df: DataFrame, key: str, ordinal: str, n: int | None) -> DataFrame:
    """Rows of the first n distinct entities in file order."""
    if n is None:
        return df
    first = df.groupBy(key).agg(F.min(ordinal).alias("_met")).orderBy("_met", key).limit(n).select(key)
    return df.join(first, key, "left_semi")


def annotations(spark: SparkSession, path: str, label: str = "Penalty", name: str = "Labels-v2.json") -> DataFrame:
    """Annotations of one label from nested JSON files below ``path``; unreadable files give no rows."""
    item = "label string, gameTime string, position string, team string, visibility string"
    raw = spark.read.schema(f"UrlLocal string, annotations array<struct<{item.replace(' string', ': string')}>>, _corrupt string")
    raw = raw.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", name).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").json(path)
    raw = raw.select("*", F.col("_metadata.file_path").alias("file"))
    rows = raw.where("_corrupt is null").select("file", F.posexplode("annotations").alias("idx", "a")).where(F.col("a.label") == label)
    parts = F.split("file", "/")
    game = F.array_join(F.slice(parts, F.size(parts) - 3, 3), "/")
    return rows.select(game.alias("game"), "idx", F.regexp_extract("a.gameTime", r"^\s*(\d+)", 1).try_cast("int").alias("half"), F.col("a.position").try_cast("int").alias("position"), F.col("a.team").alias("team"))


def segments(raw: DataFrame, token: str = "8") -> DataFrame:
    """Segments of one class token with their duration in seconds (NULL if a time is malformed)."""
    hit = raw.where(has_token(F.col("cls_id"), token))
    return hit.withColumn("duration_s", hms_seconds(F.col("event_end_time")) - hms_seconds(F.col("event_start_time")))


def crosswalk(df: DataFrame, walk: DataFrame, key: Column, ordinal: str = "ord") -> DataFrame:
    """Left join on a name without ``.mkv``; the last of repeated names counts. walk: name, target, ordinal."""
    w = Window.partitionBy("_n").orderBy(F.desc(ordinal))
    bare = lambda c: F.regexp_replace(c, r"\.mkv$", "")
    last = walk.withColumn("_n", bare(F.col("name"))).withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select("_n", "target")
    return df.withColumn("_n", bare(key)).join(last, "_n", "left").drop("_n")


def union_first(parts: Sequence[DataFrame], key: str) -> DataFrame:
    """Each key from the first part that has it; of several rows there, the least (minima are combined before the shuffle)."""
    every = None
    for i, p in enumerate(parts):
        p = p.withColumn("_term", F.lit(i))
        every = p if every is None else every.unionByName(p)
    first = every.groupBy(key).agg(F.min(F.struct("_term", F.struct(*sorted(c for c in every.columns if c not in (key, "_term"))).alias("r"))).alias("_m"))
    return first.select(*[F.col(key) if c == key else F.col(f"_m.r.{c}").alias(c) for c in every.columns if c != "_term"])


def exclusion(other: Column, width: Column, duration: Column, licence: Column, narrow: float = 640, long: float = 240) -> Column:
    """Why a catalogue entry is left out, first reason first; NULL keeps it."""
    return F.when(other, "other_sport").when(width < narrow, "too_narrow").when(duration > long, "too_long").when(licence.isNull() | (licence == ""), "no_licence")


def parsed(text: Column, schema: str, mode: str = "PERMISSIVE") -> Column:
    """A JSON column by its schema; what cannot be read is NULL."""
    return F.from_json(text, schema, {"mode": mode})


def crosswalk_coverage(segs: DataFrame, walk: DataFrame, video: str = "video_name") -> DataFrame:
    """Segments, their distinct videos, and rows of the crosswalk that map one of these videos to a name."""
    bare = lambda c: F.regexp_replace(c, r"\.mkv$", "")
    mapped = walk.where("target is not null").withColumn("_n", bare(F.col("name"))).join(segs.select(bare(F.col(video)).alias("_n")).distinct(), "_n", "left_semi")
    n = segs.agg(F.count("*").alias("segments"), F.count_distinct(video).alias("videos"), F.lit(0).cast("long").alias("mapped"))
    none = F.lit(0).cast("long")
    both = n.unionByName(mapped.agg(none.alias("segments"), none.alias("videos"), F.count("*").alias("mapped")))
    return both.agg(*[F.sum(c).alias(c) for c in ("segments", "videos", "mapped")])


def catalogue_metadata(entries: DataFrame, slug: str, family: str, now: str) -> DataFrame:
    """Metadata of catalogue entries (see ``ENTRY``). No label is inferred; empty parts leave the attribution."""
    ident = catalogue_slug(F.col("title"))
    filled = lambda c: F.nullif(F.trim(F.regexp_replace(c, "<[^>]+>", "")), F.lit(""))
    parts = F.nullif(F.concat_ws("; ", *[filled(F.col(c)) for c in ("artist", "credit", "descriptionurl")]), F.lit(""))
    free = F.coalesce(licence_open(F.col("license")), F.lit(False))
    note = F.when(~free, "licence unclear: only derived rows are published").when(licence_share_alike(F.col("license")), "copies must carry the same licence").otherwise("attribution required")
    x = entries.withColumn("pk_id", entity_id(F.lit(slug), ident))
    return x.select(
        "pk_id", entity_uid(F.col("pk_id")).alias("pk_uid"), F.lit(slug).alias("source"), F.col("title").alias("source_identifier"), dedup_key(F.lit(family), ident).alias("dedup_key"), F.lit(True).alias("is_primary"),
        F.lit("video").alias("media_kind"), F.col("relpath").isNotNull().alias("has_video"), F.col("relpath").alias("video_relpath"), F.col("sha256").alias("video_sha256"), F.nullif("fps", F.lit(0.0)).alias("fps"),
        F.nullif("n_frames", F.lit(0)).alias("n_frames"), F.col("width").alias("frame_width"), F.col("height").alias("frame_height"), F.try_divide(F.nullif("n_frames", F.lit(0)), F.nullif("fps", F.lit(0.0))).alias("clip_duration_s"),
        F.lit("none").alias("label_provenance"), F.coalesce(F.nullif("license", F.lit("")), F.lit("unknown")).alias("license"), "license_url", F.coalesce(parts, F.col("title")).alias("attribution"),
        F.lit(True).alias("redistribute_derived"), free.alias("redistribute_video"), note.alias("redistribution_note"), F.lit(now).alias("ingested_at_utc"), F.lit("pending").alias("qc_status"),
    )


def media_files(spark: SparkSession, path: str, glob: str = "*.mp4") -> DataFrame:
    """name, n_bytes and sha256 of files below ``path`` (each at most 2 GB, as it is hashed in one piece)."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", True).load(path)
    return raw.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("n_bytes"), F.sha2("content", 256).alias("sha256"))


def render_only(ink: Column, least: float = 0.05) -> Column:
    """Media kind by the share of lit pixels in the first frame; an unreadable frame counts as video."""
    return F.when(ink < least, "render_only").otherwise("video")
