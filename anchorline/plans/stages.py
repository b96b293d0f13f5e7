"""More named queries: sources, stages and diagnostics over the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.functions import scalars as S
from anchorline.operators import anchor as A
from anchorline.operators import corpus as C
from anchorline.operators import roles as O
from anchorline.operators import series as R
from anchorline.operators import timeline as T
from anchorline.plans.catalogue import _ALIGNED, _CHECKS, _ROLLED, _aligned, _facts, _t, anchor_snapshots, named
from anchorline.sources import readers


@named("crosswalk_coverage", """
select (select count(*) from orders) as segments, (select count(distinct o_custkey) from orders) as videos,
 (select count(*) from customer where c_acctbal > 0 and c_custkey in (select o_custkey from orders)) as mapped""")
def crosswalk_coverage(spark, d):
    segs = _t(spark, d, "orders").select(F.concat(F.col("o_custkey").cast("string"), F.lit(".mkv")).alias("video_name"))
    walk = _t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("name"), F.when(F.col("c_acctbal") > 0, F.col("c_name")).alias("target"))
    return readers.crosswalk_coverage(segs, walk)


@named("catalogue_rows", r"""
with e as (select c_name as bare, c_mktsegment as artist, case when c_nationkey % 2 = 0 then c_nationkey::varchar end as credit,
  case c_nationkey % 4 when 0 then 'CC BY 4.0' when 1 then 'CC BY-SA 3.0' when 2 then 'All rights reserved' end as license from customer),
s as (select *, substr(lower(regexp_replace(bare, '[^A-Za-z0-9]+', '_', 'g')), 1, 60) as ident from e)
select 'cat:' || array_to_string(list_transform(list_filter(regexp_split_to_array(ident, '[-_./ ]+'), lambda x: x <> ''), lambda x: case when regexp_full_match(x, '[0-9]+') then coalesce(nullif(ltrim(x, '0'), ''), '0') else x end), '-') as pk_id,
  case when credit is null then artist else artist || '; ' || credit end as attribution, coalesce(license, 'unknown') as license, coalesce(license like 'CC BY%', false) as redistribute_video,
  case when not coalesce(license like 'CC BY%', false) then 'licence unclear: only derived rows are published' when license like '%SA%' then 'copies must carry the same licence' else 'attribution required' end as redistribution_note from s""")
def catalogue_rows(spark, d):
    k = F.col("c_nationkey") % 4
    none = lambda t: F.lit(None).cast(t)
    e = _t(spark, d, "customer").select(
        F.concat(F.lit("File:"), "c_name", F.lit(".webm")).alias("title"), F.concat(F.lit("<b>"), "c_mktsegment", F.lit("</b>")).alias("artist"), F.when(F.col("c_nationkey") % 2 == 0, F.col("c_nationkey").cast("string")).otherwise("").alias("credit"),
        none("string").alias("descriptionurl"), F.when(k == 0, "CC BY 4.0").when(k == 1, "CC BY-SA 3.0").when(k == 2, "All rights reserved").alias("license"),
        *[none(t).alias(c) for c, t in (("license_url", "string"), ("relpath", "string"), ("sha256", "string"), ("fps", "double"), ("n_frames", "int"), ("width", "int"), ("height", "int"))],
    )
    return readers.catalogue_metadata(e, "cat", "cat", "2000-01-01T00:00:00+00:00").select("pk_id", "attribution", "license", "redistribute_video", "redistribution_note")


_SNAPPED = _CHECKS.split("\nb as (select user_id")[0].rstrip().rstrip(",")


@named("nearest_observed", f"""with {_SNAPPED},
n as (select s.user_id, off_ms, f.event_id, row_number() over (partition by s.user_id, off_ms order by abs(f.t - off_ms), f.t, f.event_id) as rn from snap s join f on f.user_id = s.user_id where snapshot_available)
select user_id, off_ms, event_id from n where rn = 1""")
def nearest_observed(spark, d):
    return T.nearest_observed(_aligned(spark, d), anchor_snapshots(spark, d), "user_id", "event_id", "t_ms", "off_ms")


@named("analysis_by_offset", f"with {_ROLLED} select off_ms, count(*) as n, min(value) as least, max(value) as most from snap join ro using (user_id) where snapshot_available and r < 3 group by off_ms")
def analysis_by_offset(spark, d):
    x = C.analysis_view(anchor_snapshots(spark, d), C.roll_up(_facts(spark, d), "user_id"), "user_id", [])
    return x.groupBy("off_ms").agg(F.count("*").alias("n"), F.min("value").alias("least"), F.max("value").alias("most"))


@named("passing_entities", f"""with {_CHECKS} select distinct user_id from q where "check" = 'min_frames' and status = 'pass' and user_id % 2 = 0""")
def passing_entities(spark, d):
    kind = F.when(F.col("user_id") % 2 == 0, "video").otherwise("none")
    meta = _t(spark, d, "events").select("user_id").distinct().withColumn("media_kind", kind)
    return C.passing(_facts(spark, d), meta, "min_frames", "user_id").select("user_id")


@named("track_diagnostics", """
with g as (select user_id, event_type, count(*) as n, min(event_id) as first_frame, max(event_id) as last_frame, round(avg(value), 6) as mean_confidence, min(value) as x_min, max(value) as x_max, min(-value) as y_min, max(-value) as y_max from events group by user_id, event_type)
select * exclude rn from (select *, row_number() over (partition by user_id order by n desc, event_type) as rn from g) where rn <= 3""")
def track_diagnostics(spark, d):
    e = _t(spark, d, "events").withColumn("y", -F.col("value"))
    return R.track_diagnostics(e, "user_id", "event_type", "event_id", "value", "y", "value", 3).withColumn("mean_confidence", F.round("mean_confidence", 6))


@named("longest_track", "select user_id, sum(n)::bigint as n_rows, max(n) as longest from (select user_id, event_type, count(*) as n from events group by 1, 2) group by user_id")
def longest_track(spark, d):
    return R.longest_track(_t(spark, d, "events"), "user_id", "event_type")


@named("speed_profile", "select user_id, round(quantile_cont(value, 0.25), 6) as p25, round(quantile_cont(value, 0.9), 6) as p90, max(value) as max_speed from events group by user_id")
def speed_profile(spark, d):
    s = R.speed_profile(_t(spark, d, "events"), "user_id", "value")
    return s.withColumns({c: F.round(c, 6) for c in ("p25", "p90")})


@named("inference_size", "select p_partkey, case when p_size % 5 = 0 then 640 else greatest(320, (round_even(least(p_size * 50, 1920) / 32.0, 0) * 32)::int) end as size from part")
def inference_size(spark, d):
    fixed = F.when(F.col("p_size") % 5 == 0, F.lit(640))
    return _t(spark, d, "part").select("p_partkey", S.inference_size(F.col("p_size") * 50, fixed).alias("size"))


@named("keypoint_unpivot", """
with k as (select vec_id, label, embedding, unnest(range(5, 17)) as kp from embeddings)
select vec_id, kp::int as kp_index, embedding[kp + 1]::double as x, case when kp % 3 > 0 then embedding[kp + 17]::double end as y, case when label > 0 then embedding[kp + 1]::double / label * case when label % 2 = 0 then -1.0 else 1.0 end end as x_n, kp % 3 = 0 as is_missing from k""")
def keypoint_unpivot(spark, d):
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    cols = [c for k in range(5, 17) for c in (at(k).alias(f"kp_{k}_x"), (at(k + 16) if k % 3 else F.lit(None).cast("double")).alias(f"kp_{k}_y"), at(k).alias(f"kp_{k}_xc"), at(k + 16).alias(f"kp_{k}_yc"))]
    wide = _t(spark, d, "embeddings").select("vec_id", F.col("label").cast("double").alias("bbox_h"), F.when(F.col("label") % 2 == 0, "L").otherwise("R").alias("camera_direction"), *cols)
    return readers.unpivot_keypoints(wide, ["vec_id"]).select("vec_id", F.col("kp_index").cast("int").alias("kp_index"), "x", "y", "x_n", "is_missing")


def _detections(spark, d) -> DataFrame:
    kind = F.when(F.col("event_type") == "view", "person").when(F.col("event_type") == "click", "ball").otherwise("other")
    return _t(spark, d, "events").select("event_id", F.when(F.col("event_id") % 7 > 0, F.col("user_id")).alias("track_id"), kind.alias("cls"), (F.col("value") / 400).alias("conf"))


@named("detection_split", "select event_id, case event_type when 'view' then 'person' else 'ball' end as cls from events where event_id % 7 > 0 and ((event_type = 'view' and value / 400 >= 0.35) or (event_type = 'click' and value / 400 >= 0.15))")
def detection_split(spark, d):
    persons, balls = O.split_detections(_detections(spark, d))
    return persons.unionByName(balls).select("event_id", "cls")


@named("keypoint_mask", "select event_id, case when value / 400 >= 0.3 then value end as x, not coalesce(value / 400 >= 0.3, false) as is_missing, case when not coalesce(value / 400 >= 0.3, false) then 'keypoint_low_confidence' end as missing_reason from events")
def keypoint_mask(spark, d):
    p = _t(spark, d, "events").select("event_id", F.col("value").alias("x"), F.col("value").alias("y"), (F.col("value") / 400).alias("confidence"))
    return O.mask_keypoints(p).select("event_id", "x", "is_missing", "missing_reason")


@named("clip_geometry", f"""with {_ALIGNED},
g as (select user_id, value as w, (value + event_id % 50) / 2 as cx, (event_id % 9 + greatest(value, event_id % 50)) / 2 as cy, us <= anchor_us as pre from al where event_type <> 'error')
select user_id, round(case when median(w) > 0 then median(w) end, 6) as goal_width, round(case when count(*) filter (where pre) > 0 then median(cx) filter (where pre) else median(cx) end, 6) as goal_cx,
 round(case when count(*) filter (where pre) > 0 then median(cy) filter (where pre) else median(cy) end, 6) as goal_cy from g group by user_id""")
def clip_geometry(spark, d):
    al = _aligned(spark, d).withColumn("pk_id", F.col("user_id"))
    g = al.select("pk_id", F.col("us").alias("frame_idx"), F.col("value").alias("goal_width_px"), F.col("value").alias("post_left_x"), (F.col("event_id") % 50).cast("double").alias("post_right_x"), (F.col("event_id") % 9).cast("double").alias("crossbar_y"), F.col("value").alias("post_left_y"), (F.col("event_id") % 50).cast("double").alias("post_right_y"), (F.col("event_type") == "error").alias("is_missing"))
    out = O.clip_geometry(g, al.select("pk_id", F.col("anchor_us").alias("anchor_frame")).distinct())
    return out.select(F.col("pk_id").alias("user_id"), *[F.round(c, 6).alias(c) for c in ("goal_width", "goal_cx", "goal_cy")])


@named("commit_detection", """
with h as (select user_id, epoch_us(ts) // 3600000000 as f, event_id, value, event_type from events),
k as (select *, row_number() over (partition by user_id, f order by event_id desc) as rn from h),
t as (select user_id, f, value as cx, count(*) over (partition by user_id) as n_all from k where rn = 1),
a as (select user_id, max(case when event_type = 'purchase' then f end) as a from h group by user_id),
x as (select t.*, a, row_number() over w as i, count(*) over (partition by t.user_id) as n, lag(cx) over w as px, lead(cx) over w as nx, lag(f / 20.0::double) over w as pt, lead(f / 20.0::double) over w as nt
  from t join a on a.user_id = t.user_id where f >= a - 1.2::double * 20.0 and f <= a + 0.6::double * 20.0 window w as (partition by t.user_id order by f)),
v as (select *, (case when i = n then cx else nx end - case when i = 1 then cx else px end) / (case when i = n then f / 20.0::double else nt end - case when i = 1 then f / 20.0::double else pt end) as vx from x where n > 1),
r as (select *, abs(vx) / 100.0::double as rel from v), w as (select user_id, max(n) as n, min(case when rel > 0.35 then f end) as hit from r group by user_id), c as (select r.user_id, r.rel from r join w on w.user_id = r.user_id and w.hit = r.f)
select a.user_id, case when a.a is not null and m.n_all >= 4 and coalesce(w.n, 0) >= 4 then w.hit end::double as frame_idx, case when a.a is not null and m.n_all >= 4 and coalesce(w.n, 0) >= 4 and w.hit is not null then greatest(0.15, least(0.9, c.rel / (2 * 0.35::double)))::double end as confidence,
 case when a.a is null then 'no_anchor' when m.n_all < 4 then 'track_too_short' when coalesce(w.n, 0) < 4 then 'track_absent_around_anchor' when w.hit is null then 'no_commit_seen' end as missing_reason
from a join (select user_id, max(n_all) as n_all from t group by user_id) m using (user_id) left join w on w.user_id = a.user_id left join c on c.user_id = a.user_id""")
def commit_detection(spark, d):
    e = _t(spark, d, "events").withColumn("f", F.floor(S.epoch_us(F.col("ts")) / 3600000000))
    t = T.keep_last(e, ["user_id", "f"], "event_id").select(F.col("user_id").alias("pk_id"), F.col("f").alias("frame_idx"), F.col("value").alias("cx"), F.lit(100.0).alias("h"))
    a = e.groupBy(F.col("user_id").alias("pk_id")).agg(F.max(F.when(F.col("event_type") == "purchase", F.col("f"))).alias("anchor_frame"), F.lit(20.0).alias("fps"))
    return O.keeper_commit(t, a).withColumnRenamed("pk_id", "user_id").withColumn("frame_idx", F.col("frame_idx").cast("double"))


@named("first_scale", "select user_id, min(event_id) filter (where event_type = 'purchase') as scale, arg_min(value, event_id) filter (where event_type = 'purchase') as anchor_value from events group by user_id")
def first_scale(spark, d):
    c = _t(spark, d, "events").select(F.col("user_id").alias("pk_id"), F.col("event_id").alias("scale_ord"), F.when(F.col("event_type") == "purchase", F.col("value")).alias("anchor_frame"))
    return O.first_scale(c).select(F.col("pk_id").alias("user_id"), F.col("scale_ord").alias("scale"), F.col("anchor_frame").alias("anchor_value"))


@named("episode_windows", "select user_id, greatest(0, (max(event_id) - 100.0)::int) as start_frame, least(9000, (max(event_id) + 62)::int) as end_frame from events group by user_id")
def episode_windows(spark, d):
    last = _t(spark, d, "events").groupBy("user_id").agg(F.max("event_id").alias("a"))
    lo, hi = A.episode_window(F.col("a"), 25.0, F.lit(9001))
    return last.select("user_id", lo.alias("start_frame"), hi.alias("end_frame"))


@named("first_entities", "select event_id, user_id from events where user_id in (select user_id from events group by user_id order by min(event_id) limit 10)")
def first_entities(spark, d):
    return readers.first_entities(_t(spark, d, "events").select("event_id", "user_id"), "user_id", "event_id", 10)


@named("source_counts", "select source, count(*) as records, count(distinct lang) as langs, count(*) filter (where text is null) as without_text from documents group by source")
def source_counts(spark, d):
    return _t(spark, d, "documents").groupBy("source").agg(F.count("*").alias("records"), F.count_distinct("lang").alias("langs"), F.count_if(F.col("text").isNull()).alias("without_text"))


@named("anchor_rate", f"with {_ALIGNED} select count(distinct user_id) as entities, count(distinct case when anchor_us is not null then user_id end) as resolved from al")
def anchor_rate(spark, d):
    return _aligned(spark, d).agg(F.count_distinct("user_id").alias("entities"), F.count_distinct(F.when(F.col("anchor_us").isNotNull(), F.col("user_id"))).alias("resolved"))
