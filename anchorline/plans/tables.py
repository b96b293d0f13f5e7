"""Queries of the composites: frames, checks, roles and the report, over canonical tables made of the driver's.

``TABLES`` makes metadata, tracks, poses, ball, events, geometry and snapshots of the events table, in SQL that Spark and
the oracle both read; the queries then call the library, and their SQL says the same again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.operators import corpus, fusion, roles
from anchorline.plans.catalogue import _t, named

_PK = "'u:' || cast(user_id as string) as pk_id"
_E = "(select *, event_id % 5 as k, cast(event_id % 97 as int) - 2 as f from {events} where user_id is not null)"
_U = "(select distinct user_id as u from {events} where user_id is not null)"
TABLES = {
    "metadata": f"""select 'u:' || cast(u as string) as pk_id, 's' || cast(u % 3 as string) as source, u % 11 <> 0 as is_primary,
  case u % 4 when 0 then 'pose_table' when 1 then 'render_only' else 'video' end as media_kind, case when u % 7 <> 0 then cast(25 as double) end as fps,
  cast(case when u % 5 = 0 then 0 else 97 end as int) as n_frames, case when u % 3 > 0 then 'L' end as label_kick_direction, cast(case when u % 2 = 0 then 1 end as int) as label_goal,
  case u % 3 when 0 then 'R' when 1 then 'L' end as label_footedness, case when u % 6 = 0 then 'R' end as label_camera_direction, case when u % 2 = 0 then 'none (source)' else 'source' end as label_provenance from {_U} x""",
    "tracks": f"""select {_PK}, case k when 3 then 'keeper' when 4 then 'other' else 'kicker' end as role, case when event_id % 50 > 0 then 't' || cast(user_id % 2 * (event_id % 2) as string) end as track_id,
  f as frame_idx, cast(f as double) / 25 as t_s, case when user_id % 9 > 0 then cast((f - 40) * 40 as double) end as t_ms_rel_contact, value as bbox_cx, value / 2 as bbox_cy, cast(50 + event_id % 60 as double) as bbox_h,
  value / 10 as vx_px_s, value / 20 as vy_px_s, event_id % 13 = 0 as is_missing, event_id as ingest_ord, 's' || cast(user_id % 3 as string) as source from {_E} e""",
    "poses": f"""select {_PK}, case when k < 3 then 'kicker' else 'keeper' end as role, f as frame_idx, kp as kp_index, case when (event_id + kp) % 4 > 0 then value / (100 + kp) end as x_n,
  case when (event_id + kp) % 4 > 0 then value / (200 + kp) end as y_n, (event_id + kp) % 4 = 0 as is_missing, event_id * 100 + kp as ingest_ord
  from {_E} e cross join (select 5 as kp union all select 7 union all select 11 union all select 12 union all select 15 union all select 16) p""",
    "ball": f"select {_PK}, f as frame_idx, value + 10 as x, value / 3 as y, value / 7 as vx_px_s, value / 9 as vy_px_s, event_id % 17 = 0 as is_missing, event_id as ingest_ord from {_E} e where k >= 2",
    "geometry": f"select {_PK}, f as frame_idx, event_id % 3 = 0 as is_missing, value as post_left_x, value + 100 as post_right_x, value / 4 as crossbar_y, value as post_left_y, value + 1 as post_right_y, cast(90 + event_id % 7 as double) as goal_width_px from {_E} e where user_id % 8 > 0",
    "events": f"""select 'u:' || cast(u as string) as pk_id, 'ball_contact' as event_name, cast(case when u % 4 < 3 then 40 end as int) as frame_idx, u % 4 = 3 as is_missing, cast(case when u % 4 < 3 then 0.5 end as double) as confidence,
  case when u % 5 = 1 then 'mark_latest_of_multiple' else 'mark' end as method from {_U} x where u % 10 > 0""",
    "snapshots": f"""select 'u:' || cast(u as string) as pk_id, o as offset_ms, (u + o / 250) % 3 <> 0 as snapshot_available, case when (u + o / 250) % 3 = 0 then case when u % 2 = 0 then 'before_clip_start' else 'after_clip_end' end end as unavailable_reason
  from {_U} x cross join (select 0 as o union all select -250 union all select -500 union all select -750 union all select -1000 union all select -1500 union all select -2000) y where u % 12 > 0""",
}


def canonical(spark, d, *names: str) -> list[DataFrame]:
    events = _t(spark, d, "events")
    return [spark.sql(TABLES[n], events=events) for n in names]


_WITH = ", ".join(f"{n}_ as ({q.format(events='events')})" for n, q in TABLES.items())

_FRAMES = f"""{_WITH},
several as (select pk_id from tracks_ where role = 'kicker' and frame_idx >= 0 group by 1 having count(distinct track_id) > 1),
per as (select pk_id, track_id, count(*) as n, min(ingest_ord) as met, min(case when abs(t_ms_rel_contact) < 1e-6 then ingest_ord end) as hit from tracks_ where role = 'kicker' and frame_idx >= 0 and track_id is not null group by 1, 2),
one as (select pk_id, track_id from per qualify row_number() over (partition by pk_id order by hit nulls last, n desc, met) = 1),
kick as (select t.* from tracks_ t left join one using (pk_id) where role = 'kicker' and frame_idx >= 0 and (t.track_id = one.track_id or (t.track_id is null and t.pk_id not in (select pk_id from several)))
  qualify row_number() over (partition by t.pk_id, frame_idx order by ingest_ord desc) = 1),
keep as (select * from tracks_ where role = 'keeper' and frame_idx >= 0 qualify row_number() over (partition by pk_id, frame_idx order by ingest_ord desc) = 1),
orb as (select * from ball_ where frame_idx >= 0 qualify row_number() over (partition by pk_id, frame_idx order by ingest_ord desc) = 1),
p as (select * from poses_ where role = 'kicker' and frame_idx >= 0),
wide as (select pk_id, frame_idx, count(*) filter (where not is_missing) as seen, arg_min(x_n, ingest_ord) filter (where kp_index = 15 and x_n is not null) as la, arg_min(x_n, ingest_ord) filter (where kp_index = 16 and x_n is not null) as ra,
  arg_min(y_n, ingest_ord) filter (where kp_index = 15 and y_n is not null) as lay, arg_min(y_n, ingest_ord) filter (where kp_index = 16 and y_n is not null) as ray from p group by 1, 2 having count(x_n) + count(y_n) > 0),
feat as (select w.*, sqrt((la - ra) * (la - ra) + (lay - ray) * (lay - ray)) as sep, case label_footedness when 'R' then ra when 'L' then la end as kx, fps from wide w join metadata_ using (pk_id)),
featv as (select *, case when fps > 0 then (kx - lag(kx) over (partition by pk_id order by frame_idx)) / (1.0 / fps) end as kvx from feat)
select k.pk_id, k.frame_idx, k.t_ms_rel_contact, k.bbox_cx as kicker_cx, round(sqrt(k.vx_px_s * k.vx_px_s + k.vy_px_s * k.vy_px_s), 6) as kicker_speed, not k.is_missing as kicker_available,
  cast(coalesce(seen, 0) as integer) as pose_n_visible_kp, coalesce(seen > 0, false) as pose_available, round(sep, 6) as ankle_separation_n, kx as kick_ankle_x_n, round(kvx, 6) as kick_ankle_vx_n,
  g.bbox_cx as keeper_cx, coalesce(not g.is_missing, false) as keeper_available, b.x as ball_x, coalesce(not b.is_missing, false) as ball_available,
  round(case when k.bbox_h > 0 then sqrt((b.x - k.bbox_cx) * (b.x - k.bbox_cx) + (b.y - k.bbox_cy) * (b.y - k.bbox_cy)) / k.bbox_h end, 6) as kicker_ball_dist_n
from kick k left join featv v on v.pk_id = k.pk_id and v.frame_idx = k.frame_idx left join keep g on g.pk_id = k.pk_id and g.frame_idx = k.frame_idx left join orb b on b.pk_id = k.pk_id and b.frame_idx = k.frame_idx
where k.t_ms_rel_contact is not null"""


@named("build_frames", f"with {_FRAMES}")
def build_frames(spark, d):
    x = fusion.build_frames(*canonical(spark, d, "metadata", "tracks", "poses", "ball"))
    r = lambda n: F.round(n, 6).alias(n)
    return x.select(
        "pk_id", "frame_idx", "t_ms_rel_contact", "kicker_cx", r("kicker_speed"), "kicker_available", F.col("pose_n_visible_kp").cast("int").alias("pose_n_visible_kp"), "pose_available", r("ankle_separation_n"), "kick_ankle_x_n",
        r("kick_ankle_vx_n"), "keeper_cx", "keeper_available", "ball_x", "ball_available", r("kicker_ball_dist_n"),
    )


_FACTS = f"""{_WITH},
con as (select pk_id, max(case when not is_missing then frame_idx end) as cf, max(method) as how, max(confidence) as conf from events_ where event_name = 'ball_contact' group by 1),
m as (select * from metadata_ left join con using (pk_id)),
ru as (select pk_id, cf, case when cf is not null and fps is not null then greatest(cf - cast(floor(2.0 * fps) as int), 0) end as lo from m),
kt as (select t.*, cf, lo from tracks_ t join ru using (pk_id) where role = 'kicker' and frame_idx >= 0),
w as (select pk_id, count(*) as n_rows, count(*) filter (where not is_missing) as seen, count(distinct track_id) as tracks, count(*) filter (where not is_missing and frame_idx between lo and cf) as in_run, max(case when lo is not null then greatest(cf - lo + 1, 1) end) as span from kt group by 1),
band as (select pk_id, bbox_cx, bbox_cy, bbox_h, row_number() over (partition by pk_id order by frame_idx, bbox_cx, bbox_cy, bbox_h) - 1 as i, count(*) over (partition by pk_id) as n from kt where frame_idx between cf - 4 and cf + 4),
mid as (select pk_id, bbox_cx as mx, bbox_cy as my, bbox_h as mh from band where i = n // 2),
sc as (select pk_id, max(h) as scale from (select pk_id, role, median(bbox_h) as h from tracks_ where frame_idx >= 0 group by 1, 2) group by 1),
po as (select pk_id, avg(case when is_missing then 0.0 else 1.0 end) as complete from poses_ where frame_idx >= 0 group by 1),
kp as (select pk_id, count(*) as n_keeper from tracks_ where role = 'keeper' and frame_idx >= 0 and not is_missing group by 1),
bl as (select pk_id, count(*) as n_ball, count(*) filter (where frame_idx <= cf) as before, max(case when frame_idx <= cf then frame_idx end) as bf from ball_ left join con using (pk_id) where frame_idx >= 0 and not ball_.is_missing group by 1),
bx as (select pk_id, x, y from ball_ join bl using (pk_id) where frame_idx = bf and not is_missing qualify row_number() over (partition by pk_id order by x desc, y desc) = 1),
ge as (select pk_id, avg(case when is_missing then 0.0 else 1.0 end) as goal from geometry_ group by 1),
sn as (select pk_id, avg(case when snapshot_available then 1.0 else 0.0 end) as avail, bool_or(snapshot_available) filter (where offset_ms = 0) as at0 from snapshots_ group by 1),
x as (select m.*, w.* exclude (pk_id), mx, my, mh, scale, complete, n_keeper, n_ball, before, bx.x as bx, bx.y as b_y, goal, avail, at0, media_kind in ('pose_table', 'render_only', 'none') as flat,
  case when span is not null then in_run::double / span else seen::double / greatest(coalesce(n_frames, 0), 1) end as cover, case when coalesce(n_frames, 0) > 0 then n_frames else coalesce(n_rows, 0) end as nf,
  sqrt((bx.x - mx) * (bx.x - mx) + (bx.y - my) * (bx.y - my)) / greatest(mh, 1.0) as dist
  from m left join w using (pk_id) left join mid using (pk_id) left join sc using (pk_id) left join po using (pk_id) left join kp using (pk_id) left join bl using (pk_id) left join bx using (pk_id) left join ge using (pk_id) left join sn using (pk_id)),
q as (
 select pk_id, 1 as check_ord, 'contact_anchor' as "check", case when cf is null then 'fail' when contains(how, 'latest_of_multiple') then 'warn' else 'pass' end as status, conf as value, null::double as threshold from x
 union all select pk_id, 2, 'kicker_track', case when seen is null then 'fail' when cover >= 0.8 then 'pass' else 'warn' end, cover, 0.8 from x
 union all select pk_id, 3, 'kicker_track_single_identity', case when seen is not null then case when tracks <= 1 then 'pass' else 'warn' end end, tracks, 1 from x
 union all select pk_id, 4, 'pose_completeness', case when complete >= 0.9 then 'pass' when complete >= 0.7 then 'warn' else 'fail' end, complete, 0.7 from x
 union all select pk_id, 5, 'keeper_track', case when flat then 'na' when n_keeper > 0 then 'pass' else 'fail' end, null, null from x
 union all select pk_id, 6, 'ball_track', case when flat then 'na' when n_ball > 0 then 'pass' else 'fail' end, null, null from x
 union all select pk_id, 7, 'fps_plausible', case when fps between 10 and 120 then 'pass' else 'fail' end, fps, null from x
 union all select pk_id, 8, 'min_frames', case when nf >= 10 then 'pass' else 'fail' end, nf, 10 from x
 union all select pk_id, 9, 'snapshot_coverage', case when avail is null then 'fail' when avail >= 0.5 then 'pass' else 'warn' end, avail, 0.5 from x
 union all select pk_id, 10, 'snapshot_at_contact', case when avail is not null then case when at0 then 'pass' else 'fail' end end, null, null from x
 union all select pk_id, 11, 'kicker_at_ball', case when flat or cf is null then 'na' when coalesce(before, 0) = 0 then 'fail' when mx is null then 'fail' when dist <= 1.5 then 'pass' when dist <= 3 then 'warn' else 'fail' end, dist, 1.5 from x
 union all select pk_id, 12, 'labels_present', case when label_kick_direction is not null then 'pass' when label_provenance like 'none%' then 'warn' else 'fail' end,
   (label_kick_direction is not null)::int + (label_goal is not null)::int + (label_footedness is not null)::int, 1 from x
 union all select pk_id, 13, 'scene_scale', case when flat then 'na' when scale >= 85 then 'pass' when scale >= 50 then 'warn' else 'fail' end, scale, 85 from x
 union all select pk_id, 14, 'goal_geometry', case when flat then 'na' when goal >= 0.6 then 'pass' when goal > 0 then 'warn' else 'fail' end, goal, 0.6 from x),
facts as (select * from q where status is not null)"""


def _checked(spark, d) -> DataFrame:
    return fusion.entity_checks(*canonical(spark, d, "metadata", "tracks", "poses", "ball", "geometry", "events", "snapshots"))


@named("entity_checks", f'with {_FACTS} select pk_id, check_ord, "check", status, round(value, 6) as value, threshold from facts')
def entity_checks(spark, d):
    return _checked(spark, d).withColumn("value", F.round("value", 6))


@named("entity_checks_by_source", f"""with {_FACTS} select source, "check", count(*) filter (where status = 'na') as n_na, count(*) filter (where status = 'pass') as n_pass, count(*) filter (where status = 'warn') as n_warn,
  count(*) filter (where status = 'fail') as n_fail from facts join metadata_ using (pk_id) group by 1, 2""")
def entity_checks_by_source(spark, d):
    return corpus.source_matrix(_checked(spark, d), *canonical(spark, d, "metadata"))


@named("corpus_report", f"""with {_FACTS},
us as (select * from metadata_ where is_primary and media_kind in ('video', 'pose_table')),
cn as (select count(*) filter (where not is_missing) as r, count(*) as n from events_ where event_name = 'ball_contact'),
s as (select offset_ms, count(*) filter (where snapshot_available) as a, count(*) as n from snapshots_ group by 1),
c as (select "check", count(*) filter (where status = 'na') as na, count(*) filter (where status = 'pass') as pass, count(*) filter (where status = 'warn') as warn, count(*) filter (where status = 'fail') as fail from facts group by 1),
t as (
 select 'corpus' as section, 'records' as key, count(*)::double as value from metadata_ union all select 'corpus', 'unique', count(*) from metadata_ where is_primary union all select 'corpus', 'usable', count(*) from us
 union all select 'label_coverage', 'label_kick_direction', count(label_kick_direction) / count(*) from us union all select 'label_coverage', 'label_goal', count(label_goal) / count(*) from us
 union all select 'label_coverage', 'label_footedness', count(label_footedness) / count(*) from us union all select 'label_coverage', 'label_camera_direction', count(label_camera_direction) / count(*) from us
 union all select 'sources', source || '/records', count(*) from metadata_ group by source union all select 'sources', source || '/unique', count(*) filter (where is_primary) from metadata_ group by source
 union all select 'contact', 'resolved', r from cn union all select 'contact', 'of', n from cn union all select 'contact', 'rate', r / n from cn
 union all select 'snapshots', offset_ms || '/available', a from s union all select 'snapshots', offset_ms || '/of', n from s union all select 'snapshots', offset_ms || '/rate', a / n from s
 union all select 'unavailable', unavailable_reason || '/n', count(*) from snapshots_ where not snapshot_available group by unavailable_reason
 union all select 'checks', "check" || '/na', na from c union all select 'checks', "check" || '/pass', pass from c union all select 'checks', "check" || '/warn', warn from c union all select 'checks', "check" || '/fail', fail from c
 union all select 'checks', "check" || '/rate', case when pass + warn + fail > 0 then pass / (pass + warn + fail) end from c)
select section, key, round(value, 9) as value from t""")
def corpus_report(spark, d):
    m, e, s = canonical(spark, d, "metadata", "events", "snapshots")
    return corpus.report(m, e, s, _checked(spark, d)).withColumn("value", F.round("value", 9))


@named("mirror_match", f"""with {_WITH}, r as (select o_custkey::varchar as source_identifier from orders), n as (select pk_id, count(*) as n_rows from poses_ where not is_missing group by 1)
select source_identifier, 'u:' || source_identifier as pk_id, coalesce(n_rows, 0) as n_rows, case when n_rows is null then 'no matching rows' else 'matched' end as status from r left join n on n.pk_id = 'u:' || source_identifier""")
def mirror_match(spark, d):
    renders = _t(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("source_identifier"))
    return corpus.mirror_match(renders, *canonical(spark, d, "poses"), "u")


# roles: persons are events, tracks their types' numbers, the anchor the middle of a user's frames
_PERSONS = f"select {_PK}, 't' || cast(event_id % 3 as string) as track_id, f as frame_idx, value as cx, value / 2 as cy, cast(50 + event_id % 60 as double) as h from {_E} e"
_STATS = f"""{_WITH}, persons as ({_PERSONS.format(events="events")}),
anchors as (select pk_id, frame_idx as anchor_frame from events_ where not is_missing),
fr as (select pk_id, count(distinct frame_idx) as fr from persons group by 1),
st as (select pk_id, track_id, count(*) as n, median(cx) as cx_med, median(cy) as cy_med, max(cx) - min(cx) as cx_span, max(cy) - min(cy) as cy_span, median(h) as h_med from persons group by 1, 2),
stats as (select st.*, sqrt(cx_span * cx_span + cy_span * cy_span) / greatest(h_med, 1.0) as travel from st join fr using (pk_id) where n >= greatest(3, cast(floor(fr * 0.08) as int)))"""


def _persons(spark, d) -> tuple[DataFrame, DataFrame, DataFrame]:
    p = spark.sql(_PERSONS, events=_t(spark, d, "events"))
    return p, roles.track_stats(p), canonical(spark, d, "events")[0].where("not is_missing").select("pk_id", F.col("frame_idx").alias("anchor_frame"))


@named("person_tracks", f"with {_STATS} select pk_id, track_id, n, cx_med, cy_med, cx_span, cy_span, h_med, round(travel, 6) as travel from stats")
def person_tracks(spark, d):
    return _persons(spark, d)[1].withColumn("travel", F.round("travel", 6))


_KEEPER = f"""{_STATS},
g as (select g.*, anchor_frame, (post_left_x + post_right_x) / 2 as gx, (crossbar_y + greatest(post_left_y, post_right_y)) / 2 as gy from geometry_ g left join anchors using (pk_id) where not is_missing),
gm as (select pk_id, median(goal_width_px) as gw, case when count(*) filter (where frame_idx <= anchor_frame) > 0 then median(gx) filter (where frame_idx <= anchor_frame) else median(gx) end as cx0,
  case when count(*) filter (where frame_idx <= anchor_frame) > 0 then median(gy) filter (where frame_idx <= anchor_frame) else median(gy) end as cy0 from g group by 1),
near as (select p.pk_id, p.track_id, median(sqrt((cx - cx0) * (cx - cx0) + (cy - cy0) * (cy - cy0)) / gw) as score from persons p join stats using (pk_id, track_id) join gm using (pk_id) left join anchors using (pk_id)
  where gw > 0 and (anchor_frame is null or frame_idx <= anchor_frame) group by 1, 2),
kn as (select pk_id, track_id from near qualify row_number() over (partition by pk_id order by score, track_id) = 1),
kr as (select pk_id, track_id from stats where pk_id not in (select pk_id from kn) qualify row_number() over (partition by pk_id order by cy_med, track_id) = 1),
keeper as (select * from kn union all select * from kr)"""


@named("keeper_pick", f"with {_KEEPER} select * from keeper")
def keeper_pick(spark, d):
    p, stats, anchors = _persons(spark, d)
    return roles.keeper(p, stats, roles.clip_geometry(*canonical(spark, d, "geometry"), anchors), anchors).select("pk_id", "track_id")


@named("kicker_pick", f"""with {_KEEPER},
free as (select s.* from stats s anti join keeper k on k.pk_id = s.pk_id and k.track_id = s.track_id),
last as (select b.pk_id, max(b.frame_idx) as bf, max(anchor_frame) as a from ball_ b join anchors using (pk_id) where b.frame_idx <= anchor_frame group by 1),
lb as (select l.pk_id, a, bf, max(x) as x, max(y) as y from last l join ball_ b on b.pk_id = l.pk_id and b.frame_idx = bf group by 1, 2, 3),
near2 as (select p.pk_id, p.track_id, min(sqrt((cx - x) * (cx - x) + (cy - y) * (cy - y))) as score from persons p join free using (pk_id, track_id) join lb using (pk_id) where frame_idx between a - 5 and a + 5 group by 1, 2),
n1 as (select pk_id, track_id from near2 qualify row_number() over (partition by pk_id order by score, track_id) = 1),
n2 as (select pk_id, track_id from free where pk_id not in (select pk_id from n1) qualify row_number() over (partition by pk_id order by travel desc, track_id) = 1)
select * from n1 union all select * from n2""")
def kicker_pick(spark, d):
    p, stats, anchors = _persons(spark, d)
    (geometry, ball) = canonical(spark, d, "geometry", "ball")
    ball = ball.groupBy("pk_id", "frame_idx").agg(F.max("x").alias("x"), F.max("y").alias("y"))
    keepers = roles.keeper(p, stats, roles.clip_geometry(geometry, anchors), anchors)
    return roles.kicker(p, stats, ball, anchors, keepers).select("pk_id", "track_id")
