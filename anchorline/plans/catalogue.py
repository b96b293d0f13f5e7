"""Named queries over the driver's tables, each with equivalent SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anchorline.functions import scalars as S
from anchorline.operators import anchor as A
from anchorline.operators import corpus as C
from anchorline.operators import kinematics as K
from anchorline.operators import series as R
from anchorline.operators import timeline as T
from anchorline.sources import readers

QUERIES: dict = {}
ORACLE: dict[str, str] = {}
HOUR = 3600.0 * 1000.0
LADDER = [h * HOUR for h in (-720, -480, -240, -120, -48, -12, 0)]


def named(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLE[name] = sql
        return f

    return keep


def _t(spark, d, name) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _aligned(spark, d) -> DataFrame:
    """Events with milliseconds from the user's latest purchase."""
    e = _t(spark, d, "events").select("user_id", "event_id", "event_type", "value", S.epoch_us(F.col("ts")).alias("us"))
    a = e.where("event_type = 'purchase'").groupBy("user_id").agg(F.max("us").alias("anchor_us"))
    return e.join(a, "user_id", "left").withColumn("t_ms", T.relative_ms(F.col("us"), F.col("anchor_us"), F.lit(1e6)))


_ALIGNED = """
e as (select user_id, event_id, event_type, value, epoch_us(ts) as us from events),
a as (select user_id, max(us) as anchor_us from e where event_type = 'purchase' group by user_id),
al as (select e.*, anchor_us, (us - anchor_us) / 1000000.0::double * 1000.0::double as t_ms from e left join a using (user_id))"""


@named("anchor_align", f"with {_ALIGNED} select user_id, event_id, t_ms from al")
def anchor_align(spark, d):
    return _aligned(spark, d).select("user_id", "event_id", "t_ms")


_OFFS = ", ".join(f"({o}::double)" for o in LADDER)
_SNAP = f"""{_ALIGNED},
f as (select user_id, t_ms as t, value, event_id from al where t_ms is not null),
o(o) as (values {_OFFS}),
u as (select distinct user_id from events),
g as (select user_id, o, min(t) as first_t, max(t) as end_t, max(t) filter (where t < o) as lo, min(t) filter (where t >= o) as hi from f cross join o group by user_id, o),
s as (select u.user_id, o.o, first_t, end_t, lo, hi, case when hi is null or (lo is not null and o.o - lo <= hi - o.o) then lo else hi end as near from u cross join o left join g on g.user_id = u.user_id and g.o = o.o),
r as (select *, abs(near - o) as gap, case when first_t is null then 'no_anchored_frames' when o < first_t - {HOUR} then 'before_clip_start' when o > end_t + {HOUR} then 'after_clip_end'
  when abs(near - o) <= {HOUR} then null when lo is null or hi is null or hi - lo > {12 * HOUR} then 'gap_exceeds_interpolation_limit' end as reason from s),
x as (select r.*, case when reason is not null then 'unavailable' when gap <= {HOUR} then 'exact' else 'interp' end as method, (o - lo) / (hi - lo) as w from r),
snap as (select x.user_id, x.o as off_ms, reason is null as snapshot_available, method as snapshot_method,
  case when coalesce(reason, '') in ('', 'gap_exceeds_interpolation_limit') then gap end as gap_ms, reason as unavailable_reason,
  case method when 'exact' then case when near is not distinct from lo then l.value else h.value end when 'interp' then l.value * (1.0 - w) + h.value * w end as value,
  case method when 'exact' then case when near is not distinct from lo then l.event_id else h.event_id end when 'interp' then l.event_id end::double as event_id
  from x left join f l on l.user_id = x.user_id and l.t = x.lo left join f h on h.user_id = x.user_id and h.t = x.hi)"""


@named("anchor_snapshots", f"with {_SNAP} select * from snap")
def anchor_snapshots(spark, d):
    frames = _aligned(spark, d).where("t_ms is not null")
    users = _t(spark, d, "events").select("user_id").distinct()
    out = T.snapshots(frames, users, LADDER, "user_id", "t_ms", ["value"], [], ["event_id"], HOUR, 12 * HOUR)
    return out.select("user_id", F.col("off").alias("off_ms"), "snapshot_available", "snapshot_method", "gap_ms", "unavailable_reason", "value", F.col("event_id").cast("double").alias("event_id"))


@named("snapshot_availability", f"with {_SNAP} select off_ms, count(*) as n, count(*) filter (where snapshot_available) as n_available, (count(*) filter (where snapshot_available))::double / count(*) as share from snap group by off_ms")
def snapshot_availability(spark, d):
    s = anchor_snapshots(spark, d).groupBy("off_ms").agg(F.count("*").alias("n"), F.count_if("snapshot_available").alias("n_available"))
    return s.withColumn("share", F.col("n_available") / F.col("n"))


@named("unavailable_reasons", f"with {_SNAP} select unavailable_reason, count(*) as n from snap where not snapshot_available group by unavailable_reason")
def unavailable_reasons(spark, d):
    return anchor_snapshots(spark, d).where("not snapshot_available").groupBy("unavailable_reason").agg(F.count("*").alias("n"))


@named("central_velocity", """
with e as (select user_id, event_id, value as x, epoch_us(ts) / 1000000.0::double as t, row_number() over w as n, count(*) over (partition by user_id) as c,
  lag(value) over w as px, lead(value) over w as nx, lag(epoch_us(ts) / 1000000.0::double) over w as pt, lead(epoch_us(ts) / 1000000.0::double) over w as nt from events window w as (partition by user_id order by epoch_us(ts) / 1000000.0::double)),
v as (select *, case when n = 1 then x else px end x0, case when n = c then x else nx end x1, case when n = 1 then t else pt end t0, case when n = c then t else nt end t1 from e)
select user_id, event_id, case when c > 1 and t1 - t0 > 0 then (x1 - x0) / (t1 - t0) end as velocity from v""")
def central_velocity(spark, d):
    e = _t(spark, d, "events").withColumn("t", S.epoch_us(F.col("ts")) / F.lit(1000000.0))
    return e.select("user_id", "event_id", K.central_difference("value", "t", ["user_id"], "t").alias("velocity"))


@named("backward_velocity", "select user_id, event_type, event_id, (value - lag(value) over (partition by user_id, event_type order by ts)) / (1.0::double / 25.0::double) as velocity from events")
def backward_velocity(spark, d):
    e = _t(spark, d, "events")
    return e.select("user_id", "event_type", "event_id", K.backward_difference("value", ["user_id", "event_type"], "ts", F.lit(25.0)).alias("velocity"))


@named("fuse_roles", """
with h as (select user_id, event_type, event_id, value, epoch_us(ts) // 3600000000 as hour, row_number() over (partition by user_id, event_type, epoch_us(ts) // 3600000000 order by event_id desc) as rn from events),
k as (select * from h where rn = 1)
select v.user_id, v.hour, v.value as view_value, c.value as click_value, c.user_id is not null as click_available, e.value as error_value, e.user_id is not null as error_available, sqrt((c.value - v.value) * (c.value - v.value)) as click_distance
from k v left join k c on c.user_id = v.user_id and c.hour = v.hour and c.event_type = 'click' left join k e on e.user_id = v.user_id and e.hour = v.hour and e.event_type = 'error' where v.event_type = 'view'""")
def fuse_roles(spark, d):
    e = _t(spark, d, "events").withColumn("hour", F.floor(S.epoch_us(F.col("ts")) / 3600000000))
    last = T.keep_last(e, ["user_id", "event_type", "hour"], "event_id")
    role = lambda n: last.where(F.col("event_type") == n).select("user_id", "hour", F.col("value").alias(f"{n}_value"))
    out = T.fuse(role("view"), {"click": role("click"), "error": role("error")}, ["user_id", "hour"])
    diff = F.col("click_value") - F.col("view_value")
    return out.withColumn("click_distance", S.distance(diff, F.lit(0.0)))


@named("identity_collapse", f"""
with {_ALIGNED}, p as (select user_id, event_type, count(*) n, min(event_id) met, min(case when abs(t_ms) < 1e-6 then event_id end) hit from al group by user_id, event_type),
c as (select *, row_number() over (partition by user_id order by hit nulls last, n desc, met) rn from p)
select al.user_id, al.event_type, event_id from al join c on c.user_id = al.user_id and c.event_type = al.event_type and rn = 1""")
def identity_collapse(spark, d):
    return T.collapse_identity(_aligned(spark, d), "user_id", "event_type", "t_ms", "event_id").select("user_id", "event_type", "event_id")


def _points(spark, d) -> DataFrame:
    e = _t(spark, d, "embeddings")
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    rows = F.array(*[F.struct(F.lit(k).alias("kp"), at(k).alias("x"), at(k + 16).alias("y")) for k in range(5, 17)])
    return e.select("vec_id", "label", F.explode(rows).alias("p")).select("vec_id", "label", "p.kp", "p.x", "p.y")


@named("pose_pivot", "select vec_id, " + ", ".join(f"embedding[{k + 1}]::double as x_{k}, embedding[{k + 17}]::double as y_{k}" for k in range(5, 17)) + " from embeddings where embedding is not null")
def pose_pivot(spark, d):
    return K.pivot_keypoints(_points(spark, d), ["vec_id"], "kp", range(5, 17), "kp")


_ANGLE = "case when ({dy}) = 0 and ({dx}) < 0 then -180.0 else degrees(atan2(-({dy}), {dx})) end"


def _kp(k):
    return f"embedding[{k + 1}]::double", f"embedding[{k + 17}]::double"


(_lsx, _lsy), (_rsx, _rsy), (_lhx, _lhy), (_rhx, _rhy), (_lax, _lay), (_rax, _ray) = (_kp(k) for k in (5, 6, 11, 12, 15, 16))


@named("pose_features", f"""
with p as (select vec_id, label % 3 as foot, {_ANGLE.format(dx=f"{_rhx} - {_lhx}", dy=f"{_rhy} - {_lhy}")} as pelvis, {_ANGLE.format(dx=f"{_rsx} - {_lsx}", dy=f"{_rsy} - {_lsy}")} as shoulder,
 degrees(atan2(({_lsx} + {_rsx}) / 2 - ({_lhx} + {_rhx}) / 2, -(({_lsy} + {_rsy}) / 2 - ({_lhy} + {_rhy}) / 2))) as lean, sqrt(({_lax} - {_rax}) * ({_lax} - {_rax}) + ({_lay} - {_ray}) * ({_lay} - {_ray})) as sep,
 {_lax} as lax, {_rax} as rax from embeddings)
select vec_id, round(pelvis, 6) as pelvis_deg, round(shoulder, 6) as shoulder_deg, round((shoulder - pelvis + 180) - 360 * floor((shoulder - pelvis + 180) / 360) - 180, 6) as hip_shoulder_deg, round(lean, 6) as torso_lean_deg,
 round(sep, 9) as ankle_separation, case foot when 0 then rax when 1 then lax end as kick_ankle_x from p""")
def pose_features(spark, d):
    wide = K.pivot_keypoints(_points(spark, d), ["vec_id", "label"], "kp", range(5, 17), "kp")
    names = {"l_shoulder": 5, "r_shoulder": 6, "l_hip": 11, "r_hip": 12, "l_ankle": 15, "r_ankle": 16}
    kp = {n: (F.col(f"x_{i}"), F.col(f"y_{i}")) for n, i in names.items()}
    foot = F.when(F.col("label") % 3 == 0, "R").when(F.col("label") % 3 == 1, "L")
    f = K.pose_features(foot, kp)
    out = [F.round(f[c], 6).alias(c) for c in ("pelvis_deg", "shoulder_deg", "hip_shoulder_deg", "torso_lean_deg")]
    return wide.select("vec_id", *out, F.round(f["ankle_separation"], 9).alias("ankle_separation"), f["kick_ankle_x"].alias("kick_ankle_x"))


def _elected(spark, d) -> DataFrame:
    docs = _t(spark, d, "documents")
    lab = _t(spark, d, "labels").select("doc_id", F.lit(True).alias("labelled"))
    key = F.sha1(F.lower(F.regexp_replace(F.trim("text"), "[ \t\n\r]+", " ")).cast("binary"))
    x = docs.join(lab, "doc_id", "left").select("doc_id", "source", "n_chars", F.coalesce("labelled", F.lit(False)).cast("int").alias("labelled"), key.alias("dedup_key"))
    return C.elect_primary(x, "dedup_key", "doc_id", [F.col("labelled"), F.coalesce("n_chars", F.lit(0)), F.col("source")], "doc_id")


_ELECTED = r"""x as (select d.doc_id, source, n_chars, (l.doc_id is not null)::int as labelled, sha1(lower(regexp_replace(trim(text), '[ \t\n\r]+', ' ', 'g'))) as dedup_key from documents d left join labels l on l.doc_id = d.doc_id),
el as (select *, row_number() over w as rn, first_value(doc_id) over w as top from x window w as (partition by dedup_key order by labelled desc, coalesce(n_chars, 0) desc, source desc, doc_id))"""


@named("dedup_primary", f"with {_ELECTED} select doc_id, dedup_key, rn = 1 as is_primary, case when rn > 1 then top end::double as duplicate_of from el")
def dedup_primary(spark, d):
    return _elected(spark, d).select("doc_id", "dedup_key", "is_primary", F.col("duplicate_of").cast("double").alias("duplicate_of"))


@named("dedup_report", f'with {_ELECTED} select dedup_key, doc_id as duplicate, top as "primary" from el where rn > 1')
def dedup_report(spark, d):
    return C.duplicate_report(_elected(spark, d), "dedup_key", "doc_id")


@named("dedup_summary", f"with {_ELECTED} select source, count(*) as records, count(*) filter (where rn = 1) as primary_records, count(*) filter (where rn > 1) as duplicates from el group by source")
def dedup_summary(spark, d):
    return C.duplicate_summary(_elected(spark, d), "source")


@named("id_normalise", r"""
with p as (select c_custkey, trim(c_name) as t, list_filter(regexp_split_to_array(trim(c_name), '[-_./ ]+'), lambda x: x <> '') as parts from customer),
n as (select c_custkey, t, array_to_string(list_transform(parts, lambda x: case when regexp_full_match(x, '[0-9]+') then case when ltrim(x, '0') = '' then '0' else ltrim(x, '0') end else lower(x) end), '-') as j from p)
select c_custkey, case when j = '' then lower(t) else j end as norm, 'cust:' || case when j = '' then lower(t) else j end as entity_id, substr(sha1('cust:' || case when j = '' then lower(t) else j end), 1, 16) as uid, regexp_replace(regexp_replace(lower(t), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as slug from n""")
def id_normalise(spark, d):
    c = _t(spark, d, "customer")
    eid = S.entity_id(F.lit("cust"), F.col("c_name"))
    return c.select("c_custkey", S.normalise_identifier(F.col("c_name")).alias("norm"), eid.alias("entity_id"), S.entity_uid(eid).alias("uid"), S.slugify(F.col("c_name")).alias("slug"))


@named("upsert_orders", """
with n as (select o_orderkey, 'new' as state, o_totalprice * 2 as price from orders where o_orderstatus = 'F'), o as (select o_orderkey, 'old' as state, o_totalprice as price from orders)
select * from o where o_orderkey not in (select o_orderkey from n) union all select * from n""")
def upsert_orders(spark, d):
    o = _t(spark, d, "orders")
    old = o.select("o_orderkey", F.lit("old").alias("state"), F.col("o_totalprice").alias("price"))
    new = o.where("o_orderstatus = 'F'").select("o_orderkey", F.lit("new").alias("state"), (F.col("o_totalprice") * 2).alias("price"))
    return C.upsert(old, new, ["o_orderkey"])


@named("licence_filter", "select doc_id, lang, source from documents where doc_id in (select doc_id from labels where quality = 1 and toxic = 0)")
def licence_filter(spark, d):
    return C.publishable(_t(spark, d, "documents").select("doc_id", "lang", "source"), _t(spark, d, "labels").where("quality = 1 and toxic = 0"), "doc_id")


@named("licence_withheld", "select source, count(*) as rows_withheld, 'licence' as reason from documents where doc_id not in (select doc_id from labels where quality = 1 and toxic = 0) group by source")
def licence_withheld(spark, d):
    w = C.withheld(_t(spark, d, "documents").select("doc_id", "source"), _t(spark, d, "labels").where("quality = 1 and toxic = 0"), "doc_id")
    return w.groupBy("source", "reason").agg(F.count("*").alias("rows_withheld"))


_CHECKS = f"""{_SNAP},
b as (select user_id, count(*) as n, count(*) filter (where event_type = 'purchase') as buys, count(distinct event_type) as types, count(*) filter (where event_type <> 'error') as good, count(*) filter (where t_ms between {-240 * HOUR} and 0) as seen from al group by user_id),
v as (select user_id, (count(*) filter (where snapshot_available))::double / count(*) as share from snap group by user_id),
q as (
 select user_id, 1 as check_ord, 'anchor' as "check", case when buys = 0 then 'fail' when buys > 1 then 'warn' else 'pass' end as status, buys::double as value, 1.0::double as threshold from b union all
 select user_id, 2, 'coverage', case when seen = 0 then 'fail' when seen >= 20 then 'pass' else 'warn' end, seen::double, 20.0 from b union all
 select user_id, 3, 'single_identity', case when types <= 1 then 'pass' else 'warn' end, types::double, 1.0 from b union all
 select user_id, 4, 'completeness', case when good::double / n >= 0.9 then 'pass' when good::double / n >= 0.7 then 'warn' else 'fail' end, good::double / n, 0.7 from b union all
 select user_id, 5, 'min_frames', case when n >= 60 then 'pass' else 'fail' end, n::double, 60.0 from b union all
 select user_id, 6, 'snapshot_coverage', case when share is null then 'na' when share >= 0.5 then 'pass' else 'warn' end, share, 0.5 from b left join v using (user_id))"""


def _facts(spark, d) -> DataFrame:
    al = _aligned(spark, d)
    b = al.groupBy("user_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == "purchase").alias("buys"), F.count_distinct("event_type").alias("types"),
        F.count_if(F.col("event_type") != "error").alias("good"), F.count_if(F.col("t_ms").between(-240 * HOUR, 0.0)).alias("seen"),
    )
    v = anchor_snapshots(spark, d).groupBy("user_id").agg((F.count_if("snapshot_available") / F.count("*")).alias("share"))
    x = b.join(v, "user_id", "left").withColumn("frac", F.col("good") / F.col("n"))
    c = F.col
    rows = [
        ("anchor", F.when(c("buys") == 0, "fail").when(c("buys") > 1, "warn").otherwise("pass"), c("buys"), 1.0),
        ("coverage", F.when(c("seen") == 0, "fail").when(c("seen") >= 20, "pass").otherwise("warn"), c("seen"), 20.0),
        ("single_identity", F.when(c("types") <= 1, "pass").otherwise("warn"), c("types"), 1.0),
        ("completeness", F.when(c("frac") >= 0.9, "pass").when(c("frac") >= 0.7, "warn").otherwise("fail"), c("frac"), 0.7),
        ("min_frames", F.when(c("n") >= 60, "pass").otherwise("fail"), c("n"), 60.0),
        ("snapshot_coverage", F.when(c("share").isNull(), "na").when(c("share") >= 0.5, "pass").otherwise("warn"), c("share"), 0.5),
    ]
    facts = F.array(*[F.struct(F.lit(i).alias("check_ord"), F.lit(n).alias("check"), s.alias("status"), v.cast("double").alias("value"), F.lit(t).alias("threshold")) for i, (n, s, v, t) in enumerate(rows, 1)])
    return x.select("user_id", F.explode(facts).alias("f")).select("user_id", "f.*")


@named("qc_checks", f"with {_CHECKS} select * from q")
def qc_checks(spark, d):
    return _facts(spark, d)


_ROLLED = f"""{_CHECKS}, ro as (select user_id, max(case status when 'na' then 0 when 'pass' then 1 when 'warn' then 2 else 3 end) as r, string_agg("check" || ':' || status, '; ' order by check_ord) filter (where status in ('warn', 'fail')) as qc_reasons from q group by user_id)"""


@named("qc_rollup", f"with {_ROLLED} select user_id, ['na', 'pass', 'warn', 'fail'][r + 1] as qc_status, qc_reasons from ro")
def qc_rollup(spark, d):
    return C.roll_up(_facts(spark, d), "user_id")


@named("qc_summary", f"""with {_CHECKS} select "check", count(*) filter (where status = 'na') as n_na, count(*) filter (where status = 'pass') as n_pass, count(*) filter (where status = 'warn') as n_warn, count(*) filter (where status = 'fail') as n_fail,
 (count(*) filter (where status = 'pass'))::double / nullif(count(*) filter (where status <> 'na'), 0) as success_rate from q group by "check" """)
def qc_summary(spark, d):
    return C.check_summary(_facts(spark, d))


@named("worst_first", f"with {_ROLLED} select user_id, ['na', 'pass', 'warn', 'fail'][r + 1] as qc_status from ro order by case r when 3 then 0 when 2 then 1 when 1 then 3 else 2 end, user_id limit 20")
def worst_first(spark, d):
    return C.worst_first(C.roll_up(_facts(spark, d), "user_id"), 20, "user_id").select("user_id", "qc_status")


@named("label_coverage", "select source, count(*) as records, count(l.doc_id) as labelled, count(l.doc_id)::double / count(*) as coverage from documents d left join labels l on l.doc_id = d.doc_id group by source")
def label_coverage(spark, d):
    x = _t(spark, d, "documents").select("doc_id", "source").join(_t(spark, d, "labels").select("doc_id", F.lit(1).alias("has")), "doc_id", "left")
    return x.groupBy("source").agg(F.count("*").alias("records"), F.count("has").alias("labelled"), (F.count("has") / F.count("*")).alias("coverage"))


@named("corpus_counts", f"with {_ELECTED} select count(*) as records, count(*) filter (where rn = 1) as primary_records, count(distinct source) as sources, sum(labelled)::bigint as labelled from el")
def corpus_counts(spark, d):
    return _elected(spark, d).agg(F.count("*").alias("records"), F.count_if("is_primary").alias("primary_records"), F.count_distinct("source").alias("sources"), F.sum("labelled").alias("labelled"))


@named("stationary_departure", """
with e as (select user_id, event_type, event_id, value, row_number() over (partition by user_id, event_type order by event_id) rn, count(*) over (partition by user_id, event_type) n from events),
s as (select user_id, event_type, median(case when rn <= greatest(n // 2, 3) then value end) spot from e group by 1, 2),
j as (select e.*, spot, sqrt((value - spot) * (value - spot)) <= 60.0 as near from e join s using (user_id, event_type)),
r as (select user_id, event_type, coalesce(min(case when not near then rn end) - 1, max(n)) run, max(n) n, max(spot) spot, min(case when not near then event_id end) gone, max(event_id) fin from j group by 1, 2),
b as (select *, row_number() over (partition by user_id order by run desc, event_type) k from r where n >= 2 and run >= 2)
select user_id, event_type, case when run < n then gone else fin + 1 end as anchor_frame, run, spot as spot_x, case when run < n then greatest(0.3, least(0.9, run / 4.0::double)) else 0.45 end::double as confidence, case when run < n then 'departure_observed' else 'ends_on_spot' end as method from b where k = 1""")
def stationary_departure(spark, d):
    e = _t(spark, d, "events").withColumn("zero", F.lit(0.0))
    out = A.stationary_departure(e, "user_id", "event_type", "event_id", "value", "zero", F.lit(60.0), F.lit(2))
    return out.select("user_id", "event_type", "anchor_frame", F.col("run").cast("long").alias("run"), "spot_x", F.col("confidence").cast("double").alias("confidence"), "method")


@named("commit_first_exceed", f"with {_ALIGNED} select user_id, count(*) as n_rows, min(event_id) filter (where abs(value) > 150.0)::double as anchor_frame from al where t_ms between {-48 * HOUR} and {24 * HOUR} group by user_id")
def commit_first_exceed(spark, d):
    band = _aligned(spark, d).where(F.col("t_ms").between(-48 * HOUR, 24 * HOUR))
    return A.first_exceedance(band, "user_id", "event_id", F.col("value"), 150.0).withColumn("anchor_frame", F.col("anchor_frame").cast("double"))


_ROLES = "m as (select l_partkey, l_suppkey, median(abs(l_extendedprice / l_quantity - p_retailprice)) as dist from lineitem join part on p_partkey = l_partkey group by 1, 2), k as (select *, row_number() over (partition by l_partkey order by dist, l_suppkey) rn from m)"


def _roles(spark, d):
    x = _t(spark, d, "lineitem").select("l_partkey", "l_suppkey", "l_extendedprice", "l_quantity").join(_t(spark, d, "part").select(F.col("p_partkey").alias("l_partkey"), "p_retailprice"), "l_partkey")
    return x.groupBy("l_partkey", "l_suppkey").agg(F.median(F.abs(F.col("l_extendedprice") / F.col("l_quantity") - F.col("p_retailprice"))).alias("dist"))


@named("role_assignment", f"with {_ROLES} select l_partkey, l_suppkey, dist as score from k where rn = 1")
def role_assignment(spark, d):
    return R.separation(_roles(spark, d), "l_partkey", "dist", "l_suppkey").select("l_partkey", "l_suppkey", "score")


@named("separation_confidence", f"with {_ROLES}, p as (select l_partkey, max(dist) filter (where rn = 1) b, max(dist) filter (where rn = 2) s from k group by 1) select l_partkey, (case when s is null then 0.3 else greatest(0.1, least(0.95, abs(s - b) / greatest(abs(s), 1e-6))) end)::double as confidence from p")
def separation_confidence(spark, d):
    return R.separation(_roles(spark, d), "l_partkey", "dist", "l_suppkey").select("l_partkey", F.col("confidence").cast("double").alias("confidence"))


_DAILY = """e as (select user_id, epoch_us(ts) // 86400000000 as day, max(value) as v, min(value) as c from events group by 1, 2),
r as (select user_id, min(day) a, max(day) b from e group by 1), g as (select user_id, unnest(range(a, b + 1)) as day from r),
s as (select g.user_id, g.day, v, c from g left join e on e.user_id = g.user_id and e.day = g.day)"""


def _daily(spark, d) -> DataFrame:
    e = _t(spark, d, "events").withColumn("day", F.floor(S.epoch_us(F.col("ts")) / 86400000000)).groupBy("user_id", "day").agg(F.max("value").alias("v"), F.min("value").alias("c"))
    g = e.groupBy("user_id").agg(F.min("day").alias("a"), F.max("day").alias("b")).select("user_id", F.explode(F.sequence("a", "b")).alias("day"))
    return g.join(e, ["user_id", "day"], "left")


@named("consensus_reject", f"""with {_DAILY}, w as (select *, count(v) over p n, median(v) over p mw, median(c) over p mc from s window p as (partition by user_id)),
x as (select *, v is not null and n >= 5 and (v not between 0.6 * mw and 1.5 * mw or abs(c - mc) > 0.75 * mw) as bad from w)
select user_id, day, case when not bad then v end as v, case when not bad then c end as c, case when bad then 'inconsistent_with_consensus' end as missing_reason from x""")
def consensus_reject(spark, d):
    return R.consensus_reject(_daily(spark, d), "user_id", "v", "c", ["v", "c"])


@named("gap_fill_bounded", f"""with {_DAILY}, i as (select *, row_number() over (partition by user_id order by day) i from s),
n as (select *, max(case when v is not null then i end) over (partition by user_id order by i) bi, min(case when v is not null then i end) over (partition by user_id order by i rows between current row and unbounded following) ai from i),
f as (select n.*, b.v bv, a.v av from n left join i b on b.user_id = n.user_id and b.i = n.bi left join i a on a.user_id = n.user_id and a.i = n.ai)
select user_id, day, case when v is null and ai - bi <= 2 then bv * (1.0 - (i - bi) / (ai - bi)::double) + av * ((i - bi) / (ai - bi)::double) else v end as v, v is null and coalesce(ai - bi <= 2, false) as filled from f""")
def gap_fill_bounded(spark, d):
    return R.gap_fill(_daily(spark, d).select("user_id", "day", "v"), "user_id", "day", ["v"], 2)


@named("iou_match", """
with b as (select p_partkey, p_partkey % 50 as f, (p_size)::double x1, (p_retailprice / 100)::double y1, (p_size + 10)::double x2, (p_retailprice / 100 + 5)::double y2 from part),
s as (select s_suppkey, s_suppkey % 50 as f, (s_nationkey * 2)::double x1, (s_acctbal / 500)::double y1, (s_nationkey * 2 + 12)::double x2, (s_acctbal / 500 + 6)::double y2 from supplier),
m as (select p_partkey, s_suppkey, greatest(0.0::double, least(b.x2, s.x2) - greatest(b.x1, s.x1)) * greatest(0.0::double, least(b.y2, s.y2) - greatest(b.y1, s.y1)) as i, (b.x2 - b.x1) * (b.y2 - b.y1) a, (s.x2 - s.x1) * (s.y2 - s.y1) c from b join s using (f)),
k as (select *, i / (a + c - i) as score, row_number() over (partition by p_partkey order by i / (a + c - i) desc, s_suppkey) rn from m where i / (a + c - i) >= 0.1)
select p_partkey, s_suppkey, score from k where rn = 1""")
def iou_match(spark, d):
    c = F.col
    p = _t(spark, d, "part").select("p_partkey", (c("p_partkey") % 50).alias("f"), c("p_size").cast("double").alias("ax1"), (c("p_retailprice") / 100).alias("ay1"), (c("p_size") + 10).cast("double").alias("ax2"), (c("p_retailprice") / 100 + 5).alias("ay2"))
    s = _t(spark, d, "supplier").select("s_suppkey", (c("s_suppkey") % 50).alias("f"), (c("s_nationkey") * 2).cast("double").alias("bx1"), (c("s_acctbal") / 500).alias("by1"), (c("s_nationkey") * 2 + 12).cast("double").alias("bx2"), (c("s_acctbal") / 500 + 6).alias("by2"))
    return R.best_overlap(p, s, ["f"], "p_partkey", "s_suppkey", ["ax1", "ay1", "ax2", "ay2"], ["bx1", "by1", "bx2", "by2"], 0.1)


@named("point_in_quad", """
with p as (select vec_id, embedding[1]::double x, embedding[2]::double y, 0.05 * (label + 1) as h from embeddings),
c as (select vec_id, (2 * h) * (y + h) - 0 * (x + h) c1, 0 * (y + h) - (2 * h) * (x - h) c2, (-2 * h) * (y - h) - 0 * (x - h) c3, 0 * (y - h) - (-2 * h) * (x + h) c4 from p)
select vec_id, (c1 >= 0 and c2 >= 0 and c3 >= 0 and c4 >= 0) or (c1 <= 0 and c2 <= 0 and c3 <= 0 and c4 <= 0) as inside from c""")
def point_in_quad(spark, d):
    e = _t(spark, d, "embeddings").withColumn("h", F.lit(0.05) * (F.col("label") + 1))
    h = F.col("h")
    quad = [(-h, -h), (h, -h), (h, h), (-h, h)]
    at = lambda i: F.get("embedding", F.lit(i)).cast("double")
    return e.select("vec_id", S.in_quad(at(0), at(1), quad).alias("inside"))


@named("token_filter", "select p_partkey, p_type from part where list_contains(regexp_split_to_array(trim(p_type), '\\s+'), 'BRASS') or list_contains(regexp_split_to_array(trim(p_type), '\\s+'), 'SMALL')")
def token_filter(spark, d):
    return _t(spark, d, "part").where(S.has_token(F.col("p_type"), "BRASS") | S.has_token(F.col("p_type"), "SMALL")).select("p_partkey", "p_type")


@named("crosswalk_enrich", """
with x as (select n_nationkey % 20 as k, n_name || ';' || r_name as target, row_number() over (partition by n_nationkey % 20 order by n_nationkey desc) rn from nation join region on r_regionkey = n_regionkey)
select c_custkey, case when target is not null then 'cust;' || target else 'cust' end as provenance, target is not null as mapped from customer left join x on k = c_nationkey and rn = 1""")
def crosswalk_enrich(spark, d):
    n = _t(spark, d, "nation").join(_t(spark, d, "region"), F.col("r_regionkey") == F.col("n_regionkey"))
    walk = n.select((F.col("n_nationkey") % 20).cast("string").alias("name"), F.concat_ws(";", "n_name", "r_name").alias("target"), F.col("n_nationkey").alias("ord"))
    c = readers.crosswalk(_t(spark, d, "customer").select("c_custkey", "c_nationkey"), walk, F.concat(F.col("c_nationkey").cast("string"), F.lit(".mkv")))
    return c.select("c_custkey", F.concat_ws(";", F.lit("cust"), "target").alias("provenance"), F.col("target").isNotNull().alias("mapped"))


@named("candidate_ladder", """
select page_id, case when regexp_matches(url, '(?i)example\\.org') then 'other_sport' when length(html) < 1000 then 'too_narrow' when length(html) > 3000 then 'too_long' when url not like 'https%' then 'no_licence' end as excluded from pages""")
def candidate_ladder(spark, d):
    n = F.length("html")
    why = readers.exclusion(F.col("url").rlike(r"(?i)example\.org"), n, n, F.when(F.col("url").like("https%"), F.col("url")), narrow=1000, long=3000)
    return _t(spark, d, "pages").select("page_id", why.alias("excluded"))


@named("json_annotations", "select event_id, (props->>'$.k')::bigint as k from events where event_type = 'click'")
def json_annotations(spark, d):
    e = _t(spark, d, "events").where("event_type = 'click'")
    return e.select("event_id", readers.parsed(F.col("props"), "k long")["k"].alias("k"))


@named("hms_seconds", """
with f as (select event_id, case when event_id % 7 = 0 then 'bad' when event_id % 11 = 0 then '1:2' else strftime(ts, '%H:%M:%S') end as t from events)
select event_id, case when len(string_split(t, ':')) = 3 then string_split(t, ':')[1]::int * 3600 + string_split(t, ':')[2]::int * 60 + string_split(t, ':')[3]::double end::double as seconds from f""")
def hms_seconds(spark, d):
    e = _t(spark, d, "events")
    t = F.when(F.col("event_id") % 7 == 0, "bad").when(F.col("event_id") % 11 == 0, "1:2").otherwise(F.date_format("ts", "HH:mm:ss"))
    return e.select("event_id", S.hms_seconds(t).cast("double").alias("seconds"))


@named("track_stats", "select user_id, event_type, count(*) as n, min(event_id) as first_frame, max(event_id) as last_frame, median(value) as med, max(value) - min(value) as span, round(quantile_cont(value, 0.9), 6) as p90 from events group by 1, 2")
def track_stats(spark, d):
    v = F.col("value")
    return _t(spark, d, "events").groupBy("user_id", "event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_frame"), F.max("event_id").alias("last_frame"), F.median(v).alias("med"), (F.max(v) - F.min(v)).alias("span"), F.round(F.percentile(v, F.lit(0.9)), 6).alias("p90"))


@named("modal_track", "select user_id, event_type, n from (select user_id, event_type, count(*) as n, row_number() over (partition by user_id order by count(*) desc, event_type) rn from events group by 1, 2) where rn = 1")
def modal_track(spark, d):
    return R.modal(_t(spark, d, "events"), "user_id", "event_type")


@named("middle_row", "select conv_id, turn, role from (select *, row_number() over (partition by conv_id order by turn, role, text) rn, count(*) over (partition by conv_id) n from conversations) where rn = n // 2 + 1")
def middle_row(spark, d):
    c = _t(spark, d, "conversations").withColumn("ord", F.struct("turn", "role", "text"))
    return R.middle_row(c, "conv_id", "ord").select("conv_id", "turn", "role")


_PIX = "a as (select vec_id, label, floor(embedding[1] * 400)::bigint x, floor(embedding[2] * 400)::bigint y from embeddings where vec_id % 2 = 0), b as (select label, floor(embedding[3] * 400)::bigint x, floor(embedding[4] * 400)::bigint y from embeddings where vec_id % 2 = 1)"


@named("hit_rate", f"with {_PIX}, h as (select vec_id, label, exists (select 1 from b where b.label = a.label and abs(a.x - b.x) <= 6 and abs(a.y - b.y) <= 6) as hit from a) select label::bigint as label, count(*) filter (where hit) as hits, count(*) as n, (count(*) filter (where hit))::double / count(*) as rate from h group by label")
def hit_rate(spark, d):
    e = _t(spark, d, "embeddings")
    px = lambda i: F.floor(F.get("embedding", F.lit(i)) * F.lit(400).cast("float"))
    a = e.where("vec_id % 2 = 0").select("vec_id", F.col("label").cast("long").alias("label"), px(0).alias("x"), px(1).alias("y"))
    b = e.where("vec_id % 2 = 1").select(F.col("label").cast("long").alias("label"), px(2).alias("x"), px(3).alias("y"))
    hits = R.near_hits(a, b, ["label"], 6, "vec_id").groupBy("label").agg(F.count("*").alias("hits"))
    n = a.groupBy("label").agg(F.count("*").alias("n"))
    return n.join(hits, "label", "left").select("label", F.coalesce("hits", F.lit(0)).cast("long").alias("hits"), "n", (F.coalesce("hits", F.lit(0)) / F.col("n")).alias("rate"))


@named("resume_anti", "select o_orderkey from orders where o_orderkey not in (select l_orderkey from lineitem)")
def resume_anti(spark, d):
    return C.not_yet(_t(spark, d, "orders").select("o_orderkey"), _t(spark, d, "lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@named("first_wins_union", "with u as (select o_custkey as k, 1 as term, o_orderkey from orders where o_orderpriority like '1%' union all select o_custkey, 2, o_orderkey from orders where o_orderpriority like '2%'), r as (select *, row_number() over (partition by k order by term, o_orderkey) rn from u) select k, term, o_orderkey from r where rn = 1")
def first_wins_union(spark, d):
    o = _t(spark, d, "orders")
    return readers.union_first([o.where(F.col("o_orderpriority").startswith(str(i))).select(F.col("o_custkey").alias("k"), F.lit(i).alias("term"), "o_orderkey") for i in (1, 2)], "k")


@named("marker_resolution", """
select user_id, count(*) filter (where event_type = 'purchase') as n_markers, max(event_id) filter (where event_type = 'purchase') as anchor_frame, count(distinct event_type) as n_tracks,
 (case when count(*) filter (where event_type = 'purchase') = 1 then 1.0 when count(*) filter (where event_type = 'purchase') > 1 then 0.5 end)::double as confidence,
 case when count(*) filter (where event_type = 'purchase') > 1 then 'marker_latest_of_multiple' else 'marker' end as method, case when count(*) filter (where event_type = 'purchase') = 0 then 'no_anchor_marker' end as missing_reason from events group by user_id""")
def marker_resolution(spark, d):
    out = A.resolve_markers(_t(spark, d, "events"), "user_id", "event_id", F.col("event_type") == "purchase", "event_type").drop("anchor_track")
    return out.withColumn("confidence", F.col("confidence").cast("double"))


@named("update_matched", "select c_custkey, case when s.s_suppkey is not null then case when s_acctbal > 0 then s_name end else c_name end as c_name from customer left join supplier s on s_suppkey = c_custkey")
def update_matched(spark, d):
    news = _t(spark, d, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("c_name"))
    return C.update_from(_t(spark, d, "customer").select("c_custkey", "c_name"), news, "c_custkey", ["c_name"])


@named("episodes")
def episodes(spark, d):
    e = _t(spark, d, "events").withColumn("zero", F.lit(0.0))
    return A.episodes(e, "user_id", "event_type", "event_id", "value", "zero", tol=40.0, fps=6.0)
