"""Across entities: primary election, upserts, licence filters, quality roll-up and summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed order of states and of media kinds, least first.
STATUS = ("na", "pass", "warn", "fail")
MEDIA = ("none", "render_only", "pose_table", "video")


def rank_of(c: Column, order: Sequence[str], default: int = 0) -> Column:
    out = F.lit(default)
    for i, name in enumerate(order):
        out = F.when(c == name, i).otherwise(out)
    return out


def elect_primary(df: DataFrame, group: str, id_col: str, score: Sequence[Column], tie: str) -> DataFrame:
    """The greatest score of each group is primary, ties by input order; the others point to it.

    Maxima and minima are combined before the shuffle, so a group that holds a third of all rows is no single task's
    work; (tie, id) must be unique in a group.
    """
    # the order is strict: compared as a struct, nulls least; the tie is turned round by electing in two steps
    best = df.groupBy(group).agg(F.max(F.struct(*score)).alias("_best"))
    top = df.join(best.withColumnRenamed(group, "_g"), F.col(group).eqNullSafe(F.col("_g"))).where(F.struct(*score).eqNullSafe(F.col("_best")))
    top = top.groupBy("_g").agg(F.min(F.struct(F.col(tie).alias("t"), F.col(id_col).alias("i"))).alias("_top"))
    out = df.join(top, F.col(group).eqNullSafe(F.col("_g")))
    first = F.col(tie).eqNullSafe(F.col("_top.t")) & F.col(id_col).eqNullSafe(F.col("_top.i"))
    return out.withColumn("is_primary", first).withColumn("duplicate_of", F.when(~first, F.col("_top.i"))).drop("_g", "_top")


def duplicate_report(elected: DataFrame, group: str, id_col: str) -> DataFrame:
    return elected.where(~F.col("is_primary")).select(group, F.col(id_col).alias("duplicate"), F.col("duplicate_of").alias("primary"))


def duplicate_summary(elected: DataFrame, source: str) -> DataFrame:
    return elected.groupBy(source).agg(F.count("*").alias("records"), F.count_if("is_primary").alias("primary_records"), F.count_if(~F.col("is_primary")).alias("duplicates"))


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of existing entities are replaced by the incoming ones; keys compare as strings."""
    names = [f"_k{i}" for i in range(len(keys))]
    new = incoming.select(*[F.col(k).cast("string").alias(n) for k, n in zip(keys, names, strict=True)]).distinct()
    cond = F.lit(True)
    for k, n in zip(keys, names, strict=True):
        cond &= F.col(k).cast("string").eqNullSafe(F.col(n))
    return existing.join(new, cond, "left_anti").unionByName(incoming, allowMissingColumns=True)


def not_yet(entities: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Entities without any row in what is done."""
    return entities.join(done.select(key).distinct(), key, "left_anti")


def worst_first(meta: DataFrame, k: int, key: str = "pk_id") -> DataFrame:
    """Failed ones first, then warned, ungraded and passed ones; a bounded top-k."""
    order = F.when(F.col("qc_status") == "fail", 0).when(F.col("qc_status") == "warn", 1).when(F.col("qc_status") == "pass", 3).otherwise(2)
    return meta.orderBy(order, key).limit(k)


def publishable(rows: DataFrame, allowed: DataFrame, key: str) -> DataFrame:
    return rows.join(allowed.select(key).distinct(), key, "left_semi")


def withheld(rows: DataFrame, allowed: DataFrame, key: str, reason: str = "licence") -> DataFrame:
    return rows.join(allowed.select(key).distinct(), key, "left_anti").withColumn("reason", F.lit(reason))


def roll_up(facts: DataFrame, key: str, order: str = "check_ord") -> DataFrame:
    """Worst status, and what warned or failed in the order of the checks (NULL if nothing)."""
    rank = rank_of(F.col("status"), STATUS)
    bad = F.when(F.col("status").isin("warn", "fail"), F.struct(F.col(order), F.concat_ws(":", "check", "status").alias("t")))
    out = facts.groupBy(key).agg(F.max(rank).alias("_r"), F.array_sort(F.collect_list(bad)).alias("_b"))
    status = F.element_at(F.array(*[F.lit(s) for s in STATUS]), F.col("_r") + 1)
    return out.select(key, status.alias("qc_status"), F.nullif(F.array_join(F.col("_b.t"), "; "), F.lit("")).alias("qc_reasons"))


def report(meta: DataFrame, events: DataFrame, snapshots: DataFrame, facts: DataFrame) -> DataFrame:
    """Every number of the corpus report as rows section, key, value: one aggregate a section, nothing collected."""
    c, rows = F.col, []

    def tall(df: DataFrame, section: str, key: Column, values: dict[str, Column]) -> None:
        pairs = F.array(*[F.struct(F.lit(n).alias("n"), v.cast("double").alias("v")) for n, v in values.items()])
        x = df.select(key.cast("string").alias("_k"), F.explode(pairs).alias("_p"))
        rows.append(x.select(F.lit(section).alias("section"), F.concat_ws("/", "_k", c("_p.n")).alias("key"), c("_p.v").alias("value")))

    none = F.lit(None).cast("string")
    usable = c("is_primary") & c("media_kind").isin("video", "pose_table")
    labels = ("label_kick_direction", "label_goal", "label_footedness", "label_camera_direction")
    n = meta.agg(F.count("*").alias("records"), F.count_if("is_primary").alias("unique"), F.count_if(usable).alias("usable"), *[F.try_divide(F.count_if(usable & c(x).isNotNull()), F.count_if(usable)).alias(x) for x in labels])
    tall(n, "corpus", none, {x: c(x) for x in ("records", "unique", "usable")})
    tall(n, "label_coverage", none, {x: c(x) for x in labels})
    tall(meta.groupBy("source").agg(F.count("*").alias("n"), F.count_if("is_primary").alias("u")), "sources", c("source"), {"records": c("n"), "unique": c("u")})
    con = events.where("event_name = 'ball_contact'").agg(F.count_if(~c("is_missing")).alias("r"), F.count("*").alias("n"))
    tall(con, "contact", none, {"resolved": c("r"), "of": c("n"), "rate": F.try_divide("r", "n")})
    s = snapshots.groupBy("offset_ms").agg(F.count_if("snapshot_available").alias("a"), F.count("*").alias("n"))
    tall(s, "snapshots", c("offset_ms"), {"available": c("a"), "of": c("n"), "rate": c("a") / c("n")})
    tall(snapshots.where("not snapshot_available").groupBy("unavailable_reason").agg(F.count("*").alias("n")), "unavailable", c("unavailable_reason"), {"n": c("n")})
    tall(check_summary(facts), "checks", c("check"), {**{x: c(f"n_{x}") for x in STATUS}, "rate": c("success_rate")})
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def source_matrix(facts: DataFrame, meta: DataFrame, key: str = "pk_id") -> DataFrame:
    """The graded facts by source and check."""
    return facts.drop("source").join(meta.select(key, "source"), key, "left").groupBy("source", "check").agg(*[F.count_if(F.col("status") == s).alias(f"n_{s}") for s in STATUS])


def mirror_match(renders: DataFrame, rows: DataFrame, slug: str, ident: str = "source_identifier", key: str = "pk_id") -> DataFrame:
    """Renders matched by identifier with the rows of another source: number of rows, and a status where there is none."""
    want = renders.select(ident, F.concat(F.lit(f"{slug}:"), F.col(ident)).alias(key))
    n = rows.where("not is_missing").groupBy(key).agg(F.count("*").alias("n_rows"))
    out = want.join(n, key, "left").withColumn("n_rows", F.coalesce("n_rows", F.lit(0)))
    return out.withColumn("status", F.when(F.col("n_rows") == 0, "no matching rows").otherwise("matched"))


def check_summary(facts: DataFrame) -> DataFrame:
    n = {s: F.count_if(F.col("status") == s) for s in STATUS}
    out = facts.groupBy("check").agg(*[n[s].alias(f"n_{s}") for s in STATUS])
    return out.withColumn("success_rate", F.try_divide(F.col("n_pass"), F.col("n_pass") + F.col("n_warn") + F.col("n_fail")))


def update_from(base: DataFrame, news: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Columns of matched rows are overwritten, with NULL too; rows without a match keep theirs."""
    n = news.select(F.col(key), *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_hit"))
    out = base.join(n, key, "left")
    return out.select(*[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in base.columns])


def analysis_view(snapshots: DataFrame, meta: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Available snapshots of entities that did not fail, with ``columns`` of the metadata."""
    ok = meta.where("qc_status is null or qc_status <> 'fail'").select(key, *columns)
    return snapshots.where("snapshot_available").join(ok, key)


def passing(facts: DataFrame, meta: DataFrame, check: str, key: str = "pk_id", media: str = "video") -> DataFrame:
    """Entities with this kind of media whose check passed."""
    ok = facts.where((F.col("check") == check) & (F.col("status") == "pass")).select(key)
    return meta.where(F.col("media_kind") == media).join(ok, key, "left_semi")
