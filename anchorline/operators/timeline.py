"""Alignment on an anchor, fusion of series, and sampling on a ladder of offsets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def relative_ms(frame: Column, anchor: Column, fps: Column) -> Column:
    """Milliseconds from the anchor; the order of operations decides ties at half frames."""
    return (frame - anchor) / fps * F.lit(1000.0)


def input_order(df: DataFrame) -> Column:
    """Where a row came in: ``ingest_ord``, or all its columns, so that reruns agree."""
    return F.col("ingest_ord") if "ingest_ord" in df.columns else F.struct(*sorted(df.columns))


def keep_last(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(order))
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def collapse_identity(df: DataFrame, key: str, track: str, time: str, order: str, eps: float = 1e-6) -> DataFrame:
    """One track an entity: the first in order with a row at the anchor, else the most frequent (ties: first met)."""
    per = df.groupBy(key, track).agg(F.count("*").alias("_n"), F.min(order).alias("_met"), F.min(F.when(F.abs(time) < eps, F.col(order))).alias("_hit"))
    w = Window.partitionBy(key).orderBy(F.col("_hit").asc_nulls_last(), F.desc("_n"), "_met")
    chosen = per.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").select(key, track)
    return df.join(chosen, [key, track], "left_semi")


def fuse(base: DataFrame, others: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Left joins of other roles on the frame, with ``<role>_available``; frames only others have are dropped."""
    out = base
    for role, df in others.items():
        flag = f"{role}_available"
        out = out.join(df.withColumn(flag, F.lit(True)), list(keys), "left").withColumn(flag, F.coalesce(flag, F.lit(False)))
    return out


def snapshots(
    frames: DataFrame,
    entities: DataFrame,
    offsets: Sequence[float],
    key: str = "pk_id",
    time: str = "t_ms",
    numeric: Sequence[str] = (),
    flags: Sequence[str] = (),
    carried: Sequence[str] = (),
    tol: Column | float = 20.0,
    max_gap: float = 120.0,
    emit_for_empty: bool = True,
) -> DataFrame:
    """Exactly one row an entity and offset: exact, interpolated, or unavailable with a reason.

    Frames have one row an entity and time. ``tol`` may be a column of ``entities``. Only the two neighbours of
    each offset are looked up: a seven-fold scan of two columns with primitive minima and maxima, then two equi-joins.
    """
    f = frames.where(F.col(time).isNotNull()).select(key, F.col(time).alias("_t"), *numeric, *flags, *carried)
    probe = f.select(key, "_t").withColumn("off", F.explode(F.array(*[F.lit(float(o)) for o in offsets])))
    near = probe.groupBy(key, "off").agg(
        F.min("_t").alias("_first"), F.max("_t").alias("_end"), F.max(F.when(F.col("_t") < F.col("off"), F.col("_t"))).alias("_lo"), F.min(F.when(F.col("_t") >= F.col("off"), F.col("_t"))).alias("_hi")
    )
    want = entities.select(key, (tol if isinstance(tol, Column) else F.lit(float(tol))).alias("_tol"))
    want = want.withColumn("off", F.explode(F.array(*[F.lit(float(o)) for o in offsets])))
    s = want.join(near, [key, "off"], "left" if emit_for_empty else "inner")
    lo_near = F.col("_hi").isNull() | (F.col("_lo").isNotNull() & (F.col("off") - F.col("_lo") <= F.col("_hi") - F.col("off")))
    s = s.withColumn("_gap", F.abs(F.when(lo_near, F.col("_lo")).otherwise(F.col("_hi")) - F.col("off"))).withColumn("_at_lo", lo_near)
    reason = (
        F.when(F.col("_first").isNull(), "no_anchored_frames")
        .when(F.col("off") < F.col("_first") - F.col("_tol"), "before_clip_start")
        .when(F.col("off") > F.col("_end") + F.col("_tol"), "after_clip_end")
        .when(F.col("_gap") <= F.col("_tol"), F.lit(None))
        .when(F.col("_lo").isNull() | F.col("_hi").isNull() | (F.col("_hi") - F.col("_lo") > F.lit(float(max_gap))), "gap_exceeds_interpolation_limit")
    )
    s = s.withColumn("unavailable_reason", reason).withColumn("snapshot_available", F.col("unavailable_reason").isNull())
    s = s.withColumn("snapshot_method", F.when(~F.col("snapshot_available"), "unavailable").when(F.col("_gap") <= F.col("_tol"), "exact").otherwise("interp"))
    s = s.withColumn("gap_ms", F.when(F.coalesce("unavailable_reason", F.lit("")).isin("", "gap_exceeds_interpolation_limit"), F.col("_gap")))
    cols = [*numeric, *flags, *carried]
    lo = f.select(F.col(key), F.col("_t").alias("_lo"), *[F.col(c).alias(f"_lo_{c}") for c in cols])
    hi = f.select(F.col(key), F.col("_t").alias("_hi"), *[F.col(c).alias(f"_hi_{c}") for c in cols])
    s = s.join(lo, [key, "_lo"], "left").join(hi, [key, "_hi"], "left")
    exact, interp = F.col("snapshot_method") == "exact", F.col("snapshot_method") == "interp"
    w = (F.col("off") - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))
    out = [key, "off", "snapshot_available", "snapshot_method", "gap_ms", "unavailable_reason"]
    own = lambda c: F.when(F.col("_at_lo"), F.col(f"_lo_{c}")).otherwise(F.col(f"_hi_{c}"))
    exprs = [F.when(exact, own(c)).when(interp, F.col(f"_lo_{c}") * (F.lit(1.0) - w) + F.col(f"_hi_{c}") * w).alias(c) for c in numeric]
    exprs += [F.coalesce(F.when(exact, own(c)).when(interp, F.col(f"_lo_{c}") & F.col(f"_hi_{c}")), F.lit(False)).alias(c) for c in flags]
    exprs += [F.when(exact, own(c)).when(interp, F.col(f"_lo_{c}")).alias(c) for c in carried]
    derivation = F.when(interp, "interpolated").otherwise("derived").alias("derivation")
    return s.select(*out, *exprs, exact.alias("is_observed_frame"), derivation)


def nearest_observed(frames: DataFrame, snapshots: DataFrame, key: str, frame: str, time: str, off: str = "off") -> DataFrame:
    """For each available snapshot the observed frame closest to its offset, the earlier of equals.

    The ladder has a fixed number of offsets, so the equi-join on the entity grows with the frames alone.
    """
    s = snapshots.where("snapshot_available").select(key, off)
    near = F.struct(F.abs(F.col(time) - F.col(off)), F.col(time), F.col(frame))
    return frames.where(F.col(time).isNotNull()).select(key, frame, time).join(s, key).groupBy(key, off).agg(F.min_by(frame, near).alias(frame))
