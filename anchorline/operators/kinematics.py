"""Differences over row neighbours, and pose features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anchorline.functions.scalars import distance, segment_angle, wrapped


def central_difference(value: str, time: str, keys: Sequence[str], order: str) -> Column:
    """(x[i+1]-x[i-1])/(t[i+1]-t[i-1]), one-sided at the ends; NULL for a single row, no progress or a null end."""
    w = Window.partitionBy(*keys).orderBy(order)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    n, size = F.row_number().over(w), F.count(F.lit(1)).over(whole)
    pick = lambda c: (F.when(n == 1, F.col(c)).otherwise(F.lag(c).over(w)), F.when(n == size, F.col(c)).otherwise(F.lead(c).over(w)))
    (x0, x1), (t0, t1) = pick(value), pick(time)
    return F.when((size > 1) & (t1 - t0 > 0), (x1 - x0) / (t1 - t0))


def backward_difference(value: str, keys: Sequence[str], order: str, fps: Column) -> Column:
    """Difference to the row before over one fixed step, whatever the gap between frames."""
    w = Window.partitionBy(*keys).orderBy(order)
    return F.when(fps > 0, (F.col(value) - F.lag(value).over(w)) / (F.lit(1.0) / fps))


def pivot_keypoints(poses: DataFrame, keys: Sequence[str], index: str, points: Sequence[int], order: str) -> DataFrame:
    """Long to wide: the first non-null x and y in order; frames without any value vanish."""
    aggs = [F.min_by(F.when(F.col(index) == k, F.col(c)), F.when((F.col(index) == k) & F.col(c).isNotNull(), F.col(order))).alias(f"{c}_{k}") for k in points for c in ("x", "y")]
    wide = poses.groupBy(*keys).agg(*aggs)
    return wide.where(F.coalesce(*[F.col(f"{c}_{k}") for k in points for c in ("x", "y")]).isNotNull())


def pose_features(foot: Column, kp: dict[str, tuple[Column, Column]]) -> dict[str, Column]:
    """Angles in degrees and ankle geometry from the named points l/r x shoulder, hip, ankle."""
    seg = lambda a, b: segment_angle(kp[b][0] - kp[a][0], kp[b][1] - kp[a][1])
    mid = lambda a, b, i: (kp[a][i] + kp[b][i]) / 2
    pelvis, shoulder = seg("l_hip", "r_hip"), seg("l_shoulder", "r_shoulder")
    dx = mid("l_shoulder", "r_shoulder", 0) - mid("l_hip", "r_hip", 0)
    dy = mid("l_shoulder", "r_shoulder", 1) - mid("l_hip", "r_hip", 1)
    f = F.upper(foot)
    pick = lambda i, r, o: F.when(f == "R", kp[r][i]).when(f == "L", kp[o][i])
    return {
        "pelvis_deg": pelvis,
        "shoulder_deg": shoulder,
        "hip_shoulder_deg": wrapped(shoulder - pelvis),
        "torso_lean_deg": F.degrees(F.atan2(dx, -dy)),
        "ankle_separation": distance(kp["l_ankle"][0] - kp["r_ankle"][0], kp["l_ankle"][1] - kp["r_ankle"][1]),
        "kick_ankle_x": pick(0, "r_ankle", "l_ankle"),
        "kick_ankle_y": pick(1, "r_ankle", "l_ankle"),
        "plant_ankle_x": pick(0, "l_ankle", "r_ankle"),
        "plant_ankle_y": pick(1, "l_ankle", "r_ankle"),
    }
