"""Column expressions: identifiers, normalisers, angles and geometry. Nulls propagate unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def nan_to_null(c: Column) -> Column:
    """A missing measurement is NULL from ingest on; NaN compares as largest in Spark."""
    return F.when(~F.isnan(c), c)


def slugify(c: Column) -> Column:
    s = F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "-")
    return F.regexp_replace(s, "^-+|-+$", "")


def normalise_identifier(c: Column) -> Column:
    """Parts between separators; digits lose leading zeros, others case; joined by ``-``."""
    text = F.trim(c.cast("string"))
    parts = F.filter(F.split(text, r"[-_./ ]+"), lambda p: p != "")
    parts = F.transform(parts, lambda p: F.when(p.rlike("^[0-9]+$"), F.regexp_replace(p, "^0+(?=[0-9])", "")).otherwise(F.lower(p)))
    joined = F.array_join(parts, "-")
    return F.when(joined == "", F.lower(text)).otherwise(joined)


def entity_id(slug: Column, raw: Column) -> Column:
    return F.concat(slug, F.lit(":"), normalise_identifier(raw))


def entity_uid(pk_id: Column) -> Column:
    return F.substring(F.sha1(pk_id), 1, 16)


def dedup_key(family: Column, raw: Column) -> Column:
    return F.concat(slugify(family), F.lit("/"), normalise_identifier(raw))


def side(c: Column) -> Column:
    """L, C or R; anything else is NULL."""
    s = F.upper(F.trim(c))
    return F.when(s.isin("L", "C", "R"), s)


def goal_flag(c: Column) -> Column:
    """Number truncated to an integer; NULL if it is none."""
    return c.try_cast("double").try_cast("int").try_cast("byte")


def hms_seconds(c: Column) -> Column:
    """Seconds of hh:mm:ss(.f); NULL if malformed."""
    p = F.split(c, ":")
    total = F.get(p, F.lit(0)).try_cast("int") * 3600 + F.get(p, F.lit(1)).try_cast("int") * 60 + F.get(p, F.lit(2)).try_cast("double")
    return F.when(F.size(p) == 3, total)


def has_token(c: Column, token: str) -> Column:
    """Whether a list separated by white space holds exactly this token."""
    return F.array_contains(F.split(F.trim(c), r"\s+"), token)


def segment_angle(dx: Column, dy: Column) -> Column:
    """Degrees of atan2(-dy, dx) with y downwards; a level segment that points left is -180, as -0.0 asks for."""
    return F.when((dy == 0) & (dx < 0), F.lit(-180.0)).otherwise(F.degrees(F.atan2(-dy, dx)))


def wrapped(c: Column) -> Column:
    """Into [-180, 180) by floor modulus."""
    return F.pmod(c + 180.0, F.lit(360.0)) - 180.0


def distance(dx: Column, dy: Column) -> Column:
    return F.sqrt(dx * dx + dy * dy)


def iou(a: list[Column], b: list[Column]) -> Column:
    """Intersection over union of boxes given as x1, y1, x2, y2; 0 where neither has an area."""
    w = F.greatest(F.lit(0.0), F.least(a[2], b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[3], b[3]) - F.greatest(a[1], b[1]))
    both = w * h
    total = (a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - both
    return F.when(total > 0, both / total).otherwise(0.0)


def in_quad(x: Column, y: Column, quad: list[tuple[Column, Column]]) -> Column:
    """Inside a convex quadrilateral, its boundary included: the four signed areas do not differ in sign."""
    cross = []
    for (x1, y1), (x2, y2) in zip(quad, quad[1:] + quad[:1], strict=True):
        cross.append((x2 - x1) * (y - y1) - (y2 - y1) * (x - x1))
    up, down = F.lit(True), F.lit(True)
    for c in cross:
        up, down = up & (c >= 0), down & (c <= 0)
    return up | down


def licence_open(c: Column) -> Column:
    return c.rlike(r"(?i)^(cc0|public domain|pdm|cc[ -]by)")


def licence_share_alike(c: Column) -> Column:
    return c.rlike(r"(?i)(^|[^a-z])sa([^a-z]|$)|share[ -]?alike")


def catalogue_slug(title: Column) -> Column:
    """A title without its namespace and extension: at most 60 characters of a-z, 0-9 and ``_``."""
    bare = F.regexp_replace(F.replace(title, F.lit("File:"), F.lit("")), r"(?<=[^./])\.[^./]*$", "")
    return F.substring(F.lower(F.regexp_replace(F.regexp_replace(bare, "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")), 1, 60)


def inference_size(width: Column, override: Column | None = None) -> Column:
    size = F.greatest(F.lit(320), (F.rint(F.least(width, F.lit(1920)) / 32) * 32).cast("int"))
    return F.coalesce(override, size) if override is not None else size


def epoch_us(c: Column) -> Column:
    return F.unix_micros(c.cast("timestamp"))
