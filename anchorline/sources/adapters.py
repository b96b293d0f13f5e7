"""Sources behind one contract: what is there, how it may be used, and its rows. Nothing here uses the network."""

from __future__ import annotations

import dataclasses
from abc import ABC, abstractmethod
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from anchorline.sources import readers

# States of access, most usable first.
ACCESS = ("open", "gated", "blocked", "error")


@dataclass
class Report:
    """What the inventory of a source found."""

    source: str
    access: str
    media_kind: str = "none"
    discovered: int | None = None
    accessible: int | None = None
    notes: list[str] = field(default_factory=list)

    def to_dict(self) -> dict:
        return dataclasses.asdict(self)


class Adapter(ABC):
    """A source reads its files below ``path``; subclasses give a slug, a deposit family and the tables."""

    slug = ""
    family = ""
    access = "open"
    media_kind = "none"

    def __init__(self, spark: SparkSession, path: str, **options):
        self.spark, self.path, self.options = spark, path, options

    @abstractmethod
    def rows(self) -> DataFrame:
        """One row an entity or observation, lazily."""

    @abstractmethod
    def count(self) -> DataFrame:
        """One row with ``discovered`` and ``accessible``."""

    def ingest(self, limit: int | None = None) -> DataFrame:
        return self.rows() if limit is None else self.rows().limit(limit)

    def inventory(self) -> Report:
        """Counts and access. A source that cannot be read is reported as such, as others must still be listed."""
        try:
            n = self.count().first()
        except Exception as e:
            return Report(self.slug, "error", self.media_kind, notes=[f"{type(e).__name__}: {str(e).splitlines()[0]}"])
        return Report(self.slug, self.access, self.media_kind, n["discovered"], n["accessible"])


class PoseTables(Adapter):
    """CSV files of one row a kick and frame."""

    media_kind = "pose_table"

    def raw(self) -> DataFrame:
        return readers.read_strings(self.spark, self.path)

    def rows(self) -> DataFrame:
        return readers.pose_table(self.raw())

    def count(self) -> DataFrame:
        n = F.count_distinct("kick_id_raw")
        return self.rows().agg(n.alias("discovered"), n.alias("accessible"))

    def ingest(self, limit: int | None = None) -> DataFrame:
        """The first ``limit`` kicks, whole."""
        return readers.first_entities(self.rows().withColumn("_ord", F.monotonically_increasing_id()), "kick_id_raw", "_ord", limit).drop("_ord")


class Annotations(Adapter):
    """Nested JSON files; their videos are behind an agreement."""

    access = "gated"

    def rows(self) -> DataFrame:
        return readers.annotations(self.spark, self.path)

    def count(self) -> DataFrame:
        return self.rows().agg(F.count("*").alias("discovered"), F.lit(0).alias("accessible"))


class Segments(Adapter):
    """A list of segments and a crosswalk to another source's names."""

    access = "gated"

    def rows(self) -> DataFrame:
        return readers.segments(readers.read_strings(self.spark, self.path), self.options.get("token", "8"))

    def count(self) -> DataFrame:
        return self.rows().agg(F.count("*").alias("discovered"), F.lit(0).alias("accessible"))


class Catalogue(Adapter):
    """JSON lines of catalogue entries beside the probed media."""

    media_kind = "video"

    def rows(self) -> DataFrame:
        return readers.catalogue_metadata(self.spark.read.schema(readers.ENTRY).json(self.path), self.slug, self.family or self.slug, self.options["now"])

    def count(self) -> DataFrame:
        return self.rows().agg(F.count("*").alias("discovered"), F.count_if("has_video").alias("accessible"))


class Registry:
    """Adapters by slug. An alias stands for several."""

    def __init__(self, adapters: Iterable[type[Adapter]], aliases: dict[str, list[str]] | None = None):
        self.adapters = {a.slug: a for a in adapters}
        self.aliases = {"all": list(self.adapters), **(aliases or {})}

    def resolve(self, names: list[str] | None = None) -> list[str]:
        """Slugs in the order asked for, each once; an unknown name is a KeyError."""
        wanted = dict.fromkeys(slug for name in names or ["all"] for slug in self.aliases.get(name, [name]))
        unknown = [s for s in wanted if s not in self.adapters]
        if unknown:
            raise KeyError(f"unknown sources {unknown}; known are {sorted(self.adapters)}")
        return list(wanted)

    def inventory(self, spark: SparkSession, paths: dict[str, str], **options) -> dict[str, Report]:
        return {slug: self.adapters[slug](spark, paths[slug], **options).inventory() for slug in self.resolve(list(paths))}
