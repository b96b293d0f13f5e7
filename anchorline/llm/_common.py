"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words in every operator here: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. Only a local session, whose executors are the driver, may do without one."""
    path = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="anchorline-")
        spark.sparkContext.setCheckpointDir(path)
    return path.rstrip("/")


class Tables:
    """Tables of one owner in the shared folder: written by ``stored``, deleted by ``drop`` (of this owner's only).

    Frames that read them are lazy, so an owner drops them when it has read all it needs; whatever is left goes
    when the application's file system is closed.
    """

    def __init__(self):
        self.held: list[tuple[object, object]] = []

    def stored(self, df: DataFrame) -> DataFrame:
        """The rows, written as Parquet and read back: cuts the lineage, survives the loss of executors."""
        spark = df.sparkSession
        path = f"{shared_dir(spark)}/anchorline-{uuid.uuid4().hex}.parquet"
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
        df.write.option("compression", "zstd").parquet(path)
        fs.deleteOnExit(p)
        self.held.append((fs, p))
        return spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        while self.held:
            fs, p = self.held.pop()
            fs.delete(p, True)


def stored(df: DataFrame) -> DataFrame:
    """A table that stays until the application ends, for results that are read lazily."""
    return Tables().stored(df)


def give_back() -> None:
    """Returns freed memory of this worker to the system; allocators keep it otherwise, also while the worker idles."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def fold(col: str = "doc_id", n: int = 4):
    """crc32 of the id's decimal text, modulo n."""
    return F.crc32(F.col(col).cast("string").cast("binary")) % n


def count_words(text):
    """Number of words of a text column; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
