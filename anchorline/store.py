"""Tables as Parquet folders: scan, replacement that survives a crash, idempotent upsert, JSON manifests."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from anchorline.contracts import SCHEMAS, coerce
from anchorline.operators.corpus import upsert as merge


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _fs(spark, path)
    return fs.exists(p)


def _beside(spark: SparkSession, path: str, kind: str) -> list:
    """Folders that writes left beside a table, latest last."""
    p, fs = _fs(spark, path)
    found = fs.globStatus(_fs(spark, f"{path}.{kind}-*")[0]) or []
    return [s.getPath() for s in sorted(found, key=lambda s: (s.getModificationTime(), s.getPath().toString()))]


def _where(spark: SparkSession, path: str) -> str | None:
    """Where the rows are: the folder, or the one a write moved away before it ended; None if there never was one."""
    if exists(spark, path):
        return path
    old = _beside(spark, path, "old")
    return old[-1].toString() if old else None


def read_table(spark: SparkSession, path: str, table: str | None = None) -> DataFrame:
    """The stored rows in the table's schema; a table that was never written is empty."""
    at = _where(spark, path)
    if at is None:
        return spark.createDataFrame([], SCHEMAS[table] if table else "")
    return spark.read.parquet(at)


def write_table(df: DataFrame, path: str, table: str | None = None) -> int:
    """Writes beside the target and swaps, so a plan may read its target; returns the rows stored.

    The old rows are moved, then the new ones take their place. Between the two, and after a crash there, ``read_table``
    finds the old rows where they were moved; they are deleted when new ones stand in their place. One writer a table.
    """
    spark = df.sparkSession
    p, fs = _fs(spark, path)
    df = coerce(df, table) if table else df
    new, moved = (_fs(spark, f"{path}.{kind}-{uuid.uuid4().hex}")[0] for kind in ("new", "old"))
    df.write.option("compression", "zstd").parquet(new.toString())
    had = fs.exists(p)
    if had and not fs.rename(p, moved):
        raise OSError(f"cannot move {path}")
    if not fs.rename(new, p):
        if had:
            fs.rename(moved, p)
        raise OSError(f"cannot move {new}")
    for kind in ("old", "new"):
        for left in _beside(spark, path, kind):
            fs.delete(left, True)
    spark.catalog.refreshByPath(path)
    return spark.read.parquet(path).count()


def upsert_table(df: DataFrame, path: str, table: str, keys=("pk_id",)) -> int:
    """Replaces what is stored of the incoming entities; replaying changes nothing. Returns the rows then stored."""
    spark = df.sparkSession
    return write_table(merge(read_table(spark, path, table), coerce(df, table), list(keys)), path, table)


def write_manifest(spark: SparkSession, path: str, data: dict) -> None:
    """Replaces the file in one step: readers see the old text or the new one."""
    t = _fs(spark, f"{path}.new")[0]
    p, fs = _fs(spark, path)
    out = fs.create(t, True)
    out.write(bytearray(json.dumps(data, sort_keys=True, indent=1).encode()))
    out.close()
    jvm = spark._jvm
    how = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    how[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    context.rename(fs.makeQualified(t), fs.makeQualified(p), how)


def read_manifest(spark: SparkSession, path: str, default: dict | None = None) -> dict:
    if not exists(spark, path):
        return default if default is not None else {}
    return json.loads("\n".join(r[0] for r in spark.read.text(path).collect()))
