"""Command line: inventory, ingest, detect, process, qc, publish, report over the tables below one root."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import UTC, datetime

from pyspark.sql import SparkSession

from anchorline import engine
from anchorline.sources import readers


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="anchorline")
    p.add_argument("--root", required=True, help="folder of the stored tables")
    p.add_argument("--fps", type=float, default=25.0, help="frame rate where a source gives none")
    verbs = p.add_subparsers(dest="verb", required=True)

    def verb(name: str, about: str, **args: dict) -> None:
        v = verbs.add_parser(name, help=about)
        for flag, how in args.items():
            v.add_argument("--" + flag.replace("_", "-"), **how)

    yes, ids = {"action": "store_true"}, {"action": "append", "dest": "ids", "metavar": "PK_ID"}
    verb("inventory", "entities and rows of a pose table", table={"required": True})
    verb("ingest", "a pose table into the stored tables", table={"required": True}, source={"required": True}, family={"default": None}, licence={"default": "CC BY 4.0"}, limit={"type": int})
    verb("detect", "a table of detections into tracks, ball and events", table={"required": True})
    verb("process", "anchored frames and snapshots", limit={"type": int}, all=yes, pk_id=ids, force=yes)
    verb("qc", "checks and their roll-up", pk_id=ids)
    verb("publish", "rows whose licence allows it", out={"required": True}, dry_run=yes)
    verb("report", "every number of the corpus", json=yes)
    return p


def run(spark: SparkSession, a: argparse.Namespace) -> object:
    cfg = engine.Config(a.root, fps=a.fps)
    if a.verb == "inventory":
        raw = readers.read_strings(spark, a.table)
        rows = readers.pose_table(raw)
        return {"entities": rows.select("kick_id_raw").distinct().count(), "rows": rows.count(), "dropped_rows": readers.dropped_rows(raw).first()["dropped"]}
    if a.verb == "ingest":
        return engine.ingest_pose_table(spark, cfg, readers.read_strings(spark, a.table), a.source, a.family or a.source, datetime.now(UTC).isoformat(timespec="seconds"), a.licence, a.limit)
    if a.verb == "detect":
        return engine.detect(spark, cfg, spark.read.parquet(a.table))
    if a.verb == "process":
        return engine.process(spark, cfg, a.ids, a.limit, a.all or bool(a.ids), a.force)
    if a.verb == "qc":
        return [r.asDict() for r in engine.grade(spark, cfg, a.ids).orderBy("check").collect()]
    if a.verb == "publish":
        return engine.publish(spark, cfg, a.out, dry_run=a.dry_run)
    return engine.report_json(spark, cfg) if a.json else engine.report_text(spark, cfg)


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    spark = SparkSession.builder.appName("anchorline").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    out = run(spark, a)
    print(out if isinstance(out, str) else json.dumps(out, indent=2, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
