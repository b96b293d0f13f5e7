"""A corpus pipeline of five operators. Each stage maps documents to documents; the last gives token ids.

1. language ID: a document goes if it has no letter (or no text), or if no known language holds a fair share
   of its n-grams; all others stay as they are;
2. SimHash near-dedup: of each component the row with the smallest doc_id stays (one, if repeated; an id whose
   rows are of several components is judged row by row);
3. substring dedup: windows of 35 words that occur more than once are cut out of the texts;
4. mixing: documents are drawn to the target weights, one row a draw;
5. SentencePiece: the ids of each text, with a digest of their decoding.

Columns of ``documents``, and any others, are passed on by all stages but the last, whatever their names. Null texts go at
stage 1, texts left empty by stage 3 at stage 4 (they have no words to draw); a row without doc_id is kept by stage 2.
Repeated rows: stage 2 keeps one, stage 3 takes what is left of them as copies of each other. Ties go to the smaller
doc_id, then to the smaller hash of the text. Very long texts pass whole. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from anchorline.llm import langid, mixing, pieces, simhash, substring_dedup
from anchorline.llm._common import Tables
from anchorline.llm.chunks import Rounds


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    filters = langid.train(langid.training_rows(docs))
    flat = docs.select(*[F.col(f"`{c}`").alias(f"_{i}") for i, c in enumerate(docs.columns)])
    judged = langid.identify(flat, filters, text_col=f"_{docs.columns.index('text')}")
    kept = judged.where((F.col("lang_pred") != "und") & (F.col("coverage") >= langid.COVERAGE))
    return kept.select(*[F.col(f"_{i}").alias(c) for i, c in enumerate(docs.columns)])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = simhash.grouped(docs)
    gone = found.where("doc_id <> component_id").select(F.col("doc_id").alias("_gone")).distinct()
    # ids that occur more than once (a row without id is left alone)
    twice = found.groupBy("doc_id").count().where("count > 1 and doc_id is not null").select(F.col("doc_id").alias("_twice"))
    once = docs.join(twice, F.col("doc_id") == F.col("_twice"), "left_anti").join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
    # their rows can be of several components: each row is judged by its own text
    parts = found.join(twice, F.col("doc_id") == F.col("_twice"), "left_semi").where("doc_id = component_id")
    parts = parts.select(F.col("doc_id").alias("_id"), F.col("fp").alias("_fp"), F.col("root").alias("_root")).distinct()
    more = docs.join(twice, F.col("doc_id") == F.col("_twice"), "left_semi").withColumn("_own", simhash.fingerprint_of(F.col("text")))
    more = more.join(parts, (F.col("doc_id") == F.col("_id")) & (F.col("_own") == F.col("_fp")))
    order = Window.partitionBy("doc_id", "_root").orderBy(F.xxhash64("text"), F.lit(0))
    first = more.withColumn("_nth", F.row_number().over(order)).where("_nth = 1").drop("_nth", "_own", "_id", "_fp", "_root")
    return once.unionByName(first)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup_docs(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    Rounds.release()  # docs are written by now, and what stays of the stage before would lie beside this one's shuffles
    return mixing.mixed_documents(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encode(docs)


STAGES = [
    ("language ID", languages),
    ("SimHash near-dedup", near_copies),
    ("substring dedup", passages),
    ("mixing sources to target weights", mixture),
    ("SentencePiece encoding and decoding", token_ids),
]
#: Most stages cannot be put in SQL; tests hold the pipeline against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), Tables()
    for _, stage in STAGES[:-1]:
        now = Tables()
        docs = now.stored(stage(spark, docs, sf_dir))
        before.drop()  # the next stage reads only what this one wrote
        before = now
    return STAGES[-1][1](spark, docs, sf_dir)
