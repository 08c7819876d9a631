"""A training corpus from raw documents: quality, repeated lines, near copies, benchmark passages, mix.

Every stage takes (spark, docs, sf_dir) and works on all that the one before kept. All but the last return the columns
of documents, whatever further columns these have. Texts that a stage shortens get their new length in n_chars.

* quality: a factorisation machine, fitted on at most 8,192 labelled documents among those given; a score below 0.3 goes.
* lines: keys of at least 20 characters that at least 3 documents share stay only in the largest doc_id.
* near copies: groups by 5-word shingles of similarity 0.8 or more; the smallest doc_id of each stays (one without id
  only if no other has one), and one row of those with the same id and text.
* benchmark: spans covered by 10-word windows of benchmark items are cut out of the texts.
* mix: words taken per document for sources weighing 1, 2, 3; one row per document that the mix takes something of, with
  text. Rows without an id share what their source's rows without one get.

Null texts count as empty; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landgauge.llm.common import read, stored
from landgauge.llm.fm_index import without_spans
from landgauge.llm.line_filter import drop_lines
from landgauge.llm.mixing import mix
from landgauge.llm.quality import quality_scores
from landgauge.llm.superminhash import document_key, near_groups


def measured_again(docs: DataFrame, columns: list[str]) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    names = ("__quality", "__good")
    scored = quality_scores(docs, read(spark, sf_dir, "labels"), threshold=0.3, names=names)
    return scored.where(F.col("__good") == 1).drop(*names)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return measured_again(drop_lines(docs, min_chars=20, min_docs=3, names=("__lines_before", "__lines_dropped")), docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = stored(near_groups(docs, width=5, percent=80), "near-groups").withColumnRenamed("id", "__id")
    dropped = stored(groups.where(~F.col("kept")).select("__id").distinct(), "near-copies")
    left = docs.withColumn("__id", document_key()).join(dropped, "__id", "left_anti")
    # Rows without id and words are linked with nothing, so all of them stay.
    known = groups.where(F.col("kept") & (F.col("doc_id").isNotNull() | (F.col("n_shingles") > 0)))
    twice = known.groupBy("__id").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("__id")
    twice = stored(twice, "repeated-rows")
    if twice.isEmpty():
        return left.select(*docs.columns)
    once = left.join(twice, "__id", "left_semi").dropDuplicates(["__id"])
    return left.join(twice, "__id", "left_anti").unionByName(once).select(*docs.columns)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return measured_again(without_spans(docs, read(spark, sf_dir, "benchmark"), width=10), docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    plan = mix(docs).groupBy(F.col("doc_id").alias("__id"), F.col("source").alias("__source")).agg(
        *[F.sum(c).alias(c) for c in ("size", "taken", "laps")], *[F.max(c).alias(c) for c in ("source_size", "target")]
    )
    plan = stored(plan.where(F.col("taken") > 0), "mix")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & F.col("source").eqNullSafe(F.col("__source"))
    return docs.select("doc_id", "source", "text").join(plan, same).drop("__id", "__source")


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("near_dedup", near_copies),
    ("decontamination", benchmark),
    ("source_mix", source_mix),
]
ORACLE_SQL = None  # SQL expresses neither the classifier nor the groups; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
