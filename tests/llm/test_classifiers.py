"""Held-out accuracy of the classifiers, odd rows, empty tables, and the pipeline."""

import public_tokenizers
from pyspark.sql import functions as F

import corpus_pipeline
from landgauge.llm import attention_lm, exact_index, fm_index, line_filter, mixing, prefix_free, quality, superminhash, token_counts, toxicity



def both(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")


def test_quality_on_the_held_out_fold(spark):
    docs, labels = both(spark, "/root/testdata/sf0.1")
    scored = quality.quality_scores(docs, labels).join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    right = scored.agg(F.avg((F.col("predicted") == F.col("quality")).cast("double"))).first()[0]
    assert right > 0.95


def test_toxicity_on_the_held_out_fold(spark):
    docs, labels = both(spark, "/root/testdata/sf0.1")
    scored = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    caught, clean = scored.agg(
        F.avg(F.when(F.col("toxic") == 1, F.col("predicted"))), F.avg(F.when(F.col("toxic") == 0, 1 - F.col("predicted")))
    ).first()
    assert caught > 0.65 and clean > 0.99
    named = scored.where((F.col("predicted") == 1) & (F.size("offending") > 0)).count()
    assert named > 0.8 * scored.where("predicted = 1").count()


def test_odd_rows_and_no_labels(spark, odd, odd_rows):
    labels = spark.createDataFrame([(0, 1, 0), (7, 0, 1), (7, 1, 0), (None, 1, 1), (9, None, None)], "doc_id long, quality int, toxic int")
    for known in (labels, labels.limit(0)):
        good = quality.quality_scores(odd, known).collect()
        toxic = toxicity.toxicity_scores(odd, known).collect()
        assert len(good) == len(toxic) == len(odd_rows)
        assert all(0 <= r["score"] <= 1 for r in [*good, *toxic])


def test_empty_tables(spark, none):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([], "item_id long, text string")
    held = F.lit(False)
    path, multi = (public_tokenizers.path(p) for p in ("piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"))
    for df in (
        mixing.mix(none), exact_index.duplicates(none), toxicity.toxicity_scores(none, labels), quality.quality_scores(none, labels),
        attention_lm.language_scores(none, held, multi, public_tokenizers.PATTERN), fm_index.contamination(none, bench),
        prefix_free.remove_repeats(none), superminhash.near_duplicates(none), token_counts.token_counts(none, path), line_filter.drop_lines(none),
    ):
        assert df.collect() == []


def test_pipeline_stages_take_effect(spark, odd, odd_rows, tmp_path):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(5, 30)], "doc_id long, quality int, toxic int")
    item = " ".join(odd_rows[6][1].split(" ")[10:31])
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    for name, df in (("documents", odd), ("labels", labels), ("benchmark", bench)):
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, str(tmp_path))
        docs.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs
        assert name == "source_mix" or docs.columns == columns
    kept = {r["doc_id"]: r["text"] for r in seen["near_dedup"].collect() if r["doc_id"] is not None}
    assert 5 in kept and 19 not in kept  # near copies of one text
    assert seen["near_dedup"].where("doc_id = 7").count() <= 1
    assert item not in " ".join(r["text"] or "" for r in seen["decontamination"].collect())
    assert seen["source_mix"].where("taken <= 0").count() == 0
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert run.count() == seen["source_mix"].count()
