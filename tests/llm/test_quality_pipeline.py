import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
import fixtures as X  # noqa: E402

pytest.importorskip("tessera.llm")
corpus_pipeline = pytest.importorskip("corpus_pipeline")
from tessera.llm import quality  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_features_and_scores_match_one_text_at_a_time(spark):
    docs = X.table(spark)
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(1 << quality.BITS) + 1).astype(np.float32)
    got = {(r.doc_id, r.text): r.score for r in quality.score(docs, weights).collect()}
    from tessera.llm import kernels
    for r in X.rows():
        total = float(weights[-1])
        for numbers, _ in quality.features(*kernels.text_bytes(pa.array([r[1]], pa.string()))):
            if len(numbers):
                total += float(weights[numbers].astype(float).sum()) * quality.SCALE / len(numbers)
        assert abs(got[r[0], r[1]] - 1 / (1 + np.exp(-total))) < 1e-6
    assert quality.score(docs, weights).columns == [*docs.columns, "score"]
    assert quality.score(X.empty(spark), weights).count() == 0


def test_learning_and_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    weights = quality.train(docs, labels)
    rows = quality.score(docs, weights).join(labels, "doc_id").select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "quality").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    good, bad = [r.score for r in held if r.quality], [r.score for r in held if not r.quality]
    assert np.mean([a > b for a in good for b in bad]) > 0.98  # area under the curve on rows never learnt from
    # held-out labels and other columns have no influence
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.array_equal(weights, quality.train(docs.drop("lang", "source"), flipped))


def test_train_without_usable_labels(spark):
    none = spark.createDataFrame([(1, None, 0), (None, 1, 0), (2, 5, 0)], "doc_id long, quality int, toxic int")
    weights = quality.train(X.table(spark), none)
    assert not weights.any()
    assert {r.score for r in quality.score(X.table(spark), weights).collect()} == {0.5}


def test_one_document_of_a_repeated_id_is_learnt(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 13)], "doc_id long, quality int")
    docs = spark.createDataFrame([(i, f"word{i % 2} text {i}") for i in range(1, 13)] + [(2, f"other row {k}") for k in range(40)], "doc_id long, text string")
    once = docs.groupBy("doc_id").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    weights = quality.train(once, labels)
    assert weights.any() and np.array_equal(weights, quality.train(docs.repartition(3), labels))


def test_pipeline_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 400")
    columns = docs.columns
    counts = []
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, SF)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        docs.write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        counts.append(docs.count())
        if name == "quality":  # every document labelled good stays
            left = {r.doc_id for r in docs.select("doc_id").collect()}
            assert all(d in left for d, r in labels.items() if d < 400 and r.quality == 1)
        if name == "near_dedup":
            sets = [s for s in (X.shingles(r.text) for r in docs.collect()) if s]
            assert not any(100 * len(a & b) >= 75 * len(a | b) for i, a in enumerate(sets) for b in sets[:i])
    assert counts[0] < 400 and counts[2] < counts[1] <= counts[0]
    sequences = docs.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m")).collect()
    assert all(r.n == r.m <= 2048 for r in sequences)


def test_stages_on_hard_and_empty_tables(spark):
    wide = X.table(spark).select("doc_id", "text", "lang", "source", "n_chars")
    for docs in (wide, wide.limit(0)):
        for name, stage in corpus_pipeline.STAGES[1:]:
            assert stage(spark, docs, SF).count() >= 0
        assert corpus_pipeline.quality_filter(spark, docs, SF).columns == wide.columns
