"""Corpus pipeline: operators of tessera.llm applied to the documents table one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; its rows are written as Parquet and
reread as the next stage's documents. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import line_dedup, minhash_dedup, mixing, packing, quality
from tessera.llm.common import free_names
from tessera.session import ensure_checkpoint_dir, table

#: Documents scored below are rejected; as in the quality query.
QUALITY_LEAST = 0.3


def _as_documents(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The documents' own columns, with n_chars counted anew."""
    if "n_chars" in columns:
        rows = rows.withColumn("n_chars", F.char_length("text").cast(dict(rows.dtypes)["n_chars"]))
    return rows.select(*columns)


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents that the classifier rejects go."""
    ensure_checkpoint_dir(spark)
    weights = quality.train(docs, table(spark, sf_dir, "labels"))
    name = free_names(docs, "_score")[0]
    return quality.score(docs, weights, name=name).where(F.col(name) >= QUALITY_LEAST).select(*[f"`{c}`" for c in docs.columns])


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: aligned lines leave the later document; a document left without any text goes,
    unless it had none before."""
    ensure_checkpoint_dir(spark)
    rows = line_dedup.dedup_lines(docs)
    return _as_documents(rows.where("n_removed = 0 or text rlike '\\\\S'"), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one document of each near-duplicate group stays."""
    ensure_checkpoint_dir(spark)
    return minhash_dedup.keep_one_per_group(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: copies of each document by its source's target rate, shuffled."""
    ensure_checkpoint_dir(spark)
    return mixing.mix(docs).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: token pieces packed into sequences of at most 2048 ids."""
    ensure_checkpoint_dir(spark)
    return packing.pack(docs)


STAGES = [("quality", quality_filter), ("lines", line_dedup_stage), ("near_dedup", near_dedup),
          ("mix", mix_sources), ("pack", pack_sequences)]

#: A trained model, component search and tokenisation are beyond SQL; tests compare operators with brute force, and of the
#: stages check columns, counts and invariants.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; intermediate tables go to the shared checkpoint folder."""
    root = f"{ensure_checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs.write.parquet(f"{root}/{i}-{name}")
            docs = spark.read.parquet(f"{root}/{i}-{name}")
    return docs
