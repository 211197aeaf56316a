"""Corpus pipeline: quality, toxicity, near-duplicates, mixing, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
every stage's result as Parquet to the shared folder and reads it back as the
next stage's input.

Edge cases: null and empty texts are scored like any other, are near-duplicates
of each other, and where they stay are mixed with size 0 and encoded to no
pieces; a null doc_id never names a component but its row can stay; of rows
alike in all columns the near-duplicate stage keeps one; rows with one id and
unlike texts are separate documents throughout; an empty table passes every
stage; extra columns are kept up to the last stage, whatever their names.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.llm import mixing, piece_sampling, quality_gam, simhash_bk, toxicity
from plume.llm.common import columns_of, whole_row
from plume.llm.queries import (QUALITY_CUT, QUALITY_FOLD, TOKENIZERS, TOXIC_CUT, TOXIC_FOLD,
                               train_labels)
from plume.session import scratch_path


def _passing(docs: DataFrame, scored: DataFrame, keep) -> DataFrame:
    """The input's rows and columns whose score passes."""
    return scored.filter(keep).select(*columns_of("row_", docs.columns))


def _with_row(docs: DataFrame) -> DataFrame:
    return docs.select(whole_row(docs).alias("row_"), F.col("text"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality_gam.train(docs, train_labels(spark, sf_dir, QUALITY_FOLD))
    scored = quality_gam.score(_with_row(docs), model, keep=("row_",))
    return _passing(docs, scored, F.col("score") >= QUALITY_CUT)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    model = toxicity.train(docs, train_labels(spark, sf_dir, TOXIC_FOLD))
    scored = toxicity.score(_with_row(docs), model, keep=("row_",))
    return _passing(docs, scored, F.col("score") < TOXIC_CUT)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash_bk.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The copies of documents the mix takes, in training order, which the
    column ``mix_position`` keeps."""
    return mixing.mix_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sampled pieces of every copy, each decoded again, with its training
    position where the mix gave one."""
    keep = tuple(c for c in docs.columns if c.startswith("mix_position"))
    return piece_sampling.encode(docs, f"{TOKENIZERS}/piece_bpe_32k.model", keep=keep)


STAGES = [
    ("quality", quality),
    ("toxicity", toxic),
    ("near_dedup", near_dedup),
    ("mixing", mix),
    ("sentencepiece", encode),
]

#: classifiers, fingerprints and sampled pieces cannot be stated in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = scratch_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
