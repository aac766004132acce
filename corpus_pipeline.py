"""Cleaning of ``documents`` in stages; each one works on all rows its predecessor kept.

Every stage but the last returns the columns of documents. ``run`` writes each stage's rows to the shared folder and
reads them back for the next, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficlake.llm import bpe, decontaminate, forest, linedup, quality
from trafficlake.llm.frames import read, shared_folder
from trafficlake.llm.queries import WORD_BPE


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from the labels, takes as good.

    NULL and empty texts score as texts without any feature; repeated rows stay or go together; without labels all stay.
    """
    model = quality.train(docs, read(spark, sf_dir, "labels"))
    return docs.where(quality.score_column(F.col("text"), model) >= 0.5)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without later repeats of three-line windows; ``n_chars`` follows. A document stays if nothing is left."""
    return linedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def keep_one_of_a_kind(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates, the one with the smallest id. All texts without words are one class."""
    return forest.keep_one(docs)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, edited or not. NULL and empty texts hold none, and NULL or empty items are in none."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document with its token ids, and a hash of what they decode to. A NULL text has no ids and decodes to nothing.

    Empty tables give empty results in all stages, and texts of any length are worked on whole.
    """
    out = bpe.code_documents(docs, public_tokenizers.path(WORD_BPE))
    return out.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("quality", keep_good),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", keep_one_of_a_kind),
    ("decontamination", drop_test_items),
    ("bpe", encode),
]

ORACLE_SQL = None  # learnt scores, sketches and alignment can't be stated in SQL; the stages are tested one by one


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = read(spark, sf_dir, "documents"), shared_folder(spark)
    for i, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{i}_{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
