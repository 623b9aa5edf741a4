"""Documents to packed training sequences, in stages that each keep what they accept.

Every stage reads what the one before it wrote. A document is a row: where stages have to name one they use a hash of
doc_id and text, so rows with a null or a repeated doc_id are documents like others. Rows equal in both count as one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm.decontamination import contaminated
from stratalake.llm.jaccard import jaccard_components
from stratalake.llm.langid import accepted
from stratalake.llm.packing import pack_documents
from stratalake.llm.parsing import without_repeats
from stratalake.llm.workers import share_package
from stratalake.sources.storage import stored

#: SQL cannot express the learned, parsing and packing stages; tests compare with brute force.
ORACLE_SQL = None

#: Share of a text's n-grams that its language must contain. Mixed and noisy prose has far more.
MIN_LANGUAGE_SCORE = 0.3
#: Passages of more than fifty words are longer in all four languages; 95 of 100 have 280 bytes or more.
PASSAGE_BYTES = 250
VOCABULARY = "byte_bpe_50k.json"
ROW = "_row_name"


def row_name() -> Column:
    return F.xxhash64("doc_id", "text")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language that the corpus has, go."""
    share_package(spark)
    return accepted(docs, MIN_LANGUAGE_SCORE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: that with the least doc_id; a null one stays only in a group of such."""
    share_package(spark)
    named = docs.withColumn(ROW, row_name())
    groups = jaccard_components(named.select(F.col(ROW).alias("doc_id"), "text"))
    groups = groups.select(F.col("doc_id").alias(ROW), "component_id").distinct()
    order = F.struct(F.col("doc_id").isNull(), "doc_id", ROW)
    kept = named.select(ROW, "doc_id").join(groups, ROW).groupBy("component_id").agg(F.min_by(ROW, order).alias(ROW))
    return named.join(kept, ROW, "left_semi").dropDuplicates([ROW]).drop(ROW)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of PASSAGE_BYTES bytes that occur more than once are cut out of all texts."""
    share_package(spark)
    return without_repeats(docs, PASSAGE_BYTES)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    named = docs.withColumn(ROW, row_name())
    found = contaminated(named.select(F.col(ROW).alias("doc_id"), "text"), benchmark)
    return named.join(found.select(F.col("doc_id").alias(ROW)).distinct(), ROW, "left_anti").drop(ROW)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids, each with its sequence and offset."""
    share_package(spark)
    return pack_documents(docs.select("doc_id", "text"), public_tokenizers.path(VOCABULARY))


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("decontaminated", decontaminated),
    ("packed", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
