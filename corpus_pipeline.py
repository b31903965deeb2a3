"""Corpus pipeline: quality classifier, line dedup, n-gram Jaccard join, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept.  All but
the last return the columns of ``documents``; n_chars follows the text where a stage cuts it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunelift.llm.common import let_workers_import, read_table
from tunelift.llm.jaccard import one_of_each_group
from tunelift.llm.line_dedup import dedup_lines
from tunelift.llm.mixing import mixed_documents
from tunelift.llm.packing import pack, token_pieces
from tunelift.llm.quality import THRESHOLD, fit, score, training_labels
from tunelift.session import materialize


def _measured(before: DataFrame, after: DataFrame) -> DataFrame:
    if "n_chars" in before.columns:
        after = after.withColumn("n_chars", F.length("text").cast(before.schema["n_chars"].dataType))
    return after


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of 0.3 or more)."""
    let_workers_import(spark)
    model = fit(docs, training_labels(read_table(spark, sf_dir, "labels")))
    return score(docs, model).where(F.col("quality_score") >= THRESHOLD).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated lines; a document goes if no word is left, or if only short lines
    are left and its whole normalised text is that of a document that stays."""
    let_workers_import(spark)
    return _measured(docs, dedup_lines(docs, drop_emptied=True))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that shares 0.8 or more of its 5-word shingles."""
    let_workers_import(spark)
    return one_of_each_group(docs, k=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: a row for each whole repetition, a cut text for a fraction."""
    let_workers_import(spark)
    return _measured(docs, mixed_documents(docs))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens, placed in sequences."""
    let_workers_import(spark)
    return pack(token_pieces(docs))


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates),
          ("mixing", mixing), ("packing", packing)]
ORACLE_SQL = None  # trained scores, SimHash tiles and tokenisers are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; every stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
