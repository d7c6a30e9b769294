"""The corpus pipeline: quality rules, near-duplicates, benchmark passages, SentencePiece ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skyquilt.llm import decontaminate, near_dup, quality, sentence_piece
from skyquilt.llm.common import new_path, table

#: Each takes (spark, docs, sf_dir). All but the last return the columns of documents.
STAGES = [
    ("quality_rules", quality.stage),
    ("near_duplicates", near_dup.stage),
    ("decontamination", decontaminate.stage),
    ("sentence_piece", sentence_piece.stage),
]

#: SQL can't express the second stage's signatures nor the last one's encoding; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
