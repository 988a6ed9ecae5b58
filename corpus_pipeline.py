"""From raw documents to packed sequences: quality, repeated lines, near copies, test passages, packing.

Every stage takes the documents that the one before kept, as a table read back from the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidebook.llm import base, decontaminate, line_dedup, ngram_join, packing, quality

#: Near copies: sets of five words with a Jaccard similarity of 0.8 and more.
SHINGLE, PERCENT = 5, 80


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label model rejects go."""
    model = quality.fit(docs, base.table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Long lines of five and more documents stay only in the one with the largest id."""
    kept = line_dedup.drop_lines(docs, line_dedup.LineIndex.build(docs, sieve=False))
    return kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id."""
    return ngram_join.representatives(docs, SHINGLE, PERCENT)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth or more of their words in test passages go."""
    found = decontaminate.find(docs, base.table(spark, sf_dir, "benchmark"), carry=tuple(docs.columns))
    return decontaminate.judge(found).filter("not contaminated").select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents as pieces of full sequences."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: The quality and near-copy stages have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = base.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = base.materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
