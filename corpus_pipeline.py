"""Training-data pipeline over ``documents``: each stage reads what the stage before it wrote.

STAGES: (name, function) pairs; a function takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return
the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from productlens.llm import decontamination, quality, simhash
from productlens.llm import queries as q
from productlens.llm.tasks import written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier scores as its query's ``predicted`` = 1."""
    model = quality.train(docs, q.table(spark, sf_dir, "labels"), folds=5)
    return quality.keep(docs, model, q.KEEP_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: 3-word shingles, fingerprints linked at 2 or fewer differing bits."""
    return simhash.representatives(docs, width=3, radius=2)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontamination.clean(docs, q.table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document that is left, with the digests of ids and decoded text."""
    return q.sentencepiece_digest(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("sentencepiece", encode),
]

#: the quality model, the near-duplicate components and the tokeniser have no SQL form; tests use brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again."""
    docs = q.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs, _ = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
