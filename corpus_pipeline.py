"""Training corpus from ``documents``: five stages, each over all that the one before kept.

1. toxicity: documents that the network rejects go.
2. near_duplicates: one document of each group of near copies stays.
3. decontamination: documents that contain a benchmark item go.
4. secrets: spans are replaced by a mark; ``n_chars`` follows the text.
5. mixing: how often each document is taken, so that sources meet their target words.

Stages 1 to 4 return the columns of their input. Rows without doc_id are kept by the
stages that compare documents. Stage 5 returns (doc_id, source, size, source_size,
target, copies, taken) for the documents that are taken at least once.
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.llm.decontamination import without_contaminated
from rillmark.llm.frames import given, stored
from rillmark.llm.jaccard import one_of_each_group
from rillmark.llm.mixing import mix_sources
from rillmark.llm.registry import with_package
from rillmark.llm.secrets import MARK, redacted
from rillmark.llm.toxicity import without_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_toxic(docs, given(with_package(spark), sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Five-word shingles, Jaccard similarity of 0.8 or more; the smallest doc_id of a group stays."""
    with_package(spark)
    return one_of_each_group(docs, n_words=5, threshold=Fraction(8, 10))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return without_contaminated(docs, given(with_package(spark), sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    with_package(spark)
    clean = redacted(docs)
    return clean.withColumn("n_chars", F.when(F.contains("text", F.lit(MARK)), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_sources(docs).where("copies > 0")


STAGES = [
    ("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("secrets", secrets), ("mixing", mixing),
]

#: Trained weights and random rounding have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = given(with_package(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"corpus-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
