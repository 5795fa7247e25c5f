"""A corpus pipeline of five operators; each stage takes all that its predecessor kept.

run(spark, sf_dir) applies the stages to the documents table. All but the last return the columns of documents; the last
adds what the mix takes of each document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import decontaminate, mixing, neardup, pii, quality
from strata.llm.common import table
from strata.session import cut

#: A document stays if its score is at least this.
QUALITY = 0.7


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier, fitted on the labelled documents; what it rejects goes."""
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.score_documents(docs, model).filter(F.col("score") >= QUALITY).drop("score")


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near-duplicate classes; the document of the smallest id stays."""
    return neardup.distinct_documents(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; no document goes."""
    return pii.redact(docs, pii.train(docs))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, and how often."""
    return mixing.mixed_documents(docs)


STAGES = [
    ("quality", keep_good),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", drop_contaminated),
    ("personal_data", hide_personal_data),
    ("mixing", mix_sources),
]

#: A trained classifier, signatures and spans are no SQL; the tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
