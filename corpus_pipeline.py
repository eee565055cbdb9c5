"""A corpus from raw documents: toxic ones out, one of each near-duplicate group, no benchmark text,
pseudonyms for personal values, sources mixed to their targets."""

from __future__ import annotations

import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ruleframe.llm import mixing, pii, simhash, toxicity, winnowing  # noqa: E402
from ruleframe.llm.queries import TOXIC, pii_key, toxicity_model  # noqa: E402
from ruleframe.llm.words import free_name  # noqa: E402
from ruleframe.session import delete_path, fresh_path, run_folder, session_settings  # noqa: E402


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold; the model learns from the labelled ones among them."""
    model = toxicity_model(spark, docs, sf_dir)
    score = free_name(docs.columns, "_score")
    return toxicity.score_toxicity(docs, model, name=score).where(F.col(score) < TOXIC).drop(score)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates."""
    return simhash.drop_near_duplicates(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    return winnowing.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal values replaced by pseudonyms of the same format."""
    count = free_name(docs.columns, "_private")
    return pii.pseudonymise_documents(docs, pii_key(spark), name=count).drop(count)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, with its size, source size, target and copy number."""
    return mixing.mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pseudonyms", pseudonymise),
    ("mixing", mix),
]
#: Rows of an Arrow batch: of Spark's 10,000 a worker and its executor would hold whole texts several times over.
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 2_000}
#: The SimHash and Feistel stages cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written as Parquet and read again by the next one.

    What a stage writes on its way goes when its result is stored, and that when the next one's is.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, step in STAGES:
        path = fresh_path(spark, name)
        with run_folder(spark), session_settings(spark, BATCH):
            result = step(spark, docs, sf_dir)
            result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        if before is not None:
            delete_path(spark, before)
        before = path
    return docs
