"""A training-data pipeline over ``documents``: quality, near-duplicates, secrets, mixing, packing.

Every stage takes (spark, docs, sf_dir), where docs has the columns of ``documents`` (doc_id, text, lang, source,
n_chars), and returns a DataFrame that is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitgraph.llm.common import shared_dir
from visitgraph.llm.minhash import drop_near_duplicates
from visitgraph.llm.mixing import mixed_documents
from visitgraph.llm.packing import pack_documents, tokenizer_path
from visitgraph.llm.quality import fit_quality, score_documents
from visitgraph.llm.secrets import redact_secrets

#: Documents scored under this go.
LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents whose quality score is at least ``LEAST_QUALITY``; the model learns from ``labels``."""
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_documents(docs, model, score_col="_score").where(F.col("_score") >= LEAST_QUALITY).drop("_score")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group alike by 0.8 or more over five-word shingles."""
    return drop_near_duplicates(docs, width=5, percent=80)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Masks secrets in every text; no document goes."""
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix to target weights takes it: not at all, once or twice."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens, with their token ids."""
    return pack_documents(docs, tokenizer_path())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secrets", secrets), ("mixing", mixing), ("packing", packing)]

#: SQL can express neither the classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{shared_dir(spark)}/stage-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
