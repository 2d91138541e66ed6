"""A corpus pipeline of five stages; each works on all that the one before it kept.

language_id drops documents whose language model finds them foreign to every learned language (or without letters). simhash_dedup keeps
one document of each near-duplicate group. decontaminate drops contaminated documents. secret_scan replaces live-looking secrets
by a mark. byte_bpe encodes every text and hashes the ids and what they decode to.

Each function takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of `documents`. Texts leave
unchanged but for redacted secrets. Rows with a null or repeated id are kept like others.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assaymill import session
from assaymill.llm import bpe, decontaminate, language, queries, secrets, simhash


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = language.predict(docs.withColumnsRenamed(_hidden(docs)), language.learn(docs))
    return judged.where(~F.col("rejected")).drop(*language.ADDED).withColumnsRenamed({v: k for k, v in _hidden(docs).items()})


def _hidden(docs: DataFrame) -> dict[str, str]:
    """Names for input columns that the operator would replace."""
    return {c: f"_own_{c}" for c in docs.columns if c in language.ADDED}


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = decontaminate.annotate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return judged.where(~F.col("contaminated")).select(*docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secrets.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns) if "n_chars" in docs.columns else clean


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.with_tokens(docs, *queries.vocabulary(), keep_text=False)


STAGES = [("language_id", language_id), ("simhash_dedup", simhash_dedup), ("decontaminate", decontamination), ("secret_scan", secret_scan),
          ("byte_bpe", byte_bpe)]

#: Language models and BPE have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written as Parquet in the shared folder and read again."""
    folder = f"{session.checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
