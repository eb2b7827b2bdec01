"""A training-data pipeline over ``documents``: five stages, each an operator of the ``llm`` subpackage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's
``docs``. All but the last keep the columns of ``documents``. What each decision does:

1. quality: documents outside the importance resample go.
2. near_duplicates: of each component of texts that share 4/5 of their five-word shingles the document with the least id
   stays; rows of one id and text stay once, rows without an id stay.
3. decontamination: occurrences of benchmark windows are cut out of the text.
4. secrets: findings are replaced by a mark.
5. tokens: whole texts become token ids, with digests of the ids and of the decoded text.

Stages that change texts set ``n_chars`` anew. Null texts pass through, except that stage 1 may reject them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, decontaminate, nearcopies, resample, secrets, tokens
from tessera.llm.workspace import Workspace

#: No SQL: the stages fit models, hash with XXH64 and run a tokenizer. Tests hold them against brute force instead.
ORACLE_SQL = None


def _counted(docs: DataFrame, columns: list[str]) -> DataFrame:
    if "n_chars" not in columns:
        return docs.select(columns)
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).select(columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return resample.sampled(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return nearcopies.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), docs.columns)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _counted(secrets.redacted(docs, secrets.fit(docs)), docs.columns)


def tokenized(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(docs, tokens.default_path(), [c for c in docs.columns if c != "text"], with_ids=True)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secret_scan),
    ("tokens", tokenized),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the table after each is written to the shared folder."""
    work = Workspace(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = work.table(name, stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
