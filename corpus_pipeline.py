"""Corpus pipeline: quality, near-duplicates, decontamination, personal data, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that the runner
writes as Parquet and reads again as the next stage's ``docs``. All but the last
return the columns of ``documents``; each works on everything its predecessor
kept and its decision takes effect:

1. quality: documents scored below the threshold go;
2. near_duplicates: one row of each group stays, the one with the smallest id
   (rows without an id come last);
3. decontaminate: documents that hold a benchmark passage go;
4. pii: personal data are masked in the text;
5. tokens: token ids, with digests of ids and of the decoded bytes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from feedrank.llm import bpe, decontaminate, pii, quality, simhash
from feedrank.llm.common import documents, stored, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# The trained stages have no SQL form; tests compare each with brute force.
ORACLE_SQL: str | None = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def near_duplicates_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_first(docs)


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.mask_documents(docs, pii.train(docs))


def tokens_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.digest_documents(docs, *bpe.public_vocabulary())


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicates_stage),
    ("decontaminate", decontaminate_stage),
    ("pii", pii_stage),
    ("tokens", tokens_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
