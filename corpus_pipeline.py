"""From raw documents to a training file, in stages that each write a table for the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgermill.llm import lsa, minmax, mixture, rules, simple8b
from ledgermill.llm.queries import REST, WEIGHTS, table, tokenizer
from ledgermill.llm.shared import stored


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without their failing lines."""
    return rules.clean(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest doc_id."""
    return minmax.without_near_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, nor a paraphrase of one."""
    return lsa.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents by the target weights of their sources, in shuffled order."""
    return mixture.mix(docs, WEIGHTS, REST).select("d.*")


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the token files hold of each document, in the order of the mixture: doc_id, start, n_tokens, ids_crc32."""
    return simple8b.read_digests(simple8b.write_ids(mixture.placed(docs), tokenizer(), order="place"))


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix), ("token_files", token_files)]

#: Near duplicates, latent semantic retrieval and token files are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each stage's rows are written as Parquet and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs)
    return docs
