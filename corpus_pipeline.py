"""From documents to token files: five stages, each written as Parquet and read again by the next.

toxicity: documents scored as toxic go. near_duplicates: one document of each Jaccard component stays,
the one with the least id. decontamination: documents with benchmark passages go. mixing: documents
are repeated at their source's rate and shuffled; files and rows are in the shuffled order. token_files:
ids in Arrow files in the order of doc_id, not in that of the mix; one row per document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tranche.llm import decontaminate, jaccard, mixing, tokens, toxicity
from tranche.llm.catalog import table, tokenizer_definition
from tranche.llm.frames import importable
from tranche.llm.labelled import fold
from tranche.session import run_folder

#: No SQL: the toxicity model is fitted, and ids come from a tokenizer's library.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    lexicon = toxicity.learn(docs, table(spark, sf_dir, "labels"), fold(F.col("doc_id"), 5) != 0)
    return toxicity.accepted(docs, lexicon)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return jaccard.deduplicated(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    mixed, (_, position) = mixing.mix(docs, mixing.tempered(docs))
    # Sorting uses the position, so the shuffle is not pruned; files and their rows follow that order.
    return mixed.orderBy(position).select(*docs.columns)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    folder = f"{run_folder(importable(spark))}/tokens"
    tokens.write(docs, tokenizer_definition(), folder)
    return tokens.read(spark, folder)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents of ``sf_dir``."""
    folder = run_folder(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
