"""A bounded, reproducible sample of labelled documents to fit a classifier on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tranche.session import run_folder


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds`` (null for a null id)."""
    return F.crc32(doc_id.cast("string")) % folds


def training_sample(
    documents: DataFrame, labels: DataFrame, label: str, usable: Column, per_class: int
) -> DataFrame:
    """Text and ``label`` (0.0 or 1.0) of at most ``per_class`` documents of each class, written to
    the shared folder.

    Taken are the usable labelled ids with the smallest hashes. An id labelled both ways is left out,
    one labelled twice alike counts once, and of documents with the same id the least text is used.
    """
    spark = documents.sparkSession
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & usable)
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.min(label).alias("label"), F.max(label).alias("other"))
        .where("label = other")
    )
    # Two selections of bounded size, each a top-k of its class.
    picked = None
    for value in (0, 1):
        own = known.where(F.col("label") == value).orderBy(F.md5(F.col("doc_id").cast("string"))).limit(per_class)
        own = own.select("doc_id", F.lit(float(value)).alias("label"))
        picked = own if picked is None else picked.unionByName(own)
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    # At most 2 * per_class pairs of numbers are broadcast.
    sample = texts.join(F.broadcast(picked), "doc_id")
    sample = sample.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label"))
    folder = f"{run_folder(spark)}/sample"
    sample.write.parquet(folder)
    return spark.read.parquet(folder)


def balanced(sample: DataFrame) -> DataFrame:
    """Add ``weight``, so that both classes weigh the same."""
    share = sample.agg(F.avg("label")).first()[0]
    share = min(max(share or 0.0, 1e-6), 1 - 1e-6)
    return sample.withColumn("weight", F.when(F.col("label") == 1, 0.5 / share).otherwise(0.5 / (1 - share)))
