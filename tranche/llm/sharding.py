"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered in the order of their id; a keyed permutation of 0 … n-1 shuffles the numbers;
the permuted number p gives shard ``p mod shards`` and slot ``p div shards``. So shards differ by at
most one row, slots have no gaps, and where any row goes follows from its number, n and the seed.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tranche.session import run_folder

ROUNDS = 4  # double rounds
PRIME = 2_147_483_647
LAW = "rows"


def geometry(n: int) -> tuple[int, int]:
    """Radices a, b of the permuted domain: a * b >= n, and fewer than a numbers too many."""
    a = max(1, math.isqrt(max(n, 1) - 1) + 1)
    return a, max(1, -(-n // a))


def round_keys(seed: int) -> list[tuple[int, int]]:
    source = random.Random(seed)
    return [(source.randrange(1, PRIME), source.randrange(1, PRIME)) for _ in range(ROUNDS)]


def _round(x: Column, key: Column) -> Column:
    y = (x + key) % PRIME
    y = (y * y + key) % PRIME
    return (y * 48_271 + x) % PRIME


def _permute_once(x: Column, n: int, seed: int) -> Column:
    a, b = geometry(n)
    keys = F.array(*[F.struct(F.lit(p).cast("long").alias("p"), F.lit(q).cast("long").alias("q"))
                     for p, q in round_keys(seed)])

    def step(state: Column, key: Column) -> Column:
        left = (state["left"] + _round(state["right"], key["p"])) % a
        right = (state["right"] + _round(left, key["q"])) % b
        return F.struct(left.alias("left"), right.alias("right"))

    # x - x mod b is a multiple of b below 2**53, so the division is exact
    start = F.struct(((x - x % b) / b).cast("long").alias("left"), (x % b).alias("right"))
    return F.aggregate(keys, start, step, lambda s: s["left"] * b + s["right"])


def permuted(x: Column, n: int, seed: int) -> Column:
    """The permuted number of ``x`` (long, 0 … n-1).

    A number that leaves 0 … n-1 walks on along its cycle until it is back. A walk passes only
    numbers outside, each at most once, so it ends within a * b - n steps; about one row in
    sqrt(n) walks at all, the others have no steps to take.
    """
    a, b = geometry(n)
    once = _permute_once(x, n, seed)
    outside = a * b - n
    if outside == 0:
        return once
    steps = F.when(once >= n, F.sequence(F.lit(1), F.lit(outside))).otherwise(F.array().cast("array<int>"))
    return F.aggregate(steps, once, lambda at, _: F.when(at >= n, _permute_once(at, n, seed)).otherwise(at))


def numbered(rows: DataFrame, order: list[Column], folder: str) -> tuple[DataFrame, int]:
    """Add ``row_number`` from 0 in global order, and give the number of rows.

    Rows are sorted into ranges and written once, so that each range stays as it is; the number is
    the range's start plus the place in the range. The starts are as many as there are ranges.
    """
    placed = (
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__at", F.monotonically_increasing_id())
    )
    placed.write.parquet(folder)
    placed = rows.sparkSession.read.parquet(folder).select(
        *rows.columns,
        F.shiftright("__at", 33).alias("__range"),
        F.col("__at").bitwiseAND((1 << 33) - 1).alias("__at"),
    )
    starts, total = [], 0
    for part in sorted(placed.groupBy("__range").count().collect()):
        starts.append((part[0], total))
        total += part[1]
    start = rows.sparkSession.createDataFrame(starts, "__range long, __start long")
    return (
        placed.join(F.broadcast(start), "__range")
        .withColumn("row_number", F.col("__start") + F.col("__at"))
        .drop("__range", "__at", "__start"),
        total,
    )


def shard(documents: DataFrame, shards: int = 8, seed: int = 42) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, row_number.

    Size is the text's UTF-8 bytes plus 1. A null or empty text has size 1 and crc32 0. Rows are
    numbered by doc_id (nulls first), then crc32 and size; rows equal in all three are alike, so
    which of them gets which number does not show. An empty table gives no rows. Other columns of
    the input are not read. ``grown_shard`` is null: under the law of rows, one more shard moves rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    narrow = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    rows, n = numbered(narrow, order, f"{run_folder(documents.sparkSession)}/numbered")
    place = rows.withColumn("__place", permuted(F.col("row_number"), n, seed))
    return place.select(
        "doc_id", "size", "text_crc32",
        F.lit(LAW).alias("law"),
        (F.col("__place") % shards).cast("int").alias("shard"),
        F.expr(f"__place div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "row_number",
    )
