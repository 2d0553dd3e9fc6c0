"""Mixing sources to target weights by Poisson replication and a global shuffle.

A source's rate is the number of times its documents are to occur on average, so that its bytes get
their share of the budget. Every document draws its own count: a number in [0, 1) from a hash of the
seed and its id, put through the inverse of the Poisson distribution with that rate. Documents are
exploded by their counts, and the copies take the order of another hash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tranche.llm.frames import fresh
from tranche.session import small_side

SEED = 42
#: A rate above this is split into equal parts, whose counts add up (a sum of Poisson counts is one).
PART_RATE = 16.0
#: Steps of the inverse; beyond them lies less than 2 ** -53 of a part.
STEPS = 80
#: Hexadecimal digits of the order's hash that name a bucket of the shuffle: 65,536 buckets.
BUCKET_DIGITS = 4


def _hash(*parts: Column | str | int) -> Column:
    texts = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat_ws(":", *[F.coalesce(t, F.lit("")) for t in texts]).cast("binary"))


def uniform(*parts: Column | str | int) -> Column:
    """A number in [0, 1) of 52 bits from a hash."""
    return F.conv(F.substring(_hash(*parts), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def cumulative(rate: Column) -> Column:
    """P(X <= k) for k = 0 … STEPS of a Poisson distribution."""
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("all"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * rate / k
        return F.struct(p.alias("p"), F.concat(state["all"], F.array(F.element_at(state["all"], -1) + p)).alias("all"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step, lambda s: s["all"])


def sizes(documents: DataFrame) -> DataFrame:
    """(source, size): UTF-8 bytes of the texts plus 1 for each document."""
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + 1
    return documents.groupBy("source").agg(F.sum(size).alias("size"))


def tempered(documents: DataFrame) -> DataFrame:
    """(source, weight): weights that grow with the square root of a source's size."""
    return sizes(documents).select("source", F.floor(F.sqrt("size")).cast("double").alias("weight"))


def rates(documents: DataFrame, weights: DataFrame, budget: int | None = None) -> DataFrame:
    """(source, rate): how often a source's documents occur on average. A source without weight has
    rate 0, a null source is one like others. ``budget``: bytes of the mix, by default those there are."""
    own = weights.select(F.col("source").alias("__source"), F.col("weight").cast("double").alias("weight"))
    known = sizes(documents)
    joined = known.join(own, F.col("source").eqNullSafe(F.col("__source")), "left")
    joined = joined.select("source", "size", F.greatest(F.coalesce("weight", F.lit(0.0)), F.lit(0.0)).alias("weight"))
    # One row of sums
    total = joined.agg(F.sum("weight").alias("all_weight"), F.sum("size").alias("all_size"))
    size = F.lit(budget).cast("double") if budget is not None else F.col("all_size").cast("double")
    rate = (F.col("weight") / F.col("all_weight")) * (size / F.col("size").cast("double"))
    return joined.crossJoin(F.broadcast(total)).select(
        "source", F.when(F.col("all_weight") > 0, rate).otherwise(0.0).alias("rate")
    )


def mix(
    documents: DataFrame, weights: DataFrame, budget: int | None = None, seed: int = SEED
) -> tuple[DataFrame, list[str]]:
    """The mixed documents: each copy with two more columns (names returned), ``copy`` from 1 and
    ``position``, its place from 0 in the global order.

    Counts and order depend on the seed, doc_id and copy only, so repeated rows of an id get the same
    count; copies of the same id and number are ordered by text and source, and those equal in
    all are alike. Null ids hash as empty text. An empty table gives no rows.
    """
    taken = documents.columns
    names = {n: fresh(n, taken) for n in ("copy", "position", "__copies", "__bucket", "__key", "__start", "__source")}
    copy, position, copies, bucket, key, start, source = names.values()
    part = F.greatest(F.ceil(F.col("rate") / PART_RATE), F.lit(1)).cast("int")
    table = rates(documents, weights, budget).withColumn("parts", part)
    table = table.select(
        F.col("source").alias(source), "parts", cumulative(F.col("rate") / F.col("parts")).alias("steps")
    )
    # Sources are few as a rule; if a count does not prove it, the planner joins and splits large ones.
    table = small_side(table)

    def counted(df: DataFrame) -> DataFrame:
        joined = df.join(table, F.col("source").eqNullSafe(F.col(source)))
        # Each part's number is drawn once, then compared with every step.
        numbers = F.transform(F.sequence(F.lit(1), F.col("parts")), lambda i: uniform("count", seed, F.col("doc_id"), i))
        draw = F.aggregate(numbers, F.lit(0), lambda n, u: n + F.size(F.filter("steps", lambda c: u >= c)))
        drawn = joined.withColumn(copies, draw).where(F.col(copies) > 0)
        exploded = drawn.select(*[F.col(f"`{c}`") for c in df.columns], F.explode(F.sequence(F.lit(1), copies)).alias(copy))
        keyed = exploded.withColumn(key, _hash("order", seed, F.col("doc_id"), F.col(copy)))
        return keyed.withColumn(bucket, F.substring(key, 1, BUCKET_DIGITS))

    # Where each bucket begins: as many rows as there are buckets, at any size of the input.
    filled = counted(documents.select("doc_id", "source")).groupBy(bucket).agg(F.count("*").alias("n"))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = filled.select(bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias(start))
    own = Window.partitionBy(bucket).orderBy(key, "doc_id", copy, "text", "source")
    rows = counted(documents).withColumn(position, F.row_number().over(own) - 1)
    rows = rows.join(F.broadcast(starts), bucket).withColumn(position, F.col(start) + F.col(position))
    return rows.select(*[F.col(f"`{c}`") for c in taken], F.col(copy).cast("long").alias(copy), position), [copy, position]
