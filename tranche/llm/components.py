"""Connected components of a graph given by its edges, by alternating stars.

Each round hooks every node's larger neighbours to its least neighbour, then its smaller ones, until
every edge leads from a node to the least of its component. A round is a few joins and aggregations
on edges and is written to the shared folder; nothing is gathered per node, and no side goes to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tranche.session import measured, run_folder


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b: two longs); component is the least node.

    Loops and repeated edges do no harm; without edges there are no rows.
    """
    folder = run_folder(edges.sparkSession)

    def stored(df: DataFrame, name: str) -> tuple[DataFrame, dict]:
        return measured(
            df, f"{folder}/{name}",
            check=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), wrong=F.bool_or(F.col("a") <= F.col("b")),
        )

    ordered = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    current, state = stored(ordered, "edges0")
    number = 0
    while True:
        both = current.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            current.select(F.col("b").alias("u"), F.col("a").alias("v"))
        )
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least.hint("merge"), "u")
        small = small.select(F.col("u").alias("a"), F.col("m").alias("b")).unionByName(
            small.where("v != m").select(F.col("v").alias("a"), F.col("m").alias("b"))
        )
        number += 1
        current, new = stored(small.distinct(), f"edges{number}")
        if new == state:
            return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
        state = new
