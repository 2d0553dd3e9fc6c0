"""Mergeable sketches: approximate quantiles (KLL) and distinct counts (HLL) per partition of a table.

A sketch is stored for each column and partition value. The whole table's quantiles and distinct counts
come from merging the stored sketches, so a new or corrected year is read alone and no other year is
read again. The exact versions in ``profile`` stay the default.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tranche.operators.profile import numeric_columns, text_columns
from tranche.sources.sinks import replace_partitions

#: Size of a quantile sketch, and the share of all rows by which a quantile's rank may be off. The
#: sketch's own error at 99 % confidence is about a third of it.
KLL_K = 800
RANK_ERROR = 0.01
#: Binary logarithm of a distinct sketch's buckets, and the relative error allowed (five deviations).
HLL_LOG_K = 14
DISTINCT_ERROR = 0.04


def sketched(df: DataFrame, by: str) -> DataFrame:
    """(by, column_name, quantiles, distinct): one sketch for each column and value of ``by``.

    Numeric columns have quantiles, text columns distinct values; the other cell is NULL. NULLs are in
    no sketch. One pass, combined before the shuffle.
    """
    numbers = [n for n in numeric_columns(df) if n != by]
    texts = [n for n in text_columns(df) if n != by]
    wide = df.groupBy(by).agg(
        *[F.kll_sketch_agg_double(F.col(n).cast("double"), F.lit(KLL_K)).alias(f"of_{n}") for n in numbers],
        *[F.hll_sketch_agg(n, F.lit(HLL_LOG_K)).alias(f"of_{n}") for n in texts],
    )
    none = F.lit(None).cast("binary")
    cells = [
        F.struct(
            F.lit(n).alias("column_name"),
            (F.col(f"of_{n}") if n in numbers else none).alias("quantiles"),
            (F.col(f"of_{n}") if n in texts else none).alias("distinct"),
        )
        for n in [*numbers, *texts]
    ]
    return wide.select(by, F.inline(F.array(*cells)))


def store_sketches(df: DataFrame, folder: str, by: str, table: str = "sketches") -> DataFrame:
    """Store the sketches of the partitions that ``df`` has rows of, in place of their earlier ones, and
    return those of all partitions."""
    return replace_partitions(sketched(df, by), folder, table, by)


def merged_quantiles(sketches: DataFrame, fractions: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """(column_name, n, q1, q2, …) of all sketches together; NULL where a column has no value.

    With the default fractions the result can stand in for the exact quartiles of a profile.
    """
    merged = sketches.where("quantiles IS NOT NULL").groupBy("column_name").agg(
        F.kll_merge_agg_double("quantiles", F.lit(KLL_K)).alias("merged")
    )
    n = F.kll_sketch_get_n_double("merged")
    found = [
        F.when(n > 0, F.kll_sketch_get_quantile_double("merged", F.lit(float(f)))).alias(f"q{i}")
        for i, f in enumerate(fractions, start=1)
    ]
    return merged.select("column_name", n.alias("n"), *found)


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """(column_name, number): distinct values of each text column over all sketches."""
    return sketches.where("distinct IS NOT NULL").groupBy("column_name").agg(
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).cast("double").alias("number")
    )
