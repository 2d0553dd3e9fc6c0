"""Global order without a one-task window: running totals, order statistics, buckets.

A window without partitions, or one partitioned by a handful of sectors, sends a
large share of all rows to one task. Everything here sorts with range
partitioning instead, and keeps only per-partition summaries small.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tranche.session import settle, small_side

RUN = "__run"
# Half width of a bracket around a wanted quantile, and the accuracy asked of the
# sketch that places it. They decide how many rows get sorted, never the result.
BRACKET = 0.001
ACCURACY = 2_000
# Rows that one task may sort; more are range-partitioned.
WINDOW_ROWS = 500_000


def running_totals(
    df: DataFrame,
    groups: Sequence[str],
    order: Sequence[Column],
    values: Sequence[str],
) -> DataFrame:
    """Add ``cum_<value>``: the sum of ``value`` up to the row, inside its group.

    ``order`` must be unique inside a group. Rows are range-partitioned by group
    and order and settled, so each sorted partition ("run") is fixed. Sums per
    run give every run its starting total; the window only spans one run.
    """
    groups = list(groups)
    runs = settle(
        df.orderBy(*groups, *order).withColumn(RUN, F.spark_partition_id())
    )
    earlier = Window.partitionBy(*groups).orderBy(RUN).rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per run and group.
    starts = runs.groupBy(*groups, RUN).agg(*[F.sum(v).alias(v) for v in values]).select(
        *groups,
        RUN,
        *[F.coalesce(F.sum(v).over(earlier), F.lit(0)).alias(f"__start_{v}") for v in values],
    )
    inside = (
        Window.partitionBy(*groups, RUN)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    summed = runs.select("*", *[F.sum(v).over(inside).alias(f"__sum_{v}") for v in values])
    return summed.join(small_side(starts), [*groups, RUN]).select(
        *df.columns,
        *[(F.col(f"__start_{v}") + F.col(f"__sum_{v}")).alias(f"cum_{v}") for v in values],
    )


def order_statistics(
    df: DataFrame,
    key: str,
    fractions: Sequence[float],
    ranks: Callable[[Column], Sequence[Column]],
    groups: Sequence[str] = (),
    tie: str | None = None,
    bracket: float = BRACKET,
) -> DataFrame:
    """Exact order statistics: (groups…, k, n, key[, tie]) for each wanted rank.

    ``ranks(n)`` gives the 1-based rank wanted for each entry of ``fractions``,
    its approximate place. A quantile sketch brackets each place, one aggregate
    counts the rows outside the brackets, and only rows inside them are sorted.
    Equal keys collapse to one row first unless ``tie`` orders them.
    """
    wanted = len(fractions)
    if not groups:
        df = df.withColumn("__all", F.lit(1))
    names = list(groups) or ["__all"]
    rows = df.where(F.col(key).isNotNull()).select(*names, key, *([tie] if tie else []))
    probes = [min(max(f + d, 0.0), 1.0) for f in fractions for d in (-bracket, bracket)]
    summary = settle(
        rows.groupBy(*names).agg(
            F.count(F.lit(1)).alias("n"),
            F.percentile_approx(key, probes, ACCURACY).alias("__cuts"),
        )
    )
    found = _pick(rows, summary, names, key, tie, wanted, ranks, bool(groups))
    if found.count() < wanted * summary.count():
        # A bracket missed its rank: sort every row instead.
        widest = summary.withColumn(
            "__cuts", F.transform("__cuts", lambda _: F.lit(None).cast(rows.schema[key].dataType))
        )
        found = _pick(rows, widest, names, key, tie, wanted, ranks, bool(groups))
    return found.drop(*([] if groups else ["__all"]))


def _pick(rows, summary, names, key, tie, wanted, ranks, grouped) -> DataFrame:
    value = F.col(key)
    cuts = [
        (F.element_at("__cuts", 2 * i + 1), F.element_at("__cuts", 2 * i + 2)) for i in range(wanted)
    ]
    # Missing cuts mean "no bracket": then every row counts as inside one.
    inside = reduce(
        lambda a, b: a | b,
        [F.coalesce((value >= low) & (value <= high), F.lit(True)) for low, high in cuts],
    )
    gap = reduce(
        lambda a, b: a + b, [F.coalesce((value > high).cast("int"), F.lit(0)) for _, high in cuts]
    )
    # Without groups the summary is one row.
    side = small_side(summary) if grouped else F.broadcast(summary)
    tagged = rows.join(side, names).select(
        *names, "n", inside.alias("__inside"), gap.alias("__gap"), key, *([tie] if tie else [])
    )
    # One pass: outside the brackets rows are only counted, per gap between them. Those of a gap
    # come before the bracketed rows of the same gap.
    bracketed = [F.when(F.col("__inside"), F.col(c)).alias(c) for c in [key, *([tie] if tie else [])]]
    counted = settle(
        tagged.groupBy(*names, "n", "__gap", "__inside", *bracketed).agg(F.count(F.lit(1)).alias("__rows"))
    )
    order = [F.col("__gap"), F.col("__inside"), F.col(key), *([F.col(tie)] if tie else [])]
    if counted.count() <= WINDOW_ROWS:
        # Few enough for one task; the result is the same either way.
        ranked = counted.withColumn(
            "cum___rows",
            F.sum("__rows").over(
                Window.partitionBy(*names).orderBy(*order)
                .rowsBetween(Window.unboundedPreceding, Window.currentRow)
            ),
        )
    else:
        ranked = running_totals(counted, names, order, ["__rows"])
    last = F.col("cum___rows")
    first = last - F.col("__rows")
    hits = F.array(
        *[
            F.when((rank.cast("bigint") > first) & (rank.cast("bigint") <= last), F.lit(k))
            for k, rank in enumerate(ranks(F.col("n")), start=1)
        ]
    )
    return settle(
        ranked.where("__inside").select(
            *names, F.explode(F.array_compact(hits)).alias("k"), "n", key, *([tie] if tie else [])
        )
    )


def quantile_values(
    df: DataFrame, value: str, fractions: Sequence[float], groups: Sequence[str] = ()
) -> DataFrame:
    """Exact quantiles with linear interpolation: (groups…, n, q1, q2, …)."""

    def ranks(n: Column) -> list[Column]:
        places = [(n - 1).cast("double") * f for f in fractions]
        return [1 + edge for p in places for edge in (F.floor(p), F.ceil(p))]

    both = [f for f in fractions for _ in range(2)]
    names = list(groups) or ["__all"]
    if not groups:
        df = df.withColumn("__all", F.lit(1))
    found = order_statistics(df, value, both, ranks, names)
    at = [F.max(F.when(F.col("k") == k, F.col(value))) for k in range(1, 2 * len(fractions) + 1)]
    outputs = []
    for i, f in enumerate(fractions):
        low, high = at[2 * i].cast("double"), at[2 * i + 1].cast("double")
        place = (F.max("n") - 1).cast("double") * f
        outputs.append((low + (high - low) * (place - F.floor(place))).alias(f"q{i + 1}"))
    return (
        found.groupBy(*names).agg(F.max("n").alias("n"), *outputs)
        .drop(*([] if groups else ["__all"]))
    )


def rank_cut_upper(buckets: int) -> Callable[[Column], list[Column]]:
    """Last rank of buckets 1 … q-1 when ranks 1 … n are cut at their own quantiles."""
    return lambda n: [1 + F.floor((n - 1) * k / F.lit(buckets)) for k in range(1, buckets)]


def ntile_upper(buckets: int) -> Callable[[Column], list[Column]]:
    """Last rank of buckets 1 … q-1 of NTILE: larger buckets come first."""
    return lambda n: [
        F.least(n, k * F.floor(n / F.lit(buckets)) + F.least(F.lit(k), n % buckets))
        for k in range(1, buckets)
    ]


def assign_buckets(
    df: DataFrame,
    key: str,
    tie: str,
    buckets: int,
    output: str,
    upper: Callable[[int], Callable[[Column], Sequence[Column]]] = rank_cut_upper,
    groups: Sequence[str] = (),
    descending: bool = False,
) -> DataFrame:
    """Add the bucket 1 … q of each row in the order (key, tie).

    Only the q-1 boundary rows per group are looked up; each row is then placed
    by comparing it with them, so ``df`` itself is neither sorted nor shuffled.
    """
    names = list(groups) or ["__all"]
    work = df if groups else df.withColumn("__all", F.lit(1))
    work = work.withColumn("__key", -F.col(key) if descending else F.col(key))
    fractions = [k / buckets for k in range(1, buckets)]
    edges = order_statistics(work, "__key", fractions, upper(buckets), names, tie)
    bounds = settle(
        edges.groupBy(*names).agg(
            *[
                F.max(F.when(F.col("k") == k, F.struct("__key", tie))).alias(f"__edge{k}")
                for k in range(1, buckets)
            ]
        )
    )
    row = F.struct("__key", tie)
    passed = reduce(
        lambda a, b: a + b, [(row > F.col(f"__edge{k}")).cast("int") for k in range(1, buckets)]
    )
    side = small_side(bounds) if groups else F.broadcast(bounds)
    return work.join(side, names, "left").select(
        *df.columns, F.when(F.col("__key").isNotNull(), 1 + passed).alias(output)
    )


def top_per_group(
    df: DataFrame, groups: Sequence[str], order: Sequence[Column], k: int, output: str
) -> DataFrame:
    """First ``k`` rows of each group; Spark drops the rest before the shuffle."""
    place = F.row_number().over(Window.partitionBy(*groups).orderBy(*order))
    return df.withColumn(output, place).where(F.col(output) <= k)


def seeded_sample(df: DataFrame, key: str, rows: int, seed: int) -> DataFrame:
    """The ``rows`` rows with the smallest seeded hash of their key."""
    mark = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")).cast("binary"))
    return df.orderBy(mark, key).limit(rows)


def in_listed_order(df: DataFrame, column: str, values: Sequence[str]) -> DataFrame:
    """One row per listed value, in that order; values without rows stay, as NULLs."""
    spark = df.sparkSession
    listed = spark.createDataFrame(
        list(enumerate(values, start=1)), f"__place int, {column} string"
    )
    return F.broadcast(listed).join(df, column, "left").orderBy("__place").drop("__place")
