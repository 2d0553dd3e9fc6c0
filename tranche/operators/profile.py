"""Table profiles in long form: (table_name, column_name, metric, number, text)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tranche.functions.columns import exact_mean, ratio
from tranche.operators.ordering import quantile_values
from tranche.session import settle, small_side

WHOLE_TABLE = "*"


def columns_of(df: DataFrame, *kinds: type) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.NumericType)


def text_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.StringType)


def date_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.DateType, T.TimestampType, T.TimestampNTZType)


def fact(column: str, metric: str, number: Column | None = None, text: Column | None = None):
    return F.struct(
        F.lit(column).alias("column_name"),
        F.lit(metric).alias("metric"),
        (number if number is not None else F.lit(None)).cast("double").alias("number"),
        (text if text is not None else F.lit(None)).cast("string").alias("text"),
    )


def stacked(row: DataFrame, facts: list[Column]) -> DataFrame:
    """One row per fact from a one-row aggregate."""
    return row.select(F.explode(F.array(*facts)).alias("fact")).select("fact.*")


def long_form(df: DataFrame, columns: list[str], kind: str) -> DataFrame:
    """(column_name, value) with one row per column and input row, NULLs left out."""
    pairs = F.array(
        *[
            F.struct(F.lit(name).alias("column_name"), F.col(name).cast(kind).alias("value"))
            for name in columns
        ]
    )
    return df.select(F.explode(pairs).alias("pair")).select("pair.*").where("value IS NOT NULL")


def shape_and_missing(df: DataFrame) -> DataFrame:
    """Row and column counts, types, and missing values of the columns that have any."""
    row = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(name).isNull()).alias(f"missing_{name}") for name in df.columns],
    )
    facts = [
        fact(WHOLE_TABLE, "rows", F.col("rows")),
        fact(WHOLE_TABLE, "columns", F.lit(len(df.columns))),
    ]
    facts += [fact(n, "data_type", text=F.lit(kind)) for n, kind in df.dtypes]
    facts += [fact(n, "missing_values", F.col(f"missing_{n}")) for n in df.columns]
    return stacked(row, facts).where("metric <> 'missing_values' OR number > 0")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in every column.

    Equal rows combine before the shuffle, so a row that occurs very often is a few there.
    """
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("n"))
    extra = copies.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n"))
    return stacked(extra, [fact(WHOLE_TABLE, "duplicate_rows", F.col("n"))])


def numeric_ranges(df: DataFrame) -> DataFrame:
    """Min, max and mean of every numeric column, in one pass."""
    names = numeric_columns(df)
    row = df.agg(
        *[F.min(n).alias(f"min_{n}") for n in names],
        *[F.max(n).alias(f"max_{n}") for n in names],
        *[exact_mean(F.col(n)).alias(f"mean_{n}") for n in names],
    )
    facts = [
        fact(n, metric, F.col(f"{metric}_{n}")) for n in names for metric in ("min", "max", "mean")
    ]
    return stacked(row, facts).where("number IS NOT NULL")


def quartiles(df: DataFrame) -> DataFrame:
    """(column_name, n, q1, q2, q3) exact, for all numeric columns together."""
    values = long_form(df, numeric_columns(df), "double")
    return quantile_values(values, "value", [0.25, 0.5, 0.75], ["column_name"])


def medians_and_outliers(df: DataFrame, cuts: DataFrame | None = None) -> DataFrame:
    """Median, and the count outside 1.5 × IQR of the quartiles.

    With an IQR of zero every value other than the quartile counts. ``cuts``: quartiles known already,
    for instance merged from stored sketches (``sketches.merged_quantiles``); exact ones if not given.
    """
    cuts = settle(quartiles(df) if cuts is None else cuts)
    iqr = F.col("q3") - F.col("q1")
    value = F.col("value")
    outside = (value < F.col("q1") - 1.5 * iqr) | (value > F.col("q3") + 1.5 * iqr)
    flagged = F.when(iqr == 0, value != F.col("q1")).otherwise(outside)
    outliers = (
        long_form(df, numeric_columns(df), "double")
        .join(small_side(cuts), "column_name")
        .groupBy("column_name")
        .agg(F.count_if(flagged).alias("number"))
    )
    none = F.lit(None).cast("string").alias("text")
    return cuts.select(
        "column_name", F.lit("median").alias("metric"), F.col("q2").alias("number"), none
    ).unionByName(
        outliers.select(
            "column_name",
            F.lit("iqr_outliers").alias("metric"),
            F.col("number").cast("double"),
            none,
        )
    )


def date_ranges(df: DataFrame) -> DataFrame:
    """First and last date of every date column, as ISO text."""
    names = date_columns(df)
    row = df.agg(
        *[F.min(n).cast("date").alias(f"min_{n}") for n in names],
        *[F.max(n).cast("date").alias(f"max_{n}") for n in names],
    )
    facts = [fact(n, m, text=F.col(f"{m}_{n}")) for n in names for m in ("min", "max")]
    return stacked(row, facts).where("text IS NOT NULL")


def distinct_counts(df: DataFrame) -> DataFrame:
    """Distinct values of every text column, in one shuffle over (column, value)."""
    names = text_columns(df)
    counts = (
        long_form(df, names, "string").distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("n"))
    )
    listed = df.sparkSession.createDataFrame([(name,) for name in names], "column_name string")
    return listed.join(counts, "column_name", "left").select(
        "column_name",
        F.lit("unique_values").alias("metric"),
        F.coalesce("n", F.lit(0)).cast("double").alias("number"),
        F.lit(None).cast("string").alias("text"),
    )


def profile_table(df: DataFrame, name: str) -> DataFrame:
    """All of the above for one table."""
    parts = [shape_and_missing(df), duplicate_rows(df)]
    if numeric_columns(df):
        parts += [numeric_ranges(df), medians_and_outliers(df)]
    if date_columns(df):
        parts.append(date_ranges(df))
    if text_columns(df):
        parts.append(distinct_counts(df))
    joined = reduce(DataFrame.unionByName, parts)
    return joined.select(F.lit(name).alias("table_name"), "*")


def portfolio_summary(loans: DataFrame) -> DataFrame:
    """One row: counts, class balance, totals and dates of the clean loans."""
    bad = F.count_if(F.col("defaulted") == 1)
    good = F.count_if(F.col("defaulted") == 0)
    return loans.agg(
        F.count(F.lit(1)).alias("clean_loan_rows"),
        F.count_distinct("loan_id").alias("unique_loans"),
        F.count_distinct("sector").alias("sectors"),
        good.alias("non_defaults"),
        bad.alias("defaults"),
        exact_mean(F.col("defaulted")).alias("default_rate"),
        ratio(good, bad).alias("negative_to_positive_ratio"),
        F.sum("ead").alias("total_ead"),
        F.sum("el").alias("total_existing_expected_loss"),
        F.min("origination_date").alias("origination_date_min"),
        F.max("origination_date").alias("origination_date_max"),
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
