"""Cleaning: trimmed text, macro values at origination, derived loan columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tranche.functions import columns as c
from tranche.operators.ordering import assign_buckets
from tranche.session import settle, small_side

TEXT_COLUMNS = ("loan_id", "sector", "loan_type", "collateral", "initial_rating")
MACRO_COLUMNS = ("gdp_growth", "unemployment", "policy_rate", "credit_spread_bps")
REPORTED_CUTOFF = "2024-12-31"


def trim_text(loans: DataFrame) -> DataFrame:
    present = [name for name in TEXT_COLUMNS if name in loans.columns]
    return loans.withColumns({name: c.strip(name) for name in present})


def macro_at_origination(portfolio: DataFrame) -> DataFrame:
    """Macro columns renamed for the join; stops if a month occurs twice."""
    macro = settle(
        portfolio.select(
            F.col("date").alias("origination_date"),
            *[F.col(name).alias(f"origination_{name}") for name in MACRO_COLUMNS],
        )
    )
    if macro.groupBy("origination_date").count().where("count > 1").limit(1).count():
        raise ValueError("portfolio metrics hold a month more than once")
    return macro


def unmatched_months(loans: DataFrame, macro: DataFrame) -> DataFrame:
    """(origination_date, loans) of the months lacking any macro value."""
    months = loans.groupBy("origination_date").agg(F.count(F.lit(1)).alias("loans"))
    names = [f"origination_{name}" for name in MACRO_COLUMNS]
    lacking = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in names])
    return (
        months.join(small_side(macro), "origination_date", "left").where(lacking)
        .select("origination_date", "loans")
    )


def join_macro(loans: DataFrame, portfolio: DataFrame) -> DataFrame:
    """Left join on the origination month; stops if a loan finds no macro values."""
    macro = macro_at_origination(portfolio)
    lost = unmatched_months(loans, macro).orderBy("origination_date").collect()
    if lost:
        months = ", ".join(str(row["origination_date"]) for row in lost)
        raise ValueError(f"no macro values for loans of {months}")
    return loans.join(small_side(macro), "origination_date", "left")


def derive_columns(loans: DataFrame, cutoff: str = REPORTED_CUTOFF) -> DataFrame:
    """Derived columns computed row by row."""
    date = F.col("origination_date")
    loss = F.when(
        F.col("defaulted") == 1, F.coalesce("loss_given_default", F.lit(0).cast("decimal(18,2)"))
    ).otherwise(F.lit(0).cast("decimal(18,2)"))
    rate = c.ratio(F.col("el"), F.col("ead")).cast("decimal(12,9)")
    return loans.withColumns(
        {
            "origination_year": F.year(date).cast("smallint"),
            "origination_month": F.month(date).cast("smallint"),
            "origination_quarter": c.quarter_label(date),
            "default_loss_amount": loss,
            "existing_expected_loss_rate": rate,
            "credit_score_band": c.credit_score_band(F.col("credit_score")),
            "reported_maturity_is_capped": (
                F.col("maturity_date") == F.lit(cutoff).cast("date")
            ).cast("smallint"),
        }
    )


def add_ead_band(loans: DataFrame) -> DataFrame:
    """Exposure quartile over all loans, ties in the order of the loan key."""
    cut = assign_buckets(loans, "ead", "loan_id", 4, "__band")
    return cut.withColumn("ead_band", c.label_of(F.col("__band"), c.EAD_BAND_LABELS)).drop("__band")


def enrich_loans(
    loans: DataFrame, portfolio: DataFrame, cutoff: str = REPORTED_CUTOFF
) -> DataFrame:
    """Row-wise derived columns and the macro values, without the exposure band."""
    return join_macro(derive_columns(trim_text(loans), cutoff), portfolio)


def clean_loans(
    loans: DataFrame, portfolio: DataFrame, cutoff: str = REPORTED_CUTOFF
) -> DataFrame:
    # The band comes first: its passes over the loans then read two columns and no join.
    return enrich_loans(add_ead_band(trim_text(loans)), portfolio, cutoff)


def clean_sources(
    frames: dict[str, DataFrame], cutoff: str = REPORTED_CUTOFF
) -> dict[str, DataFrame]:
    """Clean loans plus the other supplied tables; writers order them by key."""
    return {**frames, "loans": clean_loans(frames["loans"], frames["portfolio"], cutoff)}
