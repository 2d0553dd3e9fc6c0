"""Turning raw scores into the prediction table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tranche.functions import columns as c
from tranche.operators.ordering import assign_buckets
from tranche.schemas import PREDICTIONS

TRAIN_END = "2021-01-01"
VALIDATION_END = "2022-01-01"


def data_split(
    date: Column, train_end: str = TRAIN_END, validation_end: str = VALIDATION_END
) -> Column:
    """train before the first date, validation before the second, then test; NULL without a date."""
    return (
        F.when(date < F.lit(train_end).cast("date"), "train")
        .when(date < F.lit(validation_end).cast("date"), "validation")
        .when(date.isNotNull(), "test")
    )


def add_scores(
    loans: DataFrame,
    threshold: float,
    model_name: str,
    train_end: str = TRAIN_END,
    validation_end: str = VALIDATION_END,
) -> DataFrame:
    """Add all row-wise prediction columns to loans holding a raw ``score``.

    The published probability has six digits, and the decision uses it; metrics
    use the raw score.
    """
    probability = F.col("default_probability")
    scored = loans.withColumns(
        {
            "data_split": data_split(F.col("origination_date"), train_end, validation_end),
            "model_name": F.lit(model_name),
            "default_probability": F.bround("score", 6).cast("decimal(12,9)"),
            "operating_threshold": F.lit(threshold).cast("decimal(8,6)"),
        }
    )
    return scored.withColumns(
        {
            "predicted_default": (probability.cast("double") >= threshold).cast("smallint"),
            "risk_band": c.risk_band(probability.cast("double"), threshold),
            "term_risk_loss_proxy": c.loss_proxy(probability, F.col("ead"), F.col("lgd")),
        }
    ).withColumn("underwriting_action", c.action(F.col("predicted_default")))


def add_deciles(scored: DataFrame) -> DataFrame:
    """Risk decile over all loans, 1 = riskiest, ties in the order of the loan key."""
    cut = assign_buckets(
        scored, "default_probability", "loan_id", 10, "risk_decile", descending=True
    )
    return cut.withColumn("risk_decile", F.col("risk_decile").cast("smallint"))


def predictions(
    loans: DataFrame,
    threshold: float,
    model_name: str,
    train_end: str = TRAIN_END,
    validation_end: str = VALIDATION_END,
) -> DataFrame:
    """The prediction table of loans holding a raw ``score``."""
    scored = add_scores(loans, threshold, model_name, train_end, validation_end)
    return add_deciles(scored).select(*PREDICTIONS.columns)
