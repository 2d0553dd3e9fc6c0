"""Scalar expressions of the loan model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Labels and edges of the bands and the order of the rating scale.
CREDIT_SCORE_EDGES = (299, 579, 669, 739, 799, 850)
CREDIT_SCORE_LABELS = ("Poor", "Fair", "Good", "Very Good", "Exceptional")
EAD_BAND_LABELS = ("Q1 Small", "Q2 Medium", "Q3 Large", "Q4 Very Large")
RISK_BAND_LABELS = ("Low", "Moderate", "High", "Very High")
RATING_SCALE = ("AAA", "AA", "A", "BBB", "BB", "B", "CCC")
REVIEW_ACTION = "Manual Review"
APPROVE_ACTION = "Approve"


def strip(column: str | Column) -> Column:
    """Remove all leading and trailing whitespace, not just spaces."""
    return F.regexp_replace(column, r"^\s+|\s+$", "")


def quarter_label(date: Column) -> Column:
    """``2015Q1`` for any day of that quarter."""
    return F.concat(F.year(date).cast("string"), F.lit("Q"), F.quarter(date).cast("string"))


def month_start(date: str | Column) -> Column:
    return F.trunc(date, "MM")


def right_closed_band(value: Column, edges: Sequence[float | int], labels: Sequence[str]) -> Column:
    """Label of the interval ``(edge[i], edge[i+1]]`` holding ``value``; NULL outside."""
    chain = F.when(value <= edges[0], F.lit(None).cast("string"))
    for upper, label in zip(edges[1:], labels):
        chain = chain.when(value <= upper, label)
    return chain


def credit_score_band(score: Column) -> Column:
    return right_closed_band(score, CREDIT_SCORE_EDGES, CREDIT_SCORE_LABELS)


def label_of(bucket: Column, labels: Sequence[str]) -> Column:
    """The label of bucket 1, 2, …; NULL for any other bucket."""
    return F.element_at(F.array(*[F.lit(label) for label in labels]), bucket.cast("int"))


def risk_band(probability: Column, threshold: float) -> Column:
    """Band relative to the operating threshold; a score equal to it is still Moderate."""
    low = min(0.05, threshold / 2)
    high = max(0.30, threshold * 1.75)
    return (
        F.when(probability <= low, RISK_BAND_LABELS[0])
        .when(probability <= threshold, RISK_BAND_LABELS[1])
        .when(probability <= high, RISK_BAND_LABELS[2])
        .when(probability.isNotNull(), RISK_BAND_LABELS[3])
    )


def action(predicted: Column) -> Column:
    return F.when(predicted == 1, REVIEW_ACTION).otherwise(APPROVE_ACTION)


def loss_proxy(probability: Column, ead: Column, lgd: Column) -> Column:
    """probability × exposure × loss rate in cents, exact up to the one rounding."""
    product = (
        probability.cast("decimal(8,6)") * ead.cast("decimal(18,2)") * lgd.cast("decimal(10,7)")
    )
    return F.bround(product, 2).cast("decimal(20,2)")


def ratio(top: Column, bottom: Column) -> Column:
    """``top / bottom`` as double, NULL where ``bottom`` is zero."""
    return top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0))


def ratio_or_zero(top: Column, bottom: Column) -> Column:
    return F.coalesce(ratio(top, bottom), F.lit(0.0))


def exact_mean(column: Column) -> Column:
    """Average through an exact sum, so the result does not depend on row order."""
    return ratio(F.sum(column), F.count(column))


def rating_sort(rating: Column) -> Column:
    """1 for the best grade … 7 for the worst, NULL for a grade outside the scale."""
    chain = F.when(rating == RATING_SCALE[0], 1)
    for position, grade in enumerate(RATING_SCALE[1:], start=2):
        chain = chain.when(rating == grade, position)
    return chain


def cost_proxy(missed_loss: Column, rejected_ead: Column, rate: Column) -> Column:
    return missed_loss + rate * rejected_ead
