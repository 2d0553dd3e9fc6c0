"""Exact ranking metrics, threshold trade-offs and the choices based on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tranche.functions.columns import cost_proxy, ratio_or_zero
from tranche.operators.ordering import running_totals

GROUPS = ("model_name", "split")
STANDARD = (0.50, "standard_0.50")
OPERATING_TYPE = "operating_recall_constraint"
MINIMUM_RECALL = 0.70
OPPORTUNITY_RATE = 0.02
CUTOFFS = 99


def confusion_rates(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    """Rates of a confusion matrix; a rate over nothing is zero."""
    return {
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
        "specificity": ratio_or_zero(tn, tn + fp),
        "approval_rate": 1 - ratio_or_zero(tp + fp, tn + fp + fn + tp),
        "true_negative": tn,
        "false_positive": fp,
        "false_negative": fn,
        "true_positive": tp,
    }


def class_counts(scored: DataFrame, groups: Sequence[str] = GROUPS) -> DataFrame:
    """Positives and negatives per group and distinct score; ties become one row."""
    return scored.groupBy(*groups, "score").agg(
        F.sum((F.col("defaulted") == 1).cast("bigint")).alias("pos"),
        F.sum((F.col("defaulted") != 1).cast("bigint")).alias("neg"),
    )


def ranking_metrics(
    scored: DataFrame,
    cutoffs: Sequence[tuple[float, str]] = (STANDARD,),
    groups: Sequence[str] = GROUPS,
) -> DataFrame:
    """One metric row per group and cut-off, from totals over falling scores.

    ROC-AUC counts a tied pair as half; PR-AUC is average precision, the sum of
    recall steps times precision, not the area under straight lines.
    """
    totals = running_totals(class_counts(scored, groups), groups, [F.col("score").desc()], ["pos", "neg"])
    pos, neg, score = (F.col(name).cast("double") for name in ("pos", "neg", "score"))
    seen_pos, seen_neg = F.col("cum_pos").cast("double"), F.col("cum_neg").cast("double")
    summed = totals.groupBy(*groups).agg(
        F.sum("pos").alias("p"),
        F.sum("neg").alias("n"),
        F.sum(pos * (seen_neg - neg / 2)).alias("misordered"),
        F.sum(pos * seen_pos / (seen_pos + seen_neg)).alias("stepped"),
        F.sum(pos * (1 - score) * (1 - score) + neg * score * score).alias("squared"),
        *[
            F.sum(F.when(F.col("score") >= cutoff, F.col(name)).otherwise(0)).alias(f"{name}{i}")
            for i, (cutoff, _) in enumerate(cutoffs)
            for name in ("pos", "neg")
        ],
    )
    p, n = F.col("p"), F.col("n")
    each = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(kind).alias("threshold_type"),
                    F.lit(float(cutoff)).alias("threshold"),
                    F.col(f"pos{i}").alias("tp"),
                    F.col(f"neg{i}").alias("fp"),
                )
                for i, (cutoff, kind) in enumerate(cutoffs)
            ]
        )
    )
    rows = summed.select("*", each.alias("cut"))
    tp, fp = F.col("cut.tp"), F.col("cut.fp")
    rates = confusion_rates(n - fp, fp, p - tp, tp)
    pairs = F.nullif(p.cast("double") * n.cast("double"), F.lit(0.0))
    values = {
        "threshold_type": F.col("cut.threshold_type"),
        "threshold": F.col("cut.threshold"),
        "roc_auc": 1 - F.col("misordered") / pairs,
        "pr_auc": ratio_or_zero(F.col("stepped"), p),
        "precision": rates["precision"],
        "recall": rates["recall"],
        "f1": rates["f1"],
        "specificity": rates["specificity"],
        "brier_score": F.col("squared") / (p + n),
        "approval_rate": rates["approval_rate"],
        **{name: rates[name] for name in
           ("true_negative", "false_positive", "false_negative", "true_positive")},
    }
    return rows.select(*groups, *[value.alias(name) for name, value in values.items()])


def cutoffs_reached(score: Column) -> Column:
    """How many of the cut-offs 0.01 … 0.99 are at or below ``score``.

    The product only guesses; comparing with the neighbouring cut-offs makes
    scores equal to a cut-off land on the right side.
    """
    guess = F.floor(score * 100)
    exact = (
        guess
        + (score >= (guess + 1) / F.lit(100.0)).cast("int")
        - (score < guess / F.lit(100.0)).cast("int")
    )
    return F.least(F.greatest(exact, F.lit(0)), F.lit(CUTOFFS)).cast("int")


def threshold_table(
    scored: DataFrame, groups: Sequence[str] = GROUPS, rate: float = OPPORTUNITY_RATE
) -> DataFrame:
    """Outcome at each of 99 cut-offs from one pass: rows fall into 100 score bins."""
    bad = F.col("defaulted") == 1
    money = F.lit(0).cast("decimal(18,2)")
    loss = F.col("ead").cast("decimal(18,2)") * F.col("lgd").cast("decimal(10,7)")
    bins = (
        scored.select(*groups, "score", "defaulted", "ead", "lgd")
        .withColumn("bin", cutoffs_reached(F.col("score")))
        .groupBy(*groups, "bin")
        .agg(
            F.sum(bad.cast("bigint")).alias("pos"),
            F.sum((~bad).cast("bigint")).alias("neg"),
            F.sum(F.when(bad, loss).otherwise(money)).alias("loss"),
            F.sum(F.when(~bad, F.col("ead").cast("decimal(18,2)")).otherwise(money)).alias("good"),
        )
    )
    # At most 100 bins per group from here on.
    values = F.struct("pos", "neg", "loss", "good")
    whole = bins.groupBy(*groups).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", values))).alias("bins"),
        *[F.sum(name).alias(f"all_{name}") for name in ("pos", "neg", "good")],
    )
    steps = whole.select("*", F.explode(F.sequence(F.lit(0), F.lit(CUTOFFS - 1))).alias("step"))
    before = Window.partitionBy(*groups).orderBy("step").rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )

    def below(name: str) -> Column:
        return F.coalesce(F.sum(F.col("bins")[F.col("step")][name]).over(before), F.lit(0))

    rows = steps.select(
        *groups,
        ((F.col("step") + 1) / F.lit(100.0)).alias("threshold"),
        below("neg").alias("tn"),
        below("pos").alias("fn"),
        below("loss").alias("loss"),
        (F.col("all_good") - below("good")).alias("good"),
        "all_pos",
        "all_neg",
    )
    tn, fn = F.col("tn"), F.col("fn")
    rates = confusion_rates(tn, F.col("all_neg") - tn, fn, F.col("all_pos") - fn)
    missed = F.round("loss", 2).cast("decimal(22,2)")
    rejected = F.col("good").cast("decimal(22,2)")
    rate_column = F.lit(str(rate)).cast("decimal(10,7)")
    cost = cost_proxy(F.col("loss").cast("decimal(25,9)"), rejected, rate_column)
    return rows.select(
        *groups,
        "threshold",
        *[value.alias(name) for name, value in rates.items()],
        missed.alias("default_loss_exposure"),
        rejected.alias("rejected_good_ead"),
        rate_column.alias("opportunity_cost_rate_assumption"),
        F.round(cost, 2).cast("decimal(22,2)").alias("total_cost_proxy"),
    )


def choose_threshold(
    table: DataFrame, minimum_recall: float = MINIMUM_RECALL, groups: Sequence[str] = GROUPS
) -> DataFrame:
    """The cut-off per group: best precision, then approval, then cut-off, among
    those with enough recall; the lowest cut-off of best recall if none has."""
    eligible = F.col("recall") >= minimum_recall
    best = F.max(F.when(eligible, F.struct("precision", "approval_rate", "threshold")))
    fallback = F.max(F.struct(F.col("recall"), (-F.col("threshold")).alias("negative")))
    return table.groupBy(*groups).agg(
        F.coalesce(best["threshold"], -fallback["negative"]).alias("threshold")
    )


def select_model(metrics: DataFrame) -> DataFrame:
    """One row: the model with the best validation PR-AUC, then ROC-AUC."""
    return (
        metrics.where(F.col("split") == "validation")
        .agg(F.max_by("model_name", F.struct("pr_auc", "roc_auc", "model_name")).alias("model_name"))
    )


def split_summary(loans: DataFrame) -> DataFrame:
    """Rows, default rate and dates of each time split."""
    return loans.groupBy("data_split").agg(
        F.count(F.lit(1)).alias("rows"),
        ratio_or_zero(F.sum("defaulted"), F.count(F.lit(1))).alias("default_rate"),
        F.min("origination_date").alias("date_min"),
        F.max("origination_date").alias("date_max"),
    )
