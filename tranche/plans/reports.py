"""Business questions and reporting views. DataFrames in, one lazy DataFrame out.

Windows without partitions appear only after grouping by sector, rating, month,
year or vintage, so they see as many rows as there are such groups.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tranche.functions import columns as c
from tranche.operators.ordering import assign_buckets, in_listed_order, ntile_upper, top_per_group
from tranche.operators.rules import status_table

PREDICTION_COLUMNS = (
    "data_split", "model_name", "default_probability", "operating_threshold",
    "predicted_default", "risk_band", "risk_decile", "underwriting_action", "term_risk_loss_proxy",
)


def row_count() -> Column:
    return F.count(F.lit(1))


def default_rate() -> Column:
    return c.exact_mean(F.col("defaulted"))


def whole(order: Column):
    return Window.orderBy(order)


def percent(column: Column) -> Column:
    return F.round(100 * column, 2)


# Reporting views


def loan_fact(loans: DataFrame, predictions: DataFrame) -> DataFrame:
    """Clean loans with their prediction columns; both sides are unique by key."""
    return loans.join(predictions.select("loan_id", *PREDICTION_COLUMNS), "loan_id")


def sector_risk(fact: DataFrame) -> DataFrame:
    base = fact.groupBy("sector").agg(
        row_count().alias("loan_count"),
        F.sum("ead").alias("total_ead"),
        F.sum("defaulted").alias("defaults"),
        default_rate().alias("observed_default_rate"),
        c.exact_mean(F.col("default_probability")).alias("avg_model_probability"),
        F.sum("term_risk_loss_proxy").alias("term_risk_loss_proxy"),
        F.sum("el").alias("existing_expected_loss"),
        c.exact_mean(F.col("credit_score")).alias("avg_credit_score"),
    )
    everything = Window.partitionBy()
    return base.select(
        "*",
        F.rank().over(whole(F.col("observed_default_rate").desc_nulls_last()))
        .alias("default_rate_rank"),
        F.rank().over(whole(F.col("total_ead").desc_nulls_last())).alias("exposure_rank"),
        c.ratio(F.col("total_ead"), F.sum("total_ead").over(everything)).alias("exposure_share"),
    )


def rating_order(df: DataFrame) -> DataFrame:
    scale = ", ".join(f"('{grade}', {i})" for i, grade in enumerate(c.RATING_SCALE, start=1))
    return df.sparkSession.sql(f"SELECT * FROM VALUES {scale} AS r(initial_rating, rating_sort)")


def rating_risk(fact: DataFrame) -> DataFrame:
    """Per grade of the scale; loans with any other grade are left out."""
    return (
        fact.join(F.broadcast(rating_order(fact)), "initial_rating")
        .groupBy("initial_rating", "rating_sort")
        .agg(
            row_count().alias("loan_count"),
            F.sum("ead").alias("total_ead"),
            F.sum("defaulted").alias("defaults"),
            default_rate().alias("observed_default_rate"),
            c.exact_mean(F.col("default_probability")).alias("avg_model_probability"),
            c.exact_mean(F.col("pd_annual")).alias("avg_existing_pd"),
            c.exact_mean(F.col("credit_score")).alias("avg_credit_score"),
        )
    )


def monthly_risk_trend(fact: DataFrame) -> DataFrame:
    return fact.groupBy(c.month_start("origination_date").alias("origination_month")).agg(
        row_count().alias("originated_loans"),
        F.sum("ead").alias("originated_ead"),
        F.sum("defaulted").alias("eventual_defaults"),
        default_rate().alias("eventual_default_rate"),
        c.exact_mean(F.col("default_probability")).alias("avg_model_probability"),
        c.exact_mean(F.col("pd_annual")).alias("avg_existing_pd"),
        c.exact_mean(F.col("credit_score")).alias("avg_credit_score"),
    )


def risk_decile_lift(fact: DataFrame) -> DataFrame:
    """Test loans per decile; the average comes from the decile sums, not a second scan."""
    deciles = fact.where(F.col("data_split") == "test").groupBy("risk_decile").agg(
        row_count().alias("loan_count"),
        F.sum("defaulted").alias("defaults"),
        default_rate().alias("default_rate"),
        c.exact_mean(F.col("default_probability")).alias("avg_probability"),
        F.sum("ead").alias("total_ead"),
    )
    everything = Window.partitionBy()
    average = c.ratio(F.sum("defaults").over(everything), F.sum("loan_count").over(everything))
    return deciles.withColumn("portfolio_default_rate", average).withColumn(
        "lift_vs_test_average", c.ratio(F.col("default_rate"), F.col("portfolio_default_rate"))
    )


def executive_kpis(fact: DataFrame) -> DataFrame:
    return fact.agg(
        row_count().alias("loans"),
        F.sum("ead").alias("total_ead"),
        F.sum("defaulted").alias("defaults"),
        default_rate().alias("observed_default_rate"),
        F.sum("el").alias("existing_expected_loss"),
        F.sum("term_risk_loss_proxy").alias("term_risk_loss_proxy"),
        c.exact_mean(F.col("credit_score")).alias("avg_credit_score"),
        c.exact_mean(F.col("default_probability")).alias("avg_model_probability"),
        c.exact_mean(F.col("pd_annual")).alias("avg_existing_pd"),
    )


def model_test_metrics(metrics: DataFrame) -> DataFrame:
    return metrics.where(F.col("split") == "test")


def threshold_simulator(thresholds: DataFrame) -> DataFrame:
    return thresholds.where(F.col("split") == "test")


def stress_scenarios(stress: DataFrame) -> DataFrame:
    """Increment over the base loss, ranked inside each scenario."""
    increment = F.col("expected_loss_stress") - F.col("expected_loss_base")
    impact = Window.partitionBy("scenario").orderBy(
        F.col("incremental_expected_loss").desc_nulls_last()
    )
    return stress.select(
        "scenario", "sector", "stressed_pd", "stressed_lgd", "total_ead", "expected_loss_base",
        "expected_loss_stress", increment.alias("incremental_expected_loss"), "el_increase_pct",
    ).withColumn("sector_impact_rank", F.rank().over(impact))


def rating_migration(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("year", "sector").agg(
        row_count().alias("issuer_observations"),
        F.sum("upgraded").alias("upgrades"),
        F.sum("downgraded").alias("downgrades"),
        F.sum("defaulted").alias("defaults"),
        c.exact_mean(F.col("notches_moved")).alias("avg_notches_moved"),
        c.ratio(F.sum("downgraded"), row_count()).alias("downgrade_rate"),
    )


def vintage_curves(vintage: DataFrame, selected: tuple[str, ...] = ()) -> DataFrame:
    """All curves, or the selected vintages in order of age."""
    if not selected:
        return vintage
    return vintage.where(F.col("vintage").isin(*selected)).orderBy("vintage", "months_on_books")


# Business questions


def sector_concentration(loans: DataFrame) -> DataFrame:
    """Sectors ranked by observed default rate, each with its share of all exposure."""
    base = loans.groupBy("sector").agg(
        row_count().alias("loans"), F.sum("ead").alias("total_ead"), default_rate().alias("rate")
    )
    return base.select(
        "sector",
        "loans",
        F.round(F.col("total_ead") / F.lit(1_000_000_000), 2).alias("ead_billions"),
        percent(F.col("rate")).alias("default_rate_pct"),
        F.rank().over(whole(F.col("rate").desc_nulls_last())).alias("risk_rank"),
        F.rank().over(whole(F.col("total_ead").desc_nulls_last())).alias("exposure_rank"),
    ).orderBy("risk_rank", "exposure_rank")


def decile_separation(lift: DataFrame) -> DataFrame:
    """Per decile of the test loans: mean score, observed rate and lift."""
    return lift.select(
        "risk_decile",
        "loan_count",
        "defaults",
        percent(F.col("default_rate")).alias("default_rate_pct"),
        F.round("lift_vs_test_average", 2).alias("lift_vs_test_average"),
    ).orderBy("risk_decile")


def operating_point(predictions: DataFrame) -> DataFrame:
    """One row (model_name, operating_threshold): both are constant in a scoring run."""
    return predictions.agg(
        F.max("model_name").alias("model_name"),
        F.max("operating_threshold").alias("operating_threshold"),
    )


def threshold_tradeoffs(thresholds: DataFrame, predictions: DataFrame) -> DataFrame:
    """Test outcomes at the cut-offs within 0.05 of the operating one."""
    chosen = operating_point(predictions).withColumnRenamed("model_name", "chosen_model")
    cut = F.col("threshold").cast("decimal(8,6)")
    width = F.lit("0.05").cast("decimal(8,6)")
    near = cut.between(F.col("operating_threshold") - width, F.col("operating_threshold") + width)
    return (
        thresholds.where(F.col("split") == "test")
        .crossJoin(F.broadcast(chosen))
        .where((F.col("model_name") == F.col("chosen_model")) & near)
        .select(
            "threshold",
            F.round("precision", 4).alias("precision"),
            F.round("recall", 4).alias("recall"),
            F.round("approval_rate", 4).alias("approval_rate"),
            "false_positive",
            "false_negative",
            F.round(F.col("total_cost_proxy") / F.lit(1_000_000), 2).alias("cost_proxy_millions"),
        )
        .orderBy("threshold")
    )


def review_queue(fact: DataFrame, per_sector: int = 10) -> DataFrame:
    """The riskiest test loans of each sector, by score and then exposure."""
    flagged = fact.where(
        (F.col("underwriting_action") == c.REVIEW_ACTION) & (F.col("data_split") == "test")
    ).select(
        "loan_id", "sector", "initial_rating", "credit_score", "ead", "default_probability",
        "term_risk_loss_proxy",
    )
    order = [
        F.col("term_risk_loss_proxy").desc(), F.col("default_probability").desc(), F.col("loan_id")
    ]
    return top_per_group(flagged, ["sector"], order, per_sector, "sector_review_priority").orderBy(
        "sector", "sector_review_priority"
    )


def yearly_default_rate(loans: DataFrame) -> DataFrame:
    """Default rate per origination year and its change from the year before."""
    yearly = loans.groupBy(F.year("origination_date").alias("origination_year")).agg(
        row_count().alias("loans"), default_rate().alias("rate")
    )
    earlier = F.lag("rate").over(whole(F.col("origination_year").asc()))
    return yearly.select(
        "origination_year",
        "loans",
        percent(F.col("rate")).alias("default_rate_pct"),
        percent(F.col("rate") - earlier).alias("yoy_change_percentage_points"),
    ).orderBy("origination_year")


def sector_exposure_quartiles(loans: DataFrame) -> DataFrame:
    """Counts, scores and default rates of four exposure groups in every sector."""
    cut = assign_buckets(
        loans.select("loan_id", "sector", "ead", "defaulted"),
        "ead", "loan_id", 4, "sector_ead_quartile", upper=ntile_upper, groups=["sector"],
    )
    return cut.groupBy("sector", "sector_ead_quartile").agg(
        row_count().alias("loans"),
        F.round(c.exact_mean(F.col("ead")), 2).alias("avg_ead"),
        percent(default_rate()).alias("default_rate_pct"),
    ).orderBy("sector", "sector_ead_quartile")


def stress_increments(stress: DataFrame) -> DataFrame:
    """Expected loss added by each scenario and sector, largest first."""
    return stress_scenarios(stress).where(F.col("scenario") != "baseline").select(
        "scenario",
        "sector",
        F.round(F.col("incremental_expected_loss") / F.lit(1_000_000), 2)
        .alias("incremental_el_millions"),
        F.round("el_increase_pct", 2).alias("el_increase_pct"),
        "sector_impact_rank",
    ).orderBy("scenario", "sector_impact_rank")


def downgrade_acceleration(ratings: DataFrame) -> DataFrame:
    """Downgrade share per sector and year, with its first and second difference."""
    earlier = F.lag("downgrade_rate").over(Window.partitionBy("sector").orderBy("year"))
    return rating_migration(ratings).withColumn("prior", earlier).select(
        "year",
        "sector",
        percent(F.col("downgrade_rate")).alias("downgrade_rate_pct"),
        percent(F.col("downgrade_rate") - F.col("prior")).alias("yoy_change_pp"),
    ).orderBy("sector", "year")


def vintages_at_month(vintage: DataFrame, month: int = 36) -> DataFrame:
    """Vintages of one age by cumulative default rate."""
    return vintage.where(F.col("months_on_books") == month).select(
        "vintage",
        "n_loans_originated",
        "n_defaulted_cumulative",
        percent(F.col("cumulative_default_rate")).alias("cumulative_default_rate_pct"),
        F.rank().over(whole(F.col("cumulative_default_rate").desc_nulls_last()))
        .alias("vintage_risk_rank"),
    ).orderBy("vintage_risk_rank", "vintage")


def rolling_trend(portfolio: DataFrame, months: int = 12) -> DataFrame:
    """Mean risk and summed defaults of the last months; the first months use what there is."""
    frame = Window.orderBy("date").rowsBetween(1 - months, Window.currentRow)
    return portfolio.select(
        "date",
        "n_active_loans",
        "total_ead",
        "avg_pd",
        c.ratio(F.sum("avg_pd").over(frame), F.count("avg_pd").over(frame)).alias("avg_pd_12m"),
        F.sum("new_defaults").over(frame).alias("defaults_12m"),
    ).orderBy("date")


# Smaller reports


def shortlist(fact: DataFrame, rows: int = 500) -> DataFrame:
    """The test loans with the largest loss proxy."""
    return fact.where(F.col("data_split") == "test").select(
        "loan_id", "sector", "initial_rating", "credit_score", "ead", "default_probability",
        "term_risk_loss_proxy", "underwriting_action",
    ).orderBy(F.col("term_risk_loss_proxy").desc(), F.col("loan_id")).limit(rows)


def what_if(thresholds: DataFrame, threshold: float, rate: float) -> DataFrame:
    """The outcome at one cut-off, with the cost at a chosen opportunity rate."""
    cut = F.lit(str(threshold)).cast("decimal(8,6)")
    cost = c.cost_proxy(
        F.col("default_loss_exposure"),
        F.col("rejected_good_ead"),
        F.lit(str(rate)).cast("decimal(10,7)"),
    )
    return thresholds.where(
        (F.col("split") == "test") & (F.col("threshold").cast("decimal(8,6)") == cut)
    ).select(
        "model_name", "threshold", "precision", "recall", "f1", "specificity", "approval_rate",
        "false_positive", "false_negative", "default_loss_exposure", "rejected_good_ead",
        F.round(cost, 2).alias("dynamic_cost_proxy"),
    )


def dynamic_costs(thresholds: DataFrame, rate: float) -> DataFrame:
    """Every test cut-off with its cost at a chosen opportunity rate."""
    cost = c.cost_proxy(
        F.col("default_loss_exposure"),
        F.col("rejected_good_ead"),
        F.lit(str(rate)).cast("decimal(10,7)"),
    )
    return threshold_simulator(thresholds).withColumn("dynamic_cost_proxy", F.round(cost, 2))


def headline_metrics(metrics: DataFrame, operating_type: str) -> DataFrame:
    """Best test ROC-AUC and PR-AUC per model, and its recall at the operating cut-off."""
    return metrics.where(F.col("split") == "test").groupBy("model_name").agg(
        F.max("roc_auc").alias("roc_auc"),
        F.max("pr_auc").alias("pr_auc"),
        F.max(F.when(F.col("threshold_type") == operating_type, F.col("recall")))
        .alias("operating_recall"),
    )


def scenario_totals(stress: DataFrame) -> DataFrame:
    """Loss sums per scenario and their increase after grouping."""
    sums = stress_scenarios(stress).groupBy("scenario").agg(
        F.sum("expected_loss_base").alias("base_loss"),
        F.sum("expected_loss_stress").alias("stressed_loss"),
        F.sum("incremental_expected_loss").alias("incremental_loss"),
    )
    return sums.withColumn(
        "increase_pct", percent(c.ratio(F.col("incremental_loss"), F.col("base_loss")))
    )


def yearly_downgrades(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("year").agg(
        row_count().alias("observations"),
        F.sum("downgraded").alias("downgrades"),
        c.ratio(F.sum("downgraded"), row_count()).alias("downgrade_rate"),
    ).orderBy("year")


def yearly_balance(loans: DataFrame) -> DataFrame:
    """Count, defaults and mean of the target by origination year."""
    return loans.groupBy(F.year("origination_date").alias("origination_year")).agg(
        F.count("defaulted").alias("count"),
        F.sum("defaulted").alias("sum"),
        default_rate().alias("mean"),
    )


def rating_default_rates(loans: DataFrame) -> DataFrame:
    """Default rate of every grade of the scale, in scale order."""
    rates = loans.groupBy("initial_rating").agg(default_rate().alias("default_rate"))
    return in_listed_order(rates, "initial_rating", c.RATING_SCALE)


def sector_overview(loans: DataFrame) -> DataFrame:
    return loans.groupBy("sector").agg(
        F.count_distinct("loan_id").alias("loans"),
        F.sum("ead").alias("ead"),
        default_rate().alias("default_rate"),
    ).orderBy(F.col("default_rate").desc(), "sector")


# Validation


def split_rates(predictions: DataFrame) -> DataFrame:
    return predictions.groupBy("data_split").agg(
        row_count().alias("rows"),
        F.sum("defaulted").alias("defaults"),
        F.round(default_rate(), 6).alias("default_rate"),
    ).orderBy("data_split")


def prediction_integrity(predictions: DataFrame) -> DataFrame:
    probability = F.col("default_probability")
    return predictions.agg(
        F.count_if(~probability.between(0, 1)).alias("invalid_probabilities"),
        F.count_if(F.col("loan_id").isNull()).alias("missing_loan_ids"),
        F.count_if(F.col("underwriting_action").isNull()).alias("missing_actions"),
        F.min(probability).alias("min_probability"),
        F.max(probability).alias("max_probability"),
    )


def validation_summary(predictions: DataFrame) -> DataFrame:
    """One row of the figures the workbook checks read."""
    probability = F.col("default_probability")
    return predictions.agg(
        row_count().alias("clean_loan_rows"),
        F.count(probability).alias("prediction_rows"),
        F.count_if(F.col("data_split") == "test").alias("test_rows"),
        F.count_if(probability.isNull()).alias("missing_probabilities"),
        F.count_if(~probability.between(0, 1)).alias("invalid_probabilities"),
        F.count_if(~F.col("defaulted").isin(0, 1)).alias("invalid_target_values"),
        F.min(probability).alias("probability_min"),
        F.max(probability).alias("probability_max"),
    )


def delivery_checks(
    summary: DataFrame,
    thresholds: DataFrame,
    queue: DataFrame,
    chosen: float,
    expected: dict[str, int],
) -> DataFrame:
    """(check_name, actual, expected, difference, status) of the delivered figures.

    ``expected`` gives loan_rows, test_rows and shortlist_rows; the rest is fixed.
    """
    cut = F.lit(str(chosen)).cast("decimal(8,6)")
    from_summary = (
        ("loan rows", "clean_loan_rows", expected["loan_rows"]),
        ("missing probabilities", "missing_probabilities", 0),
        ("probabilities outside 0 to 1", "invalid_probabilities", 0),
        ("test rows", "test_rows", expected["test_rows"]),
        ("target values outside 0 and 1", "invalid_target_values", 0),
    )
    stacked = summary.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(name).alias("check_name"),
                        F.col(source).alias("actual"),
                        F.lit(wanted).cast("bigint").alias("expected"),
                    )
                    for name, source, wanted in from_summary
                ]
            )
        ).alias("row")
    ).select("row.*")
    listed = threshold_simulator(thresholds).agg(
        F.count_if(F.col("threshold").cast("decimal(8,6)") == cut).alias("actual")
    ).select(
        F.lit("chosen threshold in the test table").alias("check_name"),
        "actual",
        F.lit(1).cast("bigint").alias("expected"),
    )
    queued = queue.agg(row_count().alias("actual")).select(
        F.lit("shortlist rows").alias("check_name"),
        "actual",
        F.lit(expected["shortlist_rows"]).cast("bigint").alias("expected"),
    )
    rows = reduce(DataFrame.unionByName, [stacked, listed, queued])
    return status_table(rows, "actual")
