"""Registered queries: each reads whole tables of the star schema and runs one operator
or report of the loan model on them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import StringIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tranche import schemas
from tranche.learning import features, importance, models, training
from tranche.operators import enrich, metrics, ordering, profile, rules, scoring
from tranche.plans import pipeline, reports
from tranche.session import compilable, parts_for, run_folder, settle
from tranche.sources import files, shapes, sinks, versions

SETTINGS = models.Settings()
MODEL = "Formula A"
THRESHOLD = 0.30
# Score formulas of three stand-in models: (name, factor, modulus, step of a defaulted loan)
FORMULAS = (("Formula A", 31, 600, 300), ("Formula B", 17, 700, 200), ("Formula C", 13, 500, 400))
SELECTED_VINTAGES = ("1995Q3", "1997Q4", "1999Q4", "2001Q1")

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def plain(df: DataFrame) -> DataFrame:
    """Numbers as bigint or double, so results compare across engines."""
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DecimalType, T.FloatType)):
            column = column.cast("double")
        elif isinstance(field.dataType, T.IntegralType):
            column = column.cast("bigint")
        columns.append(column.alias(field.name))
    return df.select(*columns)


def rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    """Round doubles whose last digits depend on the order of summation."""
    return df.withColumns({name: F.round(name, digits) for name in names})


def registered(query: Query) -> Query:
    REGISTERED[query.__name__] = lambda spark, folder: plain(query(compilable(spark), folder))
    return query


# Inputs


def loans(spark: SparkSession, folder: str, with_sector: bool = True) -> DataFrame:
    return shapes.raw_loans(spark, folder, with_sector)


def clean(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.clean_loans(loans(spark, folder), shapes.macro(spark, folder), shapes.CUTOFF)


def enriched(spark: SparkSession, folder: str) -> DataFrame:
    return enrich.enrich_loans(loans(spark, folder), shapes.macro(spark, folder), shapes.CUTOFF)


def with_predictions(spark: SparkSession, folder: str, with_sector: bool = True) -> DataFrame:
    """Loans with every row-wise prediction column, without the decile."""
    scored = shapes.formula_score(loans(spark, folder, with_sector))
    return scoring.add_scores(
        scored, THRESHOLD, MODEL, shapes.TRAIN_END, shapes.VALIDATION_END
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    scored = scoring.add_deciles(with_predictions(spark, folder))
    return scored.select(*schemas.PREDICTIONS.columns)


def model_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Validation and test loans scored by all three stand-in models."""
    rows = loans(spark, folder, with_sector=False).select(
        F.substring("loan_id", 2, 12).cast("bigint").alias("number"),
        scoring.data_split(F.col("origination_date"), shapes.TRAIN_END, shapes.VALIDATION_END)
        .alias("split"),
        "defaulted",
        "ead",
        "lgd",
    ).where("split <> 'train'")
    scored = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("model_name"),
                    (
                        ((F.col("number") * factor) % modulus + step * F.col("defaulted") + 1)
                        / F.lit(1000.0)
                    ).alias("score"),
                )
                for name, factor, modulus, step in FORMULAS
            ]
        )
    )
    return rows.select("*", scored.alias("m")).select(
        "m.model_name", "split", "defaulted", "ead", "lgd", "m.score"
    )


def thresholds(spark: SparkSession, folder: str) -> DataFrame:
    return metrics.threshold_table(model_scores(spark, folder))


# Business questions


@registered
def sector_concentration(spark, folder):
    return reports.sector_concentration(loans(spark, folder))


@registered
def decile_separation(spark, folder):
    scored = scoring.add_deciles(with_predictions(spark, folder, with_sector=False))
    return reports.decile_separation(reports.risk_decile_lift(scored))


@registered
def threshold_tradeoffs(spark, folder):
    return reports.threshold_tradeoffs(
        thresholds(spark, folder), with_predictions(spark, folder, with_sector=False)
    )


@registered
def review_queue(spark, folder):
    return reports.review_queue(with_predictions(spark, folder))


@registered
def yearly_default_rate(spark, folder):
    return reports.yearly_default_rate(loans(spark, folder, with_sector=False))


@registered
def sector_exposure_quartiles(spark, folder):
    return reports.sector_exposure_quartiles(loans(spark, folder))


@registered
def stress_increments(spark, folder):
    return reports.stress_increments(shapes.stress(loans(spark, folder)))


@registered
def downgrade_acceleration(spark, folder):
    return reports.downgrade_acceleration(shapes.ratings(spark, folder))


@registered
def vintages_at_month_36(spark, folder):
    return reports.vintages_at_month(shapes.vintage(loans(spark, folder, with_sector=False)), 36)


@registered
def rolling_portfolio_trend(spark, folder):
    return reports.rolling_trend(shapes.macro(spark, folder))


# Reporting views


@registered
def loan_fact(spark, folder):
    return reports.loan_fact(clean(spark, folder), predictions(spark, folder))


@registered
def sector_risk(spark, folder):
    return reports.sector_risk(with_predictions(spark, folder))


@registered
def rating_risk(spark, folder):
    return reports.rating_risk(with_predictions(spark, folder, with_sector=False))


@registered
def monthly_risk_trend(spark, folder):
    return reports.monthly_risk_trend(with_predictions(spark, folder, with_sector=False))


@registered
def risk_decile_lift(spark, folder):
    scored = scoring.add_deciles(with_predictions(spark, folder, with_sector=False))
    return reports.risk_decile_lift(scored)


@registered
def executive_kpis(spark, folder):
    return reports.executive_kpis(with_predictions(spark, folder, with_sector=False))


@registered
def model_test_metrics(spark, folder):
    rows = metrics.ranking_metrics(model_scores(spark, folder))
    return rounded(reports.model_test_metrics(rows), 9, "roc_auc", "pr_auc", "brier_score")


@registered
def threshold_simulator(spark, folder):
    return reports.threshold_simulator(thresholds(spark, folder))


@registered
def stress_scenarios(spark, folder):
    return reports.stress_scenarios(shapes.stress(loans(spark, folder)))


@registered
def rating_migration(spark, folder):
    return reports.rating_migration(shapes.ratings(spark, folder))


@registered
def vintage_curves(spark, folder):
    return reports.vintage_curves(shapes.vintage(loans(spark, folder, with_sector=False)))


@registered
def selected_vintage_curves(spark, folder):
    curves = shapes.vintage(loans(spark, folder, with_sector=False))
    return reports.vintage_curves(curves, SELECTED_VINTAGES)


# Cleaning and enrichment


@registered
def clean_loans(spark, folder):
    return clean(spark, folder)


@registered
def credit_score_bands(spark, folder):
    banded = enrich.derive_columns(loans(spark, folder, with_sector=False), shapes.CUTOFF)
    return profile.value_counts(banded, "credit_score_band")


@registered
def exposure_band_edges(spark, folder):
    banded = enrich.add_ead_band(loans(spark, folder, with_sector=False))
    return banded.groupBy("ead_band").agg(
        F.count(F.lit(1)).alias("loans"), F.min("ead").alias("low"), F.max("ead").alias("high")
    )


# Profiles and rules


@registered
def loan_shape_and_missing(spark, folder):
    return profile.shape_and_missing(loans(spark, folder))


@registered
def item_duplicate_rows(spark, folder):
    return profile.duplicate_rows(shapes.star(spark, folder, "lineitem")).select("number")


@registered
def repeated_item_facts(spark, folder):
    """Duplicates among the columns of a table that do repeat."""
    items = shapes.star(spark, folder, "lineitem").select(
        "l_returnflag", "l_linestatus", "l_quantity", "l_discount", "l_tax"
    )
    return profile.duplicate_rows(items).select("number")


@registered
def loan_numeric_ranges(spark, folder):
    found = profile.numeric_ranges(loans(spark, folder, with_sector=False))
    return rounded(found.select("column_name", "metric", "number"), 6, "number")


@registered
def loan_quartiles(spark, folder):
    found = profile.quartiles(loans(spark, folder, with_sector=False))
    return rounded(found, 6, "q1", "q2", "q3")


@registered
def loan_medians_and_outliers(spark, folder):
    found = profile.medians_and_outliers(loans(spark, folder, with_sector=False))
    return rounded(found.select("column_name", "metric", "number"), 6, "number")


@registered
def item_quartiles(spark, folder):
    items = shapes.star(spark, folder, "lineitem").select(
        "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )
    return rounded(profile.quartiles(items), 6, "q1", "q2", "q3")


@registered
def loan_date_ranges(spark, folder):
    found = profile.date_ranges(loans(spark, folder, with_sector=False))
    return found.select("column_name", "metric", "text")


@registered
def loan_distinct_counts(spark, folder):
    return profile.distinct_counts(loans(spark, folder)).select("column_name", "number")


@registered
def distinct_counts_with_empty_column(spark, folder):
    """The same with a text column that is always NULL."""
    rows = loans(spark, folder).withColumn("remark", F.lit(None).cast("string"))
    return profile.distinct_counts(rows).select("column_name", "number")


@registered
def undated_splits(spark, folder):
    """Every tenth loan without a date: it is in no split."""
    number = F.substring("loan_id", 2, 12).cast("bigint")
    date = F.when(number % 10 != 0, F.col("origination_date"))
    split = scoring.data_split(date, shapes.TRAIN_END, shapes.VALIDATION_END)
    rows = loans(spark, folder, with_sector=False).select(split.alias("data_split"))
    return rows.groupBy("data_split").agg(F.count(F.lit(1)).alias("loans"))


@registered
def portfolio_summary(spark, folder):
    return profile.portfolio_summary(loans(spark, folder))


@registered
def target_counts(spark, folder):
    return profile.value_counts(loans(spark, folder, with_sector=False), "defaulted")


@registered
def loan_checks(spark, folder):
    return rules.loan_checks(loans(spark, folder, with_sector=False), shapes.CUTOFF)


@registered
def tight_loan_checks(spark, folder):
    """The same checks with an earlier last default date, so that one is violated."""
    return rules.loan_checks(loans(spark, folder, with_sector=False), "2000-06-30")


@registered
def table_constraints(spark, folder):
    frames = {
        "loans": loans(spark, folder),
        "credit_ratings": shapes.ratings(spark, folder),
        "portfolio_metrics": shapes.macro(spark, folder),
    }
    tables = {**schemas.TABLES, "loans": schemas.RAW_LOANS}
    return rules.check_tables(frames, tables)


@registered
def item_rules(spark, folder):
    """Row rules and a composite key on items, where both are violated."""
    items = shapes.star(spark, folder, "lineitem")
    parts = parts_for(items)
    orders = shapes.star(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    # Both sides are dealt by their number, so the sort of one task does not grow with the input.
    items = items.repartition(parts, "l_orderkey").join(
        orders.repartition(parts, "o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey")
    ).select("l_orderkey", "l_linenumber", "l_discount", "l_shipdate", "o_orderdate")
    table = schemas.Table(
        "lineitem",
        "l_orderkey bigint, l_linenumber int, l_discount double, l_shipdate date, o_orderdate date",
        ("l_orderkey", "l_linenumber"),
        checks={
            "shipped_after_order": "l_shipdate >= o_orderdate",
            "discount_below_nine_percent": "l_discount < 0.09D",
        },
    )
    found = rules.constraint_report(items, table).unionByName(rules.key_report(items, table, parts))
    return found


@registered
def orders_without_items(spark, folder):
    items = shapes.star(spark, folder, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    orders = shapes.star(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return rules.orphans(orders, items, "o_orderkey")


@registered
def scored_integrity(spark, folder):
    return rules.scored_integrity(with_predictions(spark, folder, with_sector=False))


@registered
def missing_splits(spark, folder):
    """Required split names the scored loans never take."""
    scored = with_predictions(spark, folder, with_sector=False)
    return rules.missing_values_of(scored, "data_split", ["train", "validation", "test", "holdout"])


@registered
def table_counts(spark, folder):
    base = loans(spark, folder)
    return sinks.load_counts(
        {
            "loans": base,
            "credit_ratings": shapes.ratings(spark, folder),
            "portfolio_metrics": shapes.macro(spark, folder),
            "stress_scenarios": shapes.stress(base),
            "vintage_analysis": shapes.vintage(base),
            "loan_predictions": with_predictions(spark, folder),
        }
    )


@registered
def table_count_contract(spark, folder):
    """Loan and month counts against those of the tables they come from."""
    expected = {
        "loans": shapes.star(spark, folder, "orders").count(),
        "portfolio_metrics": shapes.star(spark, folder, "lineitem")
        .select(F.trunc("l_shipdate", "MM")).distinct().count(),
        "vintage_analysis": 1,
    }
    counts = sinks.load_counts(
        {
            "loans": loans(spark, folder),
            "portfolio_metrics": shapes.macro(spark, folder),
            "vintage_analysis": shapes.vintage(loans(spark, folder, with_sector=False)),
        }
    )
    return rules.compare_counts(counts, expected)


@registered
def delivery_checks(spark, folder):
    scored = with_predictions(spark, folder)
    orders = shapes.star(spark, folder, "orders")
    expected = {
        "loan_rows": orders.count(),
        "test_rows": orders.where(F.col("o_orderdate") >= shapes.VALIDATION_END).count(),
        "shortlist_rows": 500,
    }
    one_model = thresholds(spark, folder).where(F.col("model_name") == MODEL)
    return reports.delivery_checks(
        reports.validation_summary(scored), one_model, reports.shortlist(scored), THRESHOLD, expected
    )


@registered
def delivery_status(spark, folder):
    return rules.overall_status(delivery_checks(spark, folder))


# Scores, metrics and thresholds


@registered
def prediction_table(spark, folder):
    return predictions(spark, folder)


@registered
def ranking_metrics(spark, folder):
    cutoffs = [metrics.STANDARD, (THRESHOLD, metrics.OPERATING_TYPE)]
    rows = metrics.ranking_metrics(model_scores(spark, folder), cutoffs)
    return rounded(rows, 9, "roc_auc", "pr_auc", "brier_score")


@registered
def threshold_table(spark, folder):
    return thresholds(spark, folder)


@registered
def chosen_thresholds(spark, folder):
    return metrics.choose_threshold(thresholds(spark, folder))


@registered
def chosen_thresholds_without_eligible(spark, folder):
    """No cut-off reaches the asked recall for some models: the fallback decides."""
    return metrics.choose_threshold(thresholds(spark, folder), minimum_recall=1.01)


@registered
def selected_model(spark, folder):
    return metrics.select_model(metrics.ranking_metrics(model_scores(spark, folder)))


@registered
def headline_metrics(spark, folder):
    cutoffs = [metrics.STANDARD, (THRESHOLD, metrics.OPERATING_TYPE)]
    rows = metrics.ranking_metrics(model_scores(spark, folder), cutoffs)
    found = reports.headline_metrics(rows, metrics.OPERATING_TYPE)
    return rounded(found, 9, "roc_auc", "pr_auc")


@registered
def split_summary(spark, folder):
    return metrics.split_summary(with_predictions(spark, folder, with_sector=False))


@registered
def split_rates(spark, folder):
    return reports.split_rates(with_predictions(spark, folder, with_sector=False))


@registered
def prediction_integrity(spark, folder):
    return reports.prediction_integrity(with_predictions(spark, folder, with_sector=False))


@registered
def validation_summary(spark, folder):
    return reports.validation_summary(with_predictions(spark, folder, with_sector=False))


@registered
def shortlist(spark, folder):
    return reports.shortlist(with_predictions(spark, folder))


@registered
def what_if(spark, folder):
    return reports.what_if(thresholds(spark, folder), 0.3, 0.035)


@registered
def dynamic_costs(spark, folder):
    found = reports.dynamic_costs(thresholds(spark, folder), 0.035)
    return found.select("model_name", "threshold", "total_cost_proxy", "dynamic_cost_proxy")


# Smaller reports


@registered
def scenario_totals(spark, folder):
    return reports.scenario_totals(shapes.stress(loans(spark, folder)))


@registered
def yearly_downgrades(spark, folder):
    return reports.yearly_downgrades(shapes.ratings(spark, folder))


@registered
def yearly_balance(spark, folder):
    return reports.yearly_balance(loans(spark, folder, with_sector=False))


@registered
def rating_default_rates(spark, folder):
    return reports.rating_default_rates(loans(spark, folder, with_sector=False))


@registered
def sector_overview(spark, folder):
    return reports.sector_overview(loans(spark, folder))


@registered
def seeded_sample(spark, folder):
    test = with_predictions(spark, folder, with_sector=False).where("data_split = 'test'")
    return ordering.seeded_sample(test, "loan_id", 500, 42).select(
        "loan_id", "ead", "default_probability"
    )


# Models


def prepared(spark: SparkSession, folder: str) -> DataFrame:
    """Key, target, model features and time split of the clean loans, settled for repeated passes."""
    split = scoring.data_split(F.col("origination_date"), shapes.TRAIN_END, shapes.VALIDATION_END).alias("data_split")
    rows = features.model_features(enriched(spark, folder))
    # Only what the models read: the other columns of a loan cost four times as much to compute and write.
    return settle(rows.select("loan_id", features.TARGET, *features.MODEL_FEATURES, split))


@registered
def model_inputs(spark, folder):
    """The derived model features of every loan."""
    rows = features.model_features(enriched(spark, folder)).select(
        "loan_id", "log_ead", "leverage_to_coverage", "debt_service_pressure", "origination_month"
    )
    return rounded(rows, 9, "log_ead", "leverage_to_coverage", "debt_service_pressure")


@registered
def training_medians_and_modes(spark, folder):
    """Fill values of the numeric and categorical features on the training loans."""
    train = prepared(spark, folder).where("data_split = 'train'")
    numbers = [(n, float(v), None) for n, v in features.exact_medians(train).items()]
    texts = [(n, None, v) for n, v in features.exact_modes(train).items()]
    filled = spark.createDataFrame(numbers + texts, "feature string, median double, mode string")
    return rounded(filled, 6, "median")


@registered
def trained_model_metrics(spark, folder):
    """Metric rows of the three trained models and of the chosen cut-off."""
    return training.train_and_evaluate(
        clean_table(spark, folder), SETTINGS, shapes.TRAIN_END, shapes.VALIDATION_END
    ).metrics


@registered
def logistic_importance(spark, folder):
    """Permutation importance of a logistic model on the test loans."""
    rows = prepared(spark, folder)
    model = models.fit_models(
        rows.where("data_split = 'train'"), SETTINGS, (models.LOGISTIC,)
    )[models.LOGISTIC]
    return importance.permutation_importance(model, rows.where("data_split = 'test'"))


@registered
def importance_agreement(spark, folder):
    """Whether exchanging a logistic model's terms gives the drops that scoring changed copies gives."""
    rows = prepared(spark, folder)
    model = models.fit_models(rows.where("data_split = 'train'"), SETTINGS, (models.LOGISTIC,))[models.LOGISTIC]
    test = settle(rows.where("data_split = 'test'").select("loan_id", features.TARGET, *features.MODEL_FEATURES))
    by_terms, by_copies = (
        importance.precision_drops(way(model, test, 1, SETTINGS.seed)).select("feature", F.col("importance_mean").alias(n))
        for n, way in (("terms", importance.scored_by_terms), ("copies", importance.scored_copies))
    )
    return by_terms.join(by_copies, "feature").select(
        "feature", (F.abs(F.col("terms") - F.col("copies")) < 1e-6).alias("agrees")
    )


@registered
def feature_dependence(spark, folder):
    """Loans in which a model feature changes without the forbidden columns; two leaks are planted."""

    def build(rows):
        return features.model_features(rows).withColumns({
            "waited": F.coalesce("survival_months", "maturity_months"),
            "pressure": F.coalesce(F.col("pd_annual").cast("double"), F.lit(0.0)) > 0.02,
        })

    forbidden = (features.TARGET, *schemas.POST_OUTCOME, *schemas.RISK_OUTPUTS)
    names = (*features.MODEL_FEATURES, "waited", "pressure")
    return rules.changed_without(build, settle(enriched(spark, folder)), "loan_id", names, forbidden)


@registered
def batch_scores(spark, folder):
    """All loans scored by a model that was stored and loaded again."""
    rows, target = prepared(spark, folder), run_folder(spark)
    fitted = models.fit_models(rows.where("data_split = 'train'"), SETTINGS, (models.LOGISTIC,))
    fitted[models.LOGISTIC].save(target)
    return models.RiskModel.load(spark, target).score(rows).select("loan_id", "score")


@registered
def stored_model_agreement(spark, folder):
    """Loans whose score differs between a model and its stored copy."""
    rows, target = prepared(spark, folder), run_folder(spark)
    fitted = models.fit_models(rows.where("data_split = 'train'"), SETTINGS, (models.LOGISTIC,))
    fitted[models.LOGISTIC].save(target)
    again = models.RiskModel.load(spark, target)
    both = again.score(fitted[models.LOGISTIC].score(rows, "score"), "stored")
    return both.agg(
        F.count(F.lit(1)).alias("loans"), F.count_if(F.col("score") != F.col("stored")).alias("differing")
    )


@registered
def logistic_score_check(spark, folder):
    """Loans whose logistic score is not the one its coefficients give."""
    rows = prepared(spark, folder)
    model = models.fit_models(rows.where("data_split = 'train'"), SETTINGS, (models.LOGISTIC,))[models.LOGISTIC]
    fitted = model.pipeline.stages[-1]
    values = vector_to_array(features.FEATURES)
    weights = F.array(*[F.lit(float(w)) for w in fitted.coefficients])
    margin = F.aggregate(
        F.zip_with(values, weights, lambda x, w: x * w), F.lit(float(fitted.intercept)), lambda a, x: a + x
    )
    scored = model.pipeline.transform(rows).select(
        vector_to_array(model.probabilities[0])[1].alias("score"), (1 / (1 + F.exp(-margin))).alias("own")
    )
    return scored.agg(
        F.count(F.lit(1)).alias("loans"),
        F.count_if(F.abs(F.col("score") - F.col("own")) > 1e-12).alias("differing"),
    )


def encoded_training_rows(spark: SparkSession, folder: str):
    train = prepared(spark, folder).where("data_split = 'train'")
    fitted = features.fit_preprocessing(train)
    return fitted, fitted.transform(train)


@registered
def scaled_feature_moments(spark, folder):
    """Mean and sample deviation of the scaled features on the training loans."""
    _, rows = encoded_training_rows(spark, folder)
    cells = rows.select(vector_to_array("__scaled").alias("values"))
    # One row with all moments, so a loan is not multiplied by the number of its features.
    found = cells.agg(*[
        F.struct(
            F.lit(n).alias("feature"), F.avg(F.col("values")[k]).alias("mean"),
            F.stddev_samp(F.col("values")[k]).alias("deviation"), F.count(F.col("values")[k]).alias("n"),
        ).alias(n)
        for k, n in enumerate(features.NUMERIC_FEATURES)
    ])
    # Adding zero turns a rounded -0.0 into 0.0.
    return found.select(F.inline(F.array(*features.NUMERIC_FEATURES))).where("n > 0").select(
        "feature", (F.round("mean", 6) + F.lit(0.0)).alias("mean"), F.round("deviation", 6).alias("deviation")
    )


@registered
def encoded_category_counts(spark, folder):
    """How many training loans have a one for each category."""
    fitted, rows = encoded_training_rows(spark, folder)
    indexer = next(s for s in fitted.stages if isinstance(s, StringIndexerModel))

    def counted(name: str, labels: list[str]):
        known = F.array(*[F.lit(v) for v in labels])
        return F.transform(
            F.col(name),
            lambda x, i: F.struct(
                F.lit(name).alias("feature"), F.element_at(known, i + 1).alias("category"), x.alias("one")
            ),
        )

    # Loans of equal encodings are counted first, so only the few different encodings are taken apart.
    encodings = rows.groupBy(
        *[vector_to_array(f"__onehot_{name}").alias(name) for name in features.CATEGORICAL_FEATURES]
    ).agg(F.count(F.lit(1)).alias("loans"))
    cells = F.concat(*map(counted, features.CATEGORICAL_FEATURES, indexer.labelsArray))
    found = encodings.select("loans", F.explode(cells).alias("cell")).groupBy("cell.feature", "cell.category")
    return found.agg(F.sum(F.col("cell.one") * F.col("loans")).cast("bigint").alias("ones"))


@registered
def fold_sizes(spark, folder):
    """Training loans of each class in each calibration fold."""
    train = prepared(spark, folder).where("data_split = 'train'")
    folds = models.folds_by_class(train, SETTINGS).join(train.select("loan_id", "defaulted"), "loan_id")
    return folds.groupBy("defaulted", F.col("__fold").alias("fold")).agg(F.count(F.lit(1)).alias("loans"))


# Files, export and the whole run


def clean_table(spark: SparkSession, folder: str) -> DataFrame:
    """Clean loans as a stored table."""
    return sinks.store_loans(clean(spark, folder), run_folder(spark))


@registered
def ratings_csv_round_trip(spark, folder):
    """Ratings written as ordered CSV and read back with their declared types."""
    target = run_folder(spark)
    sinks.write_clean_csv({"ratings": shapes.ratings(spark, folder)}, target)
    return files.read_typed_csv(spark, f"{target}/credit_ratings_clean", schemas.RATINGS)


@registered
def source_file_counts(spark, folder):
    """Rows of the five supplied files, written as CSV and read with their declared types."""
    base, target = loans(spark, folder), run_folder(spark)
    frames = {
        "loans": base,
        "ratings": shapes.ratings(spark, folder),
        "portfolio": shapes.macro(spark, folder),
        "stress": shapes.stress(base),
        "vintage": shapes.vintage(base),
    }
    for name, df in frames.items():
        table = schemas.SOURCE_TABLES[name]
        df.select(*[F.col(c).cast(k) for c, k in table.fields]).write.csv(
            f"{target}/{schemas.SOURCE_FILES[name]}", header=True
        )
    return sinks.load_counts(pipeline.land(files.read_sources(spark, target), target))


@registered
def stripped_texts(spark, folder):
    """Texts with white space of several kinds around them, stripped again."""
    padded = loans(spark, folder).select(
        *[F.concat(F.lit(" \t"), F.col(n), F.lit("\r\n ")).alias(n) for n in enrich.TEXT_COLUMNS]
    )
    return enrich.trim_text(padded)


@registered
def view_totals(spark, folder):
    """Totals read back through a registered view of a stored table."""
    scored = with_predictions(spark, folder, with_sector=False).select("data_split", "ead")
    sinks.register_views({"tranche_scored": sinks.store_table(scored, run_folder(spark), "scored")})
    return spark.sql("SELECT data_split, count(*) AS loans, sum(ead) AS ead FROM tranche_scored GROUP BY data_split")


@registered
def published_manifest(spark, folder):
    """The whole run, from supplied tables to the published export and its manifest, with all three models
    at their full settings."""
    base = loans(spark, folder)
    raw = {
        "loans": base,
        "ratings": shapes.ratings(spark, folder),
        "portfolio": shapes.macro(spark, folder),
        "stress": shapes.stress(base),
        "vintage": shapes.vintage(base),
    }
    raw = {
        name: sinks.store_table(df, run_folder(spark), f"raw_{name}")
        for name, df in raw.items()
    }
    plan = pipeline.Plan(
        shapes.TRAIN_END, shapes.VALIDATION_END, shapes.CUTOFF, SETTINGS,
        expected_export={"Fact_Loans": shapes.star(spark, folder, "orders").count()},
    )
    target = run_folder(spark)
    pipeline.run_tables(raw, f"{target}/tables", f"{target}/published", plan)
    return spark.read.parquet(f"{versions.current(spark, f'{target}/published')}/Manifest")
