"""The whole run as one Spark application: audit, clean, train, report, publish, validate."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tranche.learning.features import MODEL_FEATURES
from tranche.learning.models import MODEL_NAMES, Settings
from tranche.learning.training import store_models, train_and_score
from tranche.operators import enrich, profile, rules, scoring
from tranche.plans import export, reports
from tranche.schemas import POST_OUTCOME, RISK_OUTPUTS, SOURCE_TABLES, TABLES
from tranche.sources import versions
from tranche.sources.files import read_sources
from tranche.sources.sinks import (
    load_counts,
    register_views,
    store_loans,
    store_table,
    write_clean_csv,
    write_json,
)


@dataclass(frozen=True)
class Plan:
    """Dates, sizes and settings of one run."""

    train_end: str = scoring.TRAIN_END
    validation_end: str = scoring.VALIDATION_END
    cutoff: str = enrich.REPORTED_CUTOFF
    settings: Settings = Settings()
    models: tuple[str, ...] = MODEL_NAMES
    expected_sources: dict[str, int] = field(default_factory=dict)
    expected_export: dict[str, int] = field(default_factory=dict)


def portfolio_facts(loans: DataFrame, plan: Plan) -> DataFrame:
    """Portfolio summary, class balance and the scope of modelling, in the profile's long form."""
    summary = profile.portfolio_summary(loans)
    whole = profile.WHOLE_TABLE
    facts = [
        profile.fact(whole, name, text=F.col(name)) if "date" in name
        else profile.fact(whole, name, F.col(name))
        for name in summary.columns
    ]
    facts += [
        profile.fact(whole, "scope_train_before", text=F.lit(plan.train_end)),
        profile.fact(whole, "scope_validation_before", text=F.lit(plan.validation_end)),
        profile.fact(whole, "scope_last_reported_date", text=F.lit(plan.cutoff)),
        *[profile.fact(n, "scope_model_input", text=F.lit("known at origination")) for n in MODEL_FEATURES],
        *[profile.fact(n, "scope_excluded", text=F.lit("known after the outcome")) for n in POST_OUTCOME],
        *[profile.fact(n, "scope_excluded", text=F.lit("output of another model")) for n in RISK_OUTPUTS],
    ]
    return profile.stacked(summary, facts).select(F.lit("clean_loans").alias("table_name"), "*")


def audit_report(raw: dict[str, DataFrame], clean: DataFrame, plan: Plan) -> DataFrame:
    """Profiles of all supplied tables, the loan checks, and what the portfolio and the models'
    scope are, in the profile's long form."""
    profiles = [profile.profile_table(df, name) for name, df in raw.items()]
    profiles.append(portfolio_facts(clean, plan))
    checks = rules.loan_checks(raw["loans"], plan.cutoff).select(
        F.lit("loans").alias("table_name"),
        F.lit(profile.WHOLE_TABLE).alias("column_name"),
        F.col("check_name").alias("metric"),
        F.col("violations").cast("double").alias("number"),
        F.lit(None).cast("string").alias("text"),
    )
    return reduce(DataFrame.unionByName, [*profiles, checks])


def land(raw: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """The supplied tables as typed Parquet, every cell read once; a cell that does not fit stops here."""
    landed = {}
    for name, df in raw.items():
        df.write.parquet(f"{folder}/landed/{name}")
        landed[name] = df.sparkSession.read.schema(df.schema).parquet(f"{folder}/landed/{name}")
    return landed


def clean_and_store(
    raw: dict[str, DataFrame], folder: str, cutoff: str = enrich.REPORTED_CUTOFF
) -> dict[str, DataFrame]:
    """Clean tables under their model names, stored and read back; stops if a constraint is broken."""
    cleaned = enrich.clean_sources(raw, cutoff)
    stored = {"loans": store_loans(cleaned["loans"], folder)}
    for name in ("ratings", "portfolio", "stress", "vintage"):
        table = SOURCE_TABLES[name].name
        stored[table] = store_table(cleaned[name], folder, table)
    rules.require_clean(rules.check_tables(stored, TABLES))
    return stored


def train_and_store(
    tables: dict[str, DataFrame], folder: str, plan: Plan
) -> dict[str, DataFrame]:
    """Result tables of the modelling step and the loan fact, stored and read back."""
    result = train_and_score(
        tables["loans"], plan.settings, plan.train_end, plan.validation_end, plan.models
    )
    store_models(result.models, f"{folder}/models")
    write_json(result.metadata, f"{folder}/model_metadata")
    stored = {
        "loan_predictions": store_table(result.predictions, folder, "loan_predictions"),
        "model_metrics": store_table(result.metrics, folder, "model_metrics"),
        "threshold_analysis": store_table(result.thresholds, folder, "threshold_analysis"),
        "feature_importance": store_table(result.importance, folder, "feature_importance"),
    }
    rules.require_clean(rules.check_tables({"loans": tables["loans"], **stored}, TABLES))
    fact = reports.loan_fact(tables["loans"], stored["loan_predictions"])
    stored["loan_fact"] = store_table(fact, folder, "loan_fact")
    return stored


def reporting_views(tables: dict[str, DataFrame], folder: str) -> dict[str, DataFrame]:
    """Grouped views stored as tables, the others as plans over the stored tables."""
    fact = tables["loan_fact"]
    views = {
        name: store_table(build(fact), folder, name)
        for name, build in (
            ("sector_risk", reports.sector_risk),
            ("rating_risk", reports.rating_risk),
            ("monthly_risk_trend", reports.monthly_risk_trend),
            ("risk_decile_lift", reports.risk_decile_lift),
        )
    }
    views |= {
        "executive_kpis": reports.executive_kpis(fact),
        "model_test_metrics": reports.model_test_metrics(tables["model_metrics"]),
        "threshold_simulator": reports.threshold_simulator(tables["threshold_analysis"]),
        "stress_impact": reports.stress_scenarios(tables["stress_scenarios"]),
        "rating_migration": reports.rating_migration(tables["credit_ratings"]),
        "vintage_curves": reports.vintage_curves(tables["vintage_analysis"]),
    }
    return views


def validate_run(
    tables: dict[str, DataFrame], plan: Plan, published: str
) -> DataFrame:
    """One row of the final figures; stops if any of them is wrong."""
    spark = tables["loan_fact"].sparkSession
    if plan.expected_sources:
        counts = load_counts({name: tables[name] for name in plan.expected_sources})
        compared = rules.compare_counts(counts, plan.expected_sources)
        wrong = compared.where(F.coalesce(F.col("status"), F.lit("CHECK")) != "OK").collect()
        if wrong:
            raise ValueError(f"wrong row counts: {[tuple(row) for row in wrong]}")
    integrity = rules.scored_integrity(tables["loan_fact"])
    row = integrity.first()
    if row["loan_rows"] != row["unique_loan_ids"]:
        raise ValueError("scored loans hold a key twice")
    if row["invalid_probabilities"] or row["missing_analytical_outputs"]:
        raise ValueError("scored loans hold invalid or missing outputs")
    lacking = rules.missing_values_of(tables["model_metrics"], "model_name", plan.models).collect()
    if lacking:
        raise ValueError(f"metrics lack models {[r['model_name'] for r in lacking]}")
    version = versions.current(spark, published)
    listed = spark.read.parquet(f"{version}/Manifest")
    written = export.row_counts(
        {name: spark.read.parquet(f"{version}/{name}") for name in export.SHEETS}
    )
    if {r["sheet_name"]: r["row_count"] for r in listed.collect()} != written:
        raise ValueError("published tables do not match their manifest")
    # Row counts of all tables, supplied and published, beside the integrity figures
    counts = load_counts({name: tables[name] for name in sorted(tables)}).unionByName(
        listed.select(F.col("sheet_name").alias("table_name"), F.col("row_count").alias("rows"))
    )
    listed = counts.agg(F.sort_array(F.collect_list(F.struct("table_name", "rows"))).alias("row_counts"))
    return integrity.crossJoin(F.broadcast(listed)).withColumn("status", F.lit("PASS"))


def run_tables(
    raw: dict[str, DataFrame], folder: str, published: str, plan: Plan = Plan()
) -> DataFrame:
    """All steps on supplied tables; returns the validation row.

    Everything is written to a new version of ``folder``, which is put in use when all of it is
    checked. Whatever fails before, the version in use stays.
    """
    spark = next(iter(raw.values())).sparkSession
    stage = versions.start(folder)
    try:
        raw = land(raw, stage)
        tables = clean_and_store(raw, stage, plan.cutoff)
        write_json(audit_report(raw, tables["loans"], plan), f"{stage}/data_audit_report")
        tables |= train_and_store(tables, stage, plan)
        views = reporting_views(tables, stage)
        export.publish(export.export_tables(tables), published, plan.expected_export, plan.models)
        status = validate_run(tables, plan, published)
        versions.commit(spark, folder, stage)
        register_views({**tables, **views})
    except Exception:
        versions.discard(spark, stage)
        raise
    return status


def run(
    spark: SparkSession, sources: str, folder: str, published: str, plan: Plan = Plan()
) -> DataFrame:
    """All steps from the supplied CSV files, with the clean tables also written as CSV."""
    raw = read_sources(spark, sources)
    status = run_tables(raw, folder, published, plan)
    version = versions.current(spark, folder)
    stored = {
        name: spark.read.parquet(f"{version}/{table.name}") for name, table in SOURCE_TABLES.items()
    }
    write_clean_csv(stored, f"{version}/clean_csv")
    return status
