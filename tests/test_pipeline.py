import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tranche.learning.models import Settings
from tranche.plans import pipeline
from tranche.schemas import SOURCE_FILES, SOURCE_TABLES
from tranche.sources import files, sinks, versions

SECTORS, RATINGS = ["Energy", "Retail", "Tech"], ["AAA", "A", "BBB", "B"]


def pick(values, number):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int"))


@pytest.fixture(scope="module")
def sources(spark, tmp_path_factory):
    """Five CSV files with 720 loans over 36 months."""
    folder = str(tmp_path_factory.mktemp("sources"))
    key = F.col("id")
    bad = F.pmod(F.xxhash64("id"), F.lit(10)) < 2 + key % 3
    started = F.expr("add_months(date'2020-01-01', CAST(id % 36 AS INT))")
    loans = spark.range(720).select(
        F.format_string(" L%05d ", "id").alias("loan_id"),
        started.alias("origination_date"),
        F.add_months(started, 24).alias("maturity_date"),
        F.lit(24).alias("maturity_months"),
        pick(SECTORS, key).alias("sector"),
        pick(["Term Loan", "Bridge"], key).alias("loan_type"),
        pick(["Secured", "None"], key).alias("collateral"),
        pick(RATINGS, key).alias("initial_rating"),
        (500 + key % 300).alias("credit_score"),
        (1000 + key * 7).alias("ead"),
        F.lit(3.5).alias("coupon_rate"),
        (1 + key % 3 + F.when(bad, 1).otherwise(0)).alias("leverage"),
        F.lit(4).alias("interest_coverage"),
        F.lit(1.5).alias("debt_to_equity"),
        F.lit(0.02).alias("pd_annual"),
        F.lit(0.4).alias("lgd"),
        F.lit(12.5).alias("el"),
        F.lit(50).alias("unexpected_loss"),
        F.lit(500).alias("rwa"),
        bad.cast("int").alias("defaulted"),
        F.when(bad, F.add_months(started, 6)).alias("default_date"),
        F.when(bad, 6).otherwise(24).alias("survival_months"),
        F.when(bad, 0.6).alias("recovery_rate"),
        F.when(bad, 400).alias("loss_given_default"),
    )
    months = spark.range(36).select(F.expr("add_months(date'2020-01-01', CAST(id AS INT))").alias("date"))
    fixed = {
        "portfolio": months.select("*", *[
            F.lit(0.5).alias(c) for c in SOURCE_TABLES["portfolio"].columns if c != "date"
        ]).withColumns({"n_active_loans": F.lit(5), "new_defaults": F.lit(1)}),
        "ratings": spark.range(90).select(
            (F.col("id") % 30).cast("string").alias("issuer_id"), pick(SECTORS, key).alias("sector"),
            (2020 + F.floor(key / 30)).alias("year"), F.lit("A").alias("from_rating"),
            F.lit("BBB").alias("to_rating"), F.lit(0).alias("upgraded"), F.lit(1).alias("downgraded"),
            F.lit(0).alias("defaulted"), F.lit(1).alias("notches_moved")),
        "stress": spark.range(6).select(
            pick(["baseline", "severe"], key).alias("scenario"),
            pick(SECTORS, F.floor(key / 2)).alias("sector"),
            *[F.lit(0.5).alias(c) for c in SOURCE_TABLES["stress"].columns
              if c not in ("scenario", "sector", "credit_spread_bps")],
            F.lit(100).alias("credit_spread_bps")),
        "vintage": spark.range(40).select(
            F.concat(F.lit("202"), F.floor(key / 20).cast("string"), F.lit("Q1")).alias("vintage"),
            (F.lit(1) + key % 20 + F.lit(20)).alias("months_on_books"),
            F.lit(60).alias("n_loans_originated"), F.lit(50).alias("n_active"),
            F.lit(10).alias("n_defaulted_cumulative"),
            *[F.lit(0.1).alias(c) for c in SOURCE_TABLES["vintage"].columns[5:]]),
    }
    for name, df in {"loans": loans, **fixed}.items():
        df.coalesce(1).write.csv(f"{folder}/{SOURCE_FILES[name]}", header=True)
    return folder


def plan(**changes):
    settings = Settings(trees=4, tree_depth=3, rounds=3, folds=3)
    return pipeline.Plan(settings=settings, expected_sources={"loans": 720}, **changes)


def test_whole_run_from_files(spark, sources, tmp_path):
    folder, published = str(tmp_path / "tables"), str(tmp_path / "published")
    row = pipeline.run(spark, sources, folder, published, plan(expected_export={"Fact_Loans": 720}))
    row = row.first()
    assert row["status"] == "PASS" and row["loan_rows"] == 720
    assert {r["table_name"]: r["rows"] for r in row["row_counts"]}["Fact_Loans"] == 720
    tables_root, folder = folder, versions.current(spark, folder)
    manifest = {r["sheet_name"]: r["row_count"] for r in
                spark.read.parquet(f"{versions.current(spark, published)}/Manifest").collect()}
    assert manifest == {
        "Fact_Loans": 720, "Fact_Thresholds": 99, "Fact_ModelMetrics": 8, "Fact_Portfolio": 36,
        "Fact_Stress": 6, "Fact_Vintage": 40, "Fact_Migration": 9, "Feature_Importance": 18,
    }
    # The views are open to SQL, and text was trimmed on the way.
    top = spark.sql("SELECT sector FROM sector_risk ORDER BY default_rate_rank, sector").first()
    assert top["sector"] in SECTORS
    assert spark.sql("SELECT count(*) AS n FROM loan_fact WHERE loan_id LIKE ' %'").first()["n"] == 0
    assert spark.sql("SELECT sum(loans) AS n FROM executive_kpis").first()["n"] == 720
    report = spark.read.json(f"{folder}/data_audit_report")
    assert report.where("metric = 'rows'").count() == 5
    facts = {r["metric"]: r["number"] for r in report.where("table_name = 'clean_loans'").collect()}
    assert facts["clean_loan_rows"] == 720 and facts["defaults"] + facts["non_defaults"] == 720
    assert report.where("metric = 'scope_excluded'").count() == 9
    clean = files.read_typed_csv(
        spark, f"{folder}/clean_csv/loan_portfolio_clean", SOURCE_TABLES["loans"])
    assert clean.count() == 720
    assert spark.read.json(f"{folder}/model_metadata").count() == 1

    tables = {n: sinks.conform(spark.read.parquet(f"{folder}/{n}"), n)
              for n in ("loans", "model_metrics")}
    tables["loan_fact"] = spark.read.parquet(f"{folder}/loan_fact")
    wrong = pipeline.Plan(expected_sources={"loans": 721})
    with pytest.raises(ValueError, match="721"):
        pipeline.validate_run(tables, wrong, published)
    with pytest.raises(ValueError, match="lack models"):
        pipeline.validate_run(tables, pipeline.Plan(models=("Another",)), published)

    # A delivery that breaks a constraint, or has a bad cell in any column, leaves the tables in use.
    raw = files.read_sources(spark, sources)
    broken = raw["loans"].withColumn("ead", F.when(F.trim("loan_id") == "L00007", -1).otherwise(F.col("ead")))
    with pytest.raises(ValueError, match="ead_positive"):
        pipeline.run_tables({**raw, "loans": broken}, tables_root, published, plan())
    bad = raw["ratings"].withColumn("notches_moved", F.expr(
        "CASE WHEN issuer_id = '3' THEN CAST(raise_error('notches_moved: not a smallint') AS SMALLINT) ELSE notches_moved END"))
    with pytest.raises(PySparkException, match="notches_moved"):
        pipeline.run_tables({**raw, "ratings": bad}, tables_root, published, plan())
    assert versions.current(spark, tables_root) == folder
    assert spark.read.parquet(f"{folder}/loans").count() == 720
