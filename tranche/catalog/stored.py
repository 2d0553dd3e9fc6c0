"""Registered queries on stored tables and files, and the SQL that checks them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tranche import schemas
from tranche.catalog.oracle import LOAN_NUMBERS, LOAN_TEXTS, oracle, unions, using
from tranche.catalog.queries import clean, loans, registered
from tranche.operators import profile, sketches
from tranche.plans import reports
from tranche.session import run_folder, settle, small_side
from tranche.sources import files, shapes, sinks

YEAR = 1997
#: Planted bad cells: column, text, and of which multiples of the loan's number.
PLANTED = (("credit_score", "n/a", 50), ("origination_date", "1997-13-45", 70), ("ead", "1.2.3", 90))
FOOTERS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def loans_by_year(spark, folder):
    return loans(spark, folder).withColumn("origination_year", F.year("origination_date"))


def profiled(spark, folder):
    """Loans by year, without the year as a number of its own, and the stored sketches of every year."""
    rows = loans_by_year(spark, folder)
    return rows.drop("origination_year"), sketches.store_sketches(rows, run_folder(spark), "origination_year")


@registered
def sketched_quartiles(spark, folder):
    """Quartiles merged from the stored sketches of all years, held against the exact ranks."""
    rows, stored = profiled(spark, folder)
    found = settle(sketches.merged_quantiles(stored))
    names = profile.numeric_columns(rows)
    values = profile.long_form(rows, names, "double").join(small_side(found), "column_name")
    checks = [F.first("n").alias("n"), F.count("*").alias("rows")]
    for i in (1, 2, 3):
        checks += [F.count_if(F.col("value") < F.col(f"q{i}")).alias(f"below{i}"),
                   F.count_if(F.col("value") <= F.col(f"q{i}")).alias(f"upto{i}")]
    within = F.lit(True)
    for i, fraction in enumerate((0.25, 0.5, 0.75), start=1):
        within = within & (F.col(f"below{i}") <= (fraction + sketches.RANK_ERROR) * F.col("rows"))
        within = within & (F.col(f"upto{i}") >= (fraction - sketches.RANK_ERROR) * F.col("rows"))
    return values.groupBy("column_name").agg(*checks).select("column_name", "n", within.alias("within"))


@registered
def sketched_distinct_counts(spark, folder):
    """Distinct values from the merged sketches of all years and from one sketch of the whole table, held
    against the exact counts."""
    rows, stored = profiled(spark, folder)
    merged = sketches.merged_distinct(stored).withColumnRenamed("number", "merged")
    whole = sketches.merged_distinct(sketches.sketched(rows.withColumn("all", F.lit(1)), "all"))
    exact = profile.distinct_counts(rows).select("column_name", "number")
    both = exact.join(merged, "column_name").join(whole.withColumnRenamed("number", "whole"), "column_name")
    return both.select("column_name", "number", *[
        (F.abs(F.col(c) - F.col("number")) <= sketches.DISTINCT_ERROR * F.col("number")).alias(f"{c}_within")
        for c in ("merged", "whole")
    ])


@registered
def replaced_year(spark, folder):
    """A stored table by year of which one year is delivered again, twice, with other exposures; files of
    the other years stay as they are."""
    target = run_folder(spark)
    rows = loans_by_year(spark, folder).select("loan_id", "origination_year", "ead")
    sinks.replace_partitions(rows, target, "loans", "origination_year")

    def kept():
        stored = spark.read.parquet(f"{target}/loans")
        return stored.select("origination_year", "_metadata.file_path", "_metadata.file_modification_time").distinct()

    before = settle(kept())
    changed = rows.where(F.col("origination_year") == YEAR).withColumn("ead", F.col("ead") + 100)
    for _ in range(2):
        stored = sinks.replace_partitions(changed, target, "loans", "origination_year")
    same = before.join(kept(), before.columns, "left_semi").select("origination_year").distinct()
    totals = stored.groupBy("origination_year").agg(F.count("*").alias("loans"), F.sum("ead").alias("ead"))
    return totals.join(same.withColumn("untouched", F.lit(True)), "origination_year", "left").select(
        "origination_year", "loans", "ead", F.coalesce("untouched", F.lit(False)).alias("untouched")
    )


@registered
def footer_counts(spark, folder):
    """Rows of the given tables, from their files' footers."""
    return sinks.footer_counts(spark, {name: f"{folder}/{name}.parquet" for name in FOOTERS})


@registered
def footer_counts_by_year(spark, folder):
    """Rows of each year of a stored table, from its files' footers."""
    target = run_folder(spark)
    sinks.replace_partitions(loans_by_year(spark, folder), target, "loans", "origination_year")
    return sinks.footer_counts_by(spark, f"{target}/loans", "origination_year")


@registered
def bad_cell_report(spark, folder):
    """All planted cells that do not fit their type, each on a line of its own file."""
    rows = loans(spark, folder)
    number = F.substring("loan_id", 2, 12).cast("bigint")
    planted = {c: F.when(number % step == 0, F.lit(text)).otherwise(F.col(c).cast("string")) for c, text, step in PLANTED}
    target = f"{run_folder(spark)}/loans.csv"
    rows.select(*[planted.get(n, F.col(n).cast(kind)).alias(n) for n, kind in schemas.RAW_LOANS.fields]).write.csv(
        target, header=True
    )
    cells = settle(files.bad_cells(spark, target, schemas.RAW_LOANS))
    lines = cells.groupBy("column_name", "file", "line").agg(F.count("*").alias("n"))
    lines = lines.groupBy("column_name").agg(F.count("*").alias("lines"))
    found = files.bad_cell_report(cells).select("column_name", "cells", "text")
    return found.join(small_side(lines), "column_name")


@registered
def audit_json(spark, folder):
    """The date ranges of the audit report, written as JSON and read back."""
    path = f"{run_folder(spark)}/audit"
    found = profile.date_ranges(loans(spark, folder, with_sector=False)).select("column_name", "metric", "text")
    sinks.write_json(found, path)
    return spark.read.schema("column_name string, metric string, text string").json(path)


@registered
def report_csv(spark, folder):
    """The stress table delivered as CSV, typed by its declared schema, and the totals of its scenarios."""
    target = run_folder(spark)
    sinks.conform(shapes.stress(loans(spark, folder)), "stress_scenarios").write.csv(f"{target}/stress.csv", header=True)
    return reports.scenario_totals(files.read_report_csv(spark, target, "stress_scenarios", "stress.csv"))


@registered
def rebuilt_tables(spark, folder):
    """Rows of the declared tables after a rebuild from nothing and a load of four of them by header."""
    base = loans(spark, folder)
    database = f"tranche_{uuid.uuid4().hex}"
    sinks.rebuild_database(spark, database, run_folder(spark))
    loaded = {
        "loans": clean(spark, folder), "credit_ratings": shapes.ratings(spark, folder),
        "portfolio_metrics": shapes.macro(spark, folder), "stress_scenarios": shapes.stress(base),
    }
    for name, df in loaded.items():
        sinks.load_table(df.select(*reversed(df.columns)), database, name)
    return sinks.load_counts({name: spark.table(f"{database}.{name}") for name in schemas.TABLES})


def sql() -> dict[str, str]:
    known = oracle()
    own, number = using("loans"), "CAST(substr(loan_id, 2) AS BIGINT)"
    year = "CAST(year(origination_date) AS BIGINT)"
    empty = ("vintage_analysis", "loan_predictions", "model_metrics", "threshold_analysis", "feature_importance")
    return {
        "sketched_quartiles": own(unions(
            [f"SELECT '{n}' AS column_name, count({n}) AS n, true AS within FROM loans" for n in LOAN_NUMBERS]
        )),
        "sketched_distinct_counts": own(unions(
            [f"SELECT '{n}' AS column_name, CAST(count(DISTINCT {n}) AS DOUBLE) AS number, true AS merged_within, "
             "true AS whole_within FROM loans" for n in LOAN_TEXTS]
        )),
        "replaced_year": own(
            f"SELECT {year} AS origination_year, count(*) AS loans, CAST(sum(ead + CASE WHEN {year} = {YEAR} THEN 100 "
            f"ELSE 0 END) AS DOUBLE) AS ead, {year} <> {YEAR} AS untouched FROM loans GROUP BY 1, 4"
        ),
        "footer_counts": unions([f"SELECT '{n}' AS table_name, count(*) AS rows FROM {n}" for n in FOOTERS]),
        "footer_counts_by_year": own(f"SELECT {year} AS origination_year, count(*) AS rows FROM loans GROUP BY 1"),
        "bad_cell_report": own(unions(
            [f"SELECT '{c}' AS column_name, count(*) AS cells, '{text}' AS text, count(*) AS lines FROM loans "
             f"WHERE {number} % {step} = 0 HAVING count(*) > 0" for c, text, step in PLANTED]
        )),
        "audit_json": known["loan_date_ranges"],
        "report_csv": known["scenario_totals"],
        "rebuilt_tables": using("loans", "ratings", "macro", "stress")(unions(
            [f"SELECT '{name}' AS table_name, count(*) AS rows FROM {table}" for name, table in (
                ("loans", "loans"), ("credit_ratings", "ratings"), ("portfolio_metrics", "macro"),
                ("stress_scenarios", "stress"))]
            + [f"SELECT '{name}', CAST(0 AS BIGINT)" for name in empty]
        )),
    }
