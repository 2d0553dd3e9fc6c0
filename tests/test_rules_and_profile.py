import datetime

import pandas as pd
import pytest
from builders import BAD, loans, macro
from pyspark.sql import functions as F

from tranche import schemas
from tranche.operators import profile, rules
from tranche.plans import reports


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_each_loan_check_counts_its_own_violation(spark):
    day = datetime.date
    df = loans(
        spark,
        {"loan_id": "A"},
        {"loan_id": "A"},
        {"loan_id": None},
        {"loan_id": None},
        {"defaulted": 2},
        {"defaulted": None},
        {**BAD, "default_date": None},
        {"default_date": day(2021, 1, 1)},
        {**BAD, "default_date": day(2019, 1, 1)},
        {"survival_months": 25},
        {"survival_months": 3},
        {"credit_score": 299},
        {"ead": 0},
        {"pd_annual": "1.1"},
        {"lgd": "-0.1"},
        {**BAD, "default_date": day(2025, 1, 1), "maturity_date": day(2024, 1, 1)},
    )
    assert as_dict(rules.loan_checks(df), "check_name", "violations") == {
        "duplicate_loan_ids": 2,
        "invalid_target_values": 2,
        "default_without_default_date": 1,
        "nondefault_with_default_date": 1,
        "default_before_origination": 1,
        "survival_exceeds_contractual_maturity": 1,
        "nondefault_not_observed_to_contractual_maturity": 2,
        "credit_score_outside_300_850": 1,
        "nonpositive_ead": 1,
        "pd_outside_0_1": 1,
        "lgd_outside_0_1": 1,
        "defaults_after_reported_maturity_date": 1,
        "defaults_after_2024_12_31": 1,
    }


def test_constraints_name_rule_and_sample(spark):
    df = loans(
        spark,
        {},
        {"coupon_rate": 101},
        {**BAD, "recovery_rate": None},
        {"recovery_rate": "0.1"},
        {"sector": None},
        {"leverage": -1},
    )
    found = {
        r["rule"]: (r["violations"], r["sample_key"])
        for r in rules.constraint_report(df, schemas.RAW_LOANS).collect()
        if r["violations"]
    }
    assert found == {
        "coupon_rate_between_0_and_100": (1, "L1"),
        "default_fields_match_flag": (2, "L2"),
        "sector_not_null": (1, "L4"),
        "leverage_at_least_0": (1, "L5"),
    }


def test_key_and_foreign_key_rules(spark):
    parent = spark.createDataFrame([("A",), ("B",)], "loan_id string")
    child = spark.createDataFrame([("A", 1), ("A", 2), ("X", 3)], "loan_id string, v int")
    parents = schemas.Table("loans", "loan_id string", ("loan_id",))
    children = schemas.Table(
        "loan_predictions", "loan_id string, v int", ("loan_id",), references={"loan_id": "loans"}
    )
    report = rules.check_tables(
        {"loans": parent, "loan_predictions": child},
        {"loans": parents, "loan_predictions": children},
    )
    broken = {(r["table_name"], r["rule"]): (r["violations"], r["sample_key"])
              for r in report.collect() if r["violations"]}
    assert broken == {
        ("loan_predictions", "primary_key"): (1, "A"),
        ("loan_predictions", "loan_id_in_loans"): (1, "X"),
    }
    with pytest.raises(ValueError, match="primary_key"):
        rules.require_clean(report)


def test_counts_compare_and_missing_tables_fail(spark):
    counts = spark.createDataFrame([("a", 3), ("b", 5)], "table_name string, rows bigint")
    rows = {r["table_name"]: (r["difference"], r["status"])
            for r in rules.compare_counts(counts, {"a": 3, "b": 4, "c": 1}).collect()}
    assert rows == {"a": (0, "OK"), "b": (1, "CHECK"), "c": (None, "CHECK")}
    assert rules.overall_status(rules.compare_counts(counts, {"a": 3})).first()["status"] == "OK"


def test_leaking_features_are_named():
    assert rules.leaking_features(["ead", "lgd", "default_date"]) == ["default_date", "lgd"]


def test_profile_matches_pandas(spark):
    frame = pd.DataFrame(
        {
            "x": [1.0, 2.0, 2.0, 3.0, 100.0, None, 2.0],
            "flat": [5.0, 5.0, 5.0, 5.0, 5.0, 6.0, 5.0],
            "t": ["a", "b", "b", None, "a", "c", "b"],
        }
    )
    found = profile.profile_table(
        spark.createDataFrame(frame.astype(object).where(frame.notna(), None),
                              "x double, flat double, t string"), "sample"
    )
    got = {(r["column_name"], r["metric"]): r["number"] for r in found.collect()}
    assert got[("*", "rows")] == 7 and got[("*", "columns")] == 3
    assert got[("*", "duplicate_rows")] == int(frame.duplicated().sum())
    assert got[("x", "missing_values")] == 1 and ("flat", "missing_values") not in got
    assert got[("x", "median")] == frame["x"].median()
    assert got[("x", "mean")] == pytest.approx(frame["x"].mean())
    assert got[("x", "iqr_outliers")] == 1
    # The quartiles of `flat` coincide: every other value is an outlier.
    assert got[("flat", "iqr_outliers")] == 1
    assert got[("t", "unique_values")] == 3


def test_duplicate_rows_with_one_hot_row(spark):
    df = spark.range(900).selectExpr("IF(id % 3 = 0, -1, id) AS a", "'x' AS b")
    assert profile.duplicate_rows(df).first()["number"] == 299


def test_ratings_outside_the_scale_are_left_out(spark):
    df = loans(spark, {"initial_rating": "AAA"}, {"initial_rating": "NR"})
    scored = df.selectExpr("*", "0.1BD AS default_probability")
    assert [r["initial_rating"] for r in reports.rating_risk(scored).collect()] == ["AAA"]


def test_rolling_trend_keeps_short_frames(spark):
    dates = [datetime.date(2020, m, 1) for m in range(1, 13)] + [datetime.date(2021, 1, 1)]
    df = macro(spark, *dates).withColumn("new_defaults", F.lit(2))
    sums = [r["defaults_12m"] for r in reports.rolling_trend(df).collect()]
    assert sums == [2 * min(i, 12) for i in range(1, 14)]
