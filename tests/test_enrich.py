import datetime

import pytest
from builders import BAD, loans, macro

from tranche.operators import enrich

JAN, FEB = datetime.date(2020, 1, 1), datetime.date(2020, 2, 1)


def test_text_is_stripped_of_all_whitespace(spark):
    row = enrich.trim_text(loans(spark, {"loan_id": " \tL1\n", "sector": "\u0009Energy "})).first()
    assert (row["loan_id"], row["sector"]) == ("L1", "Energy")


def test_score_bands_are_right_closed(spark):
    scores = [299, 300, 579, 580, 669, 670, 739, 740, 799, 800, 850, 851]
    df = enrich.derive_columns(loans(spark, *[{"credit_score": s} for s in scores]))
    bands = {r["credit_score"]: r["credit_score_band"] for r in df.collect()}
    assert [bands[s] for s in scores] == [
        None, "Poor", "Poor", "Fair", "Fair", "Good", "Good", "Very Good", "Very Good",
        "Exceptional", "Exceptional", None,
    ]


def test_derived_columns(spark):
    df = enrich.derive_columns(
        loans(
            spark,
            {"maturity_date": datetime.date(2024, 12, 31)},
            {**BAD, "origination_date": datetime.date(2015, 5, 1)},
            {**BAD, "loss_given_default": None},
        )
    )
    first, second, third = df.orderBy("loan_id").collect()
    assert first["reported_maturity_is_capped"] == 1 and second["reported_maturity_is_capped"] == 0
    assert (first["default_loss_amount"], second["default_loss_amount"]) == (0, 500)
    assert third["default_loss_amount"] == 0
    assert second["origination_quarter"] == "2015Q2"
    assert (second["origination_year"], second["origination_month"]) == (2015, 5)
    assert float(first["existing_expected_loss_rate"]) == pytest.approx(0.01)


def test_macro_values_come_from_the_origination_month(spark):
    joined = enrich.clean_loans(loans(spark, {}, {"origination_date": FEB}), macro(spark, JAN, FEB))
    assert {float(r["origination_unemployment"]) for r in joined.collect()} == {5.0}


def test_loan_without_macro_month_stops(spark):
    with pytest.raises(ValueError, match="2020-02-01"):
        enrich.join_macro(loans(spark, {}, {"origination_date": FEB}), macro(spark, JAN))


def test_repeated_macro_month_stops(spark):
    with pytest.raises(ValueError, match="more than once"):
        enrich.join_macro(loans(spark, {}), macro(spark, JAN, JAN))
