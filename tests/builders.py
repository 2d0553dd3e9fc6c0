"""Small loan tables for tests; every field can be overridden per row."""

import datetime
from decimal import Decimal

from tranche.schemas import PORTFOLIO, RAW_LOANS, Table

DEFAULTS = {
    "origination_date": datetime.date(2020, 1, 1),
    "maturity_date": datetime.date(2022, 1, 1),
    "maturity_months": 24,
    "sector": "Energy",
    "loan_type": "Term Loan",
    "collateral": "Secured",
    "initial_rating": "BBB",
    "credit_score": 700,
    "ead": 1000,
    "coupon_rate": 3,
    "leverage": 2,
    "interest_coverage": 4,
    "debt_to_equity": 1,
    "pd_annual": "0.02",
    "lgd": "0.5",
    "el": 10,
    "unexpected_loss": 20,
    "rwa": 500,
    "defaulted": 0,
    "default_date": None,
    "survival_months": 24,
    "recovery_rate": None,
    "loss_given_default": None,
}
BAD = {
    "defaulted": 1,
    "default_date": datetime.date(2021, 1, 1),
    "survival_months": 12,
    "recovery_rate": "0.5",
    "loss_given_default": 500,
}


def typed(kind, value):
    return Decimal(str(value)) if value is not None and kind.startswith("decimal") else value


def table(spark, declared: Table, rows: list[dict]):
    ddl = ", ".join(f"{name} {kind}" for name, kind in declared.fields)
    data = [tuple(typed(kind, row.get(name)) for name, kind in declared.fields) for row in rows]
    return spark.createDataFrame(data, ddl)


def loans(spark, *rows: dict):
    filled = [{"loan_id": f"L{i}", **DEFAULTS, **row} for i, row in enumerate(rows)]
    return table(spark, RAW_LOANS, filled)


def macro(spark, *dates: datetime.date):
    base = {name: 0 for name in PORTFOLIO.columns}
    return table(
        spark,
        PORTFOLIO,
        [{**base, "date": d, "gdp_growth": 2, "unemployment": 5} for d in dates],
    )
