"""Tables of the model: columns, types, keys and constraints.

Types, ranges and names are fixed values of the data model.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Table:
    """One table: its columns as Spark DDL, its key, nullable columns and row rules."""

    name: str
    ddl: str
    key: tuple[str, ...]
    nullable: frozenset[str] = frozenset()
    checks: dict[str, str] = field(default_factory=dict)
    references: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [name for name, _ in self.fields]

    @property
    def fields(self) -> list[tuple[str, str]]:
        # Spark's own parser needs a session, and names are wanted before there is one.
        columns = re.split(r",\s*(?![^()]*\))", self.ddl.strip())
        return [(name, kind) for name, kind in (column.split() for column in columns)]

    @property
    def required(self) -> list[str]:
        return [name for name in self.columns if name not in self.nullable]


def between(column: str, low: str, high: str) -> dict[str, str]:
    return {f"{column}_between_{low}_and_{high}": f"{column} BETWEEN {low} AND {high}"}


def at_least(column: str, low: str) -> dict[str, str]:
    return {f"{column}_at_least_{low}": f"{column} >= {low}"}


def flag(column: str) -> dict[str, str]:
    return {f"{column}_is_0_or_1": f"{column} IN (0, 1)"}


def merged(*parts: dict[str, str]) -> dict[str, str]:
    return {name: rule for part in parts for name, rule in part.items()}


# Columns known only after the outcome, and outputs of an earlier risk model:
# neither may be a model input.
POST_OUTCOME = ("default_date", "survival_months", "recovery_rate", "loss_given_default")
RISK_OUTPUTS = ("pd_annual", "lgd", "el", "unexpected_loss", "rwa")

RAW_LOAN_DDL = """
loan_id string, origination_date date, maturity_date date, maturity_months smallint,
sector string, loan_type string, collateral string, initial_rating string,
credit_score smallint, ead decimal(18,2), coupon_rate decimal(10,6), leverage decimal(10,6),
interest_coverage decimal(10,6), debt_to_equity decimal(10,6), pd_annual decimal(12,9),
lgd decimal(10,7), el decimal(18,2), unexpected_loss decimal(18,2), rwa decimal(18,2),
defaulted smallint, default_date date, survival_months smallint,
recovery_rate decimal(10,7), loss_given_default decimal(18,2)
"""

DERIVED_LOAN_DDL = """
origination_gdp_growth decimal(10,6), origination_unemployment decimal(10,6),
origination_policy_rate decimal(10,6), origination_credit_spread_bps decimal(10,3),
origination_year smallint, origination_month smallint, origination_quarter string,
default_loss_amount decimal(18,2), existing_expected_loss_rate decimal(12,9),
credit_score_band string, ead_band string, reported_maturity_is_capped smallint
"""

DEFAULT_FIELDS = ("default_date", "recovery_rate", "loss_given_default")

RAW_LOAN_CHECKS = merged(
    between("maturity_months", "1", "360"),
    between("credit_score", "300", "850"),
    {"ead_positive": "ead > 0"},
    between("coupon_rate", "0", "100"),
    at_least("leverage", "0"),
    at_least("interest_coverage", "0"),
    at_least("debt_to_equity", "0"),
    between("pd_annual", "0", "1"),
    between("lgd", "0", "1"),
    at_least("el", "0"),
    at_least("unexpected_loss", "0"),
    at_least("rwa", "0"),
    flag("defaulted"),
    at_least("survival_months", "1"),
    {
        "default_fields_match_flag": "defaulted IN (0, 1) AND "
        + " AND ".join(f"({name} IS NOT NULL) = (defaulted = 1)" for name in DEFAULT_FIELDS)
    },
)

RAW_LOANS = Table("loans", RAW_LOAN_DDL, ("loan_id",), frozenset(DEFAULT_FIELDS), RAW_LOAN_CHECKS)

LOANS = Table(
    "loans",
    f"{RAW_LOAN_DDL}, {DERIVED_LOAN_DDL}",
    ("loan_id",),
    frozenset(DEFAULT_FIELDS),
    merged(
        RAW_LOAN_CHECKS,
        between("origination_month", "1", "12"),
        at_least("default_loss_amount", "0"),
        at_least("existing_expected_loss_rate", "0"),
        flag("reported_maturity_is_capped"),
    ),
)

RATINGS = Table(
    "credit_ratings",
    """
    issuer_id string, sector string, year smallint, from_rating string, to_rating string,
    upgraded smallint, downgraded smallint, defaulted smallint, notches_moved smallint
""",
    ("issuer_id", "year"),
    checks=merged(flag("upgraded"), flag("downgraded"), flag("defaulted")),
)

PORTFOLIO = Table(
    "portfolio_metrics",
    """
    date date, n_active_loans int, total_ead decimal(20,2), total_el decimal(20,2),
    total_rwa decimal(20,2), el_rate decimal(12,9), avg_pd decimal(12,9), avg_lgd decimal(10,7),
    var_99 decimal(20,2), cvar_995 decimal(20,2), sector_hhi decimal(10,7), new_defaults int,
    gdp_growth decimal(10,6), unemployment decimal(10,6), policy_rate decimal(10,6),
    credit_spread_bps decimal(10,3)
""",
    ("date",),
    checks=merged(
        at_least("n_active_loans", "0"),
        at_least("total_ead", "0"),
        at_least("total_el", "0"),
        at_least("total_rwa", "0"),
        at_least("el_rate", "0"),
        between("avg_pd", "0", "1"),
        between("avg_lgd", "0", "1"),
        at_least("var_99", "0"),
        at_least("cvar_995", "0"),
        between("sector_hhi", "0", "1"),
        at_least("new_defaults", "0"),
    ),
)

STRESS = Table(
    "stress_scenarios",
    """
    scenario string, gdp_shock_pp decimal(10,6), unemp_shock_pp decimal(10,6),
    rate_shock_pp decimal(10,6), credit_spread_bps int, sector string, base_pd decimal(12,9),
    stressed_pd decimal(12,9), pd_uplift_pp decimal(10,6), pd_multiplier decimal(10,6),
    base_lgd decimal(10,7), stressed_lgd decimal(10,7), total_ead decimal(20,2),
    expected_loss_base decimal(20,2), expected_loss_stress decimal(20,2),
    el_increase_pct decimal(12,6)
""",
    ("scenario", "sector"),
    checks=merged(
        between("base_pd", "0", "1"),
        between("stressed_pd", "0", "1"),
        at_least("pd_multiplier", "0"),
        between("base_lgd", "0", "1"),
        between("stressed_lgd", "0", "1"),
        at_least("total_ead", "0"),
        at_least("expected_loss_base", "0"),
        at_least("expected_loss_stress", "0"),
    ),
)

VINTAGE = Table(
    "vintage_analysis",
    """
    vintage string, months_on_books smallint, n_loans_originated int, n_active int,
    n_defaulted_cumulative int, cumulative_default_rate decimal(12,9),
    marginal_default_rate decimal(12,9), avg_pd_at_origination decimal(12,9),
    avg_credit_score decimal(10,3)
""",
    ("vintage", "months_on_books"),
    checks=merged(
        between("months_on_books", "1", "360"),
        at_least("n_loans_originated", "0"),
        at_least("n_active", "0"),
        at_least("n_defaulted_cumulative", "0"),
        between("cumulative_default_rate", "0", "1"),
        between("marginal_default_rate", "0", "1"),
        between("avg_pd_at_origination", "0", "1"),
    ),
)

PREDICTIONS = Table(
    "loan_predictions",
    """
    loan_id string, origination_date date, sector string, initial_rating string,
    credit_score smallint, ead decimal(18,2), lgd decimal(10,7), pd_annual decimal(12,9),
    defaulted smallint, data_split string, model_name string, default_probability decimal(12,9),
    operating_threshold decimal(8,6), predicted_default smallint, risk_band string,
    risk_decile smallint, underwriting_action string, term_risk_loss_proxy decimal(20,2)
""",
    ("loan_id",),
    checks=merged(
        flag("defaulted"),
        between("default_probability", "0", "1"),
        between("operating_threshold", "0", "1"),
        flag("predicted_default"),
        between("risk_decile", "1", "10"),
        at_least("term_risk_loss_proxy", "0"),
    ),
    references={"loan_id": "loans"},
)

METRICS = Table(
    "model_metrics",
    """
    model_name string, split string, threshold_type string, threshold decimal(8,6),
    roc_auc decimal(12,9), pr_auc decimal(12,9), precision decimal(12,9), recall decimal(12,9),
    f1 decimal(12,9), specificity decimal(12,9), brier_score decimal(12,9),
    approval_rate decimal(12,9), true_negative bigint, false_positive bigint,
    false_negative bigint, true_positive bigint
""",
    ("model_name", "split", "threshold_type"),
)

THRESHOLDS = Table(
    "threshold_analysis",
    """
    model_name string, split string, threshold decimal(8,6), precision decimal(12,9),
    recall decimal(12,9), f1 decimal(12,9), specificity decimal(12,9), approval_rate decimal(12,9),
    true_negative bigint, false_positive bigint, false_negative bigint, true_positive bigint,
    default_loss_exposure decimal(22,2), rejected_good_ead decimal(22,2),
    opportunity_cost_rate_assumption decimal(10,7), total_cost_proxy decimal(22,2)
""",
    ("model_name", "split", "threshold"),
)

IMPORTANCE = Table(
    "feature_importance",
    "model_name string, feature string, importance_mean double, importance_std double",
    ("model_name", "feature"),
)

TABLES = {
    table.name: table
    for table in (
        LOANS, RATINGS, PORTFOLIO, STRESS, VINTAGE, PREDICTIONS, METRICS, THRESHOLDS, IMPORTANCE
    )
}

# Supplied inputs and the file each is delivered in.
SOURCE_FILES = {
    "loans": "loan_portfolio.csv",
    "ratings": "credit_ratings.csv",
    "stress": "macro_stress_scenarios.csv",
    "portfolio": "portfolio_metrics.csv",
    "vintage": "vintage_analysis.csv",
}
SOURCE_TABLES = {
    "loans": RAW_LOANS,
    "ratings": RATINGS,
    "stress": STRESS,
    "portfolio": PORTFOLIO,
    "vintage": VINTAGE,
}
CLEAN_ORDER = {
    "loans": ("origination_date", "loan_id"),
    "ratings": ("year", "issuer_id"),
    "stress": ("scenario", "sector"),
    "portfolio": ("date",),
    "vintage": ("vintage", "months_on_books"),
}
