"""SQL that computes the registered queries straight from the star schema."""

from __future__ import annotations

# Fixed values, written out here so that the code under test cannot vouch for itself.
FORMULAS = (("Formula A", 31, 600, 300), ("Formula B", 17, 700, 200), ("Formula C", 13, 500, 400))
SELECTED_VINTAGES = ("1995Q3", "1997Q4", "1999Q4", "2001Q1")
SCENARIOS = (("baseline", "1.0"), ("mild", "1.25"), ("adverse", "1.5"), ("severe", "2.0"))
SHEETS = (
    ("Fact_Loans", "loan_fact", "One originated loan"),
    ("Fact_Thresholds", "threshold_simulator", "One selected-model test threshold"),
    ("Fact_ModelMetrics", "model_metrics", "One model, split, and threshold type"),
    ("Fact_Portfolio", "portfolio_metrics", "One portfolio month"),
    ("Fact_Stress", "stress_scenarios", "One scenario and sector"),
    ("Fact_Vintage", "vintage_analysis", "One vintage and month on books"),
    ("Fact_Migration", "rating_migration", "One year and sector"),
    ("Feature_Importance", "feature_importance", "One selected-model feature"),
)
LOAN_TYPES = (
    ("loan_id", "string"), ("origination_date", "date"), ("maturity_date", "date"),
    ("maturity_months", "smallint"), ("sector", "string"), ("loan_type", "string"),
    ("collateral", "string"), ("initial_rating", "string"), ("credit_score", "smallint"),
    ("ead", "decimal(18,2)"), ("coupon_rate", "decimal(10,6)"), ("leverage", "decimal(10,6)"),
    ("interest_coverage", "decimal(10,6)"), ("debt_to_equity", "decimal(10,6)"),
    ("pd_annual", "decimal(12,9)"), ("lgd", "decimal(10,7)"), ("el", "decimal(18,2)"),
    ("unexpected_loss", "decimal(18,2)"), ("rwa", "decimal(18,2)"), ("defaulted", "smallint"),
    ("default_date", "date"), ("survival_months", "smallint"), ("recovery_rate", "decimal(10,7)"),
    ("loss_given_default", "decimal(18,2)"),
)

# Named sub-queries, each built on tables or on earlier ones.
LOANS = """
SELECT 'L' || lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS loan_id, o_orderkey AS number,
       started AS origination_date,
       least(CAST(started + to_months(CAST(term AS INTEGER)) AS DATE), DATE '2006-12-31')
           AS maturity_date,
       term AS maturity_months, c_mktsegment AS sector,
       list_extract(['Term Loan', 'Revolver', 'Bridge'], o_orderkey % 3 + 1) AS loan_type,
       list_extract(['Secured', 'Unsecured', 'Guaranteed', 'Mortgage'], o_custkey % 4 + 1)
           AS collateral,
       list_extract(['AAA', 'A', 'BBB', 'BB', 'CCC'], CAST(substr(o_orderpriority, 1, 1) AS BIGINT))
           AS initial_rating,
       300 + (o_orderkey * 7919) % 551 AS credit_score, ead,
       CAST(CAST(20 + o_orderkey % 40 + 15 * bad AS DOUBLE) / 10 AS DECIMAL(10,6)) AS coupon_rate,
       CAST(CAST(1 + o_custkey % 29 AS DOUBLE) / 2 AS DECIMAL(10,6)) AS leverage,
       CAST(CAST(o_orderkey % 78 + 12 * (1 - bad) AS DOUBLE) / 4 AS DECIMAL(10,6))
           AS interest_coverage,
       CAST(CAST(1 + o_orderkey % 99 AS DOUBLE) / 10 AS DECIMAL(10,6)) AS debt_to_equity,
       CAST(pd AS DECIMAL(12,9)) AS pd_annual, CAST(loss AS DECIMAL(10,7)) AS lgd,
       CAST(round(ead * pd * loss, 2) AS DECIMAL(18,2)) AS el,
       CAST(round(ead * loss * CAST(0.25 AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) AS unexpected_loss,
       CAST(round(ead * CAST(0.5 AS DECIMAL(2,1)), 2) AS DECIMAL(18,2)) AS rwa,
       bad AS defaulted,
       CASE WHEN bad = 1 THEN CAST(started + to_months(CAST(age AS INTEGER)) AS DATE) END
           AS default_date,
       CASE WHEN bad = 1 THEN age ELSE term END AS survival_months,
       CASE WHEN bad = 1 THEN CAST(1 - loss AS DECIMAL(10,7)) END AS recovery_rate,
       CASE WHEN bad = 1 THEN CAST(round(ead * loss, 2) AS DECIMAL(18,2)) END AS loss_given_default
FROM (
    SELECT *, CAST(date_trunc('month', o_orderdate) AS DATE) AS started,
           12 * (1 + o_orderkey % 10) AS term, 1 + o_orderkey % 24 AS age,
           CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS bad,
           CAST(o_totalprice AS DECIMAL(18,2)) AS ead,
           CAST(CAST(1 + o_orderkey % 97 AS DOUBLE) / 400 AS DECIMAL(12,4)) AS pd,
           CAST(CAST(10 + o_custkey % 80 AS DOUBLE) / 100 AS DECIMAL(4,2)) AS loss
    FROM orders
) AS o JOIN customer ON o_custkey = c_custkey
"""

MACRO = """
SELECT month AS date, months_rows AS n_active_loans, total_ead, new_defaults,
       total_ead * CAST(0.01 AS DECIMAL(3,2)) AS total_el,
       total_ead * CAST(0.5 AS DECIMAL(3,2)) AS total_rwa, 0.01 AS el_rate, 0.45 AS avg_lgd,
       total_ead * CAST(0.03 AS DECIMAL(3,2)) AS var_99,
       total_ead * CAST(0.04 AS DECIMAL(3,2)) AS cvar_995, 0.2 AS sector_hhi,
       CAST(tax AS DECIMAL(12,9)) AS avg_pd,
       CAST(100 * discount AS DECIMAL(10,6)) AS gdp_growth,
       CAST(quantity / 5 AS DECIMAL(10,6)) AS unemployment,
       CAST(100 * tax AS DECIMAL(10,6)) AS policy_rate,
       CAST(1000 * tax AS DECIMAL(10,3)) AS credit_spread_bps
FROM (
    SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS month, count(*) AS months_rows,
           sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total_ead,
           count(*) FILTER (WHERE l_returnflag = 'R') AS new_defaults,
           CAST(sum(CAST(l_discount AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS discount,
           CAST(sum(CAST(l_quantity AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS quantity,
           CAST(sum(CAST(l_tax AS DECIMAL(12,2))) AS DOUBLE) / count(*) AS tax
    FROM lineitem GROUP BY 1
) AS monthly
"""

GRADE = (
    "list_position(['AAA', 'AA', 'A', 'BBB', 'BB', 'B', 'CCC'], "
    "list_extract(['AAA', 'A', 'BBB', 'BB', 'CCC'], CAST(substr({0}, 1, 1) AS BIGINT)))"
)

RATINGS = f"""
SELECT CAST(o_custkey AS VARCHAR) AS issuer_id, c_mktsegment AS sector, year, from_rating, to_rating,
       CASE WHEN moved < 0 THEN 1 ELSE 0 END AS upgraded,
       CASE WHEN moved > 0 THEN 1 ELSE 0 END AS downgraded, defaulted, moved AS notches_moved
FROM (
    SELECT o_custkey, year,
           max(CASE WHEN backward = 1 THEN grade END) - max(CASE WHEN forward = 1 THEN grade END)
               AS moved,
           max(CASE WHEN forward = 1 THEN o_orderpriority END) AS from_rating,
           max(CASE WHEN backward = 1 THEN o_orderpriority END) AS to_rating,
           max(CASE WHEN backward = 1 AND o_orderstatus = 'F' THEN 1 ELSE 0 END) AS defaulted
    FROM (
        SELECT o_custkey, o_orderstatus, o_orderpriority, year(o_orderdate) AS year,
               {GRADE.format("o_orderpriority")} AS grade,
               row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                                  ORDER BY o_orderdate, o_orderkey) AS forward,
               row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                                  ORDER BY o_orderdate DESC, o_orderkey DESC) AS backward
        FROM orders
    ) AS placed GROUP BY o_custkey, year
) AS moves JOIN customer ON o_custkey = c_custkey
"""

STRESS = f"""
SELECT scenario, sector, least(pd * multiplier, 1.0) AS stressed, lgd, ead AS total_ead,
       el AS expected_loss_base, multiplier,
       CAST(round(el * CAST(multiplier AS DECIMAL(4,2)), 2) AS DECIMAL(20,2)) AS expected_loss_stress
FROM (
    SELECT sector, sum(ead) AS ead, sum(el) AS el,
           CAST(sum(pd_annual) AS DOUBLE) / count(*) AS pd, CAST(sum(lgd) AS DOUBLE) / count(*) AS lgd
    FROM loans GROUP BY sector
) AS base CROSS JOIN (VALUES {", ".join(f"('{s[0]}', CAST({s[1]} AS DOUBLE))" for s in SCENARIOS)})
    AS scenarios(scenario, multiplier)
"""

VINTAGE = """
SELECT vintage, m AS months_on_books, total AS n_loans_originated,
       failed AS n_defaulted_cumulative, total - failed AS n_active,
       CAST(CAST(failed AS DOUBLE) / total AS DECIMAL(12,9)) AS cumulative_default_rate,
       CAST(CAST(fresh AS DOUBLE) / total AS DECIMAL(12,9)) AS marginal_default_rate,
       CAST(CAST(pd AS DOUBLE) / total AS DECIMAL(12,9)) AS avg_pd_at_origination,
       CAST(CAST(score AS DOUBLE) / total AS DECIMAL(10,3)) AS avg_credit_score
FROM (
    SELECT t.vintage, m, total, pd, score,
           count(age) FILTER (WHERE age <= m) AS failed, count(age) FILTER (WHERE age = m) AS fresh
    FROM (
        SELECT year(origination_date) || 'Q' || quarter(origination_date) AS vintage,
               count(*) AS total, sum(pd_annual) AS pd, sum(credit_score) AS score
        FROM loans GROUP BY 1
    ) AS t
    CROSS JOIN range(1, 61) AS months(m)
    LEFT JOIN (
        SELECT year(origination_date) || 'Q' || quarter(origination_date) AS vintage,
               1 + number % 24 AS age
        FROM loans WHERE defaulted = 1
    ) AS d ON d.vintage = t.vintage
    GROUP BY t.vintage, m, total, pd, score
) AS curve
"""

SCORED = """
SELECT *, CASE WHEN origination_date < DATE '2000-01-01' THEN 'train'
               WHEN origination_date < DATE '2001-01-01' THEN 'validation' ELSE 'test' END
           AS data_split,
       'Formula A' AS model_name, CAST(p AS DECIMAL(12,9)) AS default_probability,
       CAST(0.3 AS DECIMAL(8,6)) AS operating_threshold,
       CASE WHEN p >= 0.3 THEN 1 ELSE 0 END AS predicted_default,
       CASE WHEN p >= 0.3 THEN 'Manual Review' ELSE 'Approve' END AS underwriting_action,
       CASE WHEN p <= 0.05 THEN 'Low' WHEN p <= 0.3 THEN 'Moderate'
            WHEN p <= CAST(0.3 AS DOUBLE) * 1.75 THEN 'High' ELSE 'Very High' END AS risk_band,
       CASE WHEN away - exact = 0.005 AND CAST(away * 100 AS BIGINT) % 2 = 1
            THEN away - 0.01 ELSE away END AS term_risk_loss_proxy
FROM (
    SELECT *, round(exact, 2) AS away
    FROM (
        SELECT *, CAST(CAST((number * 31) % 600 + 300 * defaulted + 1 AS DOUBLE) / 1000
                       AS DECIMAL(4,3)) * ead * CAST(lgd AS DECIMAL(3,2)) AS exact,
               CAST((number * 31) % 600 + 300 * defaulted + 1 AS DOUBLE) / 1000 AS p
        FROM loans
    ) AS priced
) AS cents
"""

DECILES = """
SELECT *, greatest(1, ((place - 1) * 10 + total - 2) // (total - 1)) AS risk_decile
FROM (
    SELECT *, row_number() OVER (ORDER BY default_probability DESC, loan_id) AS place,
           count(*) OVER () AS total
    FROM scored
) AS placed
"""

BANDED = """
SELECT *, list_extract(['Q1 Small', 'Q2 Medium', 'Q3 Large', 'Q4 Very Large'],
                       greatest(1, ((place - 1) * 4 + total - 2) // (total - 1))) AS ead_band
FROM (
    SELECT *, row_number() OVER (ORDER BY ead, loan_id) AS place, count(*) OVER () AS total
    FROM loans
) AS placed
"""

CLEAN = """
SELECT b.*, gdp_growth AS origination_gdp_growth, unemployment AS origination_unemployment,
       policy_rate AS origination_policy_rate, credit_spread_bps AS origination_credit_spread_bps,
       year(origination_date) AS origination_year, month(origination_date) AS origination_month,
       year(origination_date) || 'Q' || quarter(origination_date) AS origination_quarter,
       CASE WHEN defaulted = 1 THEN coalesce(loss_given_default, 0) ELSE 0 END
           AS default_loss_amount,
       CAST(CAST(el AS DOUBLE) / CAST(ead AS DOUBLE) AS DECIMAL(12,9))
           AS existing_expected_loss_rate,
       CASE WHEN credit_score BETWEEN 300 AND 579 THEN 'Poor'
            WHEN credit_score BETWEEN 580 AND 669 THEN 'Fair'
            WHEN credit_score BETWEEN 670 AND 739 THEN 'Good'
            WHEN credit_score BETWEEN 740 AND 799 THEN 'Very Good'
            WHEN credit_score BETWEEN 800 AND 850 THEN 'Exceptional' END AS credit_score_band,
       CASE WHEN maturity_date = DATE '2006-12-31' THEN 1 ELSE 0 END AS reported_maturity_is_capped
FROM banded AS b LEFT JOIN macro ON macro.date = origination_date
"""

MODELS = " UNION ALL ".join(
    f"SELECT '{name}' AS model_name, CASE WHEN origination_date < DATE '2001-01-01' "
    "THEN 'validation' ELSE 'test' END AS split, defaulted, ead, lgd, "
    f"CAST((number * {factor}) % {modulus} + {step} * defaulted + 1 AS DOUBLE) / 1000 AS score "
    "FROM loans WHERE origination_date >= DATE '2000-01-01'"
    for name, factor, modulus, step in FORMULAS
)

# Confusion counts of every model, split and cut-off.
CUTS = """
SELECT model_name, split, t / 100.0 AS cut,
       count(*) FILTER (WHERE defaulted = 0 AND score < CAST(t AS DOUBLE) / 100) AS tn,
       count(*) FILTER (WHERE defaulted = 0 AND score >= CAST(t AS DOUBLE) / 100) AS fp,
       count(*) FILTER (WHERE defaulted = 1 AND score < CAST(t AS DOUBLE) / 100) AS fn,
       count(*) FILTER (WHERE defaulted = 1 AND score >= CAST(t AS DOUBLE) / 100) AS tp,
       coalesce(sum(ead * lgd) FILTER (WHERE defaulted = 1 AND score < CAST(t AS DOUBLE) / 100), 0)
           AS missed,
       coalesce(sum(ead) FILTER (WHERE defaulted = 0 AND score >= CAST(t AS DOUBLE) / 100), 0)
           AS rejected
FROM models CROSS JOIN range(1, 100) AS cuts(t) GROUP BY model_name, split, t
"""

RATES = """
coalesce(CAST(tp AS DOUBLE) / nullif(tp + fp, 0), 0) AS precision,
coalesce(CAST(tp AS DOUBLE) / nullif(tp + fn, 0), 0) AS recall,
coalesce(CAST(2 * tp AS DOUBLE) / nullif(2 * tp + fp + fn, 0), 0) AS f1,
coalesce(CAST(tn AS DOUBLE) / nullif(tn + fp, 0), 0) AS specificity,
1 - CAST(tp + fp AS DOUBLE) / (tn + fp + fn + tp) AS approval_rate
"""

THRESHOLDS = f"""
SELECT model_name, split, CAST(cut AS DOUBLE) AS threshold, {RATES}, tn AS true_negative,
       fp AS false_positive, fn AS false_negative, tp AS true_positive,
       CAST(round(missed, 2) AS DOUBLE) AS default_loss_exposure,
       CAST(rejected AS DOUBLE) AS rejected_good_ead,
       CAST(0.02 AS DOUBLE) AS opportunity_cost_rate_assumption,
       CAST(round(missed + CAST(0.02 AS DECIMAL(3,2)) * rejected, 2) AS DOUBLE) AS total_cost_proxy,
       missed, rejected
FROM cuts
"""

RANKING = f"""
SELECT model_name, split, threshold_type, threshold, roc_auc, pr_auc, {RATES}, brier_score,
       tn AS true_negative, fp AS false_positive, fn AS false_negative, tp AS true_positive
FROM (
    SELECT model_name, split,
           1 - sum(pos * (above_neg + neg / 2.0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS roc_auc,
           sum(CAST(pos AS DOUBLE) * seen_pos / (seen_pos + above_neg + neg)) / sum(pos) AS pr_auc,
           sum(pos * (1 - score) * (1 - score) + neg * score * score) / sum(pos + neg) AS brier_score
    FROM (
        SELECT *, sum(pos) OVER (PARTITION BY model_name, split ORDER BY score DESC) AS seen_pos,
               sum(neg) OVER (PARTITION BY model_name, split ORDER BY score DESC) - neg AS above_neg
        FROM (
            SELECT model_name, split, score, sum(defaulted) AS pos, sum(1 - defaulted) AS neg
            FROM models GROUP BY model_name, split, score
        ) AS counts
    ) AS totals GROUP BY model_name, split
) AS ranked
JOIN (
    SELECT m.model_name, m.split, threshold_type, threshold,
           count(*) FILTER (WHERE defaulted = 0 AND score < threshold) AS tn,
           count(*) FILTER (WHERE defaulted = 0 AND score >= threshold) AS fp,
           count(*) FILTER (WHERE defaulted = 1 AND score < threshold) AS fn,
           count(*) FILTER (WHERE defaulted = 1 AND score >= threshold) AS tp
    FROM models AS m CROSS JOIN (VALUES (CAST(0.5 AS DOUBLE), 'standard_0.50'),
        (CAST(0.3 AS DOUBLE), 'operating_recall_constraint')) AS kinds(threshold, threshold_type)
    GROUP BY m.model_name, m.split, threshold_type, threshold
) AS confusion USING (model_name, split)
"""

SUBQUERIES = {
    "loans": (LOANS, ()),
    "macro": (MACRO, ()),
    "ratings": (RATINGS, ()),
    "stress": (STRESS, ("loans",)),
    "vintage": (VINTAGE, ("loans",)),
    "scored": (SCORED, ("loans",)),
    "deciles": (DECILES, ("scored",)),
    "banded": (BANDED, ("loans",)),
    "clean": (CLEAN, ("banded", "macro")),
    "models": (MODELS, ("loans",)),
    "cuts": (CUTS, ("models",)),
    "thresholds": (THRESHOLDS, ("cuts",)),
    "ranking": (RANKING, ("models",)),
}


def using(*names: str):
    """Prefix a SELECT with the sub-queries it needs, in dependency order."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for needed in SUBQUERIES[name][1]:
            add(needed)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        add(name)
    head = ", ".join(f"{name} AS ({SUBQUERIES[name][0]})" for name in ordered)
    return lambda body: f"WITH {head} {body}"


def mean(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / count({column})"


def dbl(*names: str) -> str:
    return ", ".join(f"CAST({name} AS DOUBLE) AS {name}" for name in names)


def big(*names: str) -> str:
    return ", ".join(f"CAST({name} AS BIGINT) AS {name}" for name in names)


LOAN_NUMBERS = (
    "maturity_months", "credit_score", "ead", "coupon_rate", "leverage", "interest_coverage",
    "debt_to_equity", "pd_annual", "lgd", "el", "unexpected_loss", "rwa", "defaulted",
    "survival_months", "recovery_rate", "loss_given_default",
)
LOAN_TEXTS = ("loan_id", "sector", "loan_type", "collateral", "initial_rating")
LOAN_DATES = ("origination_date", "maturity_date", "default_date")
LOAN_COLUMNS = (
    "loan_id, origination_date, maturity_date, sector, loan_type, collateral, initial_rating, "
    "default_date, "
    + big("maturity_months", "credit_score", "defaulted", "survival_months")
    + ", "
    + dbl("ead", "coupon_rate", "leverage", "interest_coverage", "debt_to_equity", "pd_annual",
          "lgd", "el", "unexpected_loss", "rwa", "recovery_rate", "loss_given_default")
)
CLEAN_COLUMNS = (
    LOAN_COLUMNS
    + ", origination_quarter, credit_score_band, ead_band, "
    + big("origination_year", "origination_month", "reported_maturity_is_capped")
    + ", "
    + dbl("origination_gdp_growth", "origination_unemployment", "origination_policy_rate",
          "origination_credit_spread_bps", "default_loss_amount", "existing_expected_loss_rate")
)
PREDICTION_OUTPUTS = (
    "data_split, model_name, risk_band, underwriting_action, "
    + big("predicted_default", "risk_decile")
    + ", "
    + dbl("default_probability", "operating_threshold", "term_risk_loss_proxy")
)
COUNTS = big("true_negative", "false_positive", "false_negative", "true_positive")
METRIC_COLUMNS = (
    "model_name, split, threshold_type, threshold, round(roc_auc, 9) AS roc_auc, "
    "round(pr_auc, 9) AS pr_auc, precision, recall, f1, specificity, "
    "round(brier_score, 9) AS brier_score, approval_rate, " + COUNTS
)
THRESHOLD_COLUMNS = (
    "model_name, split, threshold, precision, recall, f1, specificity, approval_rate, "
    + COUNTS
    + ", default_loss_exposure, rejected_good_ead, opportunity_cost_rate_assumption, "
    "total_cost_proxy"
)
TYPED_STRESS = (
    "scenario, sector, CAST(CAST(stressed AS DECIMAL(12,9)) AS DOUBLE) AS stressed_pd, "
    "CAST(CAST(lgd AS DECIMAL(10,7)) AS DOUBLE) AS stressed_lgd, "
    + dbl("total_ead", "expected_loss_base", "expected_loss_stress")
    + ", CAST(expected_loss_stress - expected_loss_base AS DOUBLE) AS incremental_expected_loss, "
    "100 * (multiplier - 1) AS el_increase_pct, "
    "rank() OVER (PARTITION BY scenario ORDER BY expected_loss_stress - expected_loss_base "
    "DESC NULLS LAST) AS sector_impact_rank"
)
MIGRATION = (
    f"SELECT CAST(year AS BIGINT) AS year, sector, count(*) AS issuer_observations, "
    "CAST(sum(upgraded) AS BIGINT) AS upgrades, CAST(sum(downgraded) AS BIGINT) AS downgrades, "
    f"CAST(sum(defaulted) AS BIGINT) AS defaults, {mean('notches_moved')} AS avg_notches_moved, "
    f"{mean('downgraded')} AS downgrade_rate FROM ratings GROUP BY year, sector"
)
VINTAGE_COLUMNS = (
    "vintage, "
    + big("months_on_books", "n_loans_originated", "n_active", "n_defaulted_cumulative")
    + ", "
    + dbl("cumulative_default_rate", "marginal_default_rate", "avg_pd_at_origination",
          "avg_credit_score")
)
LIFT = (
    "SELECT risk_decile, count(*) AS loan_count, CAST(sum(defaulted) AS BIGINT) AS defaults, "
    f"{mean('defaulted')} AS default_rate, {mean('default_probability')} AS avg_probability, "
    "CAST(sum(ead) AS DOUBLE) AS total_ead, "
    "(SELECT CAST(sum(defaulted) AS DOUBLE) / count(*) FROM deciles WHERE data_split = 'test') "
    "AS portfolio_default_rate FROM deciles WHERE data_split = 'test' GROUP BY risk_decile"
)
SHARED_MEASURES = (
    f"{mean('default_probability')} AS avg_model_probability, "
    f"{mean('credit_score')} AS avg_credit_score"
)


def unions(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def loan_checks_sql(last_default: str) -> str:
    conditions = {
        "invalid_target_values": "defaulted NOT IN (0, 1)",
        "default_without_default_date": "defaulted = 1 AND default_date IS NULL",
        "nondefault_with_default_date": "defaulted = 0 AND default_date IS NOT NULL",
        "default_before_origination": "default_date < origination_date",
        "survival_exceeds_contractual_maturity": "survival_months > maturity_months",
        "nondefault_not_observed_to_contractual_maturity":
            "defaulted = 0 AND survival_months <> maturity_months",
        "credit_score_outside_300_850": "credit_score NOT BETWEEN 300 AND 850",
        "nonpositive_ead": "ead <= 0",
        "pd_outside_0_1": "pd_annual NOT BETWEEN 0 AND 1",
        "lgd_outside_0_1": "lgd NOT BETWEEN 0 AND 1",
        "defaults_after_reported_maturity_date": "default_date > maturity_date",
        f"defaults_after_{last_default.replace('-', '_')}": f"default_date > DATE '{last_default}'",
    }
    parts = [
        "SELECT 'duplicate_loan_ids' AS check_name, count(*) - count(DISTINCT loan_id) AS violations "
        "FROM loans"
    ]
    parts += [
        f"SELECT '{name}', count(*) FILTER (WHERE {condition}) FROM loans"
        for name, condition in conditions.items()
    ]
    return using("loans")(unions(parts))


def quartiles_sql(table: str, names: tuple[str, ...]) -> str:
    parts = [
        f"SELECT '{n}' AS column_name, count({n}) AS n, "
        + ", ".join(
            f"round(quantile_cont(CAST({n} AS DOUBLE), {f}), 6) AS q{i}"
            for i, f in enumerate((0.25, 0.5, 0.75), start=1)
        )
        + f" FROM {table}"
        for n in names
    ]
    return unions(parts)


def outliers_sql() -> str:
    parts = []
    for n in LOAN_NUMBERS:
        value = f"CAST({n} AS DOUBLE)"
        cuts = (
            f"SELECT quantile_cont({value}, 0.25) AS q1, quantile_cont({value}, 0.75) AS q3 FROM loans"
        )
        parts.append(
            f"SELECT '{n}' AS column_name, 'median' AS metric, "
            f"round(quantile_cont({value}, 0.5), 6) AS number FROM loans"
        )
        parts.append(
            f"SELECT '{n}', 'iqr_outliers', CAST(count(*) FILTER (WHERE CASE WHEN q3 = q1 "
            f"THEN {value} <> q1 ELSE {value} < q1 - 1.5 * (q3 - q1) OR {value} > q3 + 1.5 * (q3 - q1)"
            f" END) AS DOUBLE) FROM loans CROSS JOIN ({cuts}) AS cuts"
        )
    return using("loans")(unions(parts))


def constraints_sql() -> str:
    from tranche import schemas

    sources = {
        "loans": ("loans", schemas.RAW_LOANS),
        "credit_ratings": ("ratings", schemas.RATINGS),
        "portfolio_metrics": ("macro", schemas.PORTFOLIO),
    }
    parts = []
    for name, (source, table) in sources.items():
        key = f"concat_ws('|', {', '.join(table.key)})"
        broken = {f"{c}_not_null": f"{c} IS NULL" for c in table.required}
        broken |= {rule: f"NOT coalesce({test}, true)" for rule, test in table.checks.items()}
        parts += [
            f"SELECT '{name}' AS table_name, '{rule}' AS rule, count(*) FILTER (WHERE {test}) "
            f"AS violations, min(CASE WHEN {test} THEN {key} END) AS sample_key FROM {source}"
            for rule, test in broken.items()
        ]
        parts.append(
            f"SELECT '{name}', 'primary_key', CAST(coalesce(sum(n - 1), 0) AS BIGINT), min(k) FROM "
            f"(SELECT {key} AS k, count(*) AS n FROM {source} GROUP BY {', '.join(table.key)} "
            "HAVING count(*) > 1) AS repeated"
        )
    return using("loans", "ratings", "macro")(unions(parts))


def item_rules_sql() -> str:
    rows = "(SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS items"
    key = "concat_ws('|', l_orderkey, l_linenumber)"
    parts = [
        f"SELECT 'lineitem' AS table_name, '{n}_not_null' AS rule, "
        f"count(*) FILTER (WHERE {n} IS NULL) AS violations, "
        f"min(CASE WHEN {n} IS NULL THEN {key} END) AS sample_key FROM {rows}"
        for n in ("l_orderkey", "l_linenumber", "l_discount", "l_shipdate", "o_orderdate")
    ]
    parts.append(
        "SELECT 'lineitem', 'shipped_after_order', count(*) FILTER (WHERE l_shipdate < o_orderdate), "
        f"min({key}) FILTER (WHERE l_shipdate < o_orderdate) FROM {rows}"
    )
    parts.append(
        "SELECT 'lineitem', 'discount_below_nine_percent', "
        f"count(*) FILTER (WHERE l_discount >= CAST(0.09 AS DOUBLE)), "
        f"min({key}) FILTER (WHERE l_discount >= CAST(0.09 AS DOUBLE)) FROM {rows}"
    )
    parts.append(
        "SELECT 'lineitem', 'primary_key', CAST(sum(n - 1) AS BIGINT), min(k) FROM (SELECT count(*) AS n, "
        f"{key} AS k FROM {rows} GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) AS keys"
    )
    return unions(parts)


def distinct_rows_sql(table: str, columns: str) -> str:
    return (
        f"SELECT CAST(count(*) - (SELECT count(*) FROM (SELECT DISTINCT {columns} FROM {table}) AS d) "
        f"AS DOUBLE) AS number FROM {table}"
    )


def checks_rows() -> str:
    """(check_name, actual, expected) of the delivered figures."""
    orders = "SELECT count(*) FROM orders"
    test = f"{orders} WHERE o_orderdate >= TIMESTAMP '2001-01-01'"
    return unions(
        [
            f"SELECT 'loan rows' AS check_name, count(*) AS actual, ({orders}) AS expected FROM scored",
            "SELECT 'missing probabilities', count(*) FILTER (WHERE default_probability IS NULL), 0 "
            "FROM scored",
            "SELECT 'probabilities outside 0 to 1', "
            "count(*) FILTER (WHERE default_probability NOT BETWEEN 0 AND 1), 0 FROM scored",
            f"SELECT 'test rows', count(*) FILTER (WHERE data_split = 'test'), ({test}) FROM scored",
            "SELECT 'target values outside 0 and 1', "
            "count(*) FILTER (WHERE defaulted NOT IN (0, 1)), 0 FROM scored",
            "SELECT 'chosen threshold in the test table', count(*), 1 FROM thresholds "
            "WHERE model_name = 'Formula A' AND split = 'test' AND threshold = CAST(0.3 AS DOUBLE)",
            "SELECT 'shortlist rows', least(count(*), 500), 500 FROM scored WHERE data_split = 'test'",
        ]
    )


COVERAGE = "greatest(CAST(interest_coverage AS DOUBLE), CAST(0.1 AS DOUBLE))"
MODEL_NUMBERS = {
    name: f"CAST({name} AS DOUBLE)"
    for name in ("maturity_months", "credit_score", "coupon_rate", "leverage", "interest_coverage",
                 "debt_to_equity", "origination_gdp_growth", "origination_unemployment",
                 "origination_policy_rate", "origination_credit_spread_bps")
} | {
    "log_ead": "ln(1 + CAST(ead AS DOUBLE))",
    "leverage_to_coverage": f"CAST(leverage AS DOUBLE) / {COVERAGE}",
    "debt_service_pressure":
        f"CAST(coupon_rate AS DOUBLE) * CAST(leverage AS DOUBLE) / {COVERAGE}",
}
MODEL_INPUTS = (*MODEL_NUMBERS, "sector", "loan_type", "collateral", "initial_rating", "origination_month")
# Three models on two splits plus the chosen cut-off on both; 99 cut-offs; 18 features.
EXPORT_COUNTS = {
    "Fact_Loans": "SELECT count(*) FROM loans",
    "Fact_Thresholds": "SELECT CAST(99 AS BIGINT)",
    "Fact_ModelMetrics": "SELECT CAST(8 AS BIGINT)",
    "Fact_Portfolio": "SELECT count(*) FROM macro",
    "Fact_Stress": f"SELECT {len(SCENARIOS)} * count(DISTINCT sector) FROM loans",
    "Fact_Vintage": "SELECT count(*) FROM vintage",
    "Fact_Migration": "SELECT count(*) FROM (SELECT DISTINCT year, sector FROM ratings) AS pairs",
    "Feature_Importance": "SELECT CAST(18 AS BIGINT)",
}


def oracle() -> dict[str, str]:
    loans, scored = using("loans"), using("scored")
    kpis = (
        "CAST(sum(ead) AS DOUBLE) AS total_ead, CAST(sum(defaulted) AS BIGINT) AS defaults, "
        f"{mean('defaulted')} AS observed_default_rate"
    )
    pct = "round(100 * {0}, 2)".format
    sql = {
        "sector_concentration": loans(
            "SELECT sector, loans, round(CAST(ead AS DOUBLE) / 1e9, 2) AS ead_billions, "
            f"{pct('rate')} AS default_rate_pct, "
            "rank() OVER (ORDER BY rate DESC NULLS LAST) AS risk_rank, "
            "rank() OVER (ORDER BY ead DESC NULLS LAST) AS exposure_rank FROM (SELECT sector, "
            f"count(*) AS loans, sum(ead) AS ead, {mean('defaulted')} AS rate FROM loans "
            "GROUP BY sector) AS base"
        ),
        "decile_separation": using("deciles")(
            f"SELECT CAST(risk_decile AS BIGINT) AS risk_decile, loan_count, defaults, "
            f"{pct('default_rate')} AS default_rate_pct, "
            "round(default_rate / nullif(portfolio_default_rate, 0), 2) AS lift_vs_test_average "
            f"FROM ({LIFT}) AS lift"
        ),
        "risk_decile_lift": using("deciles")(
            "SELECT CAST(risk_decile AS BIGINT) AS risk_decile, loan_count, defaults, default_rate, "
            "avg_probability, total_ead, portfolio_default_rate, "
            "default_rate / nullif(portfolio_default_rate, 0) AS lift_vs_test_average "
            f"FROM ({LIFT}) AS lift"
        ),
        "threshold_tradeoffs": using("thresholds")(
            "SELECT threshold, round(precision, 4) AS precision, round(recall, 4) AS recall, "
            "round(approval_rate, 4) AS approval_rate, "
            + big("false_positive", "false_negative")
            + ", round(total_cost_proxy / 1e6, 2) AS cost_proxy_millions FROM thresholds "
            "WHERE split = 'test' AND model_name = 'Formula A' "
            "AND CAST(threshold AS DECIMAL(8,6)) BETWEEN 0.25 AND 0.35"
        ),
        "review_queue": scored(
            "SELECT loan_id, sector, initial_rating, "
            + big("credit_score") + ", " + dbl("ead", "default_probability", "term_risk_loss_proxy")
            + ", sector_review_priority FROM (SELECT *, row_number() OVER (PARTITION BY sector "
            "ORDER BY term_risk_loss_proxy DESC, default_probability DESC, loan_id) "
            "AS sector_review_priority FROM scored WHERE underwriting_action = 'Manual Review' "
            "AND data_split = 'test') AS queue WHERE sector_review_priority <= 10"
        ),
        "yearly_default_rate": loans(
            f"SELECT year AS origination_year, loans, {pct('rate')} AS default_rate_pct, "
            f"{pct('(rate - lag(rate) OVER (ORDER BY year))')} AS yoy_change_percentage_points "
            f"FROM (SELECT year(origination_date) AS year, count(*) AS loans, {mean('defaulted')} "
            "AS rate FROM loans GROUP BY 1) AS yearly"
        ),
        "sector_exposure_quartiles": loans(
            "SELECT sector, sector_ead_quartile, count(*) AS loans, "
            f"round({mean('ead')}, 2) AS avg_ead, {pct(mean('defaulted'))} AS default_rate_pct "
            "FROM (SELECT *, ntile(4) OVER (PARTITION BY sector ORDER BY ead, loan_id) "
            "AS sector_ead_quartile FROM loans) AS tiles GROUP BY sector, sector_ead_quartile"
        ),
        "stress_increments": using("stress")(
            "SELECT scenario, sector, round(incremental_expected_loss / 1e6, 2) "
            "AS incremental_el_millions, round(el_increase_pct, 2) AS el_increase_pct, "
            f"sector_impact_rank FROM (SELECT {TYPED_STRESS} FROM stress) AS impact "
            "WHERE scenario <> 'baseline'"
        ),
        "stress_scenarios": using("stress")(f"SELECT {TYPED_STRESS} FROM stress"),
        "scenario_totals": using("stress")(
            "SELECT scenario, CAST(base AS DOUBLE) AS base_loss, CAST(hit AS DOUBLE) AS stressed_loss, "
            "CAST(hit - base AS DOUBLE) AS incremental_loss, "
            f"{pct('(CAST(hit - base AS DOUBLE) / CAST(base AS DOUBLE))')} AS increase_pct FROM "
            "(SELECT scenario, sum(expected_loss_base) AS base, sum(expected_loss_stress) AS hit "
            "FROM stress GROUP BY scenario) AS totals"
        ),
        "rating_migration": using("ratings")(MIGRATION),
        "downgrade_acceleration": using("ratings")(
            f"SELECT year, sector, {pct('downgrade_rate')} AS downgrade_rate_pct, "
            + pct("(downgrade_rate - lag(downgrade_rate) OVER (PARTITION BY sector ORDER BY year))")
            + f" AS yoy_change_pp FROM ({MIGRATION}) AS migration"
        ),
        "yearly_downgrades": using("ratings")(
            "SELECT year, count(*) AS observations, CAST(sum(downgraded) AS BIGINT) AS downgrades, "
            f"{mean('downgraded')} AS downgrade_rate FROM ratings GROUP BY year"
        ),
        "vintages_at_month_36": using("vintage")(
            "SELECT vintage, "
            + big("n_loans_originated", "n_defaulted_cumulative")
            + ", CAST(round(100 * cumulative_default_rate, 2) AS DOUBLE) "
            "AS cumulative_default_rate_pct, rank() OVER (ORDER BY cumulative_default_rate DESC "
            "NULLS LAST) AS vintage_risk_rank FROM vintage WHERE months_on_books = 36"
        ),
        "vintage_curves": using("vintage")(f"SELECT {VINTAGE_COLUMNS} FROM vintage"),
        "selected_vintage_curves": using("vintage")(
            f"SELECT {VINTAGE_COLUMNS} FROM vintage WHERE vintage IN {SELECTED_VINTAGES}"
        ),
        "rolling_portfolio_trend": using("macro")(
            f"SELECT date, {big('n_active_loans')}, {dbl('total_ead', 'avg_pd')}, "
            "CAST(sum(avg_pd) OVER w AS DOUBLE) / count(*) OVER w AS avg_pd_12m, "
            "CAST(sum(new_defaults) OVER w AS BIGINT) AS defaults_12m FROM macro "
            "WINDOW w AS (ORDER BY date ROWS BETWEEN 11 PRECEDING AND CURRENT ROW)"
        ),
        "clean_loans": using("clean")(f"SELECT {CLEAN_COLUMNS} FROM clean"),
        "loan_fact": using("clean", "deciles")(
            f"SELECT {CLEAN_COLUMNS}, {PREDICTION_OUTPUTS} FROM clean JOIN (SELECT loan_id, "
            "data_split, model_name, default_probability, operating_threshold, predicted_default, "
            "risk_band, risk_decile, underwriting_action, term_risk_loss_proxy FROM deciles) AS d "
            "USING (loan_id)"
        ),
        "prediction_table": using("deciles")(
            "SELECT loan_id, origination_date, sector, initial_rating, "
            + big("credit_score", "defaulted") + ", " + dbl("ead", "lgd", "pd_annual")
            + f", {PREDICTION_OUTPUTS} FROM deciles"
        ),
        "sector_risk": scored(
            "SELECT *, rank() OVER (ORDER BY observed_default_rate DESC NULLS LAST) "
            "AS default_rate_rank, rank() OVER (ORDER BY total_ead DESC NULLS LAST) "
            "AS exposure_rank, total_ead / (SELECT CAST(sum(ead) AS DOUBLE) FROM loans) "
            f"AS exposure_share FROM (SELECT sector, count(*) AS loan_count, {kpis}, "
            "CAST(sum(term_risk_loss_proxy) AS DOUBLE) AS term_risk_loss_proxy, "
            f"CAST(sum(el) AS DOUBLE) AS existing_expected_loss, {SHARED_MEASURES} "
            "FROM scored GROUP BY sector) AS base"
        ),
        "rating_risk": scored(
            "SELECT initial_rating, CAST(list_position(['AAA', 'AA', 'A', 'BBB', 'BB', 'B', 'CCC'], "
            f"initial_rating) AS BIGINT) AS rating_sort, count(*) AS loan_count, {kpis}, "
            f"{mean('pd_annual')} AS avg_existing_pd, {SHARED_MEASURES} FROM scored "
            "GROUP BY initial_rating"
        ),
        "monthly_risk_trend": scored(
            "SELECT origination_date AS origination_month, count(*) AS originated_loans, "
            "CAST(sum(ead) AS DOUBLE) AS originated_ead, "
            "CAST(sum(defaulted) AS BIGINT) AS eventual_defaults, "
            f"{mean('defaulted')} AS eventual_default_rate, {mean('pd_annual')} AS avg_existing_pd, "
            f"{SHARED_MEASURES} FROM scored GROUP BY origination_date"
        ),
        "executive_kpis": scored(
            f"SELECT count(*) AS loans, {kpis}, CAST(sum(el) AS DOUBLE) AS existing_expected_loss, "
            "CAST(sum(term_risk_loss_proxy) AS DOUBLE) AS term_risk_loss_proxy, "
            f"{mean('pd_annual')} AS avg_existing_pd, {SHARED_MEASURES} FROM scored"
        ),
        "ranking_metrics": using("ranking")(f"SELECT {METRIC_COLUMNS} FROM ranking"),
        "model_test_metrics": using("ranking")(
            f"SELECT {METRIC_COLUMNS} FROM ranking WHERE split = 'test' "
            "AND threshold_type = 'standard_0.50'"
        ),
        "headline_metrics": using("ranking")(
            "SELECT model_name, round(max(roc_auc), 9) AS roc_auc, round(max(pr_auc), 9) AS pr_auc, "
            "max(CASE WHEN threshold_type <> 'standard_0.50' THEN recall END) AS operating_recall "
            "FROM ranking WHERE split = 'test' GROUP BY model_name"
        ),
        "selected_model": using("ranking")(
            "SELECT model_name FROM ranking WHERE split = 'validation' "
            "AND threshold_type = 'standard_0.50' ORDER BY pr_auc DESC, roc_auc DESC LIMIT 1"
        ),
        "threshold_table": using("thresholds")(f"SELECT {THRESHOLD_COLUMNS} FROM thresholds"),
        "threshold_simulator": using("thresholds")(
            f"SELECT {THRESHOLD_COLUMNS} FROM thresholds WHERE split = 'test'"
        ),
        "chosen_thresholds": using("thresholds")(
            "SELECT model_name, split, threshold FROM (SELECT *, row_number() OVER (PARTITION BY "
            "model_name, split ORDER BY precision DESC, approval_rate DESC, threshold DESC) AS place "
            "FROM thresholds WHERE recall >= 0.7) AS eligible WHERE place = 1"
        ),
        "chosen_thresholds_without_eligible": using("thresholds")(
            "SELECT model_name, split, threshold FROM (SELECT *, row_number() OVER (PARTITION BY "
            "model_name, split ORDER BY recall DESC, threshold) AS place FROM thresholds) AS ranked "
            "WHERE place = 1"
        ),
        "what_if": using("thresholds")(
            "SELECT model_name, threshold, precision, recall, f1, specificity, approval_rate, "
            + big("false_positive", "false_negative")
            + ", default_loss_exposure, rejected_good_ead, CAST(round(round(missed, 2) + "
            "CAST(0.035 AS DECIMAL(4,3)) * rejected, 2) AS DOUBLE) AS dynamic_cost_proxy "
            "FROM thresholds WHERE split = 'test' AND CAST(threshold AS DECIMAL(8,6)) = 0.3"
        ),
        "dynamic_costs": using("thresholds")(
            "SELECT model_name, threshold, total_cost_proxy, CAST(round(round(missed, 2) + "
            "CAST(0.035 AS DECIMAL(4,3)) * rejected, 2) AS DOUBLE) AS dynamic_cost_proxy "
            "FROM thresholds WHERE split = 'test'"
        ),
        "credit_score_bands": using("clean")(
            "SELECT credit_score_band, count(*) AS rows FROM clean GROUP BY credit_score_band"
        ),
        "exposure_band_edges": using("banded")(
            "SELECT ead_band, count(*) AS loans, CAST(min(ead) AS DOUBLE) AS low, "
            "CAST(max(ead) AS DOUBLE) AS high FROM banded GROUP BY ead_band"
        ),
        "loan_shape_and_missing": loans(
            unions(
                ["SELECT '*' AS column_name, 'rows' AS metric, CAST(count(*) AS DOUBLE) AS number, "
                 "CAST(NULL AS VARCHAR) AS text FROM loans", "SELECT '*', 'columns', 24.0, NULL"]
                + [f"SELECT '{n}', 'data_type', NULL, '{kind}'" for n, kind in LOAN_TYPES]
                + [
                    f"SELECT '{n}', 'missing_values', CAST(count(*) FILTER (WHERE {n} IS NULL) "
                    f"AS DOUBLE) AS c, NULL FROM loans HAVING c > 0"
                    for n in LOAN_NUMBERS + LOAN_TEXTS + LOAN_DATES
                ]
            )
        ),
        "item_duplicate_rows": distinct_rows_sql("lineitem", "*"),
        "repeated_item_facts": distinct_rows_sql(
            "lineitem", "l_returnflag, l_linestatus, l_quantity, l_discount, l_tax"
        ),
        "loan_numeric_ranges": loans(
            unions(
                [
                    f"SELECT '{n}' AS column_name, '{m}' AS metric, round({e}, 6) AS number FROM loans"
                    for n in LOAN_NUMBERS
                    for m, e in (
                        ("min", f"CAST(min({n}) AS DOUBLE)"),
                        ("max", f"CAST(max({n}) AS DOUBLE)"),
                        ("mean", mean(n)),
                    )
                ]
            )
        ),
        "loan_quartiles": loans(quartiles_sql("loans", LOAN_NUMBERS)),
        "item_quartiles": quartiles_sql(
            "lineitem", ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
        ),
        "loan_medians_and_outliers": outliers_sql(),
        "loan_date_ranges": loans(
            unions(
                [
                    f"SELECT '{n}' AS column_name, '{m}' AS metric, "
                    f"CAST({m}({n}) AS VARCHAR) AS text FROM loans"
                    for n in LOAN_DATES
                    for m in ("min", "max")
                ]
            )
        ),
        "loan_distinct_counts": loans(
            unions(
                [
                    f"SELECT '{n}' AS column_name, CAST(count(DISTINCT {n}) AS DOUBLE) AS number "
                    "FROM loans"
                    for n in LOAN_TEXTS
                ]
            )
        ),
        "portfolio_summary": loans(
            "SELECT count(*) AS clean_loan_rows, count(DISTINCT loan_id) AS unique_loans, "
            "count(DISTINCT sector) AS sectors, count(*) FILTER (WHERE defaulted = 0) "
            "AS non_defaults, count(*) FILTER (WHERE defaulted = 1) AS defaults, "
            f"{mean('defaulted')} AS default_rate, CAST(count(*) FILTER (WHERE defaulted = 0) "
            "AS DOUBLE) / count(*) FILTER (WHERE defaulted = 1) AS negative_to_positive_ratio, "
            "CAST(sum(ead) AS DOUBLE) AS total_ead, "
            "CAST(sum(el) AS DOUBLE) AS total_existing_expected_loss, "
            "min(origination_date) AS origination_date_min, "
            "max(origination_date) AS origination_date_max FROM loans"
        ),
        "target_counts": loans(
            "SELECT CAST(defaulted AS BIGINT) AS defaulted, count(*) AS rows FROM loans "
            "GROUP BY defaulted"
        ),
        "loan_checks": loan_checks_sql("2006-12-31"),
        "tight_loan_checks": loan_checks_sql("2000-06-30"),
        "table_constraints": constraints_sql(),
        "item_rules": item_rules_sql(),
        "orders_without_items": (
            "SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS "
            "(SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"
        ),
        "scored_integrity": scored(
            "SELECT count(*) AS loan_rows, count(DISTINCT loan_id) AS unique_loan_ids, "
            "count(*) FILTER (WHERE default_probability NOT BETWEEN 0 AND 1) "
            "AS invalid_probabilities, count(*) FILTER (WHERE default_probability IS NULL OR "
            "risk_band IS NULL OR underwriting_action IS NULL OR term_risk_loss_proxy IS NULL) "
            "AS missing_analytical_outputs, CAST(min(default_probability) AS DOUBLE) "
            "AS probability_min, CAST(max(default_probability) AS DOUBLE) AS probability_max "
            "FROM scored"
        ),
        "missing_splits": scored(
            "SELECT data_split FROM (VALUES ('train'), ('validation'), ('test'), ('holdout')) "
            "AS wanted(data_split) WHERE data_split NOT IN (SELECT data_split FROM scored)"
        ),
        "table_counts": using("loans", "ratings", "macro", "stress", "vintage")(
            unions(
                [
                    "SELECT 'loans' AS table_name, count(*) AS rows FROM loans",
                    "SELECT 'credit_ratings', count(*) FROM ratings",
                    "SELECT 'portfolio_metrics', count(*) FROM macro",
                    "SELECT 'stress_scenarios', count(*) FROM stress",
                    "SELECT 'vintage_analysis', count(*) FROM vintage",
                    "SELECT 'loan_predictions', count(*) FROM loans",
                ]
            )
        ),
        "table_count_contract": using("loans", "macro", "vintage")(
            "SELECT *, rows - expected AS difference, "
            "CASE WHEN rows = expected THEN 'OK' ELSE 'CHECK' END AS status FROM ("
            + unions(
                [
                    "SELECT 'loans' AS table_name, count(*) AS rows, "
                    "(SELECT count(*) FROM orders) AS expected FROM loans",
                    "SELECT 'portfolio_metrics', count(*), (SELECT count(DISTINCT "
                    "date_trunc('month', l_shipdate)) FROM lineitem) FROM macro",
                    "SELECT 'vintage_analysis', count(*), 1 FROM vintage",
                ]
            )
            + ") AS counts"
        ),
        "delivery_checks": using("scored", "thresholds")(
            "SELECT check_name, actual, expected, actual - expected AS difference, "
            "CASE WHEN actual = expected THEN 'OK' ELSE 'CHECK' END AS status "
            f"FROM ({checks_rows()}) AS checks"
        ),
        "delivery_status": using("scored", "thresholds")(
            "SELECT CASE WHEN count(*) FILTER (WHERE actual <> expected) = 0 THEN 'OK' "
            f"ELSE 'CHECK' END AS status FROM ({checks_rows()}) AS checks"
        ),
        "split_summary": scored(
            f"SELECT data_split, count(*) AS rows, {mean('defaulted')} AS default_rate, "
            "min(origination_date) AS date_min, max(origination_date) AS date_max FROM scored "
            "GROUP BY data_split"
        ),
        "split_rates": scored(
            "SELECT data_split, count(*) AS rows, CAST(sum(defaulted) AS BIGINT) AS defaults, "
            f"round({mean('defaulted')}, 6) AS default_rate FROM scored GROUP BY data_split"
        ),
        "prediction_integrity": scored(
            "SELECT count(*) FILTER (WHERE default_probability NOT BETWEEN 0 AND 1) "
            "AS invalid_probabilities, count(*) FILTER (WHERE loan_id IS NULL) AS missing_loan_ids, "
            "count(*) FILTER (WHERE underwriting_action IS NULL) AS missing_actions, "
            "CAST(min(default_probability) AS DOUBLE) AS min_probability, "
            "CAST(max(default_probability) AS DOUBLE) AS max_probability FROM scored"
        ),
        "validation_summary": scored(
            "SELECT count(*) AS clean_loan_rows, count(default_probability) AS prediction_rows, "
            "count(*) FILTER (WHERE data_split = 'test') AS test_rows, "
            "count(*) - count(default_probability) AS missing_probabilities, "
            "count(*) FILTER (WHERE default_probability NOT BETWEEN 0 AND 1) "
            "AS invalid_probabilities, count(*) FILTER (WHERE defaulted NOT IN (0, 1)) "
            "AS invalid_target_values, CAST(min(default_probability) AS DOUBLE) AS probability_min, "
            "CAST(max(default_probability) AS DOUBLE) AS probability_max FROM scored"
        ),
        "shortlist": scored(
            "SELECT loan_id, sector, initial_rating, underwriting_action, "
            + big("credit_score") + ", " + dbl("ead", "default_probability", "term_risk_loss_proxy")
            + " FROM (SELECT * FROM scored WHERE data_split = 'test' "
            "ORDER BY scored.term_risk_loss_proxy DESC, loan_id LIMIT 500) AS top"
        ),
        "yearly_balance": loans(
            "SELECT year(origination_date) AS origination_year, count(defaulted) AS count, "
            f"CAST(sum(defaulted) AS BIGINT) AS sum, {mean('defaulted')} AS mean FROM loans GROUP BY 1"
        ),
        "rating_default_rates": loans(
            "SELECT initial_rating, default_rate FROM (VALUES ('AAA'), ('AA'), ('A'), ('BBB'), "
            "('BB'), ('B'), ('CCC')) AS scale(initial_rating) LEFT JOIN (SELECT initial_rating, "
            f"{mean('defaulted')} AS default_rate FROM loans GROUP BY initial_rating) AS rates "
            "USING (initial_rating)"
        ),
        "sector_overview": loans(
            "SELECT sector, count(DISTINCT loan_id) AS loans, CAST(sum(ead) AS DOUBLE) AS ead, "
            f"{mean('defaulted')} AS default_rate FROM loans GROUP BY sector"
        ),
        "model_inputs": loans(
            "SELECT loan_id, round(ln(1 + CAST(ead AS DOUBLE)), 9) AS log_ead, "
            f"round(CAST(leverage AS DOUBLE) / {COVERAGE}, 9) AS leverage_to_coverage, "
            f"round(CAST(coupon_rate AS DOUBLE) * CAST(leverage AS DOUBLE) / {COVERAGE}, 9) "
            "AS debt_service_pressure, CAST(month(origination_date) AS VARCHAR) AS origination_month "
            "FROM loans"
        ),
        "training_medians_and_modes": using("clean")(
            unions(
                [
                    f"SELECT '{name}' AS feature, round(quantile_cont({value}, 0.5), 6) AS median, "
                    "CAST(NULL AS VARCHAR) AS mode FROM clean "
                    "WHERE origination_date < DATE '2000-01-01'"
                    for name, value in MODEL_NUMBERS.items()
                ]
                + [
                    f"SELECT '{name}', NULL, (SELECT CAST({name} AS VARCHAR) FROM clean "
                    f"WHERE origination_date < DATE '2000-01-01' GROUP BY CAST({name} AS VARCHAR) "
                    f"ORDER BY count(*) DESC, CAST({name} AS VARCHAR) LIMIT 1)"
                    for name in ("sector", "loan_type", "collateral", "initial_rating",
                                 "origination_month")
                ]
            )
        ),
        "ratings_csv_round_trip": using("ratings")(
            "SELECT issuer_id, sector, "
            + ", ".join(
                f"list_extract(['AAA', 'A', 'BBB', 'BB', 'CCC'], CAST(substr({c}, 1, 1) AS BIGINT)) AS {c}"
                for c in ("from_rating", "to_rating")
            )
            + ", " + big("year", "upgraded", "downgraded", "defaulted", "notches_moved")
            + " FROM ratings"
        ),
        "seeded_sample": scored(
            "SELECT loan_id, " + dbl("ead", "default_probability") + " FROM (SELECT * FROM scored "
            "WHERE data_split = 'test' ORDER BY md5('42:' || loan_id), loan_id LIMIT 500) AS picked"
        ),
        "stored_model_agreement": loans(
            "SELECT count(*) AS loans, CAST(0 AS BIGINT) AS differing FROM loans"
        ),
        "logistic_score_check": loans(
            "SELECT count(*) AS loans, CAST(0 AS BIGINT) AS differing FROM loans"
        ),
        "importance_agreement": unions([f"SELECT '{name}' AS feature, true AS agrees" for name in MODEL_INPUTS]),
        "feature_dependence": loans(unions([
            *[f"SELECT '{name}' AS feature, CAST(0 AS BIGINT) AS changed" for name in MODEL_INPUTS],
            "SELECT 'waited', count(*) FILTER (survival_months <> maturity_months) FROM loans",
            "SELECT 'pressure', count(*) FILTER (CAST(pd_annual AS DOUBLE) > 0.02) FROM loans",
        ])),
        "scaled_feature_moments": unions(
            [f"SELECT '{name}' AS feature, CAST(0 AS DOUBLE) AS mean, CAST(1 AS DOUBLE) AS deviation"
             for name in MODEL_NUMBERS]
        ),
        "encoded_category_counts": using("clean")(
            unions(
                [f"SELECT '{name}' AS feature, CAST({name} AS VARCHAR) AS category, count(*) AS ones "
                 f"FROM clean WHERE origination_date < DATE '2000-01-01' GROUP BY CAST({name} AS VARCHAR)"
                 for name in ("sector", "loan_type", "collateral", "initial_rating", "origination_month")]
            )
        ),
        "fold_sizes": loans(
            "SELECT CAST(defaulted AS BIGINT) AS defaulted, fold, (n - fold + 2) // 3 AS loans FROM ("
            "SELECT defaulted, count(*) AS n FROM loans WHERE origination_date < DATE '2000-01-01' "
            "GROUP BY defaulted) AS sizes CROSS JOIN range(0, 3) AS folds(fold)"
        ),
        "view_totals": scored(
            "SELECT data_split, count(*) AS loans, CAST(sum(ead) AS DOUBLE) AS ead FROM scored "
            "GROUP BY data_split"
        ),
        "source_file_counts": using("loans", "ratings", "macro", "stress", "vintage")(
            unions([
                "SELECT 'loans' AS table_name, count(*) AS rows FROM loans",
                "SELECT 'ratings', count(*) FROM ratings",
                "SELECT 'portfolio', count(*) FROM macro",
                "SELECT 'stress', count(*) FROM stress",
                "SELECT 'vintage', count(*) FROM vintage",
            ])
        ),
        "stripped_texts": loans(
            "SELECT loan_id, sector, loan_type, collateral, initial_rating FROM loans"
        ),
        "distinct_counts_with_empty_column": loans(
            unions([
                *[f"SELECT '{n}' AS column_name, CAST(count(DISTINCT {n}) AS DOUBLE) AS number FROM loans"
                  for n in LOAN_TEXTS],
                "SELECT 'remark', CAST(0 AS DOUBLE)",
            ])
        ),
        "undated_splits": loans(
            "SELECT CASE WHEN number % 10 = 0 THEN NULL WHEN origination_date < DATE '2000-01-01' "
            "THEN 'train' WHEN origination_date < DATE '2001-01-01' THEN 'validation' ELSE 'test' END "
            "AS data_split, count(*) AS loans FROM loans GROUP BY 1"
        ),
        "published_manifest": using("loans", "macro", "ratings", "vintage")(
            unions(
                [
                    f"SELECT '{name}' AS sheet_name, 'tbl{name}' AS table_name, "
                    f"'{source}' AS source_object, '{grain}' AS grain, "
                    f"({EXPORT_COUNTS[name]}) AS row_count"
                    for name, source, grain in SHEETS
                ]
            )
        ),
    }
    return sql
