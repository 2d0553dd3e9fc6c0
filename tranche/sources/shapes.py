"""The model's tables derived from a star schema of orders, customers and items.

The star schema stands in for the supplied loan files: same columns, types and
grains, filled by expressions over the star-schema rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tranche.functions.columns import exact_mean, month_start, quarter_label, rating_sort, ratio

# Dates of the stand-in data for the time split and the reporting cut-off.
TRAIN_END = "2000-01-01"
VALIDATION_END = "2001-01-01"
CUTOFF = "2006-12-31"

# (scenario, GDP shock, unemployment shock, rate shock, spread, loss multiplier)
SCENARIOS = (
    ("baseline", 0.0, 0.0, 0.0, 0, 1.0),
    ("mild", -1.5, 1.0, 0.5, 75, 1.25),
    ("adverse", -3.5, 3.0, 1.5, 150, 1.5),
    ("severe", -6.0, 5.5, 2.5, 300, 2.0),
)
VINTAGE_MONTHS = 60


def star(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def loan_key(orderkey: str) -> Column:
    return F.concat(F.lit("L"), F.lpad(F.col(orderkey).cast("string"), 12, "0"))


def priority_rating(priority: Column) -> Column:
    """Rating of an order priority such as ``1-URGENT``."""
    return F.element_at(
        F.array(*[F.lit(r) for r in ("AAA", "A", "BBB", "BB", "CCC")]),
        F.substring(priority, 1, 1).cast("int"),
    )


def raw_loans(spark: SparkSession, folder: str, with_sector: bool = True) -> DataFrame:
    """One loan per order. Leave the sector out where unused: it costs the only join."""
    key, customer = F.col("o_orderkey"), F.col("o_custkey")
    defaulted = F.col("o_orderstatus") == "F"
    months = 1 + key % 24
    term = 12 * (1 + key % 10)
    started = month_start(F.col("o_orderdate").cast("date"))
    ead = F.col("o_totalprice").cast("decimal(18,2)")
    pd_annual = ((1 + key % 97) / F.lit(400.0)).cast("decimal(12,4)")
    lgd = ((10 + customer % 80) / F.lit(100.0)).cast("decimal(4,2)")

    def cents(value: Column) -> Column:
        return F.round(value, 2).cast("decimal(18,2)")

    def pick(values: tuple[str, ...], number: Column) -> Column:
        return F.element_at(
            F.array(*[F.lit(v) for v in values]), (number % len(values) + 1).cast("int")
        )

    orders = star(spark, folder, "orders")
    columns = {
        "loan_id": loan_key("o_orderkey"),
        "origination_date": started,
        "maturity_date": F.least(F.add_months(started, term.cast("int")), F.lit(CUTOFF).cast("date")),
        "maturity_months": term.cast("smallint"),
        "sector": F.col("c_mktsegment"),
        "loan_type": pick(("Term Loan", "Revolver", "Bridge"), key),
        "collateral": pick(("Secured", "Unsecured", "Guaranteed", "Mortgage"), customer),
        "initial_rating": priority_rating(F.col("o_orderpriority")),
        "credit_score": (300 + (key * 7919) % 551).cast("smallint"),
        "ead": ead,
        "coupon_rate": (
            (20 + key % 40 + F.when(defaulted, 15).otherwise(0)) / F.lit(10.0)
        ).cast("decimal(10,6)"),
        "leverage": ((1 + customer % 29) / F.lit(2.0)).cast("decimal(10,6)"),
        "interest_coverage": (
            (key % 78 + F.when(defaulted, 0).otherwise(12)) / F.lit(4.0)
        ).cast("decimal(10,6)"),
        "debt_to_equity": ((1 + key % 99) / F.lit(10.0)).cast("decimal(10,6)"),
        "pd_annual": pd_annual.cast("decimal(12,9)"),
        "lgd": lgd.cast("decimal(10,7)"),
        "el": cents(ead * pd_annual * lgd),
        "unexpected_loss": cents(ead * lgd * F.lit(0.25).cast("decimal(3,2)")),
        "rwa": cents(ead * F.lit(0.5).cast("decimal(2,1)")),
        "defaulted": defaulted.cast("smallint"),
        "default_date": F.when(defaulted, F.add_months(started, months.cast("int"))),
        "survival_months": F.when(defaulted, months).otherwise(term).cast("smallint"),
        "recovery_rate": F.when(defaulted, (1 - lgd).cast("decimal(10,7)")),
        "loss_given_default": F.when(defaulted, cents(ead * lgd)),
    }
    if with_sector:
        customers = star(spark, folder, "customer").select("c_custkey", "c_mktsegment")
        orders = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    else:
        del columns["sector"]
    return orders.select(*[value.alias(name) for name, value in columns.items()])


def macro(spark: SparkSession, folder: str) -> DataFrame:
    """One row per month of shipped items."""

    def mean(column: str, scale: int) -> Column:
        return exact_mean(F.col(column).cast(f"decimal(12,{scale})"))

    price = F.sum(F.col("l_extendedprice").cast("decimal(18,2)"))
    monthly = star(spark, folder, "lineitem").groupBy(
        month_start(F.col("l_shipdate").cast("date")).alias("date")
    ).agg(
        F.count(F.lit(1)).alias("n_active_loans"),
        price.alias("total_ead"),
        F.sum((F.col("l_returnflag") == "R").cast("bigint")).alias("new_defaults"),
        mean("l_discount", 2).alias("discount"),
        mean("l_quantity", 2).alias("quantity"),
        mean("l_tax", 2).alias("tax"),
    )
    ead = F.col("total_ead").cast("double")
    return monthly.select(
        "date",
        F.col("n_active_loans").cast("int"),
        F.col("total_ead").cast("decimal(20,2)"),
        (ead * 0.01).cast("decimal(20,2)").alias("total_el"),
        (ead * 0.5).cast("decimal(20,2)").alias("total_rwa"),
        F.lit(0.01).cast("decimal(12,9)").alias("el_rate"),
        F.col("tax").cast("decimal(12,9)").alias("avg_pd"),
        F.lit(0.45).cast("decimal(10,7)").alias("avg_lgd"),
        (ead * 0.03).cast("decimal(20,2)").alias("var_99"),
        (ead * 0.04).cast("decimal(20,2)").alias("cvar_995"),
        F.lit(0.2).cast("decimal(10,7)").alias("sector_hhi"),
        F.col("new_defaults").cast("int"),
        (100 * F.col("discount")).cast("decimal(10,6)").alias("gdp_growth"),
        (F.col("quantity") / 5).cast("decimal(10,6)").alias("unemployment"),
        (100 * F.col("tax")).cast("decimal(10,6)").alias("policy_rate"),
        (1000 * F.col("tax")).cast("decimal(10,3)").alias("credit_spread_bps"),
    )


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """One row per customer and year: first and last order decide the move.

    Orders collapse to customer and year before the join, so a customer holding
    a large share of all orders costs one row per year there.
    """
    order = F.struct("o_orderdate", "o_orderkey")
    rating = priority_rating(F.col("o_orderpriority"))
    yearly = star(spark, folder, "orders").groupBy(
        "o_custkey", F.year("o_orderdate").alias("year")
    ).agg(
        F.min_by(rating, order).alias("from_rating"),
        F.max_by(rating, order).alias("to_rating"),
        F.max_by("o_orderstatus", order).alias("last_status"),
    )
    moved = rating_sort(F.col("to_rating")) - rating_sort(F.col("from_rating"))
    customers = star(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    return yearly.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_custkey").cast("string").alias("issuer_id"),
        F.col("c_mktsegment").alias("sector"),
        F.col("year").cast("smallint"),
        "from_rating",
        "to_rating",
        (moved < 0).cast("smallint").alias("upgraded"),
        (moved > 0).cast("smallint").alias("downgraded"),
        (F.col("last_status") == "F").cast("smallint").alias("defaulted"),
        moved.cast("smallint").alias("notches_moved"),
    )


def stress(loans: DataFrame) -> DataFrame:
    """One row per scenario and sector from the sector sums."""
    base = loans.groupBy("sector").agg(
        F.sum("ead").alias("ead"),
        F.sum("el").alias("el"),
        exact_mean(F.col("pd_annual")).alias("pd"),
        exact_mean(F.col("lgd")).alias("lgd"),
    )
    scenarios = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("scenario"),
                    F.lit(gdp).alias("gdp"),
                    F.lit(unemployment).alias("unemployment"),
                    F.lit(rate).alias("rate"),
                    F.lit(spread).alias("spread"),
                    F.lit(multiplier).alias("multiplier"),
                )
                for name, gdp, unemployment, rate, spread, multiplier in SCENARIOS
            ]
        )
    )
    rows = base.select("*", scenarios.alias("s"))
    factor = F.col("s.multiplier")
    return rows.select(
        F.col("s.scenario").alias("scenario"),
        F.col("s.gdp").cast("decimal(10,6)").alias("gdp_shock_pp"),
        F.col("s.unemployment").cast("decimal(10,6)").alias("unemp_shock_pp"),
        F.col("s.rate").cast("decimal(10,6)").alias("rate_shock_pp"),
        F.col("s.spread").alias("credit_spread_bps"),
        "sector",
        F.col("pd").cast("decimal(12,9)").alias("base_pd"),
        F.least(F.col("pd") * factor, F.lit(1.0)).cast("decimal(12,9)").alias("stressed_pd"),
        (100 * (F.least(F.col("pd") * factor, F.lit(1.0)) - F.col("pd"))).cast("decimal(10,6)")
        .alias("pd_uplift_pp"),
        factor.cast("decimal(10,6)").alias("pd_multiplier"),
        F.col("lgd").cast("decimal(10,7)").alias("base_lgd"),
        F.col("lgd").cast("decimal(10,7)").alias("stressed_lgd"),
        F.col("ead").cast("decimal(20,2)").alias("total_ead"),
        F.col("el").cast("decimal(20,2)").alias("expected_loss_base"),
        F.round(F.col("el") * factor.cast("decimal(4,2)"), 2).cast("decimal(20,2)")
        .alias("expected_loss_stress"),
        (100 * (factor - 1)).cast("decimal(12,6)").alias("el_increase_pct"),
    )


def vintage(loans: DataFrame, months: int = VINTAGE_MONTHS) -> DataFrame:
    """Default curve per origination quarter from counts per quarter and month."""
    age = F.when(
        F.col("defaulted") == 1,
        F.months_between("default_date", "origination_date").cast("int"),
    )
    counted = (
        loans.select(
            quarter_label(F.col("origination_date")).alias("vintage"),
            age.alias("month"),
            "pd_annual",
            "credit_score",
        )
        .groupBy("vintage", "month")
        .agg(
            F.count(F.lit(1)).alias("loans"),
            F.sum("pd_annual").alias("pd"),
            F.sum("credit_score").alias("score"),
        )
    )
    # From here on at most (quarters × months) rows.
    totals = counted.groupBy("vintage").agg(
        F.sum("loans").alias("loans"),
        F.sum("pd").alias("pd"),
        F.sum("score").alias("score"),
        F.map_from_entries(
            F.collect_list(F.when(F.col("month").isNotNull(), F.struct("month", "loans")))
        ).alias("by_month"),
    )
    rows = totals.select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(months))).alias("months_on_books")
    ).withColumn("new", F.coalesce(F.col("by_month")[F.col("months_on_books")], F.lit(0)))
    so_far = F.sum("new").over(
        Window.partitionBy("vintage")
        .orderBy("months_on_books")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return rows.withColumn("failed", so_far).select(
        "vintage",
        F.col("months_on_books").cast("smallint"),
        F.col("loans").cast("int").alias("n_loans_originated"),
        (F.col("loans") - F.col("failed")).cast("int").alias("n_active"),
        F.col("failed").cast("int").alias("n_defaulted_cumulative"),
        ratio(F.col("failed"), F.col("loans")).cast("decimal(12,9)").alias("cumulative_default_rate"),
        ratio(F.col("new"), F.col("loans")).cast("decimal(12,9)").alias("marginal_default_rate"),
        ratio(F.col("pd"), F.col("loans")).cast("decimal(12,9)").alias("avg_pd_at_origination"),
        ratio(F.col("score"), F.col("loans")).cast("decimal(10,3)").alias("avg_credit_score"),
    )


def formula_score(loans: DataFrame) -> DataFrame:
    """Add a tied, informative stand-in score in (0, 1) computed from the key."""
    number = F.substring("loan_id", 2, 12).cast("bigint")
    score = ((number * 31) % 600 + 300 * F.col("defaulted") + 1) / F.lit(1000.0)
    return loans.withColumn("score", score)
