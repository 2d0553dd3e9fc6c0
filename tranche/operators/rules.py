"""Rule checks: each table needs one aggregate for all its row rules."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tranche.schemas import POST_OUTCOME, RISK_OUTPUTS, Table
from tranche.session import parts_for

# Tasks that share the rows of one key in the search for repeated keys.
SHARES = 16
LATEST_DEFAULT = "2024-12-31"


def duplicate_keys(df: DataFrame, key: Sequence[str], parts: int | None = None) -> DataFrame:
    """(key…, n) of keys held by more than one row.

    Nearly all keys differ, so counts per task would hold as many keys as the task has rows. Rows are
    dealt by key into ``parts`` (by their number) instead, so a task's memory does not grow with the
    input; rows of one key are shared out, and their counts added up after that.
    """
    parts = parts_for(df) if parts is None else parts
    share = F.pmod(F.spark_partition_id(), F.lit(SHARES))
    dealt = df.select(*key, share.alias("__share")).repartition(parts, *key, "__share")
    counts = dealt.groupBy(*key, "__share").agg(F.count(F.lit(1)).alias("n"))
    whole = counts.repartition(parts, *key).groupBy(*key).agg(F.sum("n").alias("n"))
    return whole.where("n > 1")


def repeated_rows(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """One row: how many rows repeat the key of another row."""
    return duplicate_keys(df, key).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("violations")
    )


def counted(df: DataFrame, label: str, checks: dict[str, Column]) -> DataFrame:
    """(label, violations) of named conditions, from one aggregate."""
    names = list(checks)
    row = df.agg(*[F.count_if(checks[name]).alias(f"v{i}") for i, name in enumerate(names)])
    entries = [
        F.struct(F.lit(name).alias(label), F.col(f"v{i}").alias("violations"))
        for i, name in enumerate(names)
    ]
    return row.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")


def loan_checks(loans: DataFrame, cutoff: str = LATEST_DEFAULT) -> DataFrame:
    """(check_name, violations) of the 13 checks on supplied loans. Their names are fixed values."""
    col = F.col
    bad, good = col("defaulted") == 1, col("defaulted") == 0
    started, failed = col("origination_date"), col("default_date")
    checks = {
        "invalid_target_values": F.coalesce(~col("defaulted").isin(0, 1), F.lit(True)),
        "default_without_default_date": bad & failed.isNull(),
        "nondefault_with_default_date": good & failed.isNotNull(),
        "default_before_origination": failed < started,
        "survival_exceeds_contractual_maturity": col("survival_months") > col("maturity_months"),
        "nondefault_not_observed_to_contractual_maturity": good
        & ~col("survival_months").eqNullSafe(col("maturity_months")),
        "credit_score_outside_300_850": (col("credit_score") < 300) | (col("credit_score") > 850),
        "nonpositive_ead": col("ead") <= 0,
        "pd_outside_0_1": (col("pd_annual") < 0) | (col("pd_annual") > 1),
        "lgd_outside_0_1": (col("lgd") < 0) | (col("lgd") > 1),
        "defaults_after_reported_maturity_date": bad & (failed > col("maturity_date")),
        f"defaults_after_{cutoff.replace('-', '_')}": bad & (failed > F.lit(cutoff).cast("date")),
    }
    repeated = repeated_rows(loans, ["loan_id"]).select(
        F.lit("duplicate_loan_ids").alias("check_name"), "violations"
    )
    return repeated.unionByName(counted(loans, "check_name", checks))


def constraint_report(df: DataFrame, table: Table) -> DataFrame:
    """(table_name, rule, violations, sample_key) of NOT NULL rules and row rules.

    A rule that evaluates to NULL passes, as a CHECK constraint would.
    """
    key = F.concat_ws("|", *table.key)
    rules = {f"{name}_not_null": F.col(name).isNull() for name in table.required}
    rules |= {name: ~F.coalesce(F.expr(rule), F.lit(True)) for name, rule in table.checks.items()}
    names = list(rules)
    row = df.agg(
        *[F.count_if(rules[name]).alias(f"v{i}") for i, name in enumerate(names)],
        *[F.min(F.when(rules[name], key)).alias(f"s{i}") for i, name in enumerate(names)],
    )
    entries = [
        F.struct(
            F.lit(table.name).alias("table_name"),
            F.lit(name).alias("rule"),
            F.col(f"v{i}").alias("violations"),
            F.col(f"s{i}").alias("sample_key"),
        )
        for i, name in enumerate(names)
    ]
    return row.select(F.explode(F.array(*entries)).alias("entry")).select("entry.*")


def key_report(df: DataFrame, table: Table, parts: int | None = None) -> DataFrame:
    """The primary-key rule in the form of `constraint_report`."""
    return duplicate_keys(df, table.key, parts).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("violations"),
        F.min(F.concat_ws("|", *table.key)).alias("sample_key"),
    ).select(
        F.lit(table.name).alias("table_name"),
        F.lit("primary_key").alias("rule"),
        "violations",
        "sample_key",
    )


def orphans(child: DataFrame, parent: DataFrame, column: str) -> DataFrame:
    """Child rows whose key is missing from the parent.

    Parent keys collapse before the shuffle, so a key held by many rows is one there.
    """
    return child.join(parent.select(column).distinct(), column, "left_anti")


def check_tables(frames: dict[str, DataFrame], tables: dict[str, Table]) -> DataFrame:
    """All constraints of all tables given."""
    parts = []
    for name, df in frames.items():
        table = tables[name]
        parts += [constraint_report(df, table), key_report(df, table)]
        for column, parent in table.references.items():
            if parent in frames:
                parts.append(
                    orphans(df, frames[parent], column).agg(
                        F.count(F.lit(1)).alias("violations"), F.min(column).alias("sample_key")
                    ).select(
                        F.lit(table.name).alias("table_name"),
                        F.lit(f"{column}_in_{parent}").alias("rule"),
                        "violations",
                        "sample_key",
                    )
                )
    return reduce(DataFrame.unionByName, parts)


def require_clean(report: DataFrame) -> None:
    """Stop if any rule of a report is violated."""
    broken = report.where("violations > 0").orderBy("table_name", "rule").collect()
    if broken:
        raise ValueError("; ".join(f"{r['table_name']}.{r['rule']}: {r['violations']}" for r in broken))


def compare_counts(counts: DataFrame, expected: dict[str, int]) -> DataFrame:
    """(table_name, rows, expected, difference, status); tables without counts fail."""
    wanted = counts.sparkSession.createDataFrame(
        list(expected.items()), "table_name string, expected bigint"
    )
    return status_table(
        F.broadcast(wanted).join(counts, "table_name", "left"), "rows"
    ).select("table_name", "rows", "expected", "difference", "status")


def status_table(df: DataFrame, actual: str) -> DataFrame:
    """Add the difference from ``expected`` and OK or CHECK."""
    difference = F.col(actual) - F.col("expected")
    return df.withColumn("difference", difference).withColumn(
        "status", F.when(F.col("difference") == 0, "OK").otherwise("CHECK")
    )


def overall_status(checks: DataFrame) -> DataFrame:
    """One row: OK unless any status is CHECK."""
    return checks.agg(
        F.when(F.count_if(F.col("status") == "CHECK") == 0, "OK").otherwise("CHECK").alias("status")
    )


def scored_integrity(scored: DataFrame) -> DataFrame:
    """One row of integrity figures of the scored loans."""
    probability = F.col("default_probability")
    outputs = ("default_probability", "risk_band", "underwriting_action", "term_risk_loss_proxy")
    missing = reduce(lambda a, b: a | b, [F.col(name).isNull() for name in outputs])
    return scored.agg(
        F.count(F.lit(1)).alias("loan_rows"),
        F.count_distinct("loan_id").alias("unique_loan_ids"),
        F.count_if(~probability.between(0, 1)).alias("invalid_probabilities"),
        F.count_if(missing).alias("missing_analytical_outputs"),
        F.min(probability).alias("probability_min"),
        F.max(probability).alias("probability_max"),
    )


def missing_values_of(df: DataFrame, column: str, required: Iterable[str]) -> DataFrame:
    """Required values that ``column`` never takes."""
    wanted = df.sparkSession.createDataFrame([(v,) for v in required], f"{column} string")
    return wanted.join(df.select(column).distinct(), column, "left_anti")


def leaking_features(features: Iterable[str]) -> list[str]:
    """Features that are known only after the outcome or come from another risk model."""
    forbidden = set(POST_OUTCOME) | set(RISK_OUTPUTS)
    return sorted(set(features) & forbidden)


def changed_without(
    build: Callable[[DataFrame], DataFrame], source: DataFrame, key: str, names: Sequence[str], forbidden: Sequence[str]
) -> DataFrame:
    """(feature, changed): in how many rows each of ``names`` that ``build`` computes from ``source``
    changes, or comes or goes with its row, once the forbidden columns are empty.

    With no change the values follow from the other columns alone, whatever the columns are called and
    whichever steps lie between. ``key`` identifies the rows that ``build`` returns.
    """
    present = {f.name: f.dataType for f in source.schema.fields if f.name in set(forbidden)}
    emptied = source.withColumns({n: F.lit(None).cast(t) for n, t in present.items()})
    before = build(source).select(key, F.struct(*names).alias("before"))
    after = build(emptied).select(key, F.struct(*names).alias("after"))
    both = before.join(after, key, "full")
    moved = F.col("before").isNull() | F.col("after").isNull()
    counts = both.agg(*[
        F.count_if(moved | ~F.col("before")[n].eqNullSafe(F.col("after")[n])).alias(n) for n in names
    ])
    return counts.unpivot([], list(names), "feature", "changed")
