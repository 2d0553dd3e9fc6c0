import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tranche.operators import ordering


def loans(spark, n, seed, distinct=40):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame(
        {
            "loan_id": [f"L{i:06d}" for i in rng.permutation(n)],
            "sector": rng.choice(["a", "b", "c"], n, p=[0.7, 0.25, 0.05]),
            # A third of all rows share one value.
            "ead": np.where(rng.random(n) < 0.34, 7.0, rng.integers(0, distinct, n) / 4.0),
        }
    )
    return frame, spark.createDataFrame(frame)


@pytest.mark.parametrize("n,q,bracket", [(1, 4, 0.001), (2, 4, 0.001), (10, 4, 0.2), (37, 10, 0.01),
                                         (101, 10, 0.02), (3000, 10, 0.001), (3000, 4, 0.0)])
@pytest.mark.parametrize("descending", [False, True])
def test_rank_cut_matches_qcut_of_ranks(spark, monkeypatch, n, q, bracket, descending):
    monkeypatch.setattr(ordering.order_statistics, "__defaults__", ((), None, bracket))
    frame, df = loans(spark, n, n)
    got = ordering.assign_buckets(df, "ead", "loan_id", q, "bucket", descending=descending)
    got = got.toPandas().set_index("loan_id")["bucket"]
    ordered = frame.sort_values(["ead", "loan_id"], ascending=[not descending, True])
    if n == 1:
        want = pd.Series([1], index=ordered["loan_id"])
    else:
        ranks = pd.Series(range(1, n + 1), index=ordered["loan_id"])
        want = pd.qcut(ranks, q, labels=range(1, q + 1)).astype(int)
    assert got.sort_index().tolist() == want.sort_index().tolist()


@pytest.mark.parametrize("n", [5, 400])
def test_ntile_inside_groups(spark, n):
    frame, df = loans(spark, n, 3)
    got = ordering.assign_buckets(
        df, "ead", "loan_id", 4, "tile", upper=ordering.ntile_upper, groups=["sector"]
    )
    df.createOrReplaceTempView("ntile_input")
    want = spark.sql(
        "SELECT *, ntile(4) OVER (PARTITION BY sector ORDER BY ead, loan_id) AS tile FROM ntile_input"
    )
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_quantiles_interpolate_like_numpy(spark):
    frame, df = loans(spark, 1003, 5, distinct=997)
    got = ordering.quantile_values(df, "ead", [0.25, 0.5, 0.75], ["sector"]).collect()
    for row in got:
        values = frame.loc[frame["sector"] == row["sector"], "ead"]
        assert row["n"] == len(values)
        assert [row["q1"], row["q2"], row["q3"]] == pytest.approx(
            values.quantile([0.25, 0.5, 0.75]).tolist()
        )


def test_quantiles_survive_a_sketch_that_misses(spark, monkeypatch):
    """Brackets in the wrong place must not change the result."""
    frame, df = loans(spark, 500, 9, distinct=480)
    real = F.percentile_approx
    monkeypatch.setattr(
        ordering.F, "percentile_approx", lambda c, p, a: real(c, [0.99] * len(p), a)
    )
    row = ordering.quantile_values(df, "ead", [0.25, 0.5]).first()
    assert [row["q1"], row["q2"]] == pytest.approx(frame["ead"].quantile([0.25, 0.5]).tolist())


def test_running_totals_across_runs(spark):
    df = spark.range(5000).select(
        (F.col("id") % 3).alias("g"), F.col("id").alias("o"), (F.col("id") % 7).alias("v")
    )
    got = ordering.running_totals(df, ["g"], [F.col("o").desc()], ["v"]).toPandas()
    frame = got.sort_values(["g", "o"], ascending=[True, False])
    assert (frame.groupby("g")["v"].cumsum() == frame["cum_v"]).all()


def test_top_per_group_prunes_before_the_shuffle(spark):
    frame, df = loans(spark, 300, 1)
    top = ordering.top_per_group(df, ["sector"], [F.desc("ead"), F.col("loan_id")], 3, "place")
    want = (
        frame.sort_values(["sector", "ead", "loan_id"], ascending=[True, False, True])
        .groupby("sector").head(3)
    )
    assert {r["loan_id"] for r in top.collect()} == set(want["loan_id"])
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_listed_order_keeps_empty_categories(spark):
    df = spark.createDataFrame([("B", 2), ("A", 1)], "grade string, n int")
    got = ordering.in_listed_order(df, "grade", ["A", "X", "B"]).collect()
    assert [(r["grade"], r["n"]) for r in got] == [("A", 1), ("X", None), ("B", 2)]


def test_seeded_sample_is_repeatable(spark):
    df = spark.range(100).withColumnRenamed("id", "loan_id")
    first = {r[0] for r in ordering.seeded_sample(df, "loan_id", 10, 42).collect()}
    again = {r[0] for r in ordering.seeded_sample(df.repartition(7), "loan_id", 10, 42).collect()}
    assert first == again and len(first) == 10
