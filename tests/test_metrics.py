import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tranche.functions import columns as c
from tranche.operators import metrics, scoring
from tranche.plans import reports


def frame(n=400, seed=1):
    rng = np.random.default_rng(seed)
    y = (rng.random(n) < 0.3).astype(int)
    score = np.clip(np.round(rng.normal(0.35 + 0.2 * y, 0.2), 2), 0.0, 1.0)
    # A third of the rows share one score.
    score = np.where(rng.random(n) < 0.34, 0.29, score)
    return pd.DataFrame(
        {
            "model_name": "m", "split": rng.choice(["validation", "test"], n), "defaulted": y,
            "score": score, "ead": rng.integers(100, 9999, n) / 100, "lgd": rng.integers(1, 9, n) / 10,
        }
    )


def brute(part, cutoff):
    y, p = part["defaulted"].to_numpy(), part["score"].to_numpy()
    pos, neg = p[y == 1], p[y == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    ap, seen = 0.0, 0
    for s in sorted(set(p), reverse=True):
        tp = (pos >= s).sum()
        ap += (tp - seen) / len(pos) * tp / (p >= s).sum()
        seen = tp
    hit = p >= cutoff
    tp, fp = (hit & (y == 1)).sum(), (hit & (y == 0)).sum()
    fn, tn = (~hit & (y == 1)).sum(), (~hit & (y == 0)).sum()
    return {
        "roc_auc": auc, "pr_auc": ap, "brier_score": np.mean((p - y) ** 2),
        "precision": tp / (tp + fp) if tp + fp else 0.0, "recall": tp / (tp + fn),
        "f1": 2 * tp / (2 * tp + fp + fn), "specificity": tn / (tn + fp),
        "approval_rate": 1 - hit.mean(), "true_positive": tp, "false_positive": fp,
        "true_negative": tn, "false_negative": fn,
    }


def test_ranking_metrics_match_brute_force(spark):
    data = frame()
    rows = metrics.ranking_metrics(
        spark.createDataFrame(data), [(0.5, "standard"), (0.29, "operating")]
    ).collect()
    assert len(rows) == 4
    for row in rows:
        want = brute(data[data["split"] == row["split"]], row["threshold"])
        assert {k: row[k] for k in want} == pytest.approx(want)


def test_threshold_table_matches_brute_force(spark):
    data = frame(seed=7)
    table = metrics.threshold_table(spark.createDataFrame(data)).toPandas()
    assert len(table) == 2 * 99
    for row in table[table["split"] == "test"].itertuples():
        part = data[data["split"] == "test"]
        want = brute(part, row.threshold)
        assert row.precision == pytest.approx(want["precision"])
        assert row.recall == pytest.approx(want["recall"])
        assert row.true_negative == want["true_negative"]
        missed = part[(part["defaulted"] == 1) & (part["score"] < row.threshold)]
        turned = part[(part["defaulted"] == 0) & (part["score"] >= row.threshold)]
        loss, good = (missed["ead"] * missed["lgd"]).sum(), turned["ead"].sum()
        assert float(row.default_loss_exposure) == pytest.approx(loss, abs=0.01)
        assert float(row.rejected_good_ead) == pytest.approx(good)
        assert float(row.total_cost_proxy) == pytest.approx(loss + 0.02 * good, abs=0.01)


def test_scores_on_a_cutoff_reach_it(spark):
    df = spark.range(1, 100).select((F.col("id") / F.lit(100.0)).alias("p"), "id")
    wrong = df.where(metrics.cutoffs_reached(F.col("p")) != F.col("id")).count()
    edges = spark.createDataFrame([(0.0,), (0.009999,), (1.0,)], "p double")
    assert wrong == 0
    assert [r[0] for r in edges.select(metrics.cutoffs_reached(F.col("p"))).collect()] == [0, 0, 99]


def test_one_class_gives_zero_rates(spark):
    data = frame(20).assign(defaulted=0, split="test")
    row = metrics.ranking_metrics(spark.createDataFrame(data)).first()
    assert row["roc_auc"] is None
    assert (row["pr_auc"], row["precision"], row["recall"], row["f1"]) == (0, 0, 0, 0)


def thresholds(spark, rows):
    return spark.createDataFrame(
        [("m", "validation", *r) for r in rows],
        "model_name string, split string, threshold double, precision double, recall double, "
        "approval_rate double",
    )


def test_threshold_choice_and_its_fallback(spark):
    rows = [(0.1, 0.2, 0.9, 0.1), (0.2, 0.3, 0.8, 0.2), (0.3, 0.3, 0.7, 0.2), (0.4, 0.9, 0.6, 0.4)]
    assert metrics.choose_threshold(thresholds(spark, rows)).first()["threshold"] == 0.3
    low = [(0.1, 0.2, 0.5, 0.1), (0.2, 0.3, 0.5, 0.2), (0.3, 0.9, 0.4, 0.2)]
    assert metrics.choose_threshold(thresholds(spark, low)).first()["threshold"] == 0.1


def test_probability_at_the_threshold_is_reviewed_but_moderate(spark):
    df = spark.createDataFrame([(0.05,), (0.17,), (0.170001,), (0.31,)], "p double")
    got = [tuple(r) for r in df.select(
        c.risk_band(F.col("p"), 0.17), (F.col("p") >= 0.17).cast("int")).collect()]
    assert got == [("Low", 0), ("Moderate", 1), ("High", 1), ("Very High", 1)]


def test_decision_uses_the_rounded_score(spark):
    df = spark.createDataFrame(
        [("L1", 0.16999996), ("L2", 0.1699994)], "loan_id string, score double"
    ).selectExpr("*", "date'2020-01-01' AS origination_date", "100 AS ead", "0.5 AS lgd")
    rows = scoring.add_scores(df, 0.17, "m").orderBy("loan_id").collect()
    assert [r["predicted_default"] for r in rows] == [1, 0]
    assert [r["underwriting_action"] for r in rows] == ["Manual Review", "Approve"]
    assert float(rows[0]["term_risk_loss_proxy"]) == 8.5


def test_splits_at_their_dates(spark):
    df = spark.sql("SELECT explode(array(date'2020-12-31', date'2021-01-01', date'2021-12-31', "
                   "date'2022-01-01')) AS d")
    names = [r[0] for r in df.select(scoring.data_split(F.col("d"))).collect()]
    assert names == ["train", "validation", "validation", "test"]


def test_tradeoffs_keep_both_ends(spark):
    table = metrics.threshold_table(spark.createDataFrame(frame()))
    chosen = spark.createDataFrame([("m", 0.17)], "model_name string, t double").selectExpr(
        "model_name", "CAST(t AS decimal(8,6)) AS operating_threshold")
    cuts = [r["threshold"] for r in reports.threshold_tradeoffs(table, chosen).collect()]
    assert cuts == [i / 100 for i in range(12, 23)]
