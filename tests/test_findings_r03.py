"""Steps whose time or memory grew too fast in the third round."""

import __spark_entry__
from tranche import session
from tranche.catalog import queries
from tranche.learning import features
from tranche.operators import rules

SMALLEST = __spark_entry__.SMALLEST


def test_queries_keep_generated_methods_compilable(spark):
    limit = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(limit)
    try:
        spark.conf.set(limit, 65535)
        queries.REGISTERED["yearly_balance"](spark, SMALLEST)
        assert int(spark.conf.get(limit)) == session.HOTSPOT_METHOD_BYTES
        spark.conf.set(limit, 4000)
        session.compilable(spark)
        assert int(spark.conf.get(limit)) == 4000
    finally:
        spark.conf.set(limit, before)


def test_settled_model_rows_hold_only_what_models_read(spark):
    rows = queries.prepared(spark, SMALLEST)
    assert rows.columns == ["loan_id", features.TARGET, *features.MODEL_FEATURES, "data_split"]


def test_moments_do_not_multiply_the_loans(spark):
    found = queries.REGISTERED["scaled_feature_moments"](spark, SMALLEST)
    assert {r["feature"] for r in found.collect()} == set(features.NUMERIC_FEATURES)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan


def test_categories_are_taken_apart_after_counting(spark):
    found = queries.REGISTERED["encoded_category_counts"](spark, SMALLEST)
    train = queries.prepared(spark, SMALLEST).where("data_split = 'train'").count()
    ones = {}
    for r in found.collect():
        ones[r["feature"]] = ones.get(r["feature"], 0) + r["ones"]
    assert ones == dict.fromkeys(features.CATEGORICAL_FEATURES, train)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Generate") < plan.rindex("Aggregate")  # counted below, so before, the explode


def test_repeated_keys_are_found_in_parts_of_bounded_rows(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    rows = spark.range(1000).selectExpr("IF(id < 300, NULL, id % 650) AS a", "IF(id < 300, NULL, id % 650 * 2) AS b").repartition(5)
    found = rules.duplicate_keys(rows, ["a", "b"])
    assert found.rdd.getNumPartitions() == 10
    counts = {r["a"]: r["n"] for r in found.collect()}
    assert counts.pop(None) == 300
    assert counts == dict.fromkeys(range(300, 350), 2)
