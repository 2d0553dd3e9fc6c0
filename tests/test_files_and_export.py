import datetime
import os

import pytest
from builders import BAD, loans, macro
from pyspark.errors import PySparkException

from tranche import schemas
from tranche.plans import export
from tranche.sources import files, sinks, versions


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", encoding="utf-8") as target:
        target.write(text)
    return path


IMPORTANCE = "importance_std,model_name,feature,importance_mean\n0.5,m,ead,\n0.25,m,lgd,1.5\n"


def test_columns_are_read_by_header_and_empty_cells_are_null(spark, tmp_path):
    write(tmp_path, "i.csv", IMPORTANCE)
    df = files.read_report_csv(spark, str(tmp_path), "feature_importance", "i.csv")
    assert df.columns == schemas.IMPORTANCE.columns
    assert sorted(map(tuple, df.collect()), key=str) == [
        ("m", "ead", None, 0.5), ("m", "lgd", 1.5, 0.25)]


def test_bad_cells_missing_columns_and_files_stop(spark, tmp_path):
    bad = write(tmp_path, "bad.csv", IMPORTANCE.replace("1.5", "much"))
    with pytest.raises(PySparkException, match="importance_mean"):
        files.read_typed_csv(spark, bad, schemas.IMPORTANCE).collect()
    short = write(tmp_path, "short.csv", "model_name,feature\nm,ead\n")
    with pytest.raises(ValueError, match="importance_mean"):
        files.read_typed_csv(spark, short, schemas.IMPORTANCE)
    with pytest.raises(FileNotFoundError):
        files.read_sources(spark, str(tmp_path))


def test_clean_csv_round_trip_keeps_order_and_types(spark, tmp_path):
    df = loans(spark, {"origination_date": datetime.date(2021, 1, 1)}, BAD, {})
    sinks.write_clean_csv({"loans": df}, str(tmp_path))
    path = f"{tmp_path}/loan_portfolio_clean"
    back = files.read_typed_csv(spark, path, schemas.RAW_LOANS)
    assert back.dtypes == df.dtypes
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)
    text = "".join(open(os.path.join(path, f)).read() for f in sorted(os.listdir(path))
                   if f.endswith(".csv"))
    assert text.index("L1,") < text.index("L2,") < text.index("L0,") and "2021-01-01" in text


def test_rebuilt_database_loads_by_name(spark, tmp_path):
    sinks.rebuild_database(spark, "tranche_test", str(tmp_path / "db"))
    try:
        source = macro(spark, datetime.date(2020, 1, 1))
        shuffled = source.select(*reversed(source.columns))
        sinks.load_table(shuffled, "tranche_test", "portfolio_metrics")
        sinks.load_table(shuffled, "tranche_test", "portfolio_metrics")
        tables = {n: spark.table(f"tranche_test.{n}") for n in schemas.TABLES}
        counts = {r["table_name"]: r["rows"] for r in sinks.load_counts(tables).collect()}
        assert counts["portfolio_metrics"] == 1 and len(counts) == 9 and counts["loans"] == 0
        assert tables["portfolio_metrics"].first()["unemployment"] == 5
    finally:
        spark.sql("DROP DATABASE tranche_test CASCADE")


def sheets(spark):
    facts = ", ".join(
        f"struct('L{i}' AS loan_id, 0 AS defaulted, '{s}' AS data_split, 'm' AS model_name, "
        "0.5 AS default_probability, 0.3 AS operating_threshold, 'Low' AS risk_band, "
        "'Approve' AS underwriting_action, 1 AS term_risk_loss_proxy)"
        for i, s in enumerate(export.SPLITS)
    )
    one = {
        "Fact_Loans": f"SELECT inline(array({facts}))",
        "Fact_Thresholds": "SELECT 'm' AS model_name, 'test' AS split, 0.3 AS threshold",
        "Fact_ModelMetrics": "SELECT 'm' AS model_name, explode(array('validation', 'test')) AS "
                             "split, 't' AS threshold_type",
        "Fact_Portfolio": "SELECT date'2020-01-01' AS date",
        "Fact_Stress": "SELECT 's' AS scenario, 'x' AS sector",
        "Fact_Vintage": "SELECT 'v' AS vintage, 1 AS months_on_books",
        "Fact_Migration": "SELECT 2020 AS year, 'x' AS sector",
        "Feature_Importance": "SELECT 'ead' AS feature, 0.5 AS importance_mean",
    }
    return {name: spark.sql(text) for name, text in one.items()}


def test_publish_replaces_the_folder_and_lists_it(spark, tmp_path):
    target = str(tmp_path / "published")
    tables = sheets(spark)
    for _ in range(2):
        listed = {r["sheet_name"]: r for r in
                  export.publish(tables, target, {"Fact_Loans": 3}, ("m",)).collect()}
    assert list(listed) == list(export.SHEETS)
    assert listed["Fact_Loans"]["row_count"] == 3
    assert listed["Fact_Loans"]["table_name"] == "tblFact_Loans"
    assert spark.read.parquet(f"{versions.current(spark, target)}/Fact_Loans").count() == 3


@pytest.mark.parametrize(
    "table,change,message",
    [
        ("Fact_Loans", "SELECT * FROM {t} WHERE loan_id <> 'L0'", "time splits"),
        ("Fact_Loans", "SELECT * FROM {t} UNION ALL SELECT * FROM {t}", "duplicate keys"),
        ("Fact_Loans", "SELECT *, 1 AS x FROM {t} WHERE loan_id = 'none'", "empty"),
        ("Fact_Thresholds", "SELECT * FROM {t} UNION ALL SELECT 'n', 'test', 0.3", "not one model"),
        ("Fact_Thresholds", "SELECT 'm' AS model_name, 'train' AS split, 2 AS threshold",
         "outside 0 to 1"),
        ("Fact_ModelMetrics", "SELECT * FROM {t} WHERE split = 'test'", "validation or test"),
    ],
)
def test_breaches_are_found_and_nothing_is_published(spark, tmp_path, table, change, message):
    tables = sheets(spark)
    tables[table].createOrReplaceTempView("breached")
    tables[table] = spark.sql(change.format(t="breached"))
    target = str(tmp_path / "published")
    with pytest.raises(ValueError, match=message):
        export.publish(tables, target, {}, ("m",))
    assert not versions.exists(spark, target)


def test_failed_staging_keeps_the_old_export(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "published")
    export.publish(sheets(spark), target, {}, ("m",))
    before = versions.current(spark, target)
    real = export.row_counts
    calls = []

    def short(tables):
        calls.append(1)
        counts = real(tables)
        return counts if len(calls) == 1 else {**counts, "Fact_Loans": 0}

    monkeypatch.setattr(export, "row_counts", short)
    with pytest.raises(ValueError, match="staged"):
        export.publish(sheets(spark), target, {}, ("m",))
    assert versions.current(spark, target) == before
    assert spark.read.parquet(f"{before}/Fact_Loans").count() == 3
    assert [n for n in os.listdir(target) if n.startswith("version-")] == [before.rsplit("/", 1)[1]]
