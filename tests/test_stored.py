"""Sketches merged per partition, partitions replaced, counts from footers, all bad cells at once."""

import random

import pytest
from pyspark.sql import functions as F

from tranche.operators import profile, sketches
from tranche.schemas import Table
from tranche.sources import files, sinks


def test_merged_sketches_of_changed_years(spark, tmp_path):
    rows = spark.range(60000).select(
        (F.col("id") % 6 + 2000).alias("year"), (F.col("id") * 7919 % 60000).alias("value"),
        (F.col("id") % 5000).cast("string").alias("name"), F.lit(None).cast("double").alias("empty"),
    )
    sketches.store_sketches(rows, str(tmp_path), "year")
    new = rows.where("year = 2003").withColumn("value", F.col("value") + 1000000)
    stored = sketches.store_sketches(new, str(tmp_path), "year")
    found = {r["column_name"]: r for r in sketches.merged_quantiles(stored, (0.5, 0.9)).collect()}
    assert (found["value"]["n"], found["empty"]["n"], found["empty"]["q1"]) == (60000, 0, None)
    whole = rows.where("year <> 2003").unionByName(new)
    for q, fraction in (("q1", 0.5), ("q2", 0.9)):
        below = whole.where(F.col("value") < found["value"][q]).count()
        assert abs(below / 60000 - fraction) <= sketches.RANK_ERROR
    number = sketches.merged_distinct(stored).first()["number"]
    assert abs(number - 5000) <= sketches.DISTINCT_ERROR * 5000
    cuts = sketches.merged_quantiles(stored).where("column_name = 'value'")
    outside = profile.medians_and_outliers(whole.select("value"), cuts).where("metric = 'iqr_outliers'")
    assert outside.first()["number"] == 10000


def test_other_partitions_keep_their_files(spark, tmp_path):
    rows = spark.createDataFrame([(1, 2000), (2, 2000), (3, 2001)], "x long, year int")
    sinks.replace_partitions(rows, str(tmp_path), "t", "year")
    before = set((tmp_path / "t" / "year=2001").iterdir())
    for _ in range(2):
        stored = sinks.replace_partitions(spark.createDataFrame([(9, 2000), (8, 2002)], rows.schema), str(tmp_path), "t", "year")
        assert sorted(map(tuple, stored.collect())) == [(3, 2001), (8, 2002), (9, 2000)]
    assert set((tmp_path / "t" / "year=2001").iterdir()) == before
    narrow = spark.createDataFrame([(7, 2000)], "x int, year int")
    stored = sinks.replace_partitions(narrow, str(tmp_path), "t", "year")
    assert sorted(map(tuple, stored.collect())) == [(3, 2001), (7, 2000), (8, 2002)]
    with pytest.raises(ValueError, match="has columns"):
        sinks.replace_partitions(narrow.withColumn("y", F.col("x")), str(tmp_path), "t", "year")


def test_counts_are_pushed_to_footers(spark, tmp_path):
    spark.range(1000).withColumn("part", F.col("id") % 3).write.partitionBy("part").parquet(str(tmp_path / "t"))
    counts = sinks.footer_counts(spark, {"t": str(tmp_path / "t")})
    by = sinks.footer_counts_by(spark, str(tmp_path / "t"), "part")
    assert counts.first()["rows"] == 1000 and sorted(r["rows"] for r in by.collect()) == [333, 333, 334]
    for df in (counts, by):
        plan = df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
        assert "PushedAggregation: [COUNT(*)]" in plan and "id#" not in plan.split("(1)")[1].split("\n\n")[0]


def test_every_bad_cell_has_its_line(spark, tmp_path):
    table = Table("t", "key string, n int, day date", ("key",), frozenset(), ())
    source = random.Random(1)
    want = []
    for name, count in (("a.csv", 3000), ("b.csv", 5)):
        lines = ["day,key,n,more"]
        for k in range(2, count + 2):
            bad_n, bad_day = source.random() < 0.1, source.random() < 0.1
            day, n = "2020-02-30" if bad_day else "2020-02-28", '"1,5"' if bad_n else " 7 " if k % 2 else ""
            lines.append(f"{day},k{k},{n},x")
            want += [(name, k, "day", day)] * bad_day + [(name, k, "n", "1,5")] * bad_n
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")  # many blocks in a file
    try:
        cells = files.bad_cells(spark, str(tmp_path), table)
        found = [(r["file"].rsplit("/", 1)[1], r["line"], r["column_name"], r["text"]) for r in cells.collect()]
        report = {r["column_name"]: r for r in files.bad_cell_report(cells).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted(found) == sorted(want)
    for column, row in report.items():
        own = sorted(w for w in want if w[2] == column)
        assert (row["cells"], row["line"], row["text"]) == (len(own), own[0][1], own[0][3])
