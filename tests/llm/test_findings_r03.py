"""The near-duplicate search ran so many jobs that the driver's memory ran over in the third round, and kept
sets of shingles on disk."""

import os
import random

import brute
import pyarrow as pa
import pyarrow.parquet as pq

from tranche.llm import components, jaccard
from tranche.session import measured, run_folder


def jobs(spark, name, work):
    context = spark.sparkContext
    context.setJobGroup(name, name)
    try:
        result = work()
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
    return result, len(context.statusTracker().getJobIdsForGroup(name))


def test_a_written_table_is_measured_by_its_own_job(spark):
    folder = run_folder(spark)
    (kept, found), n = jobs(spark, "measured", lambda: measured(spark.range(10), folder))
    assert (found, n, kept.count()) == ({"rows": 10}, 1, 10)


def test_components_need_few_jobs(spark):
    path = spark.createDataFrame([(k, k + 1) for k in range(20)] + [(40, 41), (7, 7)], "a long, b long")
    found, n = jobs(spark, "components", lambda: components.components(path))
    assert {tuple(r) for r in found.collect()} == {(k, 0) for k in range(21)} | {(40, 40), (41, 40)}
    assert n <= 66, n


def test_near_duplicates_need_few_jobs(spark):
    texts = [" ".join(f"w{(k // 4) * 100 + j + (k % 4 if j == 50 else 0) * 1000}" for j in range(90)) for k in range(24)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kept, n = jobs(spark, "near", lambda: sorted(r["doc_id"] for r in jaccard.deduplicated(docs).collect()))
    assert kept == list(range(0, 24, 4))
    assert n <= 62, n


def test_near_duplicates_keep_no_sets_on_disk(spark, monkeypatch, tmp_path):
    source = random.Random(3)
    common = ["".join(source.choice("abdeilnorst") for _ in range(4)) for _ in range(400)]
    rows = []
    for k in range(6):
        words = source.choices(common, k=300)
        for j in range(4):  # near copies, one of them too far from the first
            changed = set(source.sample(range(len(words)), 4 * j))
            rows.append((4 * k + j, " ".join(f"{w}x{j}" if at in changed else w for at, w in enumerate(words))))
    monkeypatch.setattr(jaccard, "run_folder", lambda _: str(tmp_path / "run"))
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.linked_documents(
        spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == brute.jaccard(rows)
    kept = {
        name: pq.read_schema(next((tmp_path / "run" / name).glob("*.parquet")))
        for name in os.listdir(tmp_path / "run") if name != "compared"
    }
    # A shingle of a set takes 8 bytes that nothing makes smaller, a word of a text about half.
    assert not [name for name, schema in kept.items() if any(pa.types.is_list(t) for t in schema.types)]
