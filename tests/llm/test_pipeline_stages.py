"""The pipeline on a small folder, each stage against a plain version on its own input."""

import os
import zlib

import numpy as np
import pytest

import corpus_pipeline
from tranche.llm import catalog, mixing

import brute
from brute import SCHEMA


@pytest.fixture(scope="module")
def folder(spark, rows, tmp_path_factory):
    target = str(tmp_path_factory.mktemp("tables"))
    insults = [(1000 + k, f"{rows[k % 12][1]} scum{k} you pathetic thing", "en", "s1", 10) for k in range(24)]
    spark.createDataFrame(rows + insults, SCHEMA).write.parquet(f"{target}/documents.parquet")
    labels = [(i, 1, int(i >= 1000)) for i, *_ in rows + insults]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{target}/labels.parquet")
    passage = " ".join(rows[5][1].split(" ")[10:40])
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{target}/benchmark.parquet")
    return target


def test_stages(spark, folder, tmp_path):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    inputs, outputs = {}, {}
    for name, stage in corpus_pipeline.STAGES:
        inputs[name] = [tuple(r) for r in docs.collect()]
        stage(spark, docs, folder).write.parquet(os.path.join(tmp_path, name))
        docs = spark.read.parquet(os.path.join(tmp_path, name))
        outputs[name] = [tuple(r) for r in docs.collect()]
        if name != "token_files":
            assert docs.columns == columns
    kept = {r[0] for r in outputs["toxicity"]}
    assert all(i < 1000 for i in kept) and kept == {r[0] for r in inputs["toxicity"] if r[0] < 1000}
    roots = brute.jaccard([(r[0], r[1]) for r in inputs["near_duplicates"]])
    want = [r for r in inputs["near_duplicates"] if roots[r[0]][1] == r[0]]
    assert sorted(outputs["near_duplicates"], key=str) == sorted(want, key=str)
    items = [tuple(r) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    want = [r for r in inputs["decontamination"] if not brute.contamination(r[1], items)[3]]
    assert sorted(outputs["decontamination"], key=str) == sorted(want, key=str)
    assert len(want) < len(inputs["decontamination"])
    given = spark.createDataFrame(inputs["mixing"], SCHEMA)
    mixed, _ = mixing.mix(given, mixing.tempered(given))
    assert sorted(outputs["mixing"], key=str) == sorted((tuple(r) for r in mixed.select(*columns).collect()), key=str)
    from tokenizers import Tokenizer

    library = Tokenizer.from_str(catalog.tokenizer_definition())
    start, want = 0, []
    for i, text, *_ in sorted(inputs["token_files"], key=lambda r: r[0]):
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(outputs["token_files"]) == want


def test_run(spark, folder):
    assert corpus_pipeline.run(spark, folder).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert corpus_pipeline.ORACLE_SQL is None
