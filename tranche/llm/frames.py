"""Small helpers for operators that run Python over Arrow batches."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where it runs from a source folder, and keep Arrow batches
    of whole texts small unless the session sets their size."""
    if spark.conf.get(BATCH) == "10000":  # Spark's default, meant for narrow rows
        spark.conf.set(BATCH, "1000")
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(os.pathsep)
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *[p for p in paths if p]])
    return spark


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores before it until no column has it (names compare without case)."""
    lower = {x.lower() for x in taken}
    while name.lower() in lower:
        name = "_" + name
    return name


def with_columns(
    df: DataFrame, added: str, compute: Callable[[pa.RecordBatch], list[pa.Array]]
) -> tuple[DataFrame, list[str]]:
    """Add the columns declared in ``added`` (DDL), which ``compute`` gives for each batch.

    Rows stay where they are. A name that ``df`` already has gets underscores before it; the names
    used are returned.
    """
    wanted = T.StructType.fromDDL(added)
    names = [fresh(field.name, df.columns) for field in wanted.fields]
    schema = T.StructType(
        [*df.schema.fields, *[T.StructField(n, f.dataType) for n, f in zip(names, wanted.fields)]]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                new = compute(batch)
                yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *names])

    return df.mapInArrow(run, schema), names
