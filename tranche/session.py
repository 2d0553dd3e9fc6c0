"""Session settings and the two helpers every multi-step operator relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A side is broadcast only when it is measured to be no larger than this.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 << 20
# Rows that one task of a sized shuffle handles, about.
TASK_ROWS = 1_000_000
# HotSpot never compiles a method of more bytes; Spark generates up to 65,535 unless told.
HOTSPOT_METHOD_BYTES = 8_000


def local_session(name: str = "tranche", cores: int | None = None, memory: str = "12g") -> SparkSession:
    """Session for tests and the bench, with a folder of its own; a cluster supplies its own."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.codegen.hugeMethodLimit", str(HOTSPOT_METHOD_BYTES))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tranche-shared-"))
        .getOrCreate()
    )


def importable(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package where it runs from a source folder."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([root, *paths])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; all executors must reach it."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def compilable(spark: SparkSession) -> SparkSession:
    """Keep generated methods within what the JVM compiles: wide projections run several times faster,
    with the same results. A lower limit set by the user stays."""
    if int(spark.conf.get("spark.sql.codegen.hugeMethodLimit")) > HOTSPOT_METHOD_BYTES:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", HOTSPOT_METHOD_BYTES)
    return spark


def parts_for(df: DataFrame, rows: int | None = None) -> int:
    """Shuffle partitions that hold about ``rows`` (TASK_ROWS) rows each, however many rows there are."""
    return max(1, -(-df.count() // (rows or TASK_ROWS)))


def run_folder(spark: SparkSession) -> str:
    """A new path for one run's tables, below the shared folder."""
    return f"{shared_folder(spark)}/run-{uuid.uuid4().hex}"


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Within, a query's shuffle files go as soon as it has ended, not when the driver's garbage is collected. For
    steps that go on from written tables only: a shuffle needed again would be made again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and continue from there.

    One job, unlike a checkpoint, and later steps read only the columns they use.
    """
    folder = run_folder(df.sparkSession)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def measured(df: DataFrame, folder: str, **measures: Column) -> tuple[DataFrame, dict]:
    """Write ``df`` as a table into ``folder`` and read it back, with its number of rows (``rows``) and the given
    aggregates, which the writing job makes: no further job counts, and none infers the schema."""
    seen = Observation()
    wanted = {"rows": F.count(F.lit(1)), **measures}
    df.observe(seen, *[value.alias(name) for name, value in wanted.items()]).write.parquet(folder)
    got = seen.get
    found = {name: got.get(name) for name in wanted}
    found["rows"] = found["rows"] or 0  # a plan that turns out empty may be run without its measures
    return df.sparkSession.read.schema(df.schema).parquet(folder), found


def counted_side(df: DataFrame, rows: int) -> DataFrame:
    """``small_side`` for columns of fixed width, whose rows are counted already (or at most ``rows``)."""
    fits = rows <= BROADCAST_ROWS and 16 * len(df.columns) * rows <= BROADCAST_BYTES
    return F.broadcast(df) if fits else df


def _width(field: T.StructField) -> Column:
    """Bytes of a value: measured where they vary."""
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(F.col(f"`{field.name}`")), F.lit(0)) + 8
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(F.col(f"`{field.name}`")))), F.lit(0)) + 8
    return F.lit(16)


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Broadcast ``df`` if it is measured to be small, else leave the join to the planner."""
    width = F.lit(0)
    for field in df.schema.fields:
        width = width + _width(field)
    found = df.limit(rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(width).alias("size")).first()
    return F.broadcast(df) if found["n"] <= rows and (found["size"] or 0) <= size else df
