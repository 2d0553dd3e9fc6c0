"""Writers: clean CSV, stored tables, views, load counts, JSON reports."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tranche.schemas import CLEAN_ORDER, SOURCE_FILES, TABLES


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the declared columns in order, cast to the declared types."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in TABLES[table].fields])


def write_clean_csv(cleaned: dict[str, DataFrame], folder: str) -> None:
    """One folder of CSV parts per table, globally ordered, ISO dates."""
    for name, df in cleaned.items():
        target = f"{folder}/{SOURCE_FILES[name].removesuffix('.csv')}_clean"
        df.orderBy(*CLEAN_ORDER[name]).write.mode("overwrite").csv(
            target, header=True, dateFormat="yyyy-MM-dd"
        )


def store_table(
    df: DataFrame, folder: str, table: str, partition_by: str | None = None
) -> DataFrame:
    """Replace a stored table and return the stored copy."""
    spark = df.sparkSession
    out = conform(df, table) if table in TABLES else df
    writer = out.write.mode("overwrite")
    if partition_by:
        # Rebalancing splits a value holding many rows and joins small ones, so files
        # stay well sized; without it every task would write a file per value.
        writer = out.hint("rebalance", partition_by).write.mode("overwrite")
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{folder}/{table}")
    stored = spark.read.parquet(f"{folder}/{table}")
    return conform(stored, table) if table in TABLES else stored


def stored_schema(spark: SparkSession, path: str) -> dict[str, str] | None:
    """Columns and types of a stored table, None if there is none yet."""
    try:
        return dict(spark.read.parquet(path).dtypes)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def replace_partitions(df: DataFrame, folder: str, table: str, partition_by: str) -> DataFrame:
    """Replace the partitions that ``df`` has rows of and return the whole stored table.

    Files of other partitions stay as they are, and the same rows written again give the same content,
    so a failed or repeated run does no harm. Columns must be those of the stored table and are cast to
    its types, since all files are read with one schema. ``df`` must not read the table it replaces parts of.
    """
    known = stored_schema(df.sparkSession, f"{folder}/{table}")
    if known is not None:
        if set(known) != set(df.columns):
            raise ValueError(f"{table} has columns {sorted(known)}, not {sorted(df.columns)}")
        df = df.select(*[F.col(c) if c == partition_by else F.col(c).cast(known[c]).alias(c) for c in df.columns])
    out = df.hint("rebalance", partition_by).write.mode("overwrite").partitionBy(partition_by)
    out.option("partitionOverwriteMode", "dynamic").parquet(f"{folder}/{table}")
    return df.sparkSession.read.parquet(f"{folder}/{table}")


def store_loans(df: DataFrame, folder: str) -> DataFrame:
    """Loans by origination year, so date filters read only their years."""
    return store_table(df, folder, "loans", partition_by="origination_year")


def rebuild_database(spark: SparkSession, database: str, location: str) -> None:
    """Drop and recreate the declared tables, empty, under ``location``."""
    spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    for table in TABLES.values():
        required = set(table.required)
        columns = ", ".join(
            f"`{name}` {kind}{' NOT NULL' if name in required else ''}"
            for name, kind in table.fields
        )
        spark.sql(f"CREATE TABLE {database}.{table.name} ({columns}) USING parquet")


def load_table(df: DataFrame, database: str, table: str) -> None:
    """Replace the content of a declared table, columns matched by name."""
    conform(df, table).write.mode("overwrite").insertInto(f"{database}.{table}")


def load_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rows) for every table given, in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def footer_reader(spark: SparkSession) -> SparkSession:
    """A session on the same cluster in which counts of parquet tables come from the files' footers."""
    own = spark.newSession()
    row_sources = [s for s in own.conf.get("spark.sql.sources.useV1SourceList").split(",") if s != "parquet"]
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(row_sources))
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own


def footer_counts(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(table_name, rows) of stored parquet tables; no column is read."""
    own = footer_reader(spark)
    return load_counts({name: own.read.parquet(path) for name, path in paths.items()})


def footer_counts_by(spark: SparkSession, path: str, partition_by: str) -> DataFrame:
    """(partition_by, rows) of a stored table's partitions; no column is read."""
    return footer_reader(spark).read.parquet(path).groupBy(partition_by).agg(F.count(F.lit(1)).alias("rows"))


def write_json(df: DataFrame, path: str) -> None:
    """Report rows as JSON lines; reports have one row per table, column and metric."""
    df.write.mode("overwrite").json(path)


def register_views(tables: dict[str, DataFrame]) -> None:
    """Make the tables available to ``spark.sql`` under their names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
