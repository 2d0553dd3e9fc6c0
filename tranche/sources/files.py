"""Typed CSV and parquet reading: columns by header name, empty cells are NULL."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tranche.schemas import SOURCE_FILES, SOURCE_TABLES, TABLES, Table
from tranche.session import settle, small_side


def read_typed_csv(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """Read the columns of ``table`` by header name, cast to its types.

    Nothing is inferred: cells are read as text, empty ones as NULL, and a cell
    that does not fit its type stops the job.
    """
    try:
        raw = spark.read.csv(path, header=True, nullValue="", emptyValue="", mode="FAILFAST")
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error.getCondition()):
            raise FileNotFoundError(f"required file not found: {path}") from error
        raise
    _require(table, raw.columns, path)
    return raw.select(*[_strict_cast(name, kind) for name, kind in table.fields])


def _require(table: Table, names: list[str], path: str) -> None:
    absent = [name for name in table.columns if name not in names]
    if absent:
        raise ValueError(f"{path} has no column {absent}")


def _strict_cast(name: str, kind: str):
    """Cast text to ``kind``; a filled cell that does not parse raises."""
    cell = F.trim(F.col(name)) if kind != "string" else F.col(name)
    value = cell.try_cast(kind)
    bad = cell.isNotNull() & value.isNull()
    message = F.concat(F.lit(f"{name}: not a {kind}: "), cell)
    return F.when(bad, F.raise_error(message)).otherwise(value).cast(kind).alias(name)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value) of text files, lines counted from 1 in each file.

    Files are read in blocks by many tasks. A line's number is its place in its block plus the lines of
    the file's earlier blocks; only one row for each block is ordered.
    """
    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        "value", F.monotonically_increasing_id().alias("place"),
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(F.min("place").alias("first"), F.count("*").alias("n"))
    blocks = settle(blocks.select("file", "block", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier")))
    number = F.col("earlier") + F.col("place") - F.col("first") + 1
    return lines.join(small_side(blocks), ["file", "block"]).select("file", number.alias("line"), "value")


def bad_cells(spark: SparkSession, path: str, table: Table) -> DataFrame:
    """(file, line, column_name, text) of every filled cell that does not fit its declared type.

    All are found in one pass, where ``read_typed_csv`` stops at the first. Line 1 of a file is its
    header; a row is one line (no line feeds inside quotes). Cells beyond the header are not looked at.
    """
    names = spark.read.csv(path, header=True).columns
    _require(table, names, path)
    ddl = ", ".join(f"`{n}` string" for n in names)
    cells = F.from_csv("value", F.lit(ddl), {"nullValue": "", "emptyValue": "", "mode": "PERMISSIVE"})
    rows = numbered_lines(spark, path).where("line > 1").select("file", "line", cells.alias("cells"))
    bad = []
    for name, kind in table.fields:
        if kind != "string":
            cell = F.col("cells")[name]
            wrong = cell.isNotNull() & F.trim(cell).try_cast(kind).isNull()
            bad.append(F.when(wrong, F.struct(F.lit(name).alias("column_name"), cell.alias("text"))))
    found = F.explode(F.array_compact(F.array(*bad))).alias("bad")
    return rows.select("file", "line", found).select("file", "line", "bad.column_name", "bad.text")


def bad_cell_report(cells: DataFrame) -> DataFrame:
    """(column_name, cells, file, line, text): how many bad cells a column has, and the first of them."""
    first = F.min(F.struct("file", "line", "text")).alias("first")
    counted = cells.groupBy("column_name").agg(F.count("*").alias("cells"), first)
    return counted.select("column_name", "cells", "first.file", "first.line", "first.text")


def read_sources(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five supplied tables of ``folder``; all files must exist."""
    return {
        name: read_typed_csv(spark, f"{folder}/{file}", SOURCE_TABLES[name])
        for name, file in SOURCE_FILES.items()
    }


def read_report_csv(spark: SparkSession, folder: str, table: str, file: str) -> DataFrame:
    """A result table delivered as CSV, typed by its declared schema."""
    return read_typed_csv(spark, f"{folder}/{file}", TABLES[table])

