"""Readers for raw catalogues and derived tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialise

# The raw catalogue's columns, all read as text.
RAW_COLUMNS = [
    "show_id", "type", "title", "country", "release_year",
    "rating", "date_added", "duration", "listed_in", "description",
]
RAW_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in RAW_COLUMNS])

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


class MissingInput(FileNotFoundError):
    """The input of a job does not exist."""


def _is_missing(error: AnalysisException) -> bool:
    return (error.getCondition() or "").startswith("PATH_NOT_FOUND")


def read_catalogue_csv(
    spark: SparkSession,
    path: str,
    columns: list[str] = RAW_COLUMNS,
    multi_line: bool = False,
    escape: str = "\\",
) -> DataFrame:
    """Permissive CSV scan of the named columns, all as text.

    Names come from the header and types are fixed, so there is no inference
    pass. ``multi_line`` keeps quoted line breaks inside one record, but such
    files cannot be split; ``escape='"'`` reads doubled quotes.
    """
    try:
        raw = (
            spark.read.option("header", True)
            .option("mode", "PERMISSIVE")
            .option("multiLine", multi_line)
            .option("escape", escape)
            .csv(path)
        )
    except AnalysisException as error:
        if _is_missing(error):
            raise MissingInput(f"No catalogue CSV at {path}.") from error
        raise
    return raw.select(*columns)


def _reject_reason(line: Column, cells: int) -> Column:
    """Why a line is no record of so many cells: an open quote, too few cells or too many."""
    bare = F.regexp_replace(line, r'"([^"\\]|\\.|"")*"', "")
    return (
        F.when(F.contains(bare, F.lit('"')), "torn")
        .when(F.length(bare) - F.length(F.replace(bare, F.lit(","))) < cells - 1, "short")
        .otherwise("long")
    )


def quarantined_csv(
    spark: SparkSession, path: str, columns: list[str] = RAW_COLUMNS, escape: str = "\\"
) -> tuple[DataFrame, DataFrame]:
    """Rows of ``columns`` that are whole, and the lines that are not: (file, block, reason, line).

    ``block`` is the byte at which the scan's split of the file begins. Reasons are ``short``, ``long``, ``torn`` (a
    quote stays open, as where a record has a line break) and ``header``: whole lines of a file that nowhere holds
    the header of the first file, whose cells could belong to other columns. Lines equal to that header are not
    records, wherever they stand; empty lines neither. All other lines are in just one of the two tables.

    The files are scanned once: rows and lines go to one written table that both results read.
    """
    try:
        names = spark.read.option("header", True).option("escape", escape).csv(path).columns
    except AnalysisException as error:
        if _is_missing(error):
            raise MissingInput(f"No catalogue CSV at {path}.") from error
        raise
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))] + [T.StructField("line", T.StringType())])
    scanned = (
        spark.read.schema(schema)
        # A pruned scan would not look at all cells of a line.
        .option("columnPruning", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "line")
        .option("escape", escape)
        .csv(path)
    )
    wanted = [F.col(f"c{names.index(name)}").alias(f"v{i}") for i, name in enumerate(columns)]
    cells = F.array(*[F.col(f"c{i}") for i in range(len(names))])
    parsed = materialise(
        scanned.select(
            *wanted,
            F.col("line"),
            F.to_json(cells).alias("cells"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            (F.col("line").isNull() & (cells == F.array(*map(F.lit, names)))).alias("is_header"),
        ),
        "scanned-csv",
    )
    files = parsed.groupBy("file").agg(F.bool_or("is_header").alias("known"))
    # One row for each file; a file's rows all join its one row.
    rows = parsed.filter("not is_header").join(files, "file")
    kept = rows.filter("line is null and known").select(*[F.col(f"v{i}").alias(name) for i, name in enumerate(columns)])
    rejected = rows.filter("line is not null or not known").select(
        "file",
        "block",
        F.when(F.col("line").isNull(), "header").otherwise(_reject_reason(F.col("line"), len(names))).alias("reason"),
        F.coalesce("line", "cells").alias("line"),
    )
    return kept, rejected


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan. With ``schema``, an absent table reads as an empty one."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as error:
        if not _is_missing(error):
            raise
        if schema is not None:
            return spark.createDataFrame([], schema)
        raise MissingInput(f"No table at {path}.") from error


def read_report(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON report scan; an absent report reads as no rows."""
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if _is_missing(error):
            return spark.createDataFrame([], schema)
        raise


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
