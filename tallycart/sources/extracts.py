"""CSV extracts in and out (S1-S4, S6, S10). Types are always given, never inferred; columns are found by their header names.

A quote inside a quoted field is doubled, as spreadsheets write it, on reading and writing. Headers are read first, so a file
may hold its columns in any order and more than are wanted; all files of one read must agree on the order, else the read fails.
``multi_line`` reads quoted line breaks; such files can't be split over tasks.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tallycart.sources.schemas import raw_schema

CORRUPT = "_corrupt_record"
ARRIVAL = "_arrival"


def _read(
    spark: SparkSession,
    path: str,
    entity: str,
    *,
    tolerant: bool = False,
    arrival: bool = False,
    multi_line: bool = False,
    sources: bool = False,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    wanted = raw_schema(entity)
    given = {"header": True, "dateFormat": "yyyy-MM-dd", "quote": '"', "escape": '"', "multiLine": multi_line} | dict(options or {})
    header = spark.read.options(**given).csv(path).columns
    missing = [c for c in wanted.names if c not in header]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}; its header has {header}")
    placed = StructType([wanted[c] if c in wanted.names else StructField(c, StringType()) for c in header])
    reader = spark.read.options(**given).option("enforceSchema", False)
    if tolerant:
        placed = placed.add(CORRUPT, "string")
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    else:
        reader = reader.option("mode", "FAILFAST")
    columns = [F.col(f"`{c}`") for c in [*wanted.names, *([CORRUPT] if tolerant else [])]]
    if sources:
        columns += [F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name")]
    if arrival:
        place = F.struct("_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("row"))
        columns.append(place.alias(ARRIVAL))
    return reader.schema(placed).csv(path).select(*columns)


def read_extract(spark: SparkSession, path: str, entity: str, arrival: bool = False, multi_line: bool = False) -> DataFrame:
    """One typed extract; a file, a folder of files or a glob. A bad value fails the job. With ``arrival`` the place
    of each row (file, block, row) is added, so that cleaning can keep the first of several."""
    return _read(spark, path, entity, arrival=arrival, multi_line=multi_line)


def read_tolerant(spark: SparkSession, path: str, entity: str, multi_line: bool = False) -> DataFrame:
    """Bad rows stay in the result with their text in ``_corrupt_record`` and NULL for what can't be read."""
    return _read(spark, path, entity, tolerant=True, multi_line=multi_line)


def read_unquoted(spark: SparkSession, path: str, entity: str, sep: str = ",", tolerant: bool = False) -> DataFrame:
    """S3: UTF-8 text with a given separator and no quoting: a quote character is data. A bad value fails the job, or is
    kept as in S2 with ``tolerant``."""
    return _read(spark, path, entity, tolerant=tolerant, options={"sep": sep, "encoding": "UTF-8", "quote": "", "escape": "\\"})


def read_folder(spark: SparkSession, folder: str, entity: str, tolerant: bool = False, multi_line: bool = False) -> DataFrame:
    """Every file under a folder, with the file's path and name; bad values as in S3."""
    return _read(spark, folder, entity, tolerant=tolerant, multi_line=multi_line, sources=True, options={"recursiveFileLookup": True})


def read_extracts(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five extracts of a folder, as ``<entity>.csv``, with the order of arrival."""
    entities = ("customers", "products", "sales", "inventory", "returns")
    return {e: read_extract(spark, f"{folder}/{e}.csv", e, arrival=True) for e in entities}


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """CSV with a header in every part file; the parts are written in parallel."""
    df.write.mode(mode).option("header", True).option("escape", '"').option("dateFormat", "yyyy-MM-dd").csv(path)
    return path
