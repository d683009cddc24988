"""Landed JSON files as batches or streams."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StructType

from touchline.schemas import layout

INGESTED = "ingestion_time"
SOURCE_FILE = "source_file"
FILE_TIME = "file_time"
FILE_PATH = "file_path"
PACKED_ROWS = "file_rows"


def read_landing(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str,
    multi_line: bool = True,
    base: str | None = None,
) -> DataFrame:
    """A1: all JSON files below ``path`` (or several), one row per array element.

    Where single files are given, folders named ``column=value`` below ``base`` become columns.

    A multi-line file is one task whatever its size.  Feeds with very large files should
    land one record per line and pass ``multi_line=False``: those files are split.
    """
    reader = spark.read.schema(schema).option("multiLine", multi_line)
    if base is not None:
        reader = reader.option("basePath", base)
    return reader.json(path)


def read_packed(
    spark: SparkSession, path: str | list[str], schema: StructType | str, multi_line: bool = True
) -> DataFrame:
    """Files landed packed by ``sinks.write_packed``, one row per element with its file's name.

    Opening and listing a file costs the same for ten rows as for a million, so feeds of very
    many small files should land packed, some megabytes to a file.
    """
    fields = schema if isinstance(schema, StructType) else layout(schema)
    packed = StructType().add(SOURCE_FILE, "string").add(PACKED_ROWS, ArrayType(fields))
    files = read_landing(spark, path, packed, multi_line)
    return files.select(F.inline(PACKED_ROWS), SOURCE_FILE)


def stream_landing(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    multi_line: bool = True,
    max_files: int | None = None,
) -> DataFrame:
    """A2: files that arrive below ``path``, each exactly once per checkpoint."""
    reader = spark.readStream.schema(schema).option("multiLine", multi_line)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(path)


def with_source_file(df: DataFrame, name: str = SOURCE_FILE) -> DataFrame:
    """The name of the file each row came from; call it right after reading."""
    return df.select("*", F.col("_metadata.file_name").alias(name))


def with_file_order(df: DataFrame) -> DataFrame:
    """A6 for ties: each row's file name, modification time and path; call it right after reading."""
    return df.select(
        "*",
        F.col("_metadata.file_name").alias(SOURCE_FILE),
        F.col("_metadata.file_modification_time").alias(FILE_TIME),
        F.col("_metadata.file_path").alias(FILE_PATH),
    )


def stream_with_source(
    spark: SparkSession, path: str, schema: StructType | str, **options: object
) -> DataFrame:
    """File stream with processing time and source file."""
    rows = with_source_file(stream_landing(spark, path, schema, **options))
    return rows.withColumn("processing_time", F.current_timestamp())


def stamp(df: DataFrame, at: datetime | Column | None = None, name: str = INGESTED) -> DataFrame:
    """Add the ingestion time; now, unless a moment is given."""
    if at is None:
        at = F.current_timestamp()
    moment = at if isinstance(at, Column) else F.lit(at)
    return df.withColumn(name, moment.cast("timestamp"))


def from_rows(spark: SparkSession, rows: Iterable[object], schema: StructType | str) -> DataFrame:
    """A handful of driver-side rows, such as a load plan, as a DataFrame."""
    return spark.createDataFrame(list(rows), schema)
