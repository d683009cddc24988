"""Which landed files are new: the list of files against a ledger of files taken.

Only names, times and sizes are read here.  The rows of known files are never looked at, so a
run costs what its new files cost, however much has landed before.  A file written again under
its name has another time and is new.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from touchline.sources.landing import FILE_PATH, FILE_TIME, read_landing, with_file_order

LEDGER = f"{FILE_PATH} STRING, {FILE_TIME} TIMESTAMP, file_size BIGINT, open_path STRING"


def landed_files(spark: SparkSession, path: str) -> DataFrame:
    """One row per file below ``path``: its identity, size and the path to open it by.

    No content is read: the columns of the file's own are the only ones asked for.
    """
    try:
        listed = spark.read.format("binaryFile").load(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)
    return listed.select(
        F.col("_metadata.file_path").alias(FILE_PATH),
        F.col("_metadata.file_modification_time").alias(FILE_TIME),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("path").alias("open_path"),
    )


def new_files(listed: DataFrame, taken: DataFrame) -> DataFrame:
    """The listed files that the ledger does not hold in this state."""
    return listed.join(taken.select(FILE_PATH, FILE_TIME), [FILE_PATH, FILE_TIME], "left_anti")


def read_files(
    spark: SparkSession,
    files: DataFrame,
    schema: StructType | str,
    multi_line: bool = True,
    base: str | None = None,
) -> DataFrame:
    """Landed rows of the given files alone, with their file order.

    Folders named ``column=value`` below ``base`` become columns.  The names go through the
    driver, as every list of input files does in Spark.
    """
    paths = [_escaped(r["open_path"]) for r in files.select("open_path").orderBy("open_path").collect()]
    if not paths:
        return _without_rows(spark, schema)
    return with_file_order(read_landing(spark, paths, schema, multi_line, base))


def _without_rows(spark: SparkSession, schema: StructType | str) -> DataFrame:
    ordered = "source_file STRING, file_time TIMESTAMP, file_path STRING"
    plain = spark.createDataFrame([], schema)
    return spark.createDataFrame([], StructType([*plain.schema, *spark.createDataFrame([], ordered).schema]))


def _escaped(path: str) -> str:
    """A path with the signs of patterns taken literally."""
    return "".join(f"\\{c}" if c in "\\{}[]*?" else c for c in path)
