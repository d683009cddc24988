"""Layer tables as batches or streams (A3, A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from touchline.sources.files import Files

VERSION = "version"


def table_path(root: str, layer: str, name: str) -> str:
    """Folder of a table: ``root/layer/name``."""
    return f"{root.rstrip('/')}/{layer}/{name}"


def read_table(
    spark: SparkSession, root: str, layer: str, name: str, schema: StructType | None = None
) -> DataFrame:
    """A3: a parquet table of a layer.

    Give the schema of a partitioned table: without it, partition values are typed by what
    they look like.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(table_path(root, layer, name))


def stream_table(
    spark: SparkSession, path: str, schema: StructType, max_files: int | None = None
) -> DataFrame:
    """A4: an append-only parquet table as a stream."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def versions(spark: SparkSession, path: str) -> list[int]:
    """All complete versions below ``path``, by the names of its folders; no data is read.

    A version is complete once its writer left its mark, which it does last.
    """
    files = Files(spark, path)
    found = [n.partition("=")[2] for n in files.names("") if n.startswith(f"{VERSION}=")]
    return sorted(int(v) for v in found if files.exists(f"{VERSION}={v}/_SUCCESS"))


def newest_version(spark: SparkSession, path: str) -> int:
    """The largest complete version below ``path``."""
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"{path} has no version")
    return known[-1]


def expire_versions(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Remove all but the newest ``keep`` versions; a reader of an older one loses its input."""
    gone = versions(spark, path)[:-keep]
    files = Files(spark, path)
    for version in gone:
        files.delete(f"{VERSION}={version}")
    return gone


def read_version(
    spark: SparkSession,
    path: str,
    schema: StructType,
    source: str = "parquet",
    version: int | None = None,
) -> DataFrame:
    """The newest (or one given) version of a table written by ``sinks.write_version``."""
    if version is None:
        version = newest_version(spark, path)
    folder = f"{path.rstrip('/')}/{VERSION}={version}"
    return spark.read.schema(schema).format(source).load(folder).select(*schema.names)
