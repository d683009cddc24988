"""Landing manifests (B6, B7).  Inputs come from ``with_source_file``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from touchline.sources.landing import FILE_PATH, SOURCE_FILE


def _file(rows: DataFrame) -> list[str]:
    """What tells files apart: the name, and the path where rows have it."""
    return [c for c in (SOURCE_FILE, FILE_PATH) if c in rows.columns]


def landing_manifest(rows: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    """One row per landed file and key values, with its row count."""
    counted = rows.groupBy(*keys, *_file(rows)).agg(F.count(F.lit(1)).alias("row_counts"))
    named = counted.select(*keys, F.col(SOURCE_FILE).alias("file_name"), "row_counts")
    return named.withColumn("ingestion_timestamp", at)


def record_manifest(rows: DataFrame, keys: Sequence[str], at: Column) -> DataFrame:
    """One row per record with its batch file and the size of that batch.

    Sizes are counted per file first and joined back, so a file that holds much of the
    data never has to fit one task as a window would need.
    """
    sizes = rows.groupBy(*_file(rows)).agg(F.count(F.lit(1)).alias("batch_row_count"))
    return rows.join(sizes, _file(rows)).select(
        *keys,
        F.col(SOURCE_FILE).alias("batch_file_name"),
        at.alias("ingestion_timestamp"),
        "batch_row_count",
    )
