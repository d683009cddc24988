"""What the operators on texts share: words, reading tables, neutral column handling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# White space of the contracts: space, tab, line feed, vertical tab, form feed, return.
BLANKS = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, as Spark reads it (any store)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text as string; null counts as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit("")).cast(
        "string"
    )


def without_blanks(text: Column) -> Column:
    return F.regexp_replace(text, f"{BLANKS}+", "")


def words_of(text: Column) -> Column:
    """Array of the words of a text; empty for a text without words."""
    return F.filter(F.split(text, f"{BLANKS}+"), lambda w: w != "")
