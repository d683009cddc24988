"""Documents to training tokens: filter, deduplicate, mix, encode.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it to the
shared scratch folder as Parquet and gives it to the next stage.  All but the last return
the columns of ``docs``.  Ids are taken to be unique in ``documents``; rows with a null id
stay with what is decided for the null id.  An empty table passes through as an empty one.

SQL cannot express the encoding, so ``ORACLE_SQL`` is None and the tests hold ``run``
against a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import bpe, exact, mixing, near, quality
from touchline.llm.common import table
from touchline.scratch import spill


def _only(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id was kept."""
    kept = verdicts.filter("kept").select(F.col("doc_id").alias("__kept_id"))
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("__kept_id")), "left_semi")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither fail the base rules nor belong to a rejected source."""
    return _only(docs, quality.quality_rules(docs))


def drop_equal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal but for white space."""
    return exact.drop_exact_duplicates(docs)


def drop_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near duplicates, the smallest id."""
    return _only(docs, near.near_duplicates(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them: none, once, or up to three times."""
    taken = mixing.mixed(docs).filter("copies > 0")
    taken = taken.groupBy(F.col("doc_id").alias("__id")).agg(F.max("copies").alias("__copies"))
    return (
        docs.join(taken, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")))
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__copies"))))
        .select(*(F.col(f"`{c}`") for c in docs.columns))
    )


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row of the mix: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return bpe.token_digests(
        docs, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality rules", keep_good),
    ("exact dedup", drop_equal),
    ("near dedup", drop_near),
    ("mix", mix),
    ("encode", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = spill(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
