"""Exact deduplication by skew-safe combining of salted digest groups (op 8).

Texts are equal when they agree after deleting white space.  Of equal texts the row with the
most code points in the original stays, then the smallest id.

Stages, each grouping by digest *and* full content, so equal digests never merge texts:

1. within a map task, Spark's partial aggregation leaves one row per distinct text;
2. rows of one salt meet, ``salts`` groups per text, so a text with a third of all rows is
   spread over ``salts`` tasks;
3. the salt winners of a text, at most ``salts`` rows, are combined.

Only the groups' keys then meet the documents again.  That join carries SHA-256, xxHash64
and length instead of content; the groups are checked to be unique in that key, and the
query fails loudly rather than merge two texts.

Edge cases: null text is the empty text; all-white texts are equal to it; a null id loses
against every other id; rows that repeat an id are members like others, and all rows that
carry the winning id have ``kept`` true; an empty table gives no rows; other columns are
not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import text_of, without_blanks
from touchline.scratch import spill

SALTS = 16
_HALF = "9223372036854775807"


def _keyed(docs: DataFrame, text: str, id_column: str) -> DataFrame:
    whole = text_of(text)
    content = without_blanks(whole)
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.length(whole).alias("chars"),
        content.alias("content"),
    ).withColumns(
        {
            "digest": F.sha2("content", 256),
            "check": F.xxhash64("content"),
            "size": F.length("content"),
        }
    )


def _standing() -> Column:
    """Length first, then the smaller id, in one number: larger is better.

    A decimal keeps the aggregation hashed and combinable, which a struct would not.
    """
    id_part = F.lit(_HALF).cast("decimal(20,0)") - F.coalesce(
        F.col("doc_id"), F.lit(_HALF).cast("long")
    ).cast("decimal(20,0)")
    return (
        F.col("chars").cast("decimal(11,0)") * F.lit("18446744073709551616").cast("decimal(20,0)")
        + id_part
    ).cast("decimal(38,0)")


def groups_of_equal(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", salts: int = SALTS
) -> DataFrame:
    """One row per distinct text: digest, check, size, keep_id, group_size."""
    rows = _keyed(docs, text, id_column).select(
        F.pmod(F.xxhash64("doc_id"), F.lit(salts)).alias("salt"),
        "digest",
        "content",
        _standing().alias("standing"),
    )
    salted = rows.groupBy("salt", "digest", "content").agg(
        F.max("standing").alias("standing"), F.count(F.lit(1)).alias("n")
    )
    whole = salted.groupBy("digest", "content").agg(
        F.max("standing").alias("standing"), F.sum("n").alias("group_size")
    )
    modulus = F.lit("18446744073709551616").cast("decimal(20,0)")
    id_part = (F.col("standing") % modulus).cast("decimal(20,0)")
    found = (F.lit(_HALF).cast("decimal(20,0)") - id_part).cast("long")
    keys = whole.select(
        "digest",
        F.xxhash64("content").alias("check"),
        F.length("content").alias("size"),
        F.when(id_part != 0, found).alias("keep_id"),
        "group_size",
    )
    # One row per key, as proven by content; anything else stops the query.
    same = keys.groupBy("digest", "check", "size").agg(
        F.max("keep_id").alias("keep_id"),
        F.max("group_size").alias("group_size"),
        F.count(F.lit(1)).alias("contents"),
    )
    return same.filter(
        F.when(F.col("contents") == 1, True).otherwise(
            F.raise_error(F.lit("two texts share all digests")).cast("boolean")
        )
    ).drop("contents")


def exact_duplicates(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", salts: int = SALTS
) -> DataFrame:
    """Per row: doc_id, keep_id, group_size, kept, text_sha256 (of the text without blanks)."""
    rows = _keyed(docs, text, id_column).select("doc_id", "digest", "check", "size")
    # Written first: the join then has an exchange on either side, and a hot group is split.
    groups = spill(groups_of_equal(docs, text, id_column, salts), "exact-groups")
    return rows.join(groups, ["digest", "check", "size"]).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def drop_exact_duplicates(
    docs: DataFrame, text: str = "text", id_column: str = "doc_id", salts: int = SALTS
) -> DataFrame:
    """The rows that stay, with all their columns.  Ids are taken to be unique."""
    winners = groups_of_equal(docs, text, id_column, salts).select(
        F.col("keep_id").alias("__keep_id")
    )
    return docs.join(winners, F.col(id_column).cast("long").eqNullSafe(F.col("__keep_id")), "left_semi")
