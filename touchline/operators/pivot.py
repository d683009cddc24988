"""Key-value rows to typed columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from touchline.functions.parsing import Parser, entry_value

Measure = tuple[str, Parser]


def pivot_rows(
    df: DataFrame, keys: Sequence[str], label: str, value: str, measures: Mapping[str, Measure]
) -> DataFrame:
    """E6 on exploded rows: per key, the largest parsed value of each label.

    A hash aggregate of conditional maxima, so a hot key is reduced before the shuffle.
    """
    return df.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col(label) == wanted, parse(F.col(value)))).alias(name)
            for name, (wanted, parse) in measures.items()
        ]
    )


def entry_columns(entries: Column, measures: Mapping[str, Measure]) -> list[Column]:
    """E6 on an array column: the same values inside the row, without shuffle or state."""
    return [
        entry_value(entries, wanted, parse).alias(name)
        for name, (wanted, parse) in measures.items()
    ]


def pivot_entries(
    df: DataFrame, entries: Column, measures: Mapping[str, Measure], *keep: Column | str
) -> DataFrame:
    """E6 on an array column in one walk: the kept columns and one column per measure.

    The array becomes a map once, and each measure looks its label up and parses one text.
    Only rows that name a label twice are walked per measure, for the largest parsed value.
    """
    named = F.filter(entries, lambda e: e["type"].isNotNull())
    labels = F.transform(named, lambda e: e["type"])
    once = F.size(F.array_distinct(labels)) == F.size(labels)
    pairs = F.map_from_entries(F.transform(named, lambda e: F.struct(e["type"], e["value"])))
    # A column of its own: the planner does not build the map again for every measure.
    opened = df.select(*keep, entries.alias("__entries"), F.when(once, pairs).alias("__texts"))
    kept = opened.columns[:-2]
    texts = F.col("__texts")
    return opened.select(
        *kept,
        *[
            F.when(texts.isNotNull(), parse(F.try_element_at(texts, F.lit(label))))
            .otherwise(entry_value(F.col("__entries"), label, parse))
            .alias(name)
            for name, (label, parse) in measures.items()
        ],
    )


def rejected_values(
    df: DataFrame, label: str, value: str, measures: Mapping[str, Measure]
) -> DataFrame:
    """Per measure, how many non-null texts its parser turned into null."""
    counts = [
        F.count_if(
            (F.col(label) == wanted) & F.col(value).isNotNull() & parse(F.col(value)).isNull()
        ).alias(name)
        for name, (wanted, parse) in measures.items()
    ]
    rows = F.array(
        *[F.struct(F.lit(n).alias("measure"), F.col(n).alias("rejected")) for n in measures]
    )
    return df.agg(*counts).select(F.inline(rows))
