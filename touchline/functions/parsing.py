"""Text to number / date, and typed lookup in key-value arrays."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

Parser = Callable[[Column], Column]


def whole(text: Column) -> Column:
    """Text to int: ``"7"`` and ``"7.0"`` give 7; anything that is no number gives null."""
    return text.try_cast("double").try_cast("int")


def real(text: Column) -> Column:
    """Text to float, null when it is no number."""
    return text.try_cast("float")


def without_percent(text: Column) -> Column:
    """Drop percent signs."""
    return F.replace(text, F.lit("%"), F.lit(""))


def percent_whole(text: Column) -> Column:
    return whole(without_percent(text))


def percent_real(text: Column) -> Column:
    return real(without_percent(text))


def real_2(text: Column) -> Column:
    """Float rounded to two places."""
    return F.round(real(text), 2)


def iso_day(text: Column) -> Column:
    """The calendar day written in an ISO text; the offset is ignored."""
    return F.substring(text, 1, 10).try_cast("date")


def epoch(seconds: Column) -> Column:
    """Epoch seconds to timestamp."""
    return F.timestamp_seconds(seconds)


def entry_value(
    entries: Column, label: str, parse: Parser, key: str = "type", value: str = "value"
) -> Column:
    """E6 without a shuffle: the largest parsed value among the entries of one type.

    ``entries`` is an array of structs.  Same meaning as ``max(when(type = label, value))``
    over the exploded array, but computed inside the row: no state, no exchange.
    """
    chosen = F.filter(entries, lambda e: e[key] == label)
    return F.array_max(F.transform(chosen, lambda e: parse(e[value])))
