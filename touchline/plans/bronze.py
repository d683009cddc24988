"""Flattened landing tables (N12, N14, N16, N18); each works on batches and streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame

from touchline.operators.nested import flatten, parse_envelope
from touchline.schemas import layout, raw_league_ddl
from touchline.sources.landing import stamp

Moment = datetime | Column | None


def leagues(envelopes: DataFrame, seasons: str = "season") -> DataFrame:
    """One row per league and season from the JSON envelopes."""
    return flatten(parse_envelope(envelopes, layout(raw_league_ddl(seasons))))


def flattened(raw: DataFrame, at: Moment = None) -> DataFrame:
    """Flattened payload with its ingestion time (teams, fixtures)."""
    return stamp(flatten(raw), at)


def fixture_stats(raw: DataFrame, at: Moment = None) -> DataFrame:
    """One row per fixture, team and statistic."""
    return flattened(raw, at)
