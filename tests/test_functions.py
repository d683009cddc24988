"""I1-I18, C12, O1"""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from touchline.functions import calendar, parsing, scores
from touchline.schemas import table_layout


def season_rule(day):
    start = day.year if day.month >= 8 else day.year - 1
    return f"{start}-{str(start + 1)[2:]}"


def test_season_label_agrees_with_the_rule_on_every_day(spark):
    days = calendar.calendar(spark, "1996-01-01", "2104-12-31").select("date", "season").collect()
    assert len(days) == (date(2104, 12, 31) - date(1996, 1, 1)).days + 1
    assert all(row.season == season_rule(row.date) for row in days)


def test_season_of_no_day_is_null(spark):
    df = spark.sql("SELECT CAST(NULL AS DATE) AS d")
    assert df.select(calendar.season_label(F.col("d"))).first()[0] is None


def test_date_dimension_default_year(spark):
    df = calendar.calendar(spark, "2023-08-01", "2024-07-31")
    assert df.columns == table_layout("dim_dates").names
    assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in table_layout("dim_dates")]
    days = {r.date: r for r in df.collect()}
    assert len(days) == 366 and {r.season for r in days.values()} == {"2023-24"}
    leap = days[date(2024, 2, 29)]
    assert (leap.date_key, leap.day_of_year, leap.quarter) == (20240229, 60, 1)
    assert (leap.month_name, leap.month_name_short, leap.day_name, leap.day_name_short) == (
        "February", "Feb", "Thursday", "Thu",
    )
    for day, row in days.items():
        assert row.week_of_year == day.isocalendar()[1]
        assert row.day_of_week == day.isoweekday() % 7 + 1
        assert row.is_weekend == (day.isoweekday() >= 6)
        assert row.match_day_category == ("Weekend" if day.isoweekday() >= 6 else "Weekday")


def test_calendar_covers_the_data(spark):
    df = spark.createDataFrame([(date(1999, 12, 30),), (date(2000, 1, 2),), (None,)], "d DATE")
    got = [r.date for r in calendar.calendar_covering(df, "d").orderBy("date").collect()]
    assert got == [date(1999, 12, 30) + timedelta(days=i) for i in range(4)]
    assert calendar.calendar_covering(df.filter("d IS NULL"), "d").count() == 0
    assert calendar.calendar(spark, "2024-01-02", "2024-01-01").count() == 0


SCORES = [(2, 1), (1, 2), (0, 0), (None, 1), (1, None), (None, None)]


def test_score_expressions(spark):
    df = spark.createDataFrame(SCORES, "h INT, a INT")
    h, a = F.col("h"), F.col("a")
    got = df.select(
        scores.score_text(h, a), scores.match_label(h, a), scores.team_label(h, a),
        scores.total_goals(h, a), scores.goal_difference(h, a),
        *scores.outcome_flags(h, a, ("w", "l", "d")),
    ).collect()
    nothing = (None,) * 8
    assert [tuple(r) for r in got] == [
        ("2-1", "home_win", "win", 3, 1, True, False, False),
        ("1-2", "away_win", "loss", 3, -1, False, True, False),
        ("0-0", "draw", "draw", 0, 0, False, False, True),
        nothing, nothing, nothing,
    ]


@pytest.mark.parametrize(
    ("capacity", "size"),
    [(None, "small"), (40000, "small"), (40001, "medium"), (100000, "medium"), (100001, "large")],
)
def test_venue_class(spark, capacity, size):
    df = spark.createDataFrame([(capacity,)], "c BIGINT")
    assert df.select(scores.venue_class(F.col("c"))).first()[0] == size


def test_years_since(spark):
    df = spark.createDataFrame([(1900,), (None,)], "y INT")
    as_of = F.lit(date(2024, 1, 1))
    assert [r[0] for r in df.select(scores.years_since(F.col("y"), as_of)).collect()] == [124, None]
    today = df.select(scores.years_since(F.col("y")).alias("n"), F.year(F.current_date())).first()
    assert today[0] == today[1] - 1900


def test_text_parsers(spark):
    df = spark.createDataFrame(
        [("7",), ("7.0",), ("55%",), ("84.5%",), ("n/a",), ("",), (None,)], "t STRING"
    )
    t = F.col("t")
    got = df.select(
        parsing.whole(t), parsing.percent_whole(t), parsing.percent_real(t), parsing.real_2(t)
    ).collect()
    assert [tuple(r) for r in got] == [
        (7, 7, 7.0, 7.0), (7, 7, 7.0, 7.0), (None, 55, 55.0, None), (None, 84, 84.5, None),
        (None,) * 4, (None,) * 4, (None,) * 4,
    ]


def test_iso_day_ignores_the_offset(spark):
    df = spark.createDataFrame([("2024-08-01T00:30:00+02:00",), ("bad",), (None,)], "t STRING")
    got = [r[0] for r in df.select(parsing.iso_day(F.col("t"))).collect()]
    assert got == [date(2024, 8, 1), None, None]
