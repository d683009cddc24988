"""E6, C13, I14"""

from pyspark.sql import functions as F

from touchline.functions import parsing
from touchline.operators import pivot
from touchline.plans import bronze, silver
from touchline.schemas import RAW_FIXTURE_STATS, layout, table_layout

MEASURES = {"shots": ("Shots", parsing.whole), "share": ("Share", parsing.percent_whole)}
ENTRIES = [
    (1, "Shots", "3"), (1, "Shots", "7"), (1, "Share", "55%"), (1, "Other", "9"),
    (2, "Shots", None), (2, "Share", "n/a"), (3, "Shots", "5.0"),
]


def test_rows_and_arrays_agree(spark, rows):
    df = spark.createDataFrame(ENTRIES, "k INT, type STRING, value STRING")
    by_rows = pivot.pivot_rows(df, ["k"], "type", "value", MEASURES)
    arrays = df.groupBy("k").agg(F.collect_list(F.struct("type", "value")).alias("e"))
    in_place = arrays.select("k", *pivot.entry_columns(F.col("e"), MEASURES))
    want = [(1, 7, 55), (2, None, None), (3, 5, None)]
    assert rows(by_rows) == want and rows(in_place) == want


def test_missing_array(spark):
    df = spark.sql(
        "SELECT CAST(NULL AS ARRAY<STRUCT<type: STRING, value: STRING>>) AS e "
        "UNION ALL SELECT array()"
    )
    got = df.select(*pivot.entry_columns(F.col("e"), MEASURES)).collect()
    assert [tuple(r) for r in got] == [(None, None)] * 2


def test_rejects_are_counted(spark, rows):
    df = spark.createDataFrame(ENTRIES, "k INT, type STRING, value STRING")
    got = rows(pivot.rejected_values(df, "type", "value", MEASURES))
    assert got == [("share", 1), ("shots", 0)]


def payloads(spark):
    texts = [
        """{"fixture_id": 1, "stats": [
             {"team": {"id": 10}, "statistics": [
                {"type": "Shots on Goal", "value": "4"}, {"type": "Ball Possession", "value": "61%"},
                {"type": "expected_goals", "value": "1.239"}, {"type": "Passes %", "value": "84%"}]},
             {"team": {"id": 20}, "statistics": []}]}""",
        '{"fixture_id": 2, "stats": []}',
    ]
    df = spark.createDataFrame([(t,) for t in texts], "t STRING")
    return df.select(F.from_json("t", layout(RAW_FIXTURE_STATS)).alias("p")).select("p.*")


def test_silver_statistics_both_ways(spark, rows):
    raw = payloads(spark)
    at = F.lit("2024-08-01").cast("timestamp")
    by_rows = silver.stats_from_rows(bronze.fixture_stats(raw, at))
    in_place = silver.stats_from_payloads(raw.withColumn("ingestion_time", at))
    assert by_rows.columns == table_layout("silver_fixture_stats").names
    assert rows(by_rows) == rows(in_place)
    first = by_rows.filter("team_id = 10").first()
    assert first.shots_on_goal == 4 and first.ball_possession == 61
    assert abs(first.expected_goals_rate - 1.24) < 1e-6
    assert first.passes_success_percentage == 84.0
    assert (first.yellow_cards, first.fouls, first.goalkeeper_saves) == (0, 0, None)


def test_entries_in_one_walk(spark, rows):
    """One map for plain rows, the largest value where a label comes twice, nulls as ever."""
    entry = "STRUCT<type: STRING, value: STRING>"
    data = [
        (1, [("Fouls", "7"), ("Ball Possession", "61%"), ("other", "9")]),
        (2, [("Fouls", "3"), ("Fouls", "12"), ("Fouls", None)]),
        (3, [(None, "5"), ("Fouls", "x"), (None, "6")]),
        (4, []),
        (5, None),
        (6, [("Fouls", None)]),
    ]
    df = spark.createDataFrame(data, f"k INT, e ARRAY<{entry}>")
    measures = {"fouls": ("Fouls", parsing.whole), "share": ("Ball Possession", parsing.percent_whole)}
    found = pivot.pivot_entries(df, F.col("e"), measures, "k")
    assert rows(found) == [
        (1, 7, 61), (2, 12, None), (3, None, None), (4, None, None), (5, None, None), (6, None, None),
    ]
    slow = df.select("k", *pivot.entry_columns(F.col("e"), measures))
    assert rows(found) == rows(slow)
