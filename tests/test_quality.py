"""L1-L9, E8"""

import pytest
from pyspark.sql import functions as F

from touchline.operators import quality
from touchline.schemas import layout, table_layout


def declared():
    return table_layout("silver_fixture_stats")


def stats(spark, **changes):
    base = {
        "fixture_id": 1, "team_id": 2, "shots_on_goal": 3, "shots_off_goal": 2,
        "blocked_shots": 1, "shots_insidebox": 4, "shots_outsidebox": 2, "fouls": 5,
        "offsides": 0, "corner_kicks": 3, "ball_possession": 100, "yellow_cards": 1,
        "red_cards": 0, "goalkeeper_saves": 2, "total_passes": 300, "accurate_passes": 250,
        "passes_success_percentage": 83.0, "expected_goals_rate": 1.0,
        "ingestion_time": None,
    }
    row = tuple({**base, **changes}[n] for n in declared().names)
    loose = layout(", ".join(f"{f.name} {f.dataType.simpleString()}" for f in declared()))
    return spark.createDataFrame([row], loose).withColumn(
        "ingestion_time", F.lit("2024-08-01").cast("timestamp")
    )


def test_clean_table(spark):
    outcome = quality.validate(stats(spark), declared(), "silver_fixture_stats")
    assert outcome.is_valid and "valid: True" in str(outcome)


@pytest.mark.parametrize(
    ("changes", "issue"),
    [
        ({"ball_possession": 101}, ".ball_possession: 1 beyond 0 to 100"),
        ({"fouls": -1}, ".fouls: 1 below zero"),
        ({"expected_goals_rate": 1.01}, "1 beyond 0 to 1"),
        ({"expected_goals_rate": -0.5}, ".expected_goals_rate: 1 below zero"),
        ({"shots_on_goal": 9}, "1 rows count attempts unlike by result and by place"),
    ],
)
def test_business_rules(spark, changes, issue):
    found = quality.validate(stats(spark, **changes), declared(), "silver_fixture_stats")
    assert not found.is_valid and any(issue in i for i in found.business_issues)


def test_null_shot_column_exempts_the_balance(spark):
    df = stats(spark, shots_on_goal=9, blocked_shots=None)
    assert quality.validate(df, declared(), "silver_fixture_stats").is_valid


def test_expected_goals_bound_is_a_parameter(spark):
    df = stats(spark, expected_goals_rate=2.5)
    assert quality.validate(df, declared(), "silver_fixture_stats", expected_goals_max=10).is_valid


def test_rules_apply_to_their_table_only(spark):
    assert quality.validate(stats(spark, fouls=-1), declared(), "other").is_valid


def test_missing_extra_wrong_and_null(spark):
    expected = layout("a BIGINT NOT NULL, b STRING, c INT NOT NULL")
    df = spark.createDataFrame([(None, 1, 1), (1, 1, 1)], "a BIGINT, b INT, d INT")
    found = quality.validate(df, expected, "t")
    assert found.quality_issues == ["1 nulls in a"]
    assert found.schema_issues == [
        "t lacks columns: c",
        "t has undeclared columns: d",
        "t.b is int, declared string",
    ]


def test_missing_statistics_column(spark):
    found = quality.validate(stats(spark).drop("fouls"), declared(), "silver_fixture_stats")
    assert any("lacks fouls" in i for i in found.business_issues)


def test_report_has_every_rule_and_needs_one_aggregate(spark):
    df = stats(spark, fouls=-1)
    rules, _ = quality.statistics_rules("t", df.columns)
    report = quality.violation_report(df, rules)
    assert report.count() == len(rules)
    assert [r.column for r in report.filter("violations > 0").collect()] == ["fouls"]
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan") == 1
    assert quality.violation_report(df, []).count() == 0


def test_gate(spark):
    df = spark.createDataFrame(
        [(1, "x", "League", None, None, None)],
        "league_id BIGINT, name STRING, type STRING, logo STRING, country STRING, country_flag STRING",
    )
    assert quality.gate(df, "silver_leagues") is df
    with pytest.raises(ValueError, match="1 nulls in name"):
        quality.gate(df.withColumn("name", F.lit(None).cast("string")), "silver_leagues")


def test_drop_violations(spark, rows):
    df = spark.createDataFrame([(1, 5), (None, 6), (2, -1)], "id INT, n INT")
    kept = quality.drop_violations(df, known="id IS NOT NULL", positive="n > 0")
    assert rows(kept) == [(1, 5)]
    counted, seen = quality.drop_violations_counted(df, "drops", known="id IS NOT NULL", positive="n > 0")
    assert counted.count() == 1
    assert seen.get == {"rows": 3, "dropped_known": 1, "dropped_positive": 1}


def test_payload_and_emptiness_checks(spark, rows):
    df = spark.sql("SELECT 1 AS id, array(1) AS stats UNION ALL SELECT 2, array() UNION ALL SELECT 3, NULL")
    assert rows(quality.empty_payloads(df), "id") == [(2,)]
    assert quality.require_rows(df, "x") is df
    with pytest.raises(ValueError, match="tracking is empty"):
        quality.require_rows(df.filter("id > 9"), "tracking")
