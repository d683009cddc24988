"""Match tables derived from the given tables, as SQL that Spark and DuckDB both run.

Orders play the matches, customers the teams, nations the leagues, line items the match
statistics.  A few matches refer to a team or league that does not exist, some have no
score, some no extra time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "orders", "lineitem", "events", "documents")
AS_OF = "2024-08-01"

FIXTURES = """
SELECT fixture_id, referee, timezone, date, timestamp, first_period, second_period,
       stadium_id, status, elapsed, league_id, season, round, league_standings,
       home_team_id, away_team_id, goals_home, goals_away,
       CAST(floor(goals_home / 2) AS INT) AS score_halftime_home,
       CAST(floor(goals_away / 2) AS INT) AS score_halftime_away,
       goals_home AS score_fulltime_home,
       goals_away AS score_fulltime_away,
       CASE WHEN fixture_id % 10 = 0 THEN CAST(fixture_id % 3 AS INT) END AS score_extratime_home,
       CASE WHEN fixture_id % 10 = 0 THEN CAST(fixture_id % 2 AS INT) END AS score_extratime_away,
       CASE WHEN fixture_id % 20 = 0 THEN CAST(fixture_id % 6 AS INT) END AS score_penalty_home,
       CASE WHEN fixture_id % 20 = 0 THEN CAST(fixture_id % 5 AS INT) END AS score_penalty_away
FROM (
  SELECT o_orderkey AS fixture_id,
         concat('Referee ', CAST(o_custkey % 40 AS STRING)) AS referee,
         'UTC' AS timezone,
         CAST(o_orderdate AS DATE) AS date,
         1000000000 + o_orderkey * 60 AS timestamp,
         o_orderdate + INTERVAL '15' HOUR AS first_period,
         o_orderdate + INTERVAL '16' HOUR AS second_period,
         o_custkey % 25 AS stadium_id,
         CASE o_orderstatus WHEN 'F' THEN 'Match Finished' WHEN 'O' THEN 'Not Started'
                            ELSE 'Match Postponed' END AS status,
         CAST(90 + o_orderkey % 7 AS INT) AS elapsed,
         o_custkey % 26 AS league_id,
         CAST(year(o_orderdate) - CASE WHEN month(o_orderdate) < 8 THEN 1 ELSE 0 END AS INT)
           AS season,
         concat('Regular Season - ', CAST(1 + o_orderkey % 38 AS STRING)) AS round,
         o_custkey % 3 <> 0 AS league_standings,
         o_custkey AS home_team_id,
         o_custkey + 1 + o_orderkey % 24 AS away_team_id,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice) AS INT) % 5 END
           AS goals_home,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(floor(o_totalprice / 7) AS INT) % 4 END
           AS goals_away
  FROM {orders}
) AS played
"""

TEAMS = """
SELECT c_custkey AS team_id, c_name AS name,
       concat('T', CAST(c_custkey AS STRING)) AS code, n_name AS country,
       CASE WHEN c_custkey % 13 <> 0 THEN CAST(1850 + c_custkey % 150 AS INT) END AS founded,
       c_custkey % 7 = 0 AS national,
       concat('logo/', CAST(c_custkey AS STRING)) AS logo,
       c_custkey % 500 AS stadium_id,
       concat('Stadium ', CAST(c_custkey % 500 AS STRING)) AS stadium_name,
       concat('Street ', CAST(c_custkey AS STRING)) AS stadium_address,
       c_mktsegment AS city,
       CASE WHEN c_custkey % 11 <> 0 THEN CAST(floor(c_acctbal * 12) AS BIGINT) END AS capacity,
       concat('image/', CAST(c_custkey AS STRING)) AS stadium_image,
       CASE WHEN c_custkey % 2 = 0 THEN 'grass' ELSE 'turf' END AS stadium_surface
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey
"""

LEAGUES = """
SELECT CAST(n_nationkey AS BIGINT) AS league_id, n_name AS name,
       CASE WHEN n_nationkey % 4 = 0 THEN 'Cup' ELSE 'League' END AS type,
       concat('logo/', CAST(n_nationkey AS STRING)) AS logo,
       r_name AS country, concat('flag/', r_name) AS country_flag
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
"""

STATS = (
    """
SELECT s.fixture_id,
       CASE WHEN s.side = 0 THEN f.home_team_id ELSE f.away_team_id END AS team_id,
       shots_on_goal, shots_off_goal, blocked_shots, shots_insidebox, shots_outsidebox,
       fouls, CASE WHEN s.fixture_id % 9 <> 0 THEN corner_kicks END AS offsides,
       corner_kicks, ball_possession, yellow_cards, red_cards, goalkeeper_saves,
       total_passes, accurate_passes, passes_success_percentage, expected_goals_rate
FROM (
  SELECT l_orderkey AS fixture_id, l_linenumber % 2 AS side,
         CAST(count(*) AS INT) AS shots_on_goal,
         CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS INT) AS shots_off_goal,
         CAST(sum(CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END) AS INT) AS blocked_shots,
         CAST(sum(CASE WHEN l_linestatus = 'O' THEN 2 ELSE 1 END) AS INT) AS shots_insidebox,
         CAST(sum(CASE WHEN l_returnflag = 'N' THEN 0 ELSE 1 END) AS INT) AS shots_outsidebox,
         CAST(floor(max(l_quantity)) AS INT) AS fouls,
         CAST(floor(min(l_quantity)) AS INT) AS corner_kicks,
         CAST(CAST(floor(sum(l_quantity)) AS BIGINT) % 104 AS INT) AS ball_possession,
         CAST(sum(CASE WHEN l_discount > 0.05 THEN 1 ELSE 0 END) AS INT) AS yellow_cards,
         CAST(sum(CASE WHEN l_tax > 0.07 THEN 1 ELSE 0 END) AS INT) AS red_cards,
         CAST(sum(CASE WHEN l_discount < 0.02 THEN 1 ELSE 0 END) AS INT) AS goalkeeper_saves,
         CAST(floor(sum(l_quantity)) AS INT) * 3 AS total_passes,
         CAST(floor(sum(l_quantity)) AS INT) AS accurate_passes,
         CAST(CAST(floor(sum(l_quantity)) AS BIGINT) % 100 AS FLOAT) AS passes_success_percentage,
         CAST(CAST(count(*) AS DOUBLE) / 4 AS FLOAT) AS expected_goals_rate
  FROM {lineitem}
  GROUP BY l_orderkey, l_linenumber % 2
) AS s
JOIN ("""
    + FIXTURES
    + """) AS f ON s.fixture_id = f.fixture_id
"""
)

TRACKING = """
SELECT o_orderkey AS fixture_id, o_custkey % 26 AS league_id,
       CAST(year(o_orderdate) AS INT) AS season,
       o_orderstatus = 'F' OR o_custkey % 26 = 4 AS is_fetched_stat,
       CASE WHEN o_orderstatus = 'F' OR o_custkey % 26 = 4 THEN o_orderdate END
         AS fetch_stat_time
FROM {orders}
"""

FRAMES = {
    "fixtures": FIXTURES,
    "teams": TEAMS,
    "leagues": LEAGUES,
    "stats": STATS,
    "tracking": TRACKING,
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def frame(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the derived tables, in Spark."""
    text = FRAMES[name]
    inputs = {n: table(spark, sf_dir, n) for n in BASE if "{" + n + "}" in text}
    return spark.sql(text, **inputs)


def frame_sql(name: str) -> str:
    """The same table as SQL over the base table names."""
    return FRAMES[name].format(**{n: n for n in BASE})
