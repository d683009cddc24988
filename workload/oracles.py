"""The registered queries as SQL for DuckDB, over the same tables and derived frames."""

from __future__ import annotations

from workload.frames import AS_OF, frame_sql

ORACLES: dict[str, str] = {}


def _with(body: str, *frames: str) -> str:
    """Prefix ``body`` with the derived frames it names."""
    parts = ", ".join(f"{name} AS ({frame_sql(name)})" for name in frames)
    return f"WITH {parts} {body}" if parts else body


def oracle(name: str, body: str, *frames: str) -> None:
    ORACLES[name] = _with(body, *frames)


# --- dimensions ----------------------------------------------------------------------------

DIM_DATES = """
  SELECT CAST(strftime(day, '%Y%m%d') AS INTEGER) AS date_key, day AS date,
         CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month,
         strftime(day, '%B') AS month_name, CAST(quarter(day) AS INTEGER) AS quarter,
         CAST(weekofyear(day) AS INTEGER) AS week_of_year,
         CAST(dayofmonth(day) AS INTEGER) AS day_of_month,
         CAST(dayofweek(day) + 1 AS INTEGER) AS day_of_week,
         CAST(dayofyear(day) AS INTEGER) AS day_of_year,
         dayofweek(day) IN (0, 6) AS is_weekend,
         strftime(day, '%A') AS day_name, strftime(day, '%a') AS day_name_short,
         strftime(day, '%b') AS month_name_short,
         CASE WHEN month(day) >= 8
              THEN concat(year(day), '-', lpad(CAST((year(day) + 1) % 100 AS VARCHAR), 2, '0'))
              ELSE concat(year(day) - 1, '-', lpad(CAST(year(day) % 100 AS VARCHAR), 2, '0'))
         END AS season,
         CASE WHEN dayofweek(day) IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END
           AS match_day_category
  FROM (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS day
        FROM (SELECT min(date) AS lo, max(date) AS hi FROM fixtures) AS b) AS d
"""
DIM_LEAGUES = """
  SELECT row_number() OVER (ORDER BY league_id) AS league_key, * FROM leagues
"""
DIM_TEAMS = f"""
  SELECT row_number() OVER (ORDER BY team_id) AS team_key, *,
         CAST(year(DATE '{AS_OF}') - founded AS INTEGER) AS team_age,
         CASE WHEN capacity > 100000 THEN 'large' WHEN capacity > 40000 THEN 'medium'
              ELSE 'small' END AS capacity_category
  FROM teams
"""
DIM_FIXTURES = """
  SELECT row_number() OVER (ORDER BY fixture_id) AS fixture_key, *,
         score_fulltime_home || '-' || score_fulltime_away AS score_fulltime,
         score_halftime_home || '-' || score_halftime_away AS score_halftime,
         score_extratime_home || '-' || score_extratime_away AS score_extratime
  FROM fixtures
"""
DIM_STATS = """
  SELECT row_number() OVER (ORDER BY s.fixture_id, s.team_id) AS fixture_stat_key,
         f.league_id, s.*
  FROM stats s LEFT JOIN fixtures f ON s.fixture_id = f.fixture_id
"""
oracle("dim_dates", DIM_DATES, "fixtures")
oracle("checked_write", DIM_DATES, "fixtures")
oracle("dim_leagues", DIM_LEAGUES, "leagues")
oracle("dim_teams", DIM_TEAMS, "teams")
oracle("dim_fixtures", DIM_FIXTURES, "fixtures")
oracle("dim_fixture_stats", DIM_STATS, "stats", "fixtures")

# --- facts -----------------------------------------------------------------------------------

STAR = f"""
  , dim_dates AS ({DIM_DATES}), dim_leagues AS ({DIM_LEAGUES}), dim_teams AS ({DIM_TEAMS}),
  dim_fixtures AS ({DIM_FIXTURES}),
  star AS (
    SELECT f.*, d.date_key, d.season AS season_label, l.league_key, l.name AS league_name,
           h.team_key AS home_key, h.name AS home_name, a.team_key AS away_key,
           a.name AS away_name
    FROM dim_fixtures f
    JOIN dim_teams h ON h.team_id = f.home_team_id
    JOIN dim_teams a ON a.team_id = f.away_team_id
    JOIN dim_leagues l ON l.league_id = f.league_id
    JOIN dim_dates d ON d.date = f.date)
"""
TEAM_RESULT = """
  SELECT round, season_label AS season, fixture_key AS dim_fixture_key, league_name,
         CASE s.side WHEN 0 THEN home_key ELSE away_key END AS dim_team_key,
         CASE s.side WHEN 0 THEN home_name ELSE away_name END AS team_name,
         CASE s.side WHEN 0 THEN goals_home ELSE goals_away END AS goal_scored,
         CASE s.side WHEN 0 THEN goals_away ELSE goals_home END AS goal_conceded,
         fixture_key * 2 + s.side AS key,
         CASE s.side WHEN 0 THEN goals_home > goals_away ELSE goals_away > goals_home END AS win,
         CASE s.side WHEN 0 THEN goals_home < goals_away ELSE goals_away < goals_home END AS lose,
         goals_home = goals_away AS draw
  FROM star, (SELECT unnest([0, 1]) AS side) AS s
"""
STAR_FRAMES = ("fixtures", "teams", "leagues")


def star_oracle(name: str, body: str, extra: str = "", *frames: str) -> None:
    parts = ", ".join(f"{n} AS ({frame_sql(n)})" for n in (*STAR_FRAMES, *frames))
    ORACLES[name] = f"WITH {parts} {STAR} {extra} {body}"


star_oracle(
    "fact_match_result",
    """
  SELECT row_number() OVER (ORDER BY fixture_key) AS match_key,
         fixture_key AS dim_fixture_key, date_key AS dim_date_key,
         home_key AS dim_home_team_key, away_key AS dim_away_team_key,
         league_key AS dim_league_key, league_name, home_name AS home_team_name,
         away_name AS away_team_name, season_label AS season, round, status AS match_status,
         first_period, second_period, elapsed, goals_home, goals_away,
         score_halftime_home, score_halftime_away, score_fulltime_home, score_fulltime_away,
         score_extratime_home, score_extratime_away, score_penalty_home, score_penalty_away,
         goals_home + goals_away AS total_goals, goals_home - goals_away AS goal_diff,
         CASE WHEN goals_home > goals_away THEN 'home_win'
              WHEN goals_home < goals_away THEN 'away_win'
              WHEN goals_home = goals_away THEN 'draw' END AS match_result,
         goals_home = goals_away AS is_draw, goals_home > goals_away AS is_home_win,
         goals_home < goals_away AS is_away_win, league_standings AS is_league_standings
  FROM star
""",
)
star_oracle("fact_team_result", TEAM_RESULT)
star_oracle(
    "team_result_summary",
    """
  SELECT dim_team_key, team_name, season, league_name AS competition,
         count(key) AS match_played, count(*) FILTER (WHERE win) AS total_win,
         count(*) FILTER (WHERE lose) AS total_lose, count(*) FILTER (WHERE draw) AS total_draw,
         CAST(sum(goal_scored) AS BIGINT) AS total_goals_scored,
         CAST(sum(goal_conceded) AS BIGINT) AS total_goals_conceded,
         count(*) FILTER (WHERE win) / count(key) * 100 AS win_percentage
  FROM team_result GROUP BY ALL
""",
    f", team_result AS ({TEAM_RESULT})",
)

MEASURES = (
    "shots_on_goal", "shots_off_goal", "blocked_shots", "shots_insidebox",
    "shots_outsidebox", "fouls", "offsides", "corner_kicks", "ball_possession",
    "yellow_cards", "red_cards", "goalkeeper_saves", "total_passes", "accurate_passes",
    "passes_success_percentage", "expected_goals_rate",
)


def _goals(team: str, alias: str = "f") -> str:
    """Goal measures of one team on a fixture row."""
    parts = {
        "": ("goals_{0}",),
        "_first_half": ("score_halftime_{0}",),
        "_second_half": ("score_fulltime_{0}", "score_halftime_{0}"),
        "_extratime": ("score_extratime_{0}",),
        "_penalty": ("score_penalty_{0}",),
    }
    lines = []
    for suffix, columns in parts.items():
        for role, (when_home, when_away) in {
            "scored": ("home", "away"), "conceded": ("away", "home"),
        }.items():
            own, other = (
                " - ".join(f"{alias}.{c.format(side)}" for c in columns)
                for side in (when_home, when_away)
            )
            lines.append(
                f"CASE WHEN {team} = {alias}.home_team_id THEN {own} "
                f"WHEN {team} = {alias}.away_team_id THEN {other} END AS goals_{role}{suffix}"
            )
    return ", ".join(lines)


STAT_STAR = f"""
  , dim_stats AS ({DIM_STATS}),
  stat_star AS (
    SELECT s.fixture_stat_key AS dim_fixture_stat_key, t.team_key AS dim_team_key,
           f.fixture_key AS dim_fixture_key, CAST(d.date_key AS BIGINT) AS dim_date_key,
           l.league_key AS dim_league_key, l.name AS league_name,
           f.fixture_id, t.team_id, t.name AS team_name, d.season, f.round,
           f.league_standings AS is_league_standings, f.status AS match_status,
           f.first_period, f.second_period, f.elapsed,
           {", ".join("s." + m for m in MEASURES)}, {_goals("t.team_id")}
    FROM dim_stats s
    LEFT JOIN dim_teams t ON t.team_id = s.team_id
    LEFT JOIN dim_fixtures f ON f.fixture_id = s.fixture_id
    LEFT JOIN dim_dates d ON d.date = f.date
    LEFT JOIN dim_leagues l ON l.league_id = s.league_id)
"""
star_oracle(
    "fact_match_stats",
    """
  SELECT row_number() OVER (ORDER BY dim_fixture_stat_key) AS match_statistic_key, *,
         CASE WHEN goals_scored > goals_conceded THEN 'win'
              WHEN goals_scored < goals_conceded THEN 'loss'
              WHEN goals_scored = goals_conceded THEN 'draw' END AS match_result
  FROM stat_star
""",
    STAT_STAR,
    "stats",
)

_SUMS = {
    "total_goals_scored": "goals_scored", "total_goals_conceded": "goals_conceded",
    "total_goals_firsthalf": "goals_scored_first_half",
    "total_goals_secondhalf": "goals_scored_second_half",
    **{
        f"total_{m}": m
        for m in MEASURES
        if m not in ("ball_possession", "passes_success_percentage", "expected_goals_rate",
                     "total_passes")
    },
    "total_passes": "total_passes",
}
_AVERAGES = {
    "avg_pass_success_percentage": "passes_success_percentage",
    **{
        f"avg_{m}": m
        for m in ("goals_scored", "goals_conceded", "shots_on_goal", "shots_insidebox",
                  "shots_outsidebox", "fouls", "corner_kicks", "yellow_cards", "red_cards",
                  "ball_possession", "expected_goals_rate")
    },
}
_SHARES = {
    "score_firsthalf_percentage": "goals_scored_first_half",
    "score_secondhalf_percentage": "goals_scored_second_half",
    "conceded_firsthalf_percentage": "goals_conceded_first_half",
    "conceded_secondhalf_percentage": "goals_conceded_second_half",
}
star_oracle(
    "team_match_stats",
    f"""
  SELECT row_number() OVER (
           ORDER BY team_name NULLS FIRST, season NULLS FIRST, dim_team_key NULLS FIRST
         ) AS fact_key, *
  FROM (
    SELECT dim_team_key, team_name, season, count(dim_fixture_stat_key) AS match_played,
           {", ".join(f"CAST(sum({c}) AS BIGINT) AS {n}" for n, c in _SUMS.items())},
           {", ".join(f"avg({c}) AS {n}" for n, c in _AVERAGES.items())},
           {", ".join(
               f"count(*) FILTER (WHERE {c} > 0) / count(dim_fixture_stat_key) AS {n}"
               for n, c in _SHARES.items())}
    FROM stat_star GROUP BY dim_team_key, team_name, season) AS summed
""",
    STAT_STAR,
    "stats",
)

_GOAL_NAMES = [
    f"goals_{role}{part}"
    for part in ("", "_first_half", "_second_half", "_extratime", "_penalty")
    for role in ("scored", "conceded")
]
SIDES = f"""
  sides AS (
    SELECT f.fixture_id, f.home_team_id AS team_id, {_goals("f.home_team_id")} FROM fixtures f
    UNION ALL
    SELECT f.fixture_id, f.away_team_id, {_goals("f.away_team_id")} FROM fixtures f)
"""
ORACLES["goals_by_team_fixture"] = (
    f"WITH fixtures AS ({frame_sql('fixtures')}), {SIDES} SELECT fixture_id, team_id, "
    + ", ".join(
        f"coalesce({g}, 0) AS total_{g.replace('extratime', 'extra_time')}" for g in _GOAL_NAMES
    )
    + " FROM sides"
)
ORACLES["wdl_crosscheck"] = f"""
  WITH fixtures AS ({frame_sql('fixtures')}), {SIDES}, views AS (
    SELECT home_team_id AS team_id, 'home' AS seen_from, goals_home AS own, goals_away AS other
    FROM fixtures
    UNION ALL SELECT away_team_id, 'away', goals_away, goals_home FROM fixtures
    UNION ALL SELECT team_id, 'team', goals_scored, goals_conceded FROM sides)
  SELECT team_id, seen_from, count(*) FILTER (WHERE own > other) AS win_count,
         count(*) FILTER (WHERE own = other) AS draw_count,
         count(*) FILTER (WHERE own < other) AS lose_count
  FROM views GROUP BY team_id, seen_from
"""

# --- scalar functions ---------------------------------------------------------------------------

oracle(
    "match_labels",
    """
  SELECT fixture_id,
         CASE WHEN month(date) >= 8
              THEN concat(year(date), '-', lpad(CAST((year(date) + 1) % 100 AS VARCHAR), 2, '0'))
              ELSE concat(year(date) - 1, '-', lpad(CAST(year(date) % 100 AS VARCHAR), 2, '0'))
         END AS season_label,
         CAST(strftime(date, '%Y%m%d') AS INTEGER) AS date_key,
         goals_home || '-' || goals_away AS score,
         CASE WHEN goals_home > goals_away THEN 'home_win'
              WHEN goals_home < goals_away THEN 'away_win'
              WHEN goals_home = goals_away THEN 'draw' END AS match_result,
         CASE WHEN goals_away > goals_home THEN 'win' WHEN goals_away < goals_home THEN 'loss'
              WHEN goals_home = goals_away THEN 'draw' END AS away_result,
         goals_home + goals_away AS total_goals, goals_home - goals_away AS goal_diff,
         score_fulltime_home - score_halftime_home AS home_second_half,
         coalesce(score_extratime_home, score_fulltime_home) AS home_last_score,
         goals_home > goals_away AS is_home_win, goals_home < goals_away AS is_away_win,
         goals_home = goals_away AS is_draw
  FROM fixtures
""",
    "fixtures",
)
oracle(
    "venue_sizes",
    f"""
  SELECT team_id,
         CASE WHEN capacity > 100000 THEN 'large' WHEN capacity > 40000 THEN 'medium'
              ELSE 'small' END AS capacity_category,
         CAST(year(DATE '{AS_OF}') - founded AS INTEGER) AS team_age
  FROM teams
""",
    "teams",
)
ORACLES["parsed_texts"] = """
  SELECT o_orderkey, CAST(o_custkey % 101 AS INTEGER) AS share_int,
         CAST(o_custkey % 101 AS FLOAT) AS share_float,
         CASE WHEN o_orderstatus <> 'P' THEN CAST(o_custkey % 9 AS INTEGER) END AS figure_int,
         CAST(o_orderdate AS DATE) AS day, o_orderkey * 60 AS seconds_back
  FROM orders
"""
oracle(
    "filled_statistics",
    """
  SELECT fixture_id, team_id, coalesce(offsides, 0) AS offsides, fouls, true AS is_fetched,
         CAST(NULL AS VARCHAR) AS fetched_at
  FROM stats
""",
    "stats",
)
oracle(
    "complete_leagues",
    """
  SELECT team_id, founded, capacity FROM teams
  WHERE team_id IS NOT NULL AND founded IS NOT NULL AND capacity IS NOT NULL
""",
    "teams",
)

# --- keys, nested data, pivot ---------------------------------------------------------------------

ORACLES["surrogate_keys"] = """
  SELECT c_custkey, c_name, c_mktsegment,
         row_number() OVER (ORDER BY c_mktsegment, c_custkey) AS customer_key
  FROM customer
"""
ORACLES["spread_keys"] = """
  SELECT o_orderstatus, count(*) AS keys, count(*) AS distinct_keys
  FROM orders GROUP BY 1
"""
ORACLES["json_props"] = """
  SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_type FROM events
"""
ORACLES["flatten_orders"] = """
  WITH numbers AS (SELECT CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS no)
  SELECT o_orderkey AS order_id, o_custkey AS order_head_o_custkey,
         o_orderstatus AS order_head_o_orderstatus, no AS order_parts_no,
         no * o_orderkey AS order_parts_code
  FROM orders LEFT JOIN numbers
    ON no < CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AND o_orderstatus <> 'P'
"""
ORACLES["pivot_events"] = "SELECT user_id, CAST(ts AS DATE) AS day, " + (
    ", ".join(
        f"CAST(max(CASE WHEN event_type = '{k}' THEN value END) AS FLOAT) AS {k}"
        for k in ("click", "view", "purchase", "error", "signup")
    )
    + " FROM events GROUP BY 1, 2"
)
ORACLES["rejected_texts"] = """
  SELECT event_type AS measure, count(*) FILTER (WHERE value < 10) AS rejected
  FROM events GROUP BY 1
"""

# --- raw payloads -----------------------------------------------------------------------------------

oracle("raw_fixture_to_silver", "SELECT * FROM fixtures", "fixtures")
oracle("raw_team_to_silver", "SELECT * FROM teams WHERE country <> 'NATION_3'", "teams")
oracle("raw_league_to_silver", "SELECT * FROM leagues", "leagues")
oracle(
    "league_seasons",
    """
  SELECT league_id AS record_id, league_id, country AS country_name, 2023 AS season_year,
         true AS season_current
  FROM leagues, (SELECT unnest([1, 2]) AS copy) AS copies
""",
    "leagues",
)
_STATS_BACK = "SELECT * REPLACE (coalesce(offsides, 0) AS offsides) FROM stats"
for _name in ("raw_stats_to_silver", "raw_stats_in_place", "pivot_stream"):
    oracle(_name, _STATS_BACK, "stats")

# --- history ------------------------------------------------------------------------------------------

def _scd2(user: str = "user_id", ts: str = "ts") -> str:
    return f"""
  SELECT user_id, ts, event_type, ts AS "__START_AT",
         lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS "__END_AT"
  FROM (
    SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts) AS before,
           row_number() OVER (PARTITION BY user_id ORDER BY ts) AS place
    FROM (SELECT user_id, ts, max(event_type) AS event_type
          FROM (SELECT {user} AS user_id, {ts} AS ts, event_type FROM events) AS renamed
          GROUP BY 1, 2) AS reduced
  ) AS changes
  WHERE place = 1 OR event_type IS DISTINCT FROM before
"""


SCD2_EVENTS = _scd2()
for _name in ("scd2_events", "scd2_stream"):
    ORACLES[_name] = SCD2_EVENTS
ORACLES["scd2_hot_keys"] = _scd2("CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END")
ORACLES["scd2_text_sequence"] = _scd2(ts="strftime(ts, '%Y-%m-%d %H:%M:%S.%f')")
ORACLES["scd2_big_sequence"] = _scd2(ts="event_id + 1152921504606846976")
ORACLES["scd2_null_key"] = _scd2("CASE WHEN user_id % 5 <> 0 THEN user_id END")
SCD2_DELETES = """
  WITH reduced AS (
    SELECT user_id, ts, max(event_type) AS event_type FROM events GROUP BY 1, 2),
  states AS (
    SELECT *, CASE WHEN event_type <> 'purchase' THEN event_type END AS state FROM reduced),
  turns AS (
    SELECT *, lag(state) OVER (PARTITION BY user_id ORDER BY ts) AS before FROM states),
  kept AS (
    SELECT *, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS until
    FROM turns WHERE state IS DISTINCT FROM before)
  SELECT user_id, ts, event_type, ts AS "__START_AT", until AS "__END_AT"
  FROM kept WHERE state IS NOT NULL
"""
for _name in ("scd2_deletes", "scd2_stream_late"):
    ORACLES[_name] = SCD2_DELETES
ORACLES["silver_stream_counts"] = """
  WITH flags AS (
    SELECT coalesce(event_type = 'purchase', false) AS a, coalesce(value >= 50, false) AS b FROM events),
  totals AS (
    SELECT count(*) AS seen, count(*) FILTER (a AND b) AS kept,
           count(*) FILTER (NOT a) AS no_a, count(*) FILTER (NOT b) AS no_b FROM flags)
  SELECT 'is_purchase' AS rule, seen, kept, no_a AS dropped, kept AS written FROM totals
  UNION ALL
  SELECT 'is_large', seen, kept, no_b, kept FROM totals
"""
ORACLES["sql_stream_rows"] = """
  SELECT event_id, user_id, round(value, 2) AS amount, event_type AS kind,
         true AS named, true AS filled
  FROM events WHERE value IS NOT NULL
"""
ORACLES["current_versions"] = f'SELECT * FROM ({SCD2_EVENTS}) AS v WHERE "__END_AT" IS NULL'
ORACLES["scd2_snapshot"] = """
  WITH states AS (
    SELECT c_custkey, 1 AS day, c_mktsegment, c_mktsegment <> 'BUILDING' AS present
    FROM customer
    UNION ALL
    SELECT c_custkey, 2, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN 'HOME' ELSE c_mktsegment END,
           c_mktsegment <> 'MACHINERY' FROM customer
    UNION ALL
    SELECT c_custkey, 3, c_mktsegment, true FROM customer),
  steps AS (
    SELECT *, lag(CASE WHEN present THEN c_mktsegment END)
                OVER (PARTITION BY c_custkey ORDER BY day) AS before
    FROM states),
  moves AS (
    SELECT *, lead(day) OVER (PARTITION BY c_custkey ORDER BY day) AS until
    FROM steps
    WHERE CASE WHEN present THEN c_mktsegment END IS DISTINCT FROM before)
  SELECT c_custkey, c_mktsegment,
         TIMESTAMP '2024-07-31 00:00:00' + day * INTERVAL 1 DAY AS "__START_AT",
         TIMESTAMP '2024-07-31 00:00:00' + until * INTERVAL 1 DAY AS "__END_AT"
  FROM moves WHERE present
"""

# --- streams, landing files, sinks ------------------------------------------------------------------------

ORACLES["bronze_stream"] = """
  SELECT event_id AS event_id, user_id AS event_user_id, event_type AS event_kind,
         value AS items_amount
  FROM events
"""
ORACLES["silver_stream"] = """
  SELECT event_id AS id, CAST(value AS FLOAT) AS amount, event_type AS kind
  FROM events WHERE event_type = 'purchase'
"""
ORACLES["stream_file_names"] = """
  SELECT count(*) AS row_count, count(*) AS named, CAST(0 AS BIGINT) AS without_time FROM events
"""
oracle(
    "landing_manifest",
    "SELECT league_id, season AS year, count(*) AS row_counts FROM tracking GROUP BY 1, 2",
    "tracking",
)
ORACLES["record_manifest"] = "SELECT count(*) AS records, true AS sizes_agree FROM orders"
oracle(
    "json_by_group",
    "SELECT fixture_id, league_id, season, is_fetched_stat FROM tracking",
    "tracking",
)

# --- progress -----------------------------------------------------------------------------------------------

PROGRESS = """
  SELECT league_id, season AS year, CAST(count(*) AS INTEGER) AS total_fixtures,
         CAST(count(*) FILTER (WHERE is_fetched_stat) AS INTEGER) AS fetched_count,
         CAST(round(count(*) FILTER (WHERE is_fetched_stat) / count(*) * 100, 2) AS FLOAT)
           AS fetched_percentage,
         count(*) FILTER (WHERE is_fetched_stat) >= count(*) AS is_complete,
         TIMESTAMP '2024-08-01 06:00:00' AS last_updated
  FROM {source} GROUP BY league_id, season
"""
WITH_PROGRESS = f"SELECT * FROM ({PROGRESS.format(source='tracking')}) AS progress"
LANDED = """
  , landed AS (
    SELECT fixture_id AS o_orderkey, league_id, season AS year,
           'orders_' || league_id || '_' || (fixture_id // 500) || '.json' AS file FROM tracking)
"""
oracle("multi_line_rows", f"{LANDED} SELECT o_orderkey, league_id, year, file AS source_file FROM landed", "tracking")
oracle(
    "landing_manifest_files",
    f"""
  {LANDED} SELECT league_id, year, file AS file_name, count(*) AS row_counts,
         TIMESTAMP '2024-08-01 06:00:00' AS ingestion_timestamp
  FROM landed GROUP BY league_id, year, file
""",
    "tracking",
)
oracle(
    "record_manifest_rows",
    f"""
  {LANDED} SELECT o_orderkey, league_id, file AS batch_file_name,
         TIMESTAMP '2024-08-01 06:00:00' AS ingestion_timestamp,
         count(*) OVER (PARTITION BY file) AS batch_row_count
  FROM landed
""",
    "tracking",
)
oracle(
    "planned_fixtures",
    """
  SELECT p.league_id, p.year, f.fixture_id
  FROM (SELECT CAST(unnest([3, 4, 99]) AS BIGINT) AS league_id,
               CAST(unnest([1995, 1996, 1996]) AS INTEGER) AS year) AS p
  LEFT JOIN fixtures AS f ON f.league_id = p.league_id AND f.season = p.year
""",
    "fixtures",
)
oracle(
    "catalog_table",
    "SELECT league_id, name, country, 'silver' AS quality, 'League''s names' AS comment FROM leagues",
    "leagues",
)
ORACLES["upsert_few"] = """
  WITH updates AS (
    SELECT CASE WHEN n_nationkey % 2 = 0 THEN n_nationkey ELSE -n_nationkey END AS k FROM nation)
  SELECT o_orderkey, o_custkey, CASE WHEN k IS NULL THEN o_orderstatus ELSE 'N' END AS o_orderstatus
  FROM orders LEFT JOIN updates ON o_orderkey = k
  UNION ALL
  SELECT k, NULL, 'N' FROM updates WHERE k NOT IN (SELECT o_orderkey FROM orders)
"""
oracle("league_progress", WITH_PROGRESS, "tracking")
oracle(
    "versioned_json",
    f"""
  SELECT league_id, year, total_fixtures, fetched_count, is_complete
  FROM ({PROGRESS.format(source="tracking")}) AS progress
""",
    "tracking",
)
oracle(
    "initial_tracking",
    PROGRESS.format(source="(SELECT *, false AS is_fetched_stat FROM fixtures) AS fresh"),
    "fixtures",
)
ORACLES["upsert_coalesce"] = """
  WITH updates AS (
    SELECT CASE WHEN o_orderstatus = 'F' THEN o_orderkey ELSE -o_orderkey - 1 END AS k,
           CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey + 1000 END AS c, 'U' AS s
    FROM orders WHERE o_orderstatus <> 'P')
  SELECT coalesce(k, o_orderkey) AS o_orderkey, coalesce(c, o_custkey) AS o_custkey,
         coalesce(s, o_orderstatus) AS o_orderstatus
  FROM orders FULL JOIN updates ON k = o_orderkey
"""
MARKED = """
  SELECT fixture_id, league_id, season,
         CASE WHEN {hit} THEN true ELSE is_fetched_stat END AS is_fetched_stat,
         CASE WHEN {hit} THEN TIMESTAMP '2024-08-01 06:00:00' ELSE fetch_stat_time END
           AS fetch_stat_time
  FROM tracking
"""
oracle("mark_fetched", MARKED.format(hit="season < 1997"), "tracking")
oracle(
    "refresh_progress",
    f"""
  SELECT * FROM ({PROGRESS.format(source="tracking")}) AS p WHERE league_id >= 5
  UNION ALL
  SELECT * REPLACE (TIMESTAMP '2024-08-02 00:00:00' AS last_updated)
  FROM ({PROGRESS.format(source="(" + MARKED.format(hit="league_id < 5") + ") AS m")}) AS q
  WHERE league_id < 5
""",
    "tracking",
)
oracle(
    "progress_summary",
    f"""
  SELECT count(*) AS total_leagues, CAST(sum(total_fixtures) AS BIGINT) AS total_fixtures,
         CAST(sum(fetched_count) AS BIGINT) AS total_fetched,
         count(*) FILTER (WHERE NOT is_complete) AS incomplete_leagues,
         round(sum(fetched_count) / sum(total_fixtures) * 100, 2) AS overall_completion
  FROM ({PROGRESS.format(source="tracking")}) AS p
""",
    "tracking",
)
oracle(
    "incomplete_leagues",
    f"SELECT league_id, year FROM ({PROGRESS.format(source='tracking')}) AS p WHERE NOT is_complete",
    "tracking",
)
oracle(
    "next_batch",
    f"""
  SELECT t.*
  FROM tracking t JOIN ({PROGRESS.format(source="tracking")}) AS p
    ON t.league_id = p.league_id AND t.season = p.year
  WHERE NOT is_fetched_stat
  ORDER BY is_complete, t.league_id, t.season, t.fixture_id LIMIT 500
""",
    "tracking",
)
oracle(
    "league_lookup",
    "SELECT * FROM tracking WHERE league_id = 7 AND NOT is_fetched_stat",
    "tracking",
)
oracle("fixture_status", "SELECT * FROM tracking WHERE fixture_id = 11", "tracking")
oracle(
    "reset_tracking",
    """
  SELECT * REPLACE (
    CASE WHEN league_id = 3 THEN false ELSE is_fetched_stat END AS is_fetched_stat,
    CASE WHEN league_id <> 3 THEN fetch_stat_time END AS fetch_stat_time)
  FROM tracking WHERE season <> 1996
""",
    "tracking",
)
for _name, _not in (("reconcile", ""), ("untracked", "NOT")):
    oracle(
        _name,
        f"""
  SELECT fixture_id, team_id FROM stats
  WHERE fixture_id {_not} IN (SELECT fixture_id FROM tracking WHERE is_fetched_stat)
""",
        "stats",
        "tracking",
    )
oracle(
    "add_leagues",
    f"""
  , progress AS ({PROGRESS.format(source="tracking")}),
  wanted AS (SELECT league_id, unnest([1994, 1995]) AS year FROM leagues)
  SELECT * FROM progress
  UNION ALL
  SELECT w.league_id, w.year, 0, 0, 0.0, false, TIMESTAMP '2024-08-01 06:00:00'
  FROM wanted w
  WHERE NOT EXISTS (
    SELECT 1 FROM progress p WHERE p.league_id = w.league_id AND p.year = w.year)
""",
    "tracking",
    "leagues",
)
oracle(
    "league_season_grid",
    """
  SELECT league_id, CAST(unnest(range(1995, 2002)) AS INTEGER) AS year
  FROM (SELECT DISTINCT league_id FROM fixtures) AS l
""",
    "fixtures",
)

# --- data quality ------------------------------------------------------------------------------------------------


def _report(source: str, rules: list[tuple[str, str, str, str]]) -> str:
    """(kind, column, condition, message with {n}) rules as a union of counts."""
    lines = []
    for kind, column, condition, message in rules:
        text = message.replace("'", "''")
        lines.append(
            f"SELECT '{kind}' AS kind, '{column}' AS \"column\", "
            f"replace('{text}', '{{n}}', CAST(n AS VARCHAR)) AS message, n AS violations "
            f"FROM (SELECT count(*) FILTER (WHERE {condition}) AS n FROM {source}) AS c"
        )
    return " UNION ALL ".join(lines)


_TABLE = "silver_fixture_stats"
_POSITIVE = [m for m in MEASURES if m not in ("offsides", "expected_goals_rate")]
_ATTEMPTS = "shots_on_goal,shots_off_goal,blocked_shots,shots_insidebox,shots_outsidebox"
_RULES = [
    *[
        ("not_null", c, f"{c} IS NULL", f"{{n}} nulls in {c}")
        for c in ("fixture_id", "team_id")
    ],
    ("not_null", "ingestion_time", "false", "{n} nulls in ingestion_time"),
    *[
        ("non_negative", c, f"{c} < 0", f"{_TABLE}.{c}: {{n}} below zero")
        for c in (*_POSITIVE, "expected_goals_rate")
    ],
    (
        "balance",
        _ATTEMPTS,
        "shots_on_goal + shots_off_goal + blocked_shots <> shots_insidebox + shots_outsidebox",
        "{n} rows count attempts unlike by result and by place",
    ),
    *[
        (
            "range",
            c,
            f"{c} < 0 OR {c} > {top}",
            f"{_TABLE}.{c}: {{n}} beyond 0 to {top}",
        )
        for c, top in (
            ("ball_possession", 100),
            ("passes_success_percentage", 100),
            ("expected_goals_rate", 1),
        )
    ],
]
oracle("dq_report", _report("stats", _RULES), "stats")
ORACLES["document_report"] = _report(
    "documents",
    [
        *[
            ("not_null", c, f"{c} IS NULL", f"{{n}} nulls in {c}")
            for c in ("doc_id", "text", "lang", "source", "n_chars")
        ],
        (
            "range",
            "n_chars",
            "n_chars < 1 OR n_chars > 5000",
            "documents.n_chars: {n} beyond 1 to 5000",
        ),
    ],
)
ORACLES["schema_report"] = """
  SELECT issue, row_count
  FROM (SELECT count(*) AS row_count FROM customer) AS c,
       (SELECT unnest([
          'silver_teams lacks columns: ingestion_time',
          'silver_teams has undeclared columns: extra',
          'silver_teams.founded is bigint, declared int']) AS issue) AS i
"""
oracle(
    "expect_or_drop",
    """
  SELECT fixture_id, league_id, goals_home FROM fixtures
  WHERE goals_home IS NOT NULL AND league_id < 25
""",
    "fixtures",
)
ORACLES["empty_payloads"] = """
  SELECT o_orderkey AS id FROM orders
  WHERE o_orderpriority LIKE '1%' AND o_orderstatus <> 'P'
"""

# --- added with the second round ---------------------------------------------------------------

oracle(
    "reset_and_refresh",
    """
  SELECT league_id, season AS year,
         CAST(count(*) FILTER (WHERE season <> 1996) AS INTEGER) AS total_fixtures,
         CAST(count(*) FILTER (WHERE season <> 1996 AND is_fetched_stat) AS INTEGER) AS fetched_count,
         CAST(round(count(*) FILTER (WHERE season <> 1996 AND is_fetched_stat) / count(*) * 100, 2)
              AS FLOAT) AS fetched_percentage,
         season <> 1996 AND count(*) FILTER (WHERE is_fetched_stat) >= count(*) AS is_complete,
         TIMESTAMP '2024-08-02 00:00:00' AS last_updated
  FROM tracking GROUP BY league_id, season
""",
    "tracking",
)
oracle(
    "tracking_loop",
    """
  SELECT league_id, season AS year,
         CAST(CASE WHEN season = 1996 THEN 0 ELSE count(*) END AS INTEGER) AS total_fixtures,
         CAST(CASE WHEN season <> 1996 AND league_id = 3 THEN count(*) ELSE 0 END AS INTEGER)
           AS fetched_count,
         CAST(CASE WHEN season <> 1996 AND league_id = 3 THEN 100 ELSE 0 END AS FLOAT)
           AS fetched_percentage,
         season <> 1996 AND league_id = 3 AS is_complete,
         CASE WHEN bool_or(season = 1996) OVER (PARTITION BY league_id)
                THEN TIMESTAMP '2024-08-03 00:00:00'
              WHEN league_id = 3 THEN TIMESTAMP '2024-08-02 00:00:00'
              ELSE TIMESTAMP '2024-08-01 06:00:00' END AS last_updated
  FROM fixtures GROUP BY league_id, season
""",
    "fixtures",
)
ORACLES["upsert_repeated_keys"] = """
  SELECT coalesce(c_custkey, o_custkey) AS c_custkey,
         coalesce(priority, c_mktsegment) AS c_mktsegment, c_acctbal
  FROM customer
  FULL JOIN (SELECT o_custkey, max(o_orderpriority) AS priority FROM orders GROUP BY 1) AS u
    ON c_custkey = o_custkey
"""
oracle(
    "preview",
    "SELECT fixture_id, league_id, season FROM fixtures ORDER BY fixture_id LIMIT 10",
    "fixtures",
)
ORACLES["flatten_deep"] = "SELECT o_orderkey, o_totalprice FROM orders"
oracle(
    "team_history_batches",
    """
  SELECT team_id, name, country, since AS "__START_AT",
         lead(since) OVER (PARTITION BY team_id ORDER BY since) AS "__END_AT"
  FROM (
    SELECT *, lag(name) OVER (PARTITION BY team_id ORDER BY since) AS before
    FROM (
      SELECT team_id, name, country, TIMESTAMP '2024-08-01' AS since FROM teams
      WHERE team_id % 2 = 0
      UNION ALL
      SELECT team_id, CASE WHEN team_id % 4 = 0 THEN name || ' II' ELSE name END, country,
             TIMESTAMP '2024-08-02' FROM teams WHERE team_id % 3 = 0
      UNION ALL
      SELECT team_id, name, country, TIMESTAMP '2024-08-03' FROM teams) AS landed) AS steps
  WHERE before IS DISTINCT FROM name
""",
    "teams",
)
