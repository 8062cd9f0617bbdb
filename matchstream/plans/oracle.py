"""Reference SQL (DuckDB dialect) for every registered query.

Each statement starts from the same ``match_events`` CTE as the adapter and
states the metric in plain SQL: tumbling windows with ``time_bucket`` (widths
that divide a day, so the bucket origin agrees with the epoch), sliding
windows as pane buckets fanned out over ``range(n)``.  Sums are cast to
BIGINT (DuckDB widens to HUGEINT).
"""

from __future__ import annotations

from matchstream.plans.catalog import HALF_TIME_RANGE
from matchstream.sources.testdata import ORACLE_PRELUDE


def fouls_cte(width: str) -> str:
    return f""",
fouls AS (
SELECT team, count(*) AS fouls,
       time_bucket(INTERVAL '{width}', event_timestamp) AS window_start,
       time_bucket(INTERVAL '{width}', event_timestamp) + INTERVAL '{width}' AS window_end
FROM match_events WHERE event_type = 'foul' AND event_timestamp IS NOT NULL
GROUP BY team, time_bucket(INTERVAL '{width}', event_timestamp))"""


def cards_cte(duration: str, slide: str, n: int) -> str:
    return f""",
cards AS (
SELECT team, player, count(*) AS yellow_cards, window_start,
       window_start + INTERVAL '{duration}' AS window_end,
       count(*) >= 2 AS player_alert
FROM (SELECT team, player,
             time_bucket(INTERVAL '{slide}', event_timestamp) - i * INTERVAL '{slide}' AS window_start
      FROM match_events CROSS JOIN range({n}) r(i)
      WHERE event_type = 'yellow_card' AND event_timestamp IS NOT NULL) x
GROUP BY team, player, window_start)"""


MOMENTUM_SELECT = """
SELECT team, player, yellow_cards, window_start, window_end, player_alert,
       SUM(yellow_cards) OVER (PARTITION BY team, window_start, window_end) > 3 AS team_momentum_lost
FROM cards"""

CARDS_SELECT = """
SELECT team, player, yellow_cards, window_start, window_end, player_alert FROM cards"""


def players_cte(where: str) -> str:
    return f""",
players AS (
SELECT team, player,
       CAST(SUM(shots_taken) AS BIGINT) AS total_shots_taken,
       CAST(SUM(goals_scored) AS BIGINT) AS total_goals_scored,
       CAST(SUM(CASE WHEN event_type = 'assist' THEN 1 ELSE 0 END) AS BIGINT) AS total_assists,
       CASE WHEN SUM(shots_taken) > 0
            THEN CAST(SUM(goals_scored) AS DOUBLE) / CAST(SUM(shots_taken) AS DOUBLE) * 100
            ELSE CAST(0 AS DOUBLE) END AS scoring_percentage
FROM match_events {where}
GROUP BY team, player)"""


PERFORMANCE_WHERE = "WHERE event_type IN ('goal', 'assist', 'shot')"


def scoreboard_sql(key: str, counts: bool) -> str:
    extra = ", CAST(SUM(n) AS BIGINT) AS goal_events" if counts else ""
    return f""",
firsts AS (
SELECT team, goals_scored FROM (
  SELECT team, goals_scored,
         row_number() OVER (PARTITION BY {key} ORDER BY event_id) AS rn
  FROM match_events WHERE event_type = 'goal') g
WHERE rn = 1)
SELECT team, CAST(SUM(goals) AS BIGINT) AS goals{extra}
FROM (SELECT team, COALESCE(goals_scored, 0) AS goals, 1 AS n FROM firsts
      UNION ALL SELECT 'FC Python', 0, 0 UNION ALL SELECT 'AI United', 0, 0) s
GROUP BY team"""


_TOPICS = """
SELECT unnest(CASE
         WHEN event_type = 'goal' THEN ['live_score', 'player_performance']
         WHEN event_type IN ('assist', 'shot') THEN ['player_performance']
         WHEN event_type = 'foul' THEN ['team_stats_1min']
         WHEN event_type = 'yellow_card' THEN ['live_card']
         ELSE ['unrouted'] END) AS topic,
       event_id,
       CAST(json_object('timestamp', strftime(event_timestamp, '%Y-%m-%dT%H:%M:%S.%f'),
                        'event_type', event_type, 'team', team, 'player', player,
                        'shots_taken', shots_taken, 'goals_scored', goals_scored) AS VARCHAR) AS value
FROM match_events"""

_ALL_EVENTS = """
SELECT event_id, event_timestamp, event_type, team, player, shots_taken, goals_scored
FROM match_events"""

_FAMILY = """,
fam AS (
SELECT CASE WHEN event_type = 'yellow_card' THEN 'yellow_card'
            WHEN event_type IN ('goal', 'assist', 'shot') THEN 'player_performance'
            WHEN event_type = 'foul' THEN 'foul' END AS family
FROM match_events)
SELECT CASE WHEN GROUPING(family) = 1 THEN 'total' ELSE family END AS family,
       count(*) AS events
FROM fam WHERE family IS NOT NULL
GROUP BY ROLLUP (family)"""

_CARD_ROLLUP = """
SELECT team, player, count(*) AS yellow_cards,
       CASE WHEN GROUPING(team) = 1 THEN 'all'
            WHEN GROUPING(player) = 1 THEN 'team'
            ELSE 'player' END AS level
FROM match_events WHERE event_type = 'yellow_card'
GROUP BY ROLLUP (team, player)"""


def batch_oracles() -> dict[str, str]:
    lo, hi = HALF_TIME_RANGE
    p = ORACLE_PRELUDE
    return {
        "fouls_tumbling_1m": p + fouls_cte("1 minute") + "\nSELECT * FROM fouls",
        "fouls_tumbling_10m": p + fouls_cte("10 minutes") + "\nSELECT * FROM fouls",
        "fouls_by_team": p
        + "\nSELECT team, count(*) AS fouls FROM match_events WHERE event_type = 'foul' GROUP BY team",
        "yellow_cards_5m": p + cards_cte("5 minutes", "1 minute", 5) + CARDS_SELECT,
        "yellow_cards_60m": p + cards_cte("60 minutes", "10 minutes", 6) + CARDS_SELECT,
        "yellow_momentum_5m": p + cards_cte("5 minutes", "1 minute", 5) + MOMENTUM_SELECT,
        "yellow_momentum_60m": p + cards_cte("60 minutes", "10 minutes", 6) + MOMENTUM_SELECT,
        "yellow_momentum_join": p + cards_cte("60 minutes", "10 minutes", 6) + MOMENTUM_SELECT,
        "yellow_cards_by_team_player": p + _CARD_ROLLUP,
        "player_stats_all": p + players_cte("") + "\nSELECT * FROM players",
        "player_stats_performance": p + players_cte(PERFORMANCE_WHERE) + "\nSELECT * FROM players",
        "player_stats_half_time": p
        + players_cte(
            PERFORMANCE_WHERE
            + f" AND event_timestamp >= TIMESTAMP '{lo}' AND event_timestamp < TIMESTAMP '{hi}'"
        )
        + "\nSELECT * FROM players",
        "player_leaderboard": p
        + players_cte("")
        + "\nSELECT * FROM players ORDER BY total_goals_scored DESC, scoring_percentage DESC,"
        " total_assists DESC, team, player",
        "scoreboard": p + scoreboard_sql("event_timestamp", False),
        "scoreboard_collisions": p + scoreboard_sql("date_trunc('hour', event_timestamp)", True),
        "route_topics": p + _TOPICS,
        "parse_events": p + _ALL_EVENTS,
        "load_match_events": p + _ALL_EVENTS,
        "family_counts": p + _FAMILY,
        "serve_fouls_latest": p
        + fouls_cte("1 minute")
        + "\nSELECT team, fouls, window_start, window_end FROM fouls"
        " ORDER BY window_end DESC, team LIMIT 10",
        "serve_yellow_latest": p
        + cards_cte("5 minutes", "1 minute", 5)
        + "\nSELECT team, player, yellow_cards, window_start, window_end,"
        " CASE WHEN player_alert THEN '🚨 OUT' ELSE '' END AS player_alert"
        " FROM cards ORDER BY window_end DESC, team, player LIMIT 20",
        "serve_player_top20": p
        + players_cte(PERFORMANCE_WHERE)
        + "\nSELECT team, player, total_goals_scored AS goals, total_assists AS assists,"
        " total_shots_taken AS shots_taken, printf('%.2f%%', scoring_percentage) AS scoring_percentage"
        " FROM players ORDER BY total_goals_scored DESC, scoring_percentage DESC, team, player LIMIT 20",
    }
