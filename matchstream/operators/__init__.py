"""Metric operators: each is a DataFrame -> DataFrame function usable on batch
and streaming inputs alike."""

from matchstream.operators.cards import (
    with_team_momentum,
    with_team_momentum_join,
    yellow_cards_by_team_player,
    yellow_cards_sliding,
    yellow_momentum,
)
from matchstream.operators.fouls import fouls_by_team, fouls_tumbling
from matchstream.operators.players import leaderboard, player_totals, time_range
from matchstream.operators.routing import route_topics
from matchstream.operators.scoreboard import first_per_key, scoreboard
from matchstream.operators.serving import latest_fouls, latest_yellow_cards, top_players
from matchstream.operators.summary import family_counts

__all__ = [
    "fouls_tumbling",
    "fouls_by_team",
    "yellow_cards_sliding",
    "yellow_momentum",
    "with_team_momentum",
    "with_team_momentum_join",
    "yellow_cards_by_team_player",
    "player_totals",
    "leaderboard",
    "time_range",
    "scoreboard",
    "first_per_key",
    "route_topics",
    "family_counts",
    "latest_fouls",
    "latest_yellow_cards",
    "top_players",
]
