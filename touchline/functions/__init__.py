"""Column helpers: every function takes and returns Spark columns."""

from touchline.functions.keys import (
    calendar_key,
    name_key,
    plain_name,
    season_end,
    season_key,
    season_start,
    season_start_year,
)
from touchline.functions.numbers import clip, decimal_comma, log_odds, percent, spread
from touchline.functions.outcomes import (
    LABELS,
    OUTCOMES,
    SUFFIXES,
    brier,
    occurred,
    result_label,
    triple,
)
from touchline.functions.ratings import (
    HOME_BONUS,
    expected_score,
    outcome_signal,
    points,
    score_gap,
)

__all__ = [
    "HOME_BONUS",
    "LABELS",
    "OUTCOMES",
    "SUFFIXES",
    "brier",
    "calendar_key",
    "clip",
    "decimal_comma",
    "expected_score",
    "log_odds",
    "name_key",
    "occurred",
    "outcome_signal",
    "percent",
    "plain_name",
    "points",
    "result_label",
    "score_gap",
    "season_end",
    "season_key",
    "season_start",
    "season_start_year",
    "spread",
    "triple",
]
