"""The scoring mart: everything known about the matches of one round."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import brier, expected_score, score_gap, triple
from touchline.operators.relational import played


def newest_round(matches: DataFrame) -> Column:
    """The newest round as a scalar subquery: no value travels through the driver."""
    return matches.agg(F.max("round_number")).scalar()


def round_mart(
    calibrated: DataFrame,
    ratings: DataFrame,
    round_number: Column | int,
    scored_at: Column | None = None,
) -> DataFrame:
    """One row per match of the round, ordered by event; unrated matches keep NULLs."""
    stamp = F.current_timestamp() if scored_at is None else scored_at
    chosen = calibrated.filter(F.col("round_number") == round_number)
    return (
        chosen.join(ratings, "match_id", "left")
        .select(
            "round_number",
            "event_number",
            F.col("match_id").alias("match_key"),
            "match_start",
            "home_team",
            "away_team",
            "league",
            "status",
            *triple("crowd"),
            *triple("calibrated"),
            "elo_home",
            "elo_away",
            expected_score(F.col("elo_home"), F.col("elo_away")).alias("elo_expected_score"),
            stamp.alias("scored_at"),
        )
        .orderBy("event_number", "match_key")
    )


def crowd_gap(mart: DataFrame) -> DataFrame:
    """Add how far the crowd rates the home side above the ratings."""
    return mart.withColumn("gap", score_gap("crowd", F.col("elo_expected_score")))


def unrated(mart: DataFrame) -> DataFrame:
    """The matches without a rating, as rows."""
    missing = F.col("elo_home").isNull()
    return mart.filter(missing).select("round_number", "event_number", "match_key")


def mart_against_results(mart: DataFrame, fact: DataFrame, prefixes: list[str]) -> DataFrame:
    """Join published forecasts to the results they were made for, and score each."""
    results = played(fact).select("match_key", "result")
    scored = mart.join(results, "match_key")
    return scored.select(
        "match_key", "result", *[brier(prefix).alias(f"brier_{prefix}") for prefix in prefixes]
    )
