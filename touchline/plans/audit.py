"""What a run produced, as rows instead of printed lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def fact_audit(fact: DataFrame) -> DataFrame:
    """Rows, leagues, seasons and missing ratings of the match fact.

    The rows are first counted per league and season, so that the distinct counts look at
    those few groups and no row is repeated for them.
    """
    groups = fact.groupBy("league_key", "season_key").agg(
        F.count("*").alias("rows"), F.count_if(F.col("elo_home").isNull()).alias("unrated")
    )
    both = F.col("league_key").isNotNull() & F.col("season_key").isNotNull()
    return groups.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("matches"),
        F.countDistinct("league_key").alias("leagues"),
        F.count_if(both).alias("league_seasons"),
        F.coalesce(F.sum("unrated"), F.lit(0)).alias("without_rating"),
    )


def rating_summary(ratings: DataFrame) -> DataFrame:
    """Number and range of the home ratings; the mean should stay near the start rating."""
    home = F.col("elo_home")
    return ratings.agg(
        F.count("*").alias("matches"),
        F.round(F.min(home), 1).alias("lowest"),
        F.round(F.max(home), 1).alias("highest"),
        F.round(F.avg(home), 1).alias("mean"),
    )


def strongest(ratings: DataFrame, matches: DataFrame, rows: int = 10) -> DataFrame:
    """The highest home ratings on record. The few rows are chosen before the join, so
    only they are looked up among the matches."""
    top = ratings.orderBy(F.desc("elo_home"), F.asc("match_id")).limit(rows)
    return top.join(matches.select("match_id", "home_team"), "match_id").select(
        "match_id", "home_team", F.round("elo_home", 1).alias("elo")
    )
