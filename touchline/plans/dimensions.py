"""Conformed dimensions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import (
    calendar_key,
    name_key,
    season_end,
    season_key,
    season_start,
    season_start_year,
)
from touchline.functions.keys import SEASON_MONTH
from touchline.operators.relational import newest_per

# The curated leagues and their country. Being listed here is what puts a
# league in scope.
LEAGUE_COUNTRY = {
    "Premier League": "England",
    "Championship": "England",
    "League One": "England",
    "League Two": "England",
    "National League": "England",
}
# Fixed value: how far the calendar runs past the day of the build.
CALENDAR_DAYS_AHEAD = 730


def team_dimension(matches: DataFrame) -> DataFrame:
    """One row per upper-cased team name with its newest id and country, all leagues.

    Both sides come from one scan. The later match wins, then the higher match id, then
    the home side.
    """
    sides = [
        F.struct(
            F.col(f"{side}_team").alias("team_name"),
            F.col(f"{side}_team_id").alias("team_id"),
            F.col(f"{side}_team_country").alias("country"),
            F.lit(rank).alias("side"),
        )
        for rank, side in enumerate(("home", "away"))
    ]
    appearances = matches.select("match_start", "match_id", F.inline(F.array(*sides)))
    newest = newest_per(
        appearances.withColumn("team_key", name_key(F.col("team_name"))),
        ["team_key"],
        F.desc("match_start"),
        F.desc("match_id"),
        F.asc("side"),
    )
    return newest.select("team_key", "team_name", "team_id", "country")


def date_dimension(
    matches: DataFrame, as_of: Column | None = None, days_ahead: int = CALENDAR_DAYS_AHEAD
) -> DataFrame:
    """Every day from the earliest match to ``days_ahead`` days past ``as_of`` (today).

    The first day stays in the plan, so building the frame runs no job. The sequence is as
    long as the calendar, whatever the number of matches.
    """
    last = F.date_add(F.current_date() if as_of is None else as_of, days_ahead)
    span = matches.agg(F.min(F.to_date("match_start")).alias("first_day"))
    days = span.filter(F.col("first_day") <= last).select(
        F.explode(F.sequence("first_day", last)).alias("full_date")
    )
    day = F.col("full_date")
    iso_weekday = F.weekday(day) + 1
    return days.select(
        day,
        calendar_key(day).alias("date_key"),
        F.year(day).alias("year"),
        F.quarter(day).alias("quarter"),
        F.month(day).alias("month"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.dayofmonth(day).alias("day"),
        iso_weekday.alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        F.weekofyear(day).alias("week_of_year"),
        (iso_weekday >= 6).alias("is_weekend"),
    )


def league_dimension(lookup: DataFrame) -> DataFrame:
    """One row per upper-cased league; of several spellings the first in text order."""
    keyed = lookup.select(
        name_key(F.col("league_name")).alias("league_key"), "league_name", "country"
    )
    return newest_per(keyed, ["league_key"], F.asc("league_name"), F.asc("country"))


def season_dimension(
    matches: DataFrame, as_of: Column | None = None, first_month: int = SEASON_MONTH
) -> DataFrame:
    """One row per season seen; ``is_current`` tells whether ``as_of`` (today) lies in it."""
    today = F.current_date() if as_of is None else as_of
    year = F.col("start_year")
    start, end = season_start(year, first_month), season_end(year, first_month)
    return (
        matches.select(season_start_year(F.col("match_start"), first_month).alias("start_year"))
        .distinct()
        .select(
            season_key(year).alias("season_key"),
            start.alias("start_date"),
            end.alias("end_date"),
            today.between(start, end).alias("is_current"),
        )
    )
