"""Nested JSON documents: one document per round, holding an array of events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import SUFFIXES, decimal_comma, percent, result_label

# The layout of the documents. Fields that are quoted in some files and
# bare in others are declared as text. An explicit schema saves the inference pass and
# keeps ``error`` present when no file carries it.
DOCUMENT_SCHEMA = """
    error string,
    draw struct<
      drawNumber: bigint,
      drawEvents: array<struct<
        eventNumber: bigint,
        match: struct<
          matchId: bigint, matchStart: string, sportEventStatus: string,
          participants: array<struct<name: string, result: string, id: string, countryName: string>>,
          league: struct<name: string, id: string, country: struct<name: string>>>,
        svenskaFolket: struct<one: string, x: string, two: string>,
        odds: struct<one: string, x: string, two: string>,
        startOdds: struct<one: string, x: string, two: string>,
        favouriteOdds: struct<one: string, x: string, two: string>,
        providerIds: array<struct<provider: string, type: string, id: string>>>>>,
    _corrupt_record string
"""
PROVIDER = "BetRadar"
OUTCOME_FIELDS = ("one", "x", "two")


def read_documents(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """One row per document.

    ``multi_line`` reads pretty-printed files, each holding one document or one array of
    documents; such a file is parsed by one task. Without it every line is a document and
    large files are split among tasks.
    """
    return (
        spark.read.schema(DOCUMENT_SCHEMA)
        .option("multiLine", multi_line)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )


def accepted(documents: DataFrame) -> DataFrame:
    """Documents that carry no error payload and could be parsed."""
    return documents.filter(F.col("error").isNull() & F.col("_corrupt_record").isNull())


def rejected(documents: DataFrame) -> DataFrame:
    """The remaining documents and why they were set aside."""
    reason = F.when(F.col("_corrupt_record").isNotNull(), "corrupt").when(
        F.col("error").isNotNull(), "error"
    )
    return documents.select(
        reason.alias("reason"), F.coalesce("_corrupt_record", "error").alias("payload")
    ).filter(F.col("reason").isNotNull())


def provider_id(provider_ids: Column, provider: str = PROVIDER) -> Column:
    """The id given by one provider, wherever it stands in the array."""
    mine = F.filter(provider_ids, lambda entry: entry["provider"] == provider)
    return F.get(mine, F.lit(0))["id"]


def _outcome_columns(prefix: str, field: Column, parse) -> list[Column]:
    return [
        parse(field[name]).alias(f"{prefix}_{suffix}")
        for suffix, name in zip(SUFFIXES, OUTCOME_FIELDS, strict=True)
    ]


def event_columns(round_number: Column, event: Column) -> list[Column]:
    """The flat columns of one event."""
    match = event["match"]
    home, away = (F.get(match["participants"], F.lit(side)) for side in (0, 1))
    home_goals, away_goals = (side["result"].try_cast("int") for side in (home, away))
    return [
        round_number.alias("round_number"),
        event["eventNumber"].alias("event_number"),
        match["matchId"].alias("match_id"),
        match["matchStart"].alias("match_start"),
        home["name"].alias("home_team"),
        away["name"].alias("away_team"),
        match["league"]["name"].alias("league"),
        *_outcome_columns("crowd", event["svenskaFolket"], percent),
        home_goals.alias("home_goals"),
        away_goals.alias("away_goals"),
        result_label(home_goals, away_goals).alias("result"),
        *_outcome_columns("odds", event["odds"], decimal_comma),
        *_outcome_columns("start_odds", event["startOdds"], decimal_comma),
        home["id"].try_cast("int").alias("home_team_id"),
        away["id"].try_cast("int").alias("away_team_id"),
        home["countryName"].alias("home_team_country"),
        away["countryName"].alias("away_team_country"),
        match["league"]["id"].try_cast("int").alias("league_id"),
        match["league"]["country"]["name"].alias("league_country"),
        match["sportEventStatus"].alias("status"),
        *_outcome_columns("favourite_odds", event["favouriteOdds"], percent),
        provider_id(event["providerIds"]).alias("betradar_id"),
    ]


def extract_events(documents: DataFrame) -> DataFrame:
    """One row per event; a document without events gives none."""
    exploded = documents.select(
        F.col("draw.drawNumber").alias("round"), F.explode("draw.drawEvents").alias("event")
    )
    return exploded.select(event_columns(F.col("round"), F.col("event")))
