"""The batch runs: documents to matches, dimensions, facts, model columns and the mart.

Every step reads tables, writes tables and may be run again. What is updated or replaced is
published in versions, because updates read what they replace and so may earlier results;
``expire`` drops the old ones.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.functions import triple
from touchline.operators.calibration import calibrate, calibration_metrics, fit_crowd_curves
from touchline.operators.rating import rate_matches
from touchline.operators.relational import inline_relation, newest_rounds, scope_semi
from touchline.plans import audit, dimensions, facts, mart
from touchline.sources import documents, ingest, parts, tables
from touchline.sources.workspace import pinned


@dataclass(frozen=True)
class Layers:
    """Where the tables are, and which leagues are in scope."""

    silver: str = "silver"
    gold: str = "gold"
    mart: str = "mart"
    leagues: Mapping[str, str] = field(default_factory=lambda: dimensions.LEAGUE_COUNTRY)

    @property
    def matches(self) -> str:
        return f"{self.silver}.matches"

    @property
    def rejects(self) -> str:
        return f"{self.silver}.rejects"

    @property
    def account(self) -> str:
        return f"{self.silver}.load_account"

    @property
    def forecasts(self) -> str:
        return f"{self.gold}.match_forecast"

    @property
    def fact(self) -> str:
        return f"{self.gold}.fact_match"

    @property
    def coupon(self) -> str:
        return f"{self.mart}.coupon"


def create_layers(spark: SparkSession, layers: Layers, folder: str | None = None) -> None:
    tables.create_namespaces(spark, [layers.silver, layers.gold, layers.mart], folder)


def load_matches(
    spark: SparkSession,
    layers: Layers,
    path: str,
    multi_line: bool = True,
    plan: DataFrame | None = None,
) -> DataFrame:
    """One row per match of all documents, every league, played or not.

    Documents that cannot be parsed or carry an error are kept in a table of their own with the
    reason, and counted in the account of the load. With a ``plan`` (see ``ingest_plan``), the
    load fails if a round that the plan asks for did not arrive in an accepted document; the
    account and the rejects are written before. The documents are parsed once and written as
    parsed, for all that reads them.
    """
    landed = pinned(documents.read_documents(spark, path, multi_line), "landed")
    accepted = documents.accepted(landed)
    rejects = tables.publish(documents.rejected(landed), layers.rejects)
    account = rejects.groupBy(F.col("reason").alias("status")).agg(F.count("*").alias("documents"))
    if plan is None:
        account = account.unionByName(accepted.agg(F.lit("accepted").alias("status"), F.count("*").alias("documents")))
        tables.publish(account, layers.account)
    else:
        arrived = accepted.select(F.col("draw.drawNumber").alias("round_number"))
        account = tables.publish(account.unionByName(ingest.ingest_audit(plan, arrived)), layers.account)
        ingest.require_complete(account)
    return tables.publish(newest_rounds(documents.extract_events(accepted)), layers.matches)


def build_dimensions(spark: SparkSession, layers: Layers, as_of: Column | None = None) -> None:
    matches = spark.table(layers.matches)
    listed = inline_relation(spark, layers.leagues, ("league_name", "country"))
    inside = scope_semi(matches, listed)
    for name, frame in (
        ("dim_team", dimensions.team_dimension(matches)),
        ("dim_date", dimensions.date_dimension(matches, as_of)),
        ("dim_league", dimensions.league_dimension(listed)),
        ("dim_season", dimensions.season_dimension(inside, as_of)),
    ):
        tables.publish(frame, f"{layers.gold}.{name}")


def build_facts(spark: SparkSession, layers: Layers) -> DataFrame:
    """Both facts; the aggregate is built from the match fact as written. Returns the audit."""
    leagues = spark.table(f"{layers.gold}.dim_league")
    fact = parts.publish_parts(facts.match_fact(spark.table(layers.matches), leagues), layers.fact, "season_key")
    tables.publish(facts.league_season_fact(fact), f"{layers.gold}.fact_league_season")
    return audit.fact_audit(fact)


def add_forecasts(spark: SparkSession, layers: Layers) -> tuple[DataFrame, DataFrame]:
    """Fit the curves on all played matches, rate every match, in scope or not, write both once per
    load, and fill the fact's columns by one update, which writes the seasons whose forecasts
    changed. Returns the in-sample metrics of the curves and the summary of the ratings.

    Both are made anew from all matches: a corrected result changes all that follows it.
    """
    matches = spark.table(layers.matches)
    calibrated = calibrate(matches, fit_crowd_curves(matches))
    names = [*triple("calibrated"), "elo_home", "elo_away"]
    forecasts = calibrated.join(rate_matches(matches), "match_id").select(
        F.col("match_id").alias("match_key"), "result", *triple("crowd"), *names
    )
    written = tables.publish(forecasts, layers.forecasts)
    parts.update_parts(layers.fact, written, "match_key", names, "season_key")
    return calibration_metrics(written), audit.rating_summary(written)


def score_newest_round(
    spark: SparkSession, layers: Layers, scored_at: Column | None = None
) -> DataFrame:
    """Score the newest round into the mart from the load's forecasts, replacing an earlier score
    of the same match. Returns the round as written."""
    matches = spark.table(layers.matches)
    known = spark.table(layers.forecasts).withColumnRenamed("match_key", "match_id")
    newest = mart.newest_round(matches)
    chosen = matches.filter(F.col("round_number") == newest)
    calibrated = chosen.join(known.select("match_id", *triple("calibrated")), "match_id", "left")
    ratings = known.select("match_id", "elo_home", "elo_away")
    scored = mart.round_mart(calibrated, ratings, newest, scored_at)
    written = tables.upsert_table(layers.coupon, scored, "match_key")
    return mart.crowd_gap(written.filter(F.col("round_number") == newest))


def expire(spark: SparkSession, layers: Layers, keep: int = 2) -> None:
    """Drop older versions of all published tables, once nothing reads them any more."""
    made = [f"{layers.gold}.{name}" for name in ("dim_team", "dim_date", "dim_league", "dim_season", "fact_league_season")]
    for name in (layers.matches, layers.rejects, layers.account, layers.fact, layers.forecasts, layers.coupon, *made):
        tables.expire_versions(spark, name, keep)
