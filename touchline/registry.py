"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline import binding, landing
from touchline.functions import (
    LABELS,
    OUTCOMES,
    brier,
    calendar_key,
    clip,
    decimal_comma,
    expected_score,
    name_key,
    outcome_signal,
    percent,
    result_label,
    season_end,
    season_key,
    season_start,
    season_start_year,
    triple,
)
from touchline.operators import calibration, judging, pooling, rating, relational
from touchline.plans import audit, backtest, dimensions, facts, mart
from touchline.sources import documents, ingest, parts, tables
from touchline.sources.workspace import new_folder, pinned, shared_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
LEAGUES = list(binding.SCOPE)


def query(function: Query) -> Query:
    QUERIES[function.__name__.removesuffix("_query")] = function
    return function


def _as_of():
    return F.lit(binding.AS_OF).cast("date")


def _rounded(df: DataFrame, digits: int, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _leagues(spark: SparkSession) -> DataFrame:
    lookup = relational.inline_relation(spark, binding.SCOPE, ("league_name", "country"))
    return dimensions.league_dimension(lookup)


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.match_fact(binding.matches(spark, sf_dir), _leagues(spark))


def _cheap_ratings(matches: DataFrame) -> DataFrame:
    """Made-up ratings for queries about joins and formulas rather than rating."""
    return matches.select(
        "match_id",
        (1400 + F.col("match_id") * 37 % 200).cast("double").alias("elo_home"),
        (1400 + F.col("match_id") * 53 % 200).cast("double").alias("elo_away"),
    )


def _with_expected(matches: DataFrame) -> DataFrame:
    return matches.join(_cheap_ratings(matches), "match_id").withColumn(
        "elo_expected_score", expected_score(F.col("elo_home"), F.col("elo_away"))
    )


def _expected_in_place(matches: DataFrame) -> DataFrame:
    rated = matches.withColumns(
        {
            "elo_home": (1400 + F.col("match_id") * 37 % 200).cast("double"),
            "elo_away": (1400 + F.col("match_id") * 53 % 200).cast("double"),
        }
    )
    return rated.withColumn(
        "elo_expected_score", expected_score(F.col("elo_home"), F.col("elo_away"))
    )


def _calibrated(matches: DataFrame) -> DataFrame:
    return calibration.calibrate(matches, calibration.fit_crowd_curves(matches))


# --- sources and sinks -----------------------------------------------------------------


@query
def scan_table(spark, sf_dir):
    lines = binding.table(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query
def inline_relation(spark, sf_dir):
    lookup = relational.inline_relation(spark, binding.SCOPE, ("league", "country"))
    counts = binding.matches(spark, sf_dir).groupBy("league").agg(F.count("*").alias("matches"))
    return lookup.join(counts, "league")


def _landed_rounds(matches: DataFrame, league: str) -> DataFrame:
    return matches.filter(F.col("league") == league).select("round_number").distinct()


@query
def ingest_plan(spark, sf_dir):
    matches = binding.matches(spark, sf_dir)
    landed = _landed_rounds(matches, "Division A")
    return ingest.ingest_plan(matches.select("round_number"), landed, first_id=0)


@query
def ingest_audit(spark, sf_dir):
    matches = binding.matches(spark, sf_dir)
    return ingest.ingest_audit(ingest_plan(spark, sf_dir), _landed_rounds(matches, "Cup"))


_databases: list[str] = []


def _namespace(spark: SparkSession) -> str:
    name = f"touchline_{uuid.uuid4().hex[:12]}"
    tables.create_namespaces(spark, [name], shared_folder(spark))
    _databases.append(name)
    return name


def drop_databases(spark: SparkSession) -> None:
    """Drop the databases that queries have made so far, once their results have been used."""
    while _databases:
        spark.sql(f"DROP DATABASE IF EXISTS {_databases.pop()} CASCADE")


@query
def overwrite_roundtrip(spark, sf_dir):
    teams = dimensions.team_dimension(binding.matches(spark, sf_dir))
    table = f"{_namespace(spark)}.dim_team"
    tables.overwrite(teams.select("team_key"), table)
    return tables.overwrite(teams, table)


@query
def merge_update_matched(spark, sf_dir):
    start = F.lit(1500.0)
    target = _fact(spark, sf_dir).withColumns({"elo_home": start, "elo_away": start})
    rated = _expected_in_place(relational.played(binding.matches(spark, sf_dir)))
    source = rated.select(
        F.col("match_id").alias("match_key"),
        F.when(F.col("result") != "X", F.col("elo_home")).alias("elo_home"),
        "elo_away",
    )
    merged = tables.merge_matched(target, source, "match_key", ["elo_home", "elo_away"])
    return merged.select("match_key", "league_key", "result", "elo_home", "elo_away")


@query
def upsert_wildcard(spark, sf_dir):
    matches = binding.matches(spark, sf_dir).withColumn("match_key", F.col("match_id"))
    published = matches.filter(F.col("match_date") < "2000-01-01")
    incoming = matches.filter(F.col("match_date") >= "1999-07-01")
    target = published.select("match_key", "round_number", "crowd_1", "status")
    source = incoming.select(
        "match_key",
        "round_number",
        (F.col("crowd_1") + F.col("crowd_x")).alias("crowd_1"),
        F.col("result").alias("status"),
        F.col("crowd_2"),
    )
    table = f"{_namespace(spark)}.coupon"
    tables.upsert_table(table, target, "match_key")
    return _rounded(tables.upsert_table(table, source, "match_key"), 6, ["crowd_1", "crowd_2"])


def _kept_files(before: DataFrame, after: DataFrame) -> DataFrame:
    """The seasons whose files are the same in two versions of a table."""

    def files(df: DataFrame) -> DataFrame:
        read = df.select("season_key", F.input_file_name().alias("file")).distinct()
        return read.groupBy("season_key").agg(F.sort_array(F.collect_set("file")).alias("files"))

    return files(after).join(files(before), ["season_key", "files"], "left_semi").select("season_key")


@query
def update_one_season(spark, sf_dir):
    """Ratings that differ from the published ones in one season: only its files are written."""
    name = f"{_namespace(spark)}.fact_match"
    start = F.lit(1500.0)
    fact = _fact(spark, sf_dir).withColumns({"elo_home": start, "elo_away": start})
    before = parts.publish_parts(fact, name, "season_key")
    changed = (F.col("season_key") == "1997/1998") & F.col("result").isNotNull()
    rated = F.when(changed, 1400 + F.col("match_key") * 37 % 200).otherwise(start)
    source = fact.select("match_key", rated.alias("elo_home"), "elo_away")
    after = parts.update_parts(name, source, "match_key", ["elo_home", "elo_away"], "season_key")
    kept = _kept_files(before, after).withColumn("kept", F.lit(True))
    totals = after.groupBy("season_key").agg(
        F.count("*").alias("matches"), F.sum("elo_home").alias("elo_home"), F.sum("elo_away").alias("elo_away")
    )
    return totals.join(kept, "season_key", "left").withColumn("kept", F.coalesce("kept", F.lit(False)))


@query
def upsert_moved_season(spark, sf_dir):
    """Matches of the last season arrive, and some of an early one are moved to the season after."""
    name = f"{_namespace(spark)}.coupon"
    season = season_key(season_start_year(F.col("match_start")))
    matches = binding.matches(spark, sf_dir).select("match_id", season.alias("season_key"), "round_number", "crowd_1")
    late = F.col("season_key") >= "1999/2000"
    moved = (F.col("season_key") == "1994/1995") & (F.col("match_id") % 10 == 0)
    before = parts.upsert_parts(name, matches.filter(~late), "match_id", "season_key")
    source = matches.filter(late | moved).select(
        "match_id",
        F.when(moved, "1995/1996").otherwise(F.col("season_key")).alias("season_key"),
        F.when(~moved, F.col("round_number")).alias("round_number"),
        "crowd_1",
        moved.alias("postponed"),
    )
    after = parts.upsert_parts(name, source, "match_id", "season_key")
    kept = _kept_files(before, after).withColumn("kept", F.lit(True))
    totals = after.groupBy("season_key").agg(
        F.count("*").alias("matches"),
        F.sum(F.col("round_number").cast("bigint")).alias("rounds"),
        F.count_if("postponed").alias("postponed"),
        F.count("postponed").alias("told"),
    )
    return totals.join(kept, "season_key", "left").withColumn("kept", F.coalesce("kept", F.lit(False)))


@query
def temp_view_sql(spark, sf_dir):
    text = """
        SELECT league, result, count(*) AS matches, min(match_date) AS first_day
        FROM {matches} WHERE result IS NOT NULL GROUP BY league, result
    """
    return spark.sql(text, matches=binding.matches(spark, sf_dir))


@query
def run_audit(spark, sf_dir):
    rated = _cheap_ratings(relational.played(binding.matches(spark, sf_dir)))
    fact = _fact(spark, sf_dir).drop("elo_home", "elo_away")
    source = rated.withColumnRenamed("match_id", "match_key")
    return audit.fact_audit(fact.join(source, "match_key", "left"))


@query
def scan_json_documents(spark, sf_dir):
    path = landing.land_arrays(binding.matches(spark, sf_dir), new_folder(spark, "arrays"))
    landed = documents.read_documents(spark, path)
    size = F.size("draw.drawEvents").cast("bigint")
    return (
        documents.accepted(landed)
        .groupBy(F.col("draw.drawNumber").alias("round_number"))
        .agg(F.sum(size).alias("events"))
    )


@query
def extract_events(spark, sf_dir):
    path = landing.land_lines(binding.matches(spark, sf_dir), new_folder(spark, "lines"))
    landed = documents.read_documents(spark, path, multi_line=False)
    return documents.extract_events(documents.accepted(landed))


@query
def load_rejects(spark, sf_dir):
    """Documents set aside, by reason; the good ones beside them are counted too."""
    matches = binding.matches(spark, sf_dir)
    path = landing.land_faults(matches, landing.land_lines(matches, new_folder(spark, "faults")))
    landed = documents.read_documents(spark, path, multi_line=False)
    events = documents.extract_events(documents.accepted(landed))
    rejects = documents.rejected(landed).groupBy("reason").agg(F.count("*").alias("rows"))
    return rejects.unionByName(events.agg(F.lit("events of accepted").alias("reason"), F.count("*").alias("rows")))


# --- projections, filters, scalar functions --------------------------------------------


@query
def filter_played(spark, sf_dir):
    return relational.played(binding.matches(spark, sf_dir)).select("match_id", "result")


@query
def scope_filter(spark, sf_dir):
    matches = binding.matches(spark, sf_dir).select("match_id", "league")
    return relational.scope_to(matches, LEAGUES)


@query
def scope_semi(spark, sf_dir):
    matches = binding.matches(spark, sf_dir).select("match_id", "league")
    return relational.scope_semi(matches, _leagues(spark))


@query
def scope_loosely(spark, sf_dir):
    """The same scope over league names that are spelled in several ways."""
    spelled = F.when(F.col("match_id") % 3 == 0, F.upper("league")).when(
        F.col("match_id") % 3 == 1, F.replace("league", F.lit(" "), F.lit(",  "))
    )
    matches = binding.matches(spark, sf_dir).select("match_id", F.coalesce(spelled, "league").alias("league"))
    return relational.scope_semi(matches, _leagues(spark), loosely=True)


@query
def time_split(spark, sf_dir):
    matches = binding.matches(spark, sf_dir)
    parts = relational.with_part(matches, binding.CUTOFF, "match_date")
    return parts.select("match_id", "match_date", "result", "part")


@query
def result_label_query(spark, sf_dir):
    goals = F.col("home_goals"), F.col("away_goals")
    return binding.matches(spark, sf_dir).select("match_id", result_label(*goals).alias("result"))


@query
def long_outcomes(spark, sf_dir):
    return relational.long_outcomes(binding.matches(spark, sf_dir))


@query
def season_key_query(spark, sf_dir):
    year = season_start_year(F.col("match_start"))
    return binding.matches(spark, sf_dir).select(
        "match_id",
        season_key(year).alias("season_key"),
        season_start(year).alias("start_date"),
        season_end(year).alias("end_date"),
    )


@query
def scalar_string(spark, sf_dir):
    name = F.col("c_name")
    return binding.table(spark, sf_dir, "customer").select(
        "c_custkey",
        name_key(name).alias("name_key"),
        F.regexp_replace(name, "^Customer#", "").alias("number_text"),
        F.translate(F.col("c_acctbal").cast("decimal(12,2)").cast("string"), ".", ",").alias(
            "balance_text"
        ),
        F.concat(F.lower("c_mktsegment"), F.lit("/"), F.col("c_nationkey").cast("string")).alias(
            "segment_key"
        ),
    )


@query
def scalar_date(spark, sf_dir):
    day = F.to_date("match_start")
    return binding.matches(spark, sf_dir).select(
        "match_id",
        day.alias("day"),
        calendar_key(day).alias("date_key"),
        F.quarter(day).alias("quarter"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "EEEE").alias("day_name"),
        (F.weekday(day) + 1).alias("day_of_week"),
        F.weekofyear(day).alias("week_of_year"),
    )


@query
def scalar_math(spark, sf_dir):
    price, discount, quantity = F.col("l_extendedprice"), F.col("l_discount"), F.col("l_quantity")
    lines = binding.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.log(clip(price, 1.0, 50000.0)).alias("log_price"),
        F.pow(discount - F.lit(0.05), 2).alias("squared"),
        F.abs(quantity - F.lit(25.0)).alias("distance"),
        F.sqrt(quantity).alias("root"),
        F.log(price / quantity).alias("log_unit_price"),
    )
    return _rounded(lines, 5, ["log_price", "squared", "distance", "root", "log_unit_price"])


@query
def parse_decimal(spark, sf_dir):
    comma = F.translate(F.format_string("%.2f", "odds_1"), ".", ",")
    return binding.matches(spark, sf_dir).select(
        "match_id",
        decimal_comma(comma).alias("odds_1"),
        percent(F.format_string("%.0f", F.col("crowd_1") * 100)).alias("crowd_1"),
        decimal_comma(F.col("odds_x")).alias("odds_x"),
        decimal_comma(F.col("league")).alias("malformed"),
        F.col("betradar_id").try_cast("int").alias("betradar_number"),
    )


@query
def array_pick(spark, sf_dir):
    def entry(provider, value):
        return F.struct(F.lit(provider).alias("provider"), value.alias("id"))

    providers = F.when(
        F.col("league") != "Cup",
        F.array(
            entry("Another", F.col("match_id").cast("string")),
            entry(documents.PROVIDER, F.col("betradar_id")),
        ),
    )
    return binding.matches(spark, sf_dir).select(
        "match_id", documents.provider_id(providers).alias("betradar_id")
    )


# --- warehouse -------------------------------------------------------------------------


@query
def latest_per_match(spark, sf_dir):
    matches = binding.matches(spark, sf_dir).select(
        "match_id", "round_number", "event_number", "league", "status"
    )
    again = matches.filter(F.col("league") == "Cup").withColumns(
        {"round_number": F.col("round_number") + 1, "status": F.lit("Moved")}
    )
    return relational.newest_rounds(matches.unionByName(again))


@query
def dim_team(spark, sf_dir):
    return dimensions.team_dimension(binding.matches(spark, sf_dir))


@query
def dim_date(spark, sf_dir):
    return dimensions.date_dimension(binding.matches(spark, sf_dir), _as_of())


@query
def dim_league(spark, sf_dir):
    names = binding.matches(spark, sf_dir).select(
        F.col("league").alias("league_name"), F.col("league_country").alias("country")
    )
    return dimensions.league_dimension(names)


@query
def dim_season(spark, sf_dir):
    matches = binding.matches(spark, sf_dir)
    return dimensions.season_dimension(relational.scope_semi(matches, _leagues(spark)), _as_of())


@query
def fact_match(spark, sf_dir):
    return _fact(spark, sf_dir)


@query
def fact_league_season(spark, sf_dir):
    return facts.league_season_fact(_fact(spark, sf_dir))


@query
def star_join(spark, sf_dir):
    """The dimensions are written first: of a written table Spark knows the size, and so
    joins it by broadcast as long as it is small, leaving the fact where it is."""
    matches = binding.matches(spark, sf_dir)
    joined = facts.star(
        _fact(spark, sf_dir),
        pinned(dimensions.team_dimension(matches), "dim_team"),
        _leagues(spark),
        pinned(dimensions.date_dimension(matches, _as_of()), "dim_date"),
    )
    return (
        joined.groupBy("home_country", "away_country", "league_name", "year", "is_weekend")
        .agg(F.count("*").alias("matches"), F.sum("home_goals").alias("home_goals"))
    )


@query
def left_lookup(spark, sf_dir):
    lookup = relational.inline_relation(spark, binding.SCOPE, ("league", "country"))
    matches = binding.matches(spark, sf_dir).select("match_id", "league")
    return matches.join(lookup, "league", "left")


# --- ratings ---------------------------------------------------------------------------


@query
def elo_ratings(spark, sf_dir):
    rated = rating.rate_matches(binding.matches(spark, sf_dir))
    return _rounded(rated, 4, ["elo_home", "elo_away"])


@query
def elo_linked(spark, sf_dir):
    """One component that holds every match."""
    rated = rating.rate_matches(binding.linked_matches(spark, sf_dir))
    return _rounded(rated, 4, ["elo_home", "elo_away"])


@query
def elo_summary(spark, sf_dir):
    return audit.rating_summary(rating.rate_matches(binding.matches(spark, sf_dir)))


@query
def elo_topk(spark, sf_dir):
    matches = binding.matches(spark, sf_dir)
    return audit.strongest(rating.rate_matches(matches), matches)


@query
def elo_scored_join(spark, sf_dir):
    matches = _with_expected(binding.matches(spark, sf_dir))
    columns = ["match_id", "home_team", "elo_home", "elo_away", "elo_expected_score"]
    return _rounded(matches.select(columns), 6, ["elo_expected_score"])


@query
def elo_expected(spark, sf_dir):
    rated = _expected_in_place(binding.matches(spark, sf_dir))
    return _rounded(rated.select("match_id", "elo_expected_score"), 6, ["elo_expected_score"])


@query
def elo_predictor(spark, sf_dir):
    rated = _expected_in_place(binding.matches(spark, sf_dir))
    expected = F.col("elo_expected_score")
    signals = {f"signal_{label.lower()}": outcome_signal(label, expected) for label in LABELS}
    named = rated.select("match_id", *[v.alias(k) for k, v in signals.items()])
    return _rounded(named, 6, list(signals))


@query
def elo_long(spark, sf_dir):
    rated = _expected_in_place(binding.matches(spark, sf_dir))
    return _rounded(relational.long_signals(rated), 6, ["predicted_prob"])


@query
def elo_probs(spark, sf_dir):
    matches = binding.matches(spark, sf_dir)
    rated = rating.rate_matches(matches).join(matches.select("match_id", "result"), "match_id")
    expected = expected_score(F.col("elo_home"), F.col("elo_away")).alias("elo_expected_score")
    rated = pinned(rated.select("match_id", "result", expected), "rated")
    scored = calibration.rating_probabilities(rated, calibration.fit_rating_curves(rated))
    return _rounded(scored, 6, ["elo_expected_score", *triple("elo")])


# --- calibration -----------------------------------------------------------------------


@query
def isotonic_curve(spark, sf_dir):
    curves = calibration.fit_crowd_curves(binding.matches(spark, sf_dir))
    return _rounded(calibration.curve_table(spark, curves), 6, ["value"])


@query
def calibrated_probs(spark, sf_dir):
    names = triple("calibrated")
    scored = _calibrated(binding.matches(spark, sf_dir)).select("match_id", *names)
    return _rounded(scored, 6, names)


@query
def calibration_metrics(spark, sf_dir):
    scored = _calibrated(binding.matches(spark, sf_dir))
    return _rounded(calibration.calibration_metrics(scored), 8, ["value"])


# --- mart ------------------------------------------------------------------------------


def _mart(spark, sf_dir):
    matches = binding.matches(spark, sf_dir)
    stamp = F.lit(binding.AS_OF).cast("date")
    return mart.round_mart(
        _calibrated(matches), rating.rate_matches(matches), mart.newest_round(matches), stamp
    )


@query
def mart_score(spark, sf_dir):
    scored = _mart(spark, sf_dir)
    scored = _rounded(scored, 4, ["elo_home", "elo_away"])
    return _rounded(scored, 6, [*triple("calibrated"), "elo_expected_score"])


@query
def mart_gap(spark, sf_dir):
    gaps = mart.crowd_gap(_mart(spark, sf_dir)).select("match_key", "event_number", "gap")
    return _rounded(gaps, 6, ["gap"])


@query
def mart_vs_results(spark, sf_dir):
    matches = binding.matches(spark, sf_dir)
    published = matches.select(
        F.col("match_id").alias("match_key"), *triple("crowd"), *triple("favourite_odds")
    )
    prefixes = ["crowd", "favourite_odds"]
    scored = mart.mart_against_results(published, _fact(spark, sf_dir), prefixes)
    return _rounded(scored, 10, [f"brier_{p}" for p in prefixes])


# --- judging ---------------------------------------------------------------------------


@query
def split_describe(spark, sf_dir):
    matches = binding.matches(spark, sf_dir)
    parts = judging.describe_split(matches, binding.CUTOFF, "match_date")
    return _rounded(parts, 6, ["share"])


@query
def brier_row(spark, sf_dir):
    matches = relational.played(binding.matches(spark, sf_dir))
    return matches.select("match_id", F.round(brier("crowd"), 6).alias("brier"))


FORECASTS = ["even", "crowd", "favourite_odds"]
PAIRS = [("even", "crowd"), ("even", "favourite_odds"), ("crowd", "favourite_odds")]


@query
def pooled_brier(spark, sf_dir):
    matches = judging.with_even_forecast(binding.matches(spark, sf_dir))
    return _rounded(judging.pooled_brier(matches, FORECASTS), 8, ["brier"])


def _paired(spark, sf_dir):
    matches = judging.with_even_forecast(binding.matches(spark, sf_dir))
    return judging.paired_scores(matches, PAIRS)


@query
def paired_brier(spark, sf_dir):
    numbers = ["mean_difference", "sd", "standard_error", "ci_low", "ci_high"]
    return _rounded(_rounded(_paired(spark, sf_dir), 8, numbers), 4, ["t_statistic"]).drop("verdict")


@query
def paired_verdict(spark, sf_dir):
    return _paired(spark, sf_dir).select("baseline", "candidate", "verdict")


@query
def blend(spark, sf_dir):
    names = triple("blended")
    mixed = relational.mixed(binding.matches(spark, sf_dir), {"crowd": 0.3, "favourite_odds": 0.7}, "blended")
    return _rounded(mixed.select("match_id", *names), 6, names)


@query
def fit_blend_weight(spark, sf_dir):
    matches = judging.with_even_forecast(binding.matches(spark, sf_dir))
    best = judging.best_blend_weight(matches, "crowd", "even")
    return _rounded(best, 8, ["weight", "brier"])


@query
def unrated_events(spark, sf_dir):
    """Matches of all rounds that no rating covers, where ratings are made of the played matches."""
    matches = binding.matches(spark, sf_dir)
    ratings = rating.rate_matches(relational.played(matches))
    return mart.unrated(matches.withColumnRenamed("match_id", "match_key").join(
        ratings.withColumnRenamed("match_id", "match_key"), "match_key", "left"
    ))


# --- logistic pooling ------------------------------------------------------------------

POOLED = ("crowd", "favourite_odds")
JOINED = ("crowd", "elo")


@query
def logit_features(spark, sf_dir):
    features = pooling.pool_features(POOLED, interaction=True)
    matches = binding.matches(spark, sf_dir)
    out = matches.select("match_id", *[v.alias(k) for k, v in features.items()])
    return _rounded(out, 6, list(features))


def _pool_input(spark, sf_dir):
    """Crowd probabilities and some made from ratings. The fit reads its rows again and
    again, so they are written once."""
    rated = _expected_in_place(binding.matches(spark, sf_dir))
    expected, draw = F.col("elo_expected_score"), F.col("elo_x")
    made = rated.withColumn("elo_x", 0.2 + 0.2 * outcome_signal("X", expected)).withColumns(
        {"elo_1": expected * (1 - draw), "elo_2": (1 - expected) * (1 - draw)}
    )
    return pinned(made.select("match_id", "result", *triple("crowd"), *triple("elo")), "pool")


@query
def pool_fit(spark, sf_dir):
    return pooling.pool_table(spark, pooling.fit_pool(_pool_input(spark, sf_dir), JOINED))


@query
def pool_apply(spark, sf_dir):
    matches = _pool_input(spark, sf_dir)
    pooled = pooling.apply_pool(matches, pooling.fit_pool(matches, JOINED))
    return pooled.select("match_id", "result", *triple("pooled"))


@query
def pool_coefficients(spark, sf_dir):
    pool = pooling.fit_pool(_pool_input(spark, sf_dir), JOINED, interaction=True)
    return pooling.pool_coefficients(spark, pool)


def _gradient(matches: DataFrame, pool) -> DataFrame:
    """The mean slope of the penalised loss in every coefficient: 0 at the optimum."""
    features = {"intercept": F.lit(1.0)} | pooling.pool_features(pool.sources, pool.interaction)
    scored = pooling.apply_pool(matches, pool)
    slopes = {
        (label, name): F.avg((F.col(f"pooled_{s}") - (F.col("result") == label).cast("double")) * x)
        for s, label in OUTCOMES.items()
        for name, x in features.items()
    }
    held = {(r["class"], r["feature"]): r["coefficient"] for r in pooling.pool_table(matches.sparkSession, pool).collect()}
    rows = [
        F.struct(
            F.lit(label).alias("class"),
            F.lit(name).alias("feature"),
            F.round(F.abs(slope + (0.0 if name == "intercept" else held[label, name] / pool.rows)), 4).alias("slope"),
        )
        for (label, name), slope in slopes.items()
    ]
    return scored.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


@query
def pool_gradient(spark, sf_dir):
    matches = _pool_input(spark, sf_dir)
    return _gradient(matches, pooling.fit_pool(matches, JOINED))


@query
def pool_gradient_interaction(spark, sf_dir):
    matches = _pool_input(spark, sf_dir)
    return _gradient(matches, pooling.fit_pool(matches, JOINED, interaction=True))


@query
def pool_balance(spark, sf_dir):
    """The summed probability of every class, which an intercept without penalty makes its count."""
    matches = _pool_input(spark, sf_dir)
    pooled = pooling.apply_pool(matches, pooling.fit_pool(matches, JOINED))
    rows = [
        F.struct(F.lit(label).alias("class"), F.round(F.sum(f"pooled_{s}"), 0).cast("bigint").alias("matches"))
        for s, label in OUTCOMES.items()
    ]
    return pooled.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


@query
def backtest_report(spark, sf_dir):
    matches = binding.matches(spark, sf_dir)
    return backtest.run_backtest(matches, LEAGUES, binding.CUTOFF, "match_date").report()


@query
def rolling_origin(spark, sf_dir):
    judged = backtest.rolling_origins(binding.matches(spark, sf_dir), binding.ORIGINS, "match_date")
    return _rounded(judged, 6, ["brier_crowd", "brier_calibrated", "gain"])


ORIGIN_PAIRS = [
    ("even", "crowd"),
    ("crowd", "calibrated"),
    ("calibrated", "elo"),
    ("calibrated", "halves"),
    ("calibrated", "best_mix"),
]


@query
def rolling_pairs(spark, sf_dir):
    """All forecasts that need no solver, learned anew per origin, and how stable their gains are."""
    rated = _expected_in_place(binding.matches(spark, sf_dir))
    columns = ["match_id", "match_date", "result", *triple("crowd"), "elo_expected_score"]
    rated = pinned(rated.select(*columns), "rated")
    scored = backtest.rolling_forecasts(rated, binding.ORIGINS, "match_date", pools=False)
    judged = backtest.origin_scores(pinned(scored, "scored"), ORIGIN_PAIRS)
    numbers = ["mean_difference", "standard_error", "ci_low", "ci_high"]
    return _rounded(_rounded(judged, 7, numbers), 4, ["t_statistic"]).drop("verdict")


@query
def simultaneous_limits(spark, sf_dir):
    """Limits that hold for all pairs and origins at once, from resamples drawn by a hash."""
    day = F.col("match_date")
    origin = F.array_max(F.filter(F.lit(binding.ORIGINS), lambda o: F.to_date(o) <= day))
    matches = judging.with_even_forecast(binding.matches(spark, sf_dir)).withColumn("origin", origin)
    judged = judging.simultaneous_scores(matches.filter(F.col("origin").isNotNull()), PAIRS, ("origin",), draws=64)
    numbers = ["mean_difference", "standard_error", "ci_low", "ci_high"]
    return _rounded(_rounded(judged, 7, numbers), 4, ["critical", "t_statistic"])
