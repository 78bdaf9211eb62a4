"""Out-of-sample evaluation: rate, split by time, fit on the past, judge on the rest."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import brier, expected_score, triple
from touchline.operators.calibration import (
    Curves,
    calibrate,
    fit_crowd_curves,
    fit_rating_curves,
    rating_probabilities,
)
from touchline.operators.judging import (
    best_blend_weight,
    clustered_scores,
    describe,
    describe_split,
    paired_scores,
    pooled_brier,
    with_even_forecast,
)
from touchline.operators.parallel import together
from touchline.operators.pooling import Pool, apply_pool, fit_pool, pool_coefficients
from touchline.operators.rating import rate_matches
from touchline.operators.relational import mixed, scope_to, with_part
from touchline.plans.dimensions import LEAGUE_COUNTRY
from touchline.sources.workspace import pinned

# Fixed value: the day from which matches are judged.
CUTOFF = "2023-07-01"
FORECASTS = ["even", "crowd", "calibrated", "elo", "halves", "best_mix", "pool", "pool_by_odds"]
PAIRS = [
    ("crowd", "calibrated"),
    ("calibrated", "elo"),
    ("calibrated", "halves"),
    ("calibrated", "best_mix"),
    ("calibrated", "pool"),
    ("calibrated", "pool_by_odds"),
]


@dataclass(frozen=True)
class Backtest:
    """The frames of one evaluation."""

    everything: DataFrame
    split: DataFrame
    scored: DataFrame
    briers: DataFrame
    pairs: DataFrame
    weight: float
    coefficients: DataFrame

    def report(self) -> DataFrame:
        """All numbers as ``(section, item, metric, value)`` rows. Days count from 1970-01-01; a
        verdict is 1 for better, -1 for worse and 0 where no difference was measurable."""
        parts = self.everything.withColumn("part", F.lit("all")).unionByName(self.split, True)
        parts = parts.withColumns({day: F.unix_date(day) for day in ("first_day", "last_day")})
        side = F.when(F.col("verdict") == "better", 1).when(F.col("verdict") == "worse", -1).otherwise(0)
        sections = [
            _long("split", parts, F.col("part"), ["matches", "share", "first_day", "last_day"]),
            _long("brier", self.briers, F.col("forecast"), ["brier"]),
            _long(
                "paired",
                self.pairs.withColumn("verdict", side),
                F.concat_ws(" vs ", "candidate", "baseline"),
                ["mean_difference", "standard_error", "t_statistic", "ci_low", "ci_high", "n", "verdict"],
            ),
            _long("coefficient", self.coefficients, F.col("item"), ["influence"]),
            self.briers.sparkSession.createDataFrame(
                [("blend", "calibrated", "weight", self.weight)],
                "section string, item string, metric string, value double",
            ),
        ]
        out = sections[0]
        for section in sections[1:]:
            out = out.unionByName(section)
        return out


def _long(section: str, df: DataFrame, item, metrics: list[str]) -> DataFrame:
    rows = [
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics
    ]
    return df.select(
        F.lit(section).alias("section"), item.alias("item"), F.inline(F.array(*rows))
    )


@dataclass(frozen=True)
class Forecasts:
    """What was learned from the matches before a day. Without pools, their forecasts are left out."""

    crowd_curves: Curves
    rating_curves: Curves
    weight: float
    pool: Pool | None
    pool_by_odds: Pool | None

    def apply(self, matches: DataFrame) -> DataFrame:
        """Add every forecast."""
        scored = _from_curves(matches, self.crowd_curves, self.rating_curves)
        scored = mixed(scored, {"calibrated": 0.5, "elo": 0.5}, "halves")
        scored = mixed(scored, {"calibrated": self.weight, "elo": 1 - self.weight}, "best_mix")
        for pool, name in ((self.pool, "pool"), (self.pool_by_odds, "pool_by_odds")):
            scored = scored if pool is None else apply_pool(scored, pool, name)
        return with_even_forecast(scored)


def _from_curves(matches: DataFrame, crowd_curves: Curves, rating_curves: Curves) -> DataFrame:
    return rating_probabilities(calibrate(matches, crowd_curves), rating_curves)


def fit_forecasts(train: DataFrame, pools: bool = True) -> Forecasts:
    """Fit the curves, then on their forecasts, which are written once, the blend weight and the pools."""
    spark = train.sparkSession
    crowd_curves, rating_curves = together(
        spark, lambda: fit_crowd_curves(train), lambda: fit_rating_curves(train)
    )
    trained = pinned(_from_curves(train, crowd_curves, rating_curves), "trained")
    fits = [lambda: best_blend_weight(trained, "calibrated", "elo").first()]
    if pools:
        fits += [lambda: fit_pool(trained), lambda: fit_pool(trained, interaction=True)]
    best, *pooled = together(spark, *fits)
    return Forecasts(crowd_curves, rating_curves, best["weight"], *(pooled or (None, None)))


def run_backtest(
    matches: DataFrame,
    leagues: Iterable[str] = tuple(LEAGUE_COUNTRY),
    cutoff: str = CUTOFF,
    start: str = "match_start",
) -> Backtest:
    """Rate everything, then fit and judge within ``leagues`` only.

    The frames that several fits read are written once: the rated matches, and both halves
    with their forecasts.
    """
    spark = matches.sparkSession
    rated = matches.join(rate_matches(matches), "match_id").withColumn(
        "elo_expected_score", expected_score(F.col("elo_home"), F.col("elo_away"))
    )
    columns = ["match_id", start, "league", "result", "crowd_1", "crowd_x", "crowd_2"]
    rated = pinned(rated.select(*columns, "elo_expected_score"), "rated")
    inside = scope_to(rated, leagues)
    train, test = (with_part(inside, cutoff, start, part) for part in ("train", "test"))

    fitted = fit_forecasts(train)
    scored = pinned(fitted.apply(test), "scored")

    named = [
        pool_coefficients(spark, p).select(
            F.concat_ws(" ", F.lit(kind), "source").alias("item"), "influence"
        )
        for kind, p in (("additive", fitted.pool), ("interaction", fitted.pool_by_odds))
    ]
    return Backtest(
        everything=describe(rated, start),
        split=describe_split(inside, cutoff, start),
        scored=scored,
        briers=pooled_brier(scored, FORECASTS),
        pairs=paired_scores(scored, PAIRS),
        weight=fitted.weight,
        coefficients=named[0].unionByName(named[1]),
    )


def rolling_origins(matches: DataFrame, origins: list[str], start: str = "match_start") -> DataFrame:
    """How stable the gain of calibration is: curves are fitted anew before each of ``origins`` and
    judged until the next, the last one until the end.

    One row per origin, ``(origin, matches, brier_crowd, brier_calibrated, gain)``, and one for all
    judged matches together, whose origin is ``all``. The fits run side by side.
    """
    spark = matches.sparkSession
    day = F.to_date(start)
    ends = [*(F.to_date(F.lit(o)) for o in origins[1:]), None]

    def judged(origin: str, end) -> DataFrame:
        known = with_part(matches, origin, start)
        curves = fit_crowd_curves(known.filter("part = 'train'"))
        later = with_part(matches, origin, start, "test")
        later = later if end is None else later.filter(day < end)
        scored = calibrate(later, curves).dropna(subset=[*triple("crowd"), *triple("calibrated")])
        return scored.select(F.lit(origin).alias("origin"), brier("crowd").alias("crowd"), brier("calibrated").alias("calibrated"))

    parts = together(spark, *(lambda o=o, e=e: judged(o, e) for o, e in zip(origins, ends, strict=True)))
    rows = reduce(DataFrame.unionAll, parts)
    listed = rows.withColumn("origin", F.explode(F.array("origin", F.lit("all"))))
    return listed.groupBy("origin").agg(
        F.count("*").alias("matches"),
        F.avg("crowd").alias("brier_crowd"),
        F.avg("calibrated").alias("brier_calibrated"),
        F.avg(F.col("crowd") - F.col("calibrated")).alias("gain"),
    )


def rolling_forecasts(rated: DataFrame, origins: list[str], start: str = "match_start", pools: bool = True) -> DataFrame:
    """Every forecast of the played matches from the first origin on, each learned from the matches
    before the last of ``origins`` that the match does not precede. That day is in ``origin``.

    ``rated`` holds ratings before each match as ``elo_expected_score``; they look at no later match
    and so are the same for all origins. Curves, blend weight and pools are fitted anew per origin,
    side by side. Matches without a day are left out.
    """
    day = F.to_date(start)
    ends = [*(F.to_date(F.lit(o)) for o in origins[1:]), None]

    def judged(origin: str, end: Column | None) -> DataFrame:
        fitted = fit_forecasts(with_part(rated, origin, start, "train"), pools)
        later = with_part(rated, origin, start, "test")
        later = later if end is None else later.filter(day < end)
        return fitted.apply(later).withColumn("origin", F.lit(origin))

    parts = together(rated.sparkSession, *(lambda o=o, e=e: judged(o, e) for o, e in zip(origins, ends, strict=True)))
    return reduce(DataFrame.unionByName, parts)


def origin_scores(scored: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """How stable every comparison is: one row per origin and pair, and one per pair over all
    origins, named ``all``, whose error is clustered by origin."""
    each = paired_scores(scored, pairs, by=("origin",)).drop("sd").withColumn("clusters", F.lit(1).cast("bigint"))
    return each.unionByName(clustered_scores(scored, pairs, "origin").withColumn("origin", F.lit("all")))
