"""Filters, newest-row selection and reshaping."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.functions import LABELS, OUTCOMES, outcome_signal, plain_name, triple


def played(matches: DataFrame) -> DataFrame:
    return matches.filter(F.col("result").isNotNull())


def scope_to(matches: DataFrame, leagues: Iterable[str], loosely: bool = False) -> DataFrame:
    """Keep the named leagues: an exact match of the text, so NULL and other cases drop out.
    ``loosely`` compares plain names instead, which finds spelling variants of a league.

    Apply it after rating, so that matches out of scope still inform the ratings.
    """
    if not loosely:
        return matches.filter(F.col("league").isin(list(leagues)))
    wanted = [plain_name(F.lit(league)) for league in leagues]
    return matches.filter(plain_name(F.col("league")).isin(wanted))


def scope_semi(matches: DataFrame, leagues: DataFrame, loosely: bool = False) -> DataFrame:
    """Keep matches whose league is listed in ``leagues(league_name)``."""
    form = plain_name if loosely else (lambda name: name)
    return matches.join(leagues, form(F.col("league")) == form(F.col("league_name")), "left_semi")


def with_part(matches: DataFrame, cutoff: str, start: str = "match_start", only: str | None = None) -> DataFrame:
    """The played matches, tagged ``train`` before the day ``cutoff`` and ``test`` from then on.

    Matches without a day belong to neither part and drop out. ``only`` one part may be asked
    for: its bound is then a condition on the day, which reaches the scan of a date column; a
    filter on the tag would not. Text has to be read as a date first.
    """
    day, boundary = F.to_date(start), F.to_date(F.lit(cutoff))
    bounds = {"train": day < boundary, "test": day >= boundary, None: day.isNotNull()}
    side = F.when(day < boundary, "train").otherwise("test")
    return played(matches).filter(bounds[only]).withColumn("part", side)


def newest_per(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """One row per key, the first in ``order``.

    Spark limits every key to one row per map task before the shuffle, so a key holding
    a large share of the rows costs its reducer no more than one row per task.
    """
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", ranked).filter("__rank = 1").drop("__rank")


def newest_rounds(events: DataFrame) -> DataFrame:
    """One row per match, as carried by the newest round that holds it."""
    return newest_per(
        events, ["match_id"], F.desc("round_number"), F.asc("event_number")
    )


def inline_relation(spark: SparkSession, rows: Mapping[str, str], columns: tuple[str, str]) -> DataFrame:
    """A lookup as a two-column relation.

    The rows are literals in the plan, so Spark knows how small they are and joins them by
    broadcast. A frame made from driver rows has no known size: the other side, however
    large, would be shuffled or broadcast instead.
    """
    pairs = [
        F.struct(F.lit(key).alias(columns[0]), F.lit(value).alias(columns[1]))
        for key, value in rows.items()
    ]
    return spark.sql("SELECT 1").select(F.inline(F.array(*pairs)))


def _long(matches: DataFrame, chances: Mapping[str, Column], ids: Iterable[str] = ()) -> DataFrame:
    """One row per played match and label, all from one scan: what the label's forecast or
    signal was, and whether it came true."""
    rows = [
        F.struct(
            F.lit(label).alias("outcome"),
            chance.alias("predicted_prob"),
            (F.col("result") == label).alias("actual_occurred"),
        )
        for label, chance in chances.items()
    ]
    return played(matches).select(*ids, F.inline(F.array(*rows)))


def long_outcomes(
    matches: DataFrame,
    prefix: str = "crowd",
    ids: tuple[str, ...] = ("round_number", "event_number", "match_id", "result"),
) -> DataFrame:
    """A forecast's three columns as rows."""
    return _long(matches, {label: F.col(f"{prefix}_{s}") for s, label in OUTCOMES.items()}, ids)


def long_signals(matches: DataFrame, expected: str = "elo_expected_score") -> DataFrame:
    """The ratings' counterpart: the signals that an expected score gives for each label."""
    return _long(matches, {label: outcome_signal(label, F.col(expected)) for label in LABELS})


def normalised(df: DataFrame, prefix: str) -> DataFrame:
    """Scale a triple so that it sums to one; three zeros hold no opinion and become NULL."""
    names = triple(prefix)
    total = F.col(names[0]) + F.col(names[1]) + F.col(names[2])
    return df.withColumns({name: F.try_divide(F.col(name), total) for name in names})


def mixed(df: DataFrame, shares: Mapping[str, float], into: str = "mixed") -> DataFrame:
    """Add a mixture of any number of forecasts: ``shares`` maps their prefixes to weights, which
    have to sum to one. Where one of them is NULL, so is the mixture."""
    if abs(sum(shares.values()) - 1) > 1e-9:
        raise ValueError(f"the shares of a mixture sum to one, not to {sum(shares.values())}")
    return df.withColumns(
        {
            name: reduce(add, [F.col(part) * F.lit(float(share)) for part, share in zip(parts, shares.values(), strict=True)])
            for name, *parts in zip(triple(into), *map(triple, shares), strict=True)
        }
    )
