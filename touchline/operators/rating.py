"""Pre-match Elo ratings: a chronological fold over all matches that can influence one another.

A rating depends on every earlier match of both sides, but on no match of teams that are
linked to neither. The matches are therefore split into the connected components of the
graph of teams, which are folded in parallel, each in time order within one task. A task folds
all its components together: match by match where its teams are few, else level by level, as the
matches that are next for both of their sides do not touch each other and are rated as arrays.

A component is sequential by nature. So that no task and no retry folds more than about
``task_rows`` rows of one, the matches are cut into as many time slices as the largest component
needs, one in most cases. Slices are folded in turn, the components of each in parallel; the
ratings between them are a written table. The result is that of one fold over everything.

Teams are grouped by hashes of their names: should two names share one, their components are folded
as one, with the same ratings. Tables of teams are broadcast only up to ``BROADCAST_TEAMS`` rows, so
what passes the driver does not grow with the teams.

Limit: where all teams are linked, as in one league system, a slice is one task's work.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import HOME_BONUS, points
from touchline.operators.components import connected_components
from touchline.sources.workspace import pinned

# Fixed values of the rating system.
START_RATING = 1500.0
STEP = 20.0

TASK_ROWS = 2_000_000

#: Rows of a table of teams up to which it is sent to every executor: some 10 MB.
BROADCAST_TEAMS = 100_000

#: Teams of a block up to which its levels are so narrow that arrays do not pay.
FEW_TEAMS = 10_000

CARRIED = ["home_team", "away_team"]


def levels(home: np.ndarray, away: np.ndarray) -> Iterator[np.ndarray]:
    """The matches, as positions in time order, level by level: a match's level is one more than
    that of the last match before it of either side, so no team plays twice in a level.

    Each round takes the matches that are next for both sides; only teams that have just played
    can bring up a new one, so all rounds together look at every match twice.
    """
    n, alone = len(home), home == away
    team = np.concatenate([home, away[~alone]])
    match = np.concatenate([np.arange(n), np.flatnonzero(~alone)])
    order = np.lexsort((match, team))
    team, match = team[order], match[order]
    teams = int(team.max(initial=-1)) + 1
    # Past a team's last match stands n, which is next for nobody.
    ends = np.cumsum(np.bincount(team, minlength=teams) + 1) - 1
    queue = np.full(len(match) + teams, n)
    queue[np.arange(len(match)) + team] = match
    at = np.concatenate(([0], ends[:-1] + 1)) if teams else ends
    next_ = queue[at] if teams else at
    home, away = np.append(home, 0), np.append(away, 0)
    moved = np.arange(teams)
    while len(moved):
        found = next_[moved]
        found = found[found < n]
        ready = np.unique(found[(next_[home[found]] == found) & (next_[away[found]] == found)])
        if len(ready):
            yield ready
        moved = np.unique(np.concatenate([home[ready], away[ready]]))
        at[moved] += 1
        next_[moved] = queue[at[moved]]


def _one_by_one(home, away, took, ratings, step: float, home_bonus: float):
    """The ratings of both sides before and after every match, in time order; ``ratings`` is brought up to date."""
    current = ratings.tolist()
    before, after = [], []
    for i, j, points_taken in zip(home.tolist(), away.tolist(), took.tolist()):
        h, a = current[i], current[j]
        before.append((h, a))
        if points_taken == points_taken:  # else a match without result
            shift = step * (points_taken - 1.0 / (1.0 + 10.0 ** ((a - h - home_bonus) / 400.0)))
            h, a = h + shift, a - shift
            current[i] = h
            current[j] = a
        after.append((h, a))
    ratings[:] = current
    return np.array(before).T, np.array(after).T


def _by_level(home, away, took, ratings, step: float, home_bonus: float):
    """The same, level by level."""
    before, after = np.empty((2, len(home))), np.empty((2, len(home)))
    for level in levels(home, away):
        h, a = ratings[home[level]], ratings[away[level]]
        before[:, level] = h, a
        shift = step * (took[level] - 1.0 / (1.0 + 10.0 ** ((a - h - home_bonus) / 400.0)))
        shift = np.where(np.isnan(shift), 0.0, shift)  # a match without result
        h, a = h + shift, a - shift
        ratings[home[level]] = h
        ratings[away[level]] = a
        after[:, level] = h, a
    return before, after


def _fold(step: float, home_bonus: float, rows_at_once: int = 200_000, few_teams: int = FEW_TEAMS):
    """The fold over the Arrow batches of one task, in blocks of rows. Between blocks only current
    ratings are kept. A team's first rating is the one its row brings along; the ratings after a
    match and its place in the task's order are given too."""
    current: dict = {}

    def rated(block, first):
        n = len(block)
        codes, names = pd.factorize(pd.concat([block["home_team"], block["away_team"]]), use_na_sentinel=False)
        names = np.where(pd.isna(names), None, names).tolist()
        starts = np.empty(len(names))
        starts[codes] = np.concatenate([block["home_start"], block["away_start"]])
        ratings = np.array([current.get(name, start) for name, start in zip(names, starts)])
        run = _one_by_one if len(names) <= few_teams else _by_level
        before, after = run(codes[:n], codes[n:], block["points"].to_numpy(float), ratings, step, home_bonus)
        current.update(zip(names, ratings.tolist()))
        done = block[["match_id", *CARRIED]]
        return done.assign(
            elo_home=before[0], elo_away=before[1], home_after=after[0], away_after=after[1], place=np.arange(first, first + n)
        )

    def fold(batches):
        current.clear()
        held, rows, first = [], 0, 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= rows_at_once:
                yield rated(pd.concat(held, ignore_index=True), first)
                held, rows, first = [], 0, first + rows
        if rows:
            yield rated(pd.concat(held, ignore_index=True), first)

    return fold


def _time_order() -> list[Column]:
    """By start and id. The row number keeps the order of rows that share both, and lets
    slices be cut between them, however many there are."""
    return [F.asc_nulls_last("match_start"), F.asc("match_id"), F.asc("row")]


def _folded(part: DataFrame, step: float, home_bonus: float) -> DataFrame:
    """Fold every component of ``part`` in time order. The number of tasks is set, as adaptive
    execution would put rows that are few into a single task, however long they take."""
    tasks = int(part.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = part.repartition(tasks, "component").sortWithinPartitions(*_time_order())
    kept = ["match_id", *CARRIED]
    schema = [f"{name} {part.schema[name].dataType.simpleString()}" for name in kept]
    schema += [f"{name} double" for name in ("elo_home", "elo_away", "home_after", "away_after")]
    asked = ordered.select(*kept, "points", "home_start", "away_start")
    return asked.mapInPandas(_fold(step, home_bonus), ", ".join([*schema, "place long"]))


def _sized(teams: DataFrame, rows: int) -> DataFrame:
    """A written table of teams, marked for how a join should reach it: what is broadcast passes
    the driver, and Spark would judge by the size of the compressed files."""
    return F.broadcast(teams) if rows <= BROADCAST_TEAMS else teams.hint("merge")


def _by_component(matches: DataFrame) -> tuple[DataFrame, int]:
    """What the fold needs of every match, with the component of its teams, and the matches of the
    largest component."""
    log = matches.select(
        "match_id",
        "match_start",
        "home_team",
        "away_team",
        points(F.col("result")).alias("points"),
        F.monotonically_increasing_id().alias("row"),
        _node("home_team").alias("node"),
        _node("away_team").alias("other"),
    )
    log = pinned(log, "log")
    teams = pinned(connected_components(log.select(F.col("node").alias("left"), F.col("other").alias("right"))), "teams")
    teams = _sized(teams, teams.count())
    sizes = log.groupBy("node").count().join(teams, "node").groupBy("component").agg(F.sum("count").alias("rows"))
    largest = sizes.agg(F.max("rows")).first()[0] or 0
    return log.drop("other").join(teams, "node").drop("node"), largest


def rate_matches(
    matches: DataFrame,
    start_rating: float = START_RATING,
    step: float = STEP,
    home_bonus: float = HOME_BONUS,
    task_rows: int = TASK_ROWS,
) -> DataFrame:
    """``(match_id, elo_home, elo_away)``: both ratings as they stood before every match.

    Unplayed matches are rated and change nothing.
    """
    log, largest = _by_component(matches)
    slices = max(1, math.ceil(largest / task_rows))
    if slices > 1:
        cut = log.repartitionByRange(slices, *_time_order()).withColumn("slice", F.spark_partition_id())
        log = pinned(cut, "slices")
    ratings, folded = None, []
    for turn in range(slices):
        part = log.filter(F.col("slice") == turn).drop("slice") if slices > 1 else log
        done = _folded(_with_start(part, ratings, start_rating), step, home_bonus)
        if slices > 1:
            done = pinned(done, "rated")
            if turn < slices - 1:
                ratings = pinned(_ratings_after(done, ratings), "state")
        folded.append(done.select("match_id", "elo_home", "elo_away"))
    return reduce(DataFrame.unionAll, folded)


def _node(side: str) -> Column:
    """A team as a graph node. A missing name is a node too; teams that share a node only share
    a group."""
    return F.xxhash64(F.coalesce(F.col(side), F.lit("")))


def _with_start(part: DataFrame, ratings: DataFrame | None, start_rating: float) -> DataFrame:
    """Add the rating of both sides at the start of the slice."""
    fresh = F.lit(float(start_rating))
    if ratings is not None:
        ratings = _sized(ratings, ratings.count())
    for side in ("home", "away"):
        if ratings is None:
            part = part.withColumn(f"{side}_start", fresh)
            continue
        known = ratings.select(F.col("team").alias("__team"), F.col("rating").alias("__rating"))
        part = (
            part.join(known, F.col(f"{side}_team").eqNullSafe(F.col("__team")), "left")
            .withColumn(f"{side}_start", F.coalesce("__rating", fresh))
            .drop("__team", "__rating")
        )
    return part


def _ratings_after(folded: DataFrame, ratings: DataFrame | None) -> DataFrame:
    """``(team, rating)`` after a slice: the last rating of its teams, the rest unchanged."""
    sides = [
        F.struct(
            F.col(f"{side}_team").alias("team"),
            F.col(f"{side}_after").alias("rating"),
            (F.col("place") * 2 + rank).alias("moment"),
        )
        for rank, side in enumerate(("home", "away"))
    ]
    # All matches of a team are in one task, so their places tell which was last.
    last = folded.select(F.inline(F.array(*sides))).groupBy("team").agg(F.max_by("rating", "moment").alias("rating"))
    if ratings is None:
        return last
    old = ratings.select(F.col("team").alias("__team"), F.col("rating").alias("__rating"))
    return old.join(last, F.col("__team").eqNullSafe(F.col("team")), "full_outer").select(
        F.coalesce("team", "__team").alias("team"),
        F.coalesce("rating", "__rating").alias("rating"),
    )
