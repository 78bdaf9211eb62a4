"""The three-way outcome: labels, column triples and the Brier score."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# Column suffix -> value found in ``result``.
OUTCOMES = {"1": "1", "x": "X", "2": "2"}
SUFFIXES = tuple(OUTCOMES)
LABELS = tuple(OUTCOMES.values())


def triple(prefix: str) -> list[str]:
    """The three column names of a forecast."""
    return [f"{prefix}_{suffix}" for suffix in SUFFIXES]


def result_label(home_goals: Column, away_goals: Column) -> Column:
    """``1``, ``X`` or ``2``; NULL goals match no branch, so an unplayed match stays NULL."""
    return F.when(home_goals > away_goals, "1").when(home_goals < away_goals, "2").when(home_goals == away_goals, "X")


def occurred(label: str) -> Column:
    """1.0 or 0.0, and NULL where the match has no result."""
    return (F.col("result") == label).cast("double")


def brier(prefix: str) -> Column:
    """Mean squared error of one match's three probabilities."""
    errors = [
        F.pow(F.col(f"{prefix}_{suffix}") - occurred(label), 2)
        for suffix, label in OUTCOMES.items()
    ]
    return reduce(add, errors) / F.lit(float(len(errors)))
