"""Parsing and arithmetic on probability columns."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# The bounds that keep a log-odds finite.
EDGE = 1e-6


def decimal_comma(text: Column) -> Column:
    """Read ``1,50`` or ``1.50``, quoted or bare, as a double; anything else is NULL."""
    return F.translate(text.cast("string"), ",", ".").try_cast("double")


def percent(text: Column) -> Column:
    """Read a percentage such as ``45,00`` as a fraction."""
    return decimal_comma(text) / F.lit(100)


def clip(value: Column, low: float, high: float) -> Column:
    """Limit to ``[low, high]``. greatest/least skip NULLs, so NULL is kept by hand."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def log_odds(probability: Column) -> Column:
    p = clip(probability, EDGE, 1.0 - EDGE)
    return F.log(p / (F.lit(1.0) - p))


def spread(probabilities: list[Column]) -> Column:
    """Entropy of a forecast over its largest possible value: 1 means no opinion."""
    parts = [clip(p, EDGE, 1.0) for p in probabilities]
    total = parts[0] * F.log(parts[0])
    for p in parts[1:]:
        total = total + p * F.log(p)
    return -total / F.lit(math.log(len(parts)))
