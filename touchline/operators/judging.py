"""Scoring forecasts against results."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions import OUTCOMES, SUFFIXES, brier, occurred
from touchline.operators.relational import played

# Fixed value: half-width of a 95 % interval in standard errors.
Z95 = 1.96


def with_even_forecast(df: DataFrame, prefix: str = "even") -> DataFrame:
    """The forecast that knows nothing; it scores two ninths whatever happens."""
    return df.withColumns({f"{prefix}_{s}": F.lit(1.0) / F.lit(3.0) for s in SUFFIXES})


def pooled_brier(df: DataFrame, prefixes: list[str]) -> DataFrame:
    """Mean Brier score of every forecast as ``(forecast, brier)`` rows, from one pass."""
    scores = played(df).agg(*[F.avg(brier(p)).alias(p) for p in prefixes])
    rows = [F.struct(F.lit(p).alias("forecast"), F.col(p).alias("brier")) for p in prefixes]
    return scores.select(F.inline(F.array(*rows)))


def verdict(ci_low: Column, ci_high: Column) -> Column:
    """An interval that is missing or holds zero settles nothing."""
    better = F.when(ci_low > 0, "better").when(ci_high < 0, "worse")
    return better.otherwise("no measurable difference")


def paired_scores(df: DataFrame, pairs: list[tuple[str, str]], by: tuple[str, ...] = ()) -> DataFrame:
    """Compare forecasts match by match: one row per ``(baseline, candidate)`` pair, and per
    value of the columns ``by`` if any are named.

    Positive means that the candidate did better. All pairs share one pass.
    """
    gains = {
        f"{i}": brier(baseline) - brier(candidate) for i, (baseline, candidate) in enumerate(pairs)
    }
    sums = played(df).groupBy(*by).agg(
        *[F.avg(g).alias(f"mean_{i}") for i, g in gains.items()],
        *[F.stddev_samp(g).alias(f"sd_{i}") for i, g in gains.items()],
        *[F.count(g).alias(f"n_{i}") for i, g in gains.items()],
    )
    rows = [
        F.struct(
            F.lit(baseline).alias("baseline"),
            F.lit(candidate).alias("candidate"),
            F.col(f"mean_{i}").alias("mean_difference"),
            F.col(f"sd_{i}").alias("sd"),
            F.col(f"n_{i}").alias("n"),
        )
        for i, (baseline, candidate) in enumerate(pairs)
    ]
    error = F.when(F.col("sd") > 0, F.col("sd") / F.sqrt("n"))
    return _with_limits(sums.select(*by, F.inline(F.array(*rows))).withColumn("standard_error", error))


def _with_limits(pairs: DataFrame, width: Column | None = None) -> DataFrame:
    """The limits at ``width`` standard errors around the mean difference, and what they say."""
    mean, reach = F.col("mean_difference"), (F.lit(Z95) if width is None else width) * F.col("standard_error")
    limits = {"t_statistic": mean / F.col("standard_error"), "ci_low": mean - reach, "ci_high": mean + reach}
    return pairs.withColumns(limits).withColumn("verdict", verdict(F.col("ci_low"), F.col("ci_high")))


def clustered_scores(df: DataFrame, pairs: list[tuple[str, str]], cluster: str) -> DataFrame:
    """The paired comparison of all matches together, with an error that lets the matches of a
    ``cluster`` share what went right or wrong: what a cluster's sum differs from its expectation
    counts as one deviation. One cluster alone has no error and settles nothing; with few
    clusters the normal limits are too narrow, which ``clusters`` shows.
    """
    gains = {f"{i}": brier(b) - brier(c) for i, (b, c) in enumerate(pairs)}
    sums = played(df).groupBy(cluster).agg(
        *[F.coalesce(F.sum(g), F.lit(0.0)).alias(f"total_{i}") for i, g in gains.items()],
        *[F.count(g).alias(f"n_{i}") for i, g in gains.items()],
    )
    rows = [
        F.struct(F.lit(b).alias("baseline"), F.lit(c).alias("candidate"), F.col(f"total_{i}").alias("total"), F.col(f"n_{i}").alias("n"))
        for i, (b, c) in enumerate(pairs)
    ]
    keys = ["baseline", "candidate"]
    # A row per pair and cluster reaches the window.
    pair = Window.partitionBy(*keys)
    each = sums.select(F.inline(F.array(*rows))).filter("n > 0")
    each = each.withColumn("mean_difference", F.sum("total").over(pair) / F.sum("n").over(pair))
    deviation = F.col("total") - F.col("mean_difference") * F.col("n")
    pooled = each.groupBy(*keys).agg(
        F.first("mean_difference").alias("mean_difference"),
        F.sum("n").alias("n"),
        F.count("*").alias("clusters"),
        F.sum(deviation * deviation).alias("squares"),
    )
    groups = F.col("clusters")
    error = F.when(groups > 1, F.sqrt(groups / (groups - 1) * F.col("squares")) / F.col("n"))
    pooled = pooled.withColumn("standard_error", F.when(error > 0, error)).drop("squares")
    return _with_limits(pooled)


def poisson_limits() -> list[int]:
    """Of 65,536 equally likely numbers, how many give a Poisson count of mean 1 up to 0, 1, ... 7."""
    shares = [math.exp(-1) / math.factorial(k) for k in range(8)]
    return [math.floor(65536 * sum(shares[: k + 1])) for k in range(8)]


def resampling_weights(key: Column, draws: int) -> Column:
    """How often a row is in each of ``draws`` resamples: an array of Poisson counts, which depend
    on the row's key alone, so that a task that is repeated draws the same."""
    limits = poisson_limits()
    digests = [F.md5(F.concat_ws("|", key.cast("string"), F.lit(str(block)))) for block in range(-(-draws // 8))]

    def numbers(digest: Column) -> Column:
        return F.array(*[F.conv(F.substring(digest, 4 * place + 1, 4), 16, 10).cast("int") for place in range(8)])

    def count(number: Column) -> Column:
        return reduce(Column.__add__, [(number >= limit).cast("int") for limit in limits])

    return F.transform(F.flatten(F.transform(F.array(*digests), numbers)), count)


def simultaneous_scores(
    df: DataFrame, pairs: list[tuple[str, str]], by: tuple[str, ...], key: str = "match_id", draws: int = 200, level: float = 0.95
) -> DataFrame:
    """The paired comparison per value of ``by``, with limits that hold for all rows at once.

    Looking at many pairs and origins, one of the usual limits will exclude zero by chance. Here
    the matches are resampled ``draws`` times by Poisson counts; in each resample the largest
    deviation of any row, in standard errors, is taken, and ``critical`` is what a share ``level`` of
    them does not exceed. The resamples are sums over one pass; a map task hands on a
    row per value of ``by`` and draw.
    """
    if draws % 8:
        raise ValueError("draws come in eights")
    cells = paired_scores(df, pairs, by).drop("t_statistic", "ci_low", "ci_high", "verdict", "sd")
    gains = {f"{i}": brier(b) - brier(c) for i, (b, c) in enumerate(pairs)}
    drawn = played(df).select(
        *by, *[g.alias(f"gain_{i}") for i, g in gains.items()], F.posexplode(resampling_weights(F.col(key), draws)).alias("draw", "times")
    )
    sums = drawn.filter("times > 0").groupBy(*by, "draw").agg(
        *[F.sum(F.col("times") * F.col(f"gain_{i}")).alias(f"total_{i}") for i in gains],
        *[F.sum(F.when(F.col(f"gain_{i}").isNotNull(), F.col("times"))).alias(f"n_{i}") for i in gains],
    )
    rows = [
        F.struct(F.lit(b).alias("baseline"), F.lit(c).alias("candidate"), (F.col(f"total_{i}") / F.col(f"n_{i}")).alias("redrawn"))
        for i, (b, c) in enumerate(pairs)
    ]
    redrawn = sums.select(*by, "draw", F.inline(F.array(*rows)))
    apart = F.abs(F.col("redrawn") - F.col("mean_difference")) / F.col("standard_error")
    largest = redrawn.join(cells, [*by, "baseline", "candidate"]).groupBy("draw").agg(F.max(apart).alias("largest"))
    critical = largest.agg(F.expr(f"percentile_disc({level}) WITHIN GROUP (ORDER BY largest)").alias("critical"))
    return _with_limits(cells.withColumn("critical", critical.scalar()), F.col("critical"))


def blend_weights(df: DataFrame, left: str, right: str, steps: int = 21) -> DataFrame:
    """The mean Brier score of every weight from 0 to 1 in ``steps`` even steps.

    A blend's squared error is a quadratic in the weight, so three averages over the
    matches give every step; the rows are not repeated per weight. Matches that lack a
    probability or a result are left out.
    """
    names = [f"{side}_{s}" for side in (left, right) for s in SUFFIXES]
    gap, miss = {}, {}
    for s, label in OUTCOMES.items():
        gap[s] = F.col(f"{left}_{s}") - F.col(f"{right}_{s}")
        miss[s] = F.col(f"{right}_{s}") - occurred(label)

    def mean_of(term) -> Column:
        return F.avg(term("1") + term("x") + term("2")) / F.lit(3.0)

    curve = (
        played(df)
        .dropna(subset=names)
        .agg(
            mean_of(lambda s: gap[s] * gap[s]).alias("bend"),
            mean_of(lambda s: gap[s] * miss[s]).alias("slope"),
            mean_of(lambda s: miss[s] * miss[s]).alias("base"),
        )
        .filter(F.col("base").isNotNull())
    )
    step = F.explode(F.sequence(F.lit(0), F.lit(steps - 1)))
    grid = curve.select("*", step.alias("step"))
    weight = F.col("step") / F.lit(steps - 1)
    score = F.col("bend") * weight * weight + F.lit(2.0) * F.col("slope") * weight + F.col("base")
    return grid.select(weight.alias("weight"), score.alias("brier"))


def best_blend_weight(df: DataFrame, left: str, right: str, steps: int = 21) -> DataFrame:
    """The weight of ``left`` with the lowest score; the smallest such weight on a tie.

    Choose it on the training half only.
    """
    return blend_weights(df, left, right, steps).orderBy("brier", "weight").limit(1)


def describe(matches: DataFrame, start: str = "match_start") -> DataFrame:
    """Number of played matches, first and last day."""
    return played(matches).agg(
        F.count("*").alias("matches"),
        F.min(F.to_date(start)).alias("first_day"),
        F.max(F.to_date(start)).alias("last_day"),
    )


def describe_split(matches: DataFrame, cutoff: str, start: str = "match_start") -> DataFrame:
    """The same for either side of the cutoff, with its share of the played matches."""
    day = F.to_date(start)
    part = F.when(day < F.to_date(F.lit(cutoff)), "train").otherwise("test")
    counts = (
        played(matches)
        .filter(day.isNotNull())
        .groupBy(part.alias("part"))
        .agg(
            F.count("*").alias("matches"),
            F.min(day).alias("first_day"),
            F.max(day).alias("last_day"),
        )
    )
    # Two rows at most reach this window.
    total = F.sum("matches").over(Window.partitionBy(F.lit(0)))
    return counts.withColumn("share", F.col("matches") / total)
