"""Comparisons over several origins: clustered errors, limits for all at once, refits per origin."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline import binding
from touchline.functions import expected_score, triple
from touchline.operators import judging
from touchline.plans import backtest

FOLDER = "/root/testdata/sf0.001"
PAIRS = [("crowd", "odds"), ("odds", "crowd"), ("crowd", "crowd")]
COLUMNS = "match_id long, origin string, result string, crowd_1 double, crowd_x double, crowd_2 double, odds_1 double, odds_x double, odds_2 double"


def made(seed=5, n=300):
    random = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        a, b = random.dirichlet([2, 1, 1]), random.dirichlet([2, 1, 1])
        result = [*"1X2", None][random.choice(4, p=[0.4, 0.3, 0.2, 0.1])]
        rows.append((i, "abc"[i % 7 % 3], result, *map(float, a), *(map(float, b) if i % 11 else (None, None, None))))
    return rows


def gains(rows):
    out = []
    for row in rows:
        if row[2] is not None and row[6] is not None:
            hit = np.array([row[2] == v for v in "1X2"], dtype=float)
            out.append((row[0], row[1], (((np.array(row[3:6]) - hit) ** 2) - (np.array(row[6:9]) - hit) ** 2).mean()))
    return out


def test_clustered_error(spark):
    rows = made()
    got = {(r.baseline, r.candidate): r for r in judging.clustered_scores(spark.createDataFrame(rows, COLUMNS), PAIRS, "origin").collect()}
    values = gains(rows)
    mean = np.mean([g for _, _, g in values])
    sums = [sum(g - mean for _, o, g in values if o == origin) for origin in "abc"]
    error = math.sqrt(3 / 2 * sum(s * s for s in sums)) / len(values)
    row = got["crowd", "odds"]
    assert (row.n, row.clusters) == (len(values), 3)
    assert row.mean_difference == pytest.approx(mean) and row.standard_error == pytest.approx(error)
    assert row.ci_high == pytest.approx(mean + 1.96 * error)
    assert got["odds", "crowd"].mean_difference == pytest.approx(-mean)
    # a forecast against itself has no error
    assert got["crowd", "crowd"].standard_error is None and got["crowd", "crowd"].verdict == "no measurable difference"


def test_one_cluster_and_no_rows_settle_nothing(spark):
    rows = [(i, "a", *rest) for i, _, *rest in made()]
    row = judging.clustered_scores(spark.createDataFrame(rows, COLUMNS), PAIRS[:1], "origin").first()
    assert row.clusters == 1 and row.standard_error is None and row.verdict == "no measurable difference"
    empty = spark.createDataFrame([], COLUMNS)
    assert judging.clustered_scores(empty, PAIRS, "origin").count() == 0
    assert judging.simultaneous_scores(empty, PAIRS, ("origin",), draws=8).count() == 0


def test_limits_for_all_rows_at_once(spark):
    rows, draws = made(), 40
    judged = judging.simultaneous_scores(spark.createDataFrame(rows, COLUMNS), PAIRS, ("origin",), draws=draws, level=0.9)
    got = {(r.origin, r.baseline, r.candidate): r for r in judged.collect()}
    assert len(got) == 9
    limits = judging.poisson_limits()

    def times(i, draw):
        digest = hashlib.md5(f"{i}|{draw // 8}".encode()).hexdigest()
        return sum(int(digest[draw % 8 * 4 : draw % 8 * 4 + 4], 16) >= limit for limit in limits)

    values = gains(rows)
    largest = []
    for draw in range(draws):
        found = []
        for origin in "abc":
            here = np.array([g for _, o, g in values if o == origin])
            counts = np.array([times(i, draw) for i, o, _ in values if o == origin])
            found.append(abs((here * counts).sum() / counts.sum() - here.mean()) / (here.std(ddof=1) / math.sqrt(len(here))))
        largest.append(max(found))
    critical = sorted(largest)[math.ceil(0.9 * draws) - 1]
    for (origin, baseline, candidate), row in got.items():
        assert row.critical == pytest.approx(critical)
        if baseline == candidate:
            assert row.standard_error is None and row.verdict == "no measurable difference"
        else:
            assert row.ci_high - row.ci_low == pytest.approx(2 * critical * row.standard_error)
    assert critical > 1.7


def test_resampling_counts_are_poisson(spark):
    drawn = spark.range(4000).select(F.explode(judging.resampling_weights(F.col("id"), 16)).alias("w"))
    counts = {r.w: r["count"] for r in drawn.groupBy("w").count().collect()}
    total = sum(counts.values())
    assert total == 4000 * 16
    for k in range(4):
        assert counts[k] / total == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.01)
    with pytest.raises(ValueError, match="eights"):
        judging.simultaneous_scores(spark.createDataFrame([], COLUMNS), PAIRS, (), draws=10)


def test_rolling_forecasts_learn_from_the_past_alone(spark):
    matches = binding.matches(spark, FOLDER)
    expected = expected_score(1400.0 + F.col("match_id") * 37 % 200, 1400.0 + F.col("match_id") * 53 % 200)
    rated = matches.select("match_id", "match_date", "result", *triple("crowd"), expected.alias("elo_expected_score"))
    origins = ["1998-07-01", "1999-07-01"]
    scored = backtest.rolling_forecasts(rated, origins, "match_date")
    days = {r.origin: (r.first, r.last) for r in scored.groupBy("origin").agg(
        F.min(F.col("match_date").cast("string")).alias("first"), F.max(F.col("match_date").cast("string")).alias("last")
    ).collect()}
    assert origins[0] <= days[origins[0]][0] <= days[origins[0]][1] < origins[1] <= days[origins[1]][0]
    assert scored.count() == matches.filter(F.col("result").isNotNull() & (F.col("match_date") >= origins[0])).count()
    for name in backtest.FORECASTS:
        assert set(triple(name)) <= set(scored.columns)
    # other results from the second origin on change no forecast
    other = rated.withColumn("result", F.when((F.col("match_date") >= origins[1]) & F.col("result").isNotNull(), "X").otherwise(F.col("result")))
    names = [*triple("calibrated"), *triple("best_mix"), *triple("pool_by_odds")]
    first = {r.match_id: r for r in scored.select("match_id", *names).collect()}
    again = {r.match_id: r for r in backtest.rolling_forecasts(other, origins, "match_date").select("match_id", *names).collect()}
    assert first.keys() == again.keys()
    for i, row in first.items():
        assert [row[n] for n in names] == pytest.approx([again[i][n] for n in names], abs=1e-6, nan_ok=True)
    judged = {(r.origin, r.baseline, r.candidate): r for r in backtest.origin_scores(scored, backtest.PAIRS).collect()}
    assert len(judged) == 3 * len(backtest.PAIRS)
    for b, c in backtest.PAIRS:
        assert judged["all", b, c].n == sum(judged[o, b, c].n for o in origins) and judged["all", b, c].clusters == 2
