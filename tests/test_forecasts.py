import random

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchline.functions import expected_score, outcome_signal, triple
from touchline.operators import calibration, components, judging, pooling, rating, relational
from touchline.operators.components import connected_components
from touchline.operators.rating import _fold, levels, rate_matches
from touchline.sources import workspace

LOG = "match_id int, match_start string, home_team string, away_team string, result string"
FEW = settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def plain_ratings(rows):
    """The definition, as a loop."""
    current, out = {}, {}
    took = {"1": 1.0, "X": 0.5, "2": 0.0}
    for match_id, _, home, away, result in sorted(rows, key=lambda r: (r[1], r[0])):
        h, a = current.get(home, 1500.0), current.get(away, 1500.0)
        out[match_id] = (h, a)
        if result in took:
            shift = 20.0 * (took[result] - 1.0 / (1.0 + 10.0 ** ((a - h - 65.0) / 400.0)))
            current[home], current[away] = h + shift, a - shift
    return out


def made_log(seed, matches, teams, hot=0.0):
    rng = random.Random(seed)
    rows = []
    for i in range(matches):
        home, away = rng.sample(range(teams), 2)
        if rng.random() < hot:
            home, away = (0, away or 1)
        day = 1 + i * 300 // matches
        start = f"2024-{1 + day // 28:02d}-{1 + day % 28:02d}"
        names = [None if t == 3 else f"t{t}" for t in (home, away)]
        rows.append((i * 7919 % 104729, start, *names, rng.choice(["1", "X", "2", None, "?"])))
    return rows


def rated(spark, rows, **options):
    df = spark.createDataFrame(rows, LOG).repartition(3)
    return {r.match_id: (r.elo_home, r.elo_away) for r in rate_matches(df, **options).collect()}


def assert_same(actual, expected):
    assert actual.keys() == expected.keys()
    for key, pair in expected.items():
        assert actual[key] == pytest.approx(pair, abs=1e-9)


def test_ratings_start_level_and_are_zero_sum(spark):
    rows = [
        (1, "2024-01-01", "A", "B", "1"),
        (2, "2024-01-02", "A", "B", None),
        (3, "2024-01-03", "B", "A", "X"),
        (4, "2024-01-04", "A", "C", "2"),
    ]
    got = rated(spark, rows)
    assert got[1] == (1500.0, 1500.0) and got[4][1] == 1500.0
    assert got[2][0] > 1500.0 and sum(got[2]) == pytest.approx(3000.0)
    assert got[3] == (got[2][1], got[2][0])  # the unplayed match taught nothing


@pytest.mark.parametrize("seed", [1, 2])
def test_ratings_equal_the_loop(spark, seed):
    rows = made_log(seed, 300, 12)
    assert_same(rated(spark, rows), plain_ratings(rows))


def test_sliced_ratings_equal_the_loop(spark):
    rows = made_log(3, 200, 12, hot=0.3)
    assert_same(rated(spark, rows, task_rows=60), plain_ratings(rows))


@pytest.mark.parametrize("teams, matches", [(2, 40), (3, 1), (7, 200), (60, 500), (1, 5)])
def test_levels_of_matches(teams, matches):
    drawn = np.random.default_rng(teams)
    home, away = drawn.integers(0, teams, (2, matches))
    used, codes = np.unique(np.concatenate([home, away]), return_inverse=True)
    home, away = codes[:matches], codes[matches:]
    last, want = {}, []
    for h, a in zip(home.tolist(), away.tolist()):
        want.append(max(last.get(h, 0), last.get(a, 0)) + 1)
        last[h] = last[a] = want[-1]
    got = np.zeros(matches, dtype=int)
    for number, level in enumerate(levels(home, away), 1):
        assert (got[level] == 0).all()
        got[level] = number
    assert got.tolist() == want


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_fold_in_blocks_equals_the_loop(block):
    rows = sorted(made_log(5, 400, 30), key=lambda r: (r[1], r[0])) + [(1, "2025", "t1", "t1", "1"), (2, "2025", "t1", None, "X")]
    frame = pd.DataFrame(rows, columns=["match_id", "match_start", "home_team", "away_team", "result"])
    frame["points"] = frame["result"].map({"1": 1.0, "X": 0.5, "2": 0.0})
    frame["component"], frame["row"], frame["home_start"], frame["away_start"] = "", range(len(frame)), 1500.0, 1500.0
    done = pd.concat(_fold(20.0, 65.0, block)(frame.iloc[i : i + 5] for i in range(0, len(frame), 5)))
    assert_same({r.match_id: (r.elo_home, r.elo_away) for r in done.itertuples()}, plain_ratings(rows))


@pytest.mark.parametrize("few_teams", [0, 1000])
def test_fold_tells_places_and_last_ratings(few_teams):
    """Few teams or many: the same ratings, and the place tells which of a team's matches was last."""
    rows = sorted(made_log(6, 300, 20), key=lambda r: (r[1], r[0])) + [(1, "2025", "t1", "t1", "1"), (2, "2025", "t1", None, "X")]
    frame = pd.DataFrame(rows, columns=["match_id", "match_start", "home_team", "away_team", "result"])
    frame["points"] = frame["result"].map({"1": 1.0, "X": 0.5, "2": 0.0})
    frame["home_start"], frame["away_start"] = 1500.0, 1500.0
    done = pd.concat(_fold(20.0, 65.0, 70, few_teams)(frame.iloc[i : i + 9] for i in range(0, len(frame), 9)))
    assert done["place"].tolist() == list(range(len(rows)))
    assert_same({r.match_id: (r.elo_home, r.elo_away) for r in done.itertuples()}, plain_ratings(rows))


def test_large_tables_of_teams_are_not_broadcast(spark, monkeypatch):
    """What is broadcast passes the driver, so it must not grow with the teams."""
    rows = made_log(8, 200, 40)
    plans = []

    def pinned(df, name, write=workspace.pinned):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(df, name)

    for module in (rating, components):
        monkeypatch.setattr(module, "pinned", pinned)
    monkeypatch.setattr(rating, "BROADCAST_TEAMS", 0)
    monkeypatch.setattr(rating, "connected_components", lambda pairs: connected_components(pairs, 0))
    df = spark.createDataFrame(rows, LOG).repartition(3)
    done = rate_matches(df, task_rows=60)
    plans.append(done._jdf.queryExecution().executedPlan().toString())
    assert_same({r.match_id: (r.elo_home, r.elo_away) for r in done.collect()}, plain_ratings(rows))
    assert len(plans) > 8 and not [p for p in plans if "BroadcastHashJoin" in p or "BroadcastNestedLoop" in p]


def test_copies_do_not_pile_up_in_a_slice(spark):
    """Rows that share start and id are folded in input order and spread over slices."""
    copies = [(1, "2024-01-01", "A", "B", "1")] * 90
    df = spark.createDataFrame(copies, LOG).coalesce(1)
    one = rate_matches(df).collect()
    sliced = rate_matches(df, task_rows=30)
    assert sorted(one) == sorted(sliced.collect())
    assert max(r.elo_home for r in one) > 1600
    sizes = sliced.groupBy(F.input_file_name()).count().collect()
    assert len(sizes) >= 3 and max(r["count"] for r in sizes) < 60


def test_separate_leagues_equal_the_loop(spark):
    """Many groups of teams that do not meet, some large enough to need several slices."""
    rows = []
    for league in range(12):
        made = made_log(league, 15 + 20 * (league % 3), 6)
        rows += [(i + 200_000 * league, start, *[t and f"{league}{t}" for t in pair], r) for i, start, *pair, r in made]
    for task_rows in (1_000_000, 25):
        assert_same(rated(spark, rows, task_rows=task_rows), plain_ratings(rows))


def test_leagues_are_rated_in_parallel(spark):
    rows = [(i, f"2024-01-{1 + i % 28:02d}", f"{i % 40}a", f"{i % 40}b", "1") for i in range(4000)]
    df = rate_matches(spark.createDataFrame(rows, LOG))
    busy = df.groupBy(F.spark_partition_id().alias("task")).count().collect()
    assert len(busy) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(r["count"] for r in busy) < 2500


def test_components(spark):
    pairs = [("a", "b"), ("b", "c"), ("x", "y"), ("z", "z"), ("c", "a")]
    df = spark.createDataFrame(pairs, "left string, right string")
    got = {r.node: r.component for r in connected_components(df).collect()}
    assert got == {"a": "a", "b": "a", "c": "a", "x": "x", "y": "x", "z": "z"}
    chain = [(f"{i:02d}", f"{i + 1:02d}") for i in range(30)]
    links = spark.createDataFrame(chain, "left string, right string")
    for bound in (0, 1_000_000):
        assert connected_components(links, bound).select("component").distinct().collect() == [("00",)]
        assert {r.node: r.component for r in connected_components(df, bound).collect()} == got
    assert connected_components(df.limit(0)).collect() == []


@FEW
@given(st.floats(800, 2400), st.floats(800, 2400))
def test_expected_score(spark, home, away):
    df = spark.createDataFrame([(home, away)], "h double, a double")
    row = df.select(
        expected_score(F.col("h"), F.col("a")).alias("e"),
        (expected_score(F.col("h"), F.col("a"), 0.0) + expected_score(F.col("a"), F.col("h"), 0.0)).alias("both"),
    ).first()
    assert row.e == pytest.approx(1 / (1 + 10 ** ((away - home - 65) / 400)))
    assert row.both == pytest.approx(1.0)  # on neutral ground the sides share one point


def test_signals(spark):
    grid = [i / 16 for i in range(17)]
    df = spark.createDataFrame([(e,) for e in grid], "e double")
    rows = df.select(*[outcome_signal(v, F.col("e")).alias(v) for v in ("1", "X", "2")]).collect()
    assert [r["1"] for r in rows] == grid and [r["2"] for r in rows] == grid[::-1]
    draws = [r["X"] for r in rows]
    assert draws == draws[::-1] and draws.index(max(draws)) == 8
    assert all(r["X"] == min(r["1"], r["2"]) for r in rows)


def plain_isotonic(x, y):
    """Max over starts of min over ends of segment means, per distinct x."""
    xs = np.unique(x)
    hits = np.array([y[x == v].sum() for v in xs])
    n = np.array([(x == v).sum() for v in xs])
    ch, cn = np.concatenate([[0], hits.cumsum()]), np.concatenate([[0], n.cumsum()])
    with np.errstate(divide="ignore", invalid="ignore"):
        means = (ch[None, 1:] - ch[:-1, None]) / (cn[None, 1:] - cn[:-1, None])
    return xs, np.array([means[: m + 1, m:].min(axis=1).max() for m in range(len(xs))])


def test_curves_equal_the_definition(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.random(60), rng.integers(1, 9, 60) / 10])
    rows = [(v, float(p), bool(rng.random() < p)) for p in x for v in ("1", "X", "2")]
    long = spark.createDataFrame(rows, "outcome string, predicted_prob double, actual_occurred boolean")
    curves = calibration.fit_curves(long)
    asked = np.linspace(-0.1, 1.1, 49)
    df = spark.createDataFrame([(float(v),) * 3 for v in asked], "crowd_1 double, crowd_x double, crowd_2 double")
    scored = calibration.calibrate(df, curves).select(triple("calibrated")).collect()
    got = np.array([tuple(r) for r in scored], dtype=float)  # NULL becomes NaN
    want = []
    for label in ("1", "X", "2"):
        mine = [(p, y) for v, p, y in rows if v == label]
        xs, fit = plain_isotonic(np.array([p for p, _ in mine]), np.array([y for _, y in mine], dtype=float))
        want.append(np.interp(asked, xs, fit))
    want = np.array(want).T
    total = want.sum(axis=1)
    keep = total > 0
    assert np.allclose(got[keep], want[keep] / total[keep, None], atol=1e-12)
    assert np.isnan(got[~keep]).all()
    table = calibration.curve_table(spark, curves).filter("outcome = '1'").orderBy("boundary").collect()
    values = [r.value for r in table]
    assert values == sorted(values) and 0 <= values[0] and values[-1] <= 1


def test_identity_curves_change_nothing(spark):
    rows = [(v, p, y) for v in ("1", "X", "2") for p, y in ((0.0, False), (1.0, True))]
    curves = calibration.fit_curves(
        spark.createDataFrame(rows, "outcome string, predicted_prob double, actual_occurred boolean")
    )
    df = spark.createDataFrame([(0.5, 0.3, 0.2), (None, 0.3, 0.2)], "crowd_1 double, crowd_x double, crowd_2 double")
    known, unknown = calibration.calibrate(df, curves).collect()
    assert (known.calibrated_1, known.calibrated_x, known.calibrated_2) == pytest.approx((0.5, 0.3, 0.2))
    assert unknown.calibrated_1 is None and unknown.calibrated_x is None


def test_long_forms(spark):
    df = spark.createDataFrame(
        [(1, 1, 1, "1", 0.5, 0.3, 0.2, 0.6), (1, 2, 2, None, 0.4, 0.3, 0.3, 0.4)],
        "round_number int, event_number int, match_id int, result string, crowd_1 double, "
        "crowd_x double, crowd_2 double, elo_expected_score double",
    )
    crowd = {r.outcome: r for r in relational.long_outcomes(df).collect()}
    assert {k: (r.predicted_prob, r.actual_occurred) for k, r in crowd.items()} == {
        "1": (0.5, True), "X": (0.3, False), "2": (0.2, False)
    }
    signals = relational.long_signals(df).collect()
    assert len(signals) == 3 and sum(r.actual_occurred for r in signals) == 1


def test_calibration_metrics(spark):
    df = spark.createDataFrame(
        [("1", 0.5, 0.3, 0.2, 1.0, 0.0, 0.0), (None, 0.5, 0.3, 0.2, 0.1, 0.1, 0.8)],
        "result string, crowd_1 double, crowd_x double, crowd_2 double, "
        "calibrated_1 double, calibrated_x double, calibrated_2 double",
    )
    got = {r.metric: r.value for r in calibration.calibration_metrics(df).collect()}
    assert got["brier_raw_1"] == 0.25 and got["brier_calibrated_1"] == 0.0
    assert got["brier_raw_pooled"] == pytest.approx((0.25 + 0.09 + 0.04) / 3)
    assert got["rows"] == 2
    named = calibration.calibration_metrics(df, run="first")
    assert named.columns == ["run", "metric", "value"] and named.first().run == "first"


PAIRED = (
    "result string, crowd_1 double, crowd_x double, crowd_2 double, "
    "calibrated_1 double, calibrated_x double, calibrated_2 double"
)


def forecasts(rng, n):
    """Random three-way forecasts."""
    return rng.dirichlet([2, 1.5, 2], n)


def test_paired_scores(spark):
    rng = np.random.default_rng(17)
    one, other = forecasts(rng, 40), forecasts(rng, 40)
    results = rng.choice(["1", "X", "2"], 40)
    rows = [(str(r), *map(float, a), *map(float, b)) for r, a, b in zip(results, one, other)]
    unplayed, gap = (None, *rows[0][1:]), ("2", None, *rows[1][2:])
    df = spark.createDataFrame([*rows, unplayed, gap], PAIRED)
    compared, same = judging.paired_scores(df, [("crowd", "calibrated"), ("crowd", "crowd")]).collect()
    actual = np.array([[r == v for v in ("1", "X", "2")] for r in results], dtype=float)
    gains = ((one - actual) ** 2).mean(axis=1) - ((other - actual) ** 2).mean(axis=1)
    error = gains.std(ddof=1) / np.sqrt(40)
    assert compared.n == 40 and compared.mean_difference == pytest.approx(gains.mean())
    assert compared.standard_error == pytest.approx(error)
    assert compared.t_statistic == pytest.approx(gains.mean() / error)
    low, high = gains.mean() - 1.96 * error, gains.mean() + 1.96 * error
    assert (compared.ci_low, compared.ci_high) == pytest.approx((low, high))
    assert compared.verdict == ("better" if low > 0 else "worse" if high < 0 else "no measurable difference")
    assert same.mean_difference == 0.0 and same.t_statistic is None and same.verdict == "no measurable difference"


def test_even_forecast_scores_two_ninths(spark):
    df = spark.createDataFrame([("1",), ("X",), ("2",), (None,)], "result string")
    got = judging.pooled_brier(judging.with_even_forecast(df), ["even"]).first()
    assert got.brier == pytest.approx(2 / 9)


MIX = "result string, good_1 double, good_x double, good_2 double, bad_1 double, bad_x double, bad_2 double"


@FEW
@given(st.floats(0, 1), st.integers(0, 10**6))
def test_mixture(spark, share, seed):
    rng = np.random.default_rng(seed)
    good, bad = forecasts(rng, 5), forecasts(rng, 5)
    rows = [("1", *map(float, g), *map(float, b)) for g, b in zip(good, bad)]
    mix = relational.mixed(spark.createDataFrame(rows, MIX), {"good": share, "bad": 1 - share}, "mix")
    got = np.array([tuple(r) for r in mix.select(triple("mix")).collect()])
    assert np.allclose(got, share * good + (1 - share) * bad) and np.allclose(got.sum(axis=1), 1)


def test_shares_that_do_not_sum_to_one_are_refused(spark):
    with pytest.raises(ValueError):
        relational.mixed(spark.createDataFrame([], MIX), {"good": 0.7, "bad": 0.7})


def test_best_weight_is_all_on_the_better_forecast(spark):
    rng = np.random.default_rng(23)
    rows = []
    for label in rng.choice(3, 60):
        sure = np.full(3, 0.05)
        sure[label] = 0.9
        rows.append((["1", "X", "2"][label], *map(float, sure), *map(float, np.roll(sure, 1))))
    df = spark.createDataFrame(rows, MIX)
    assert judging.best_blend_weight(df, "good", "bad").first().weight == 1.0
    assert judging.best_blend_weight(df, "bad", "good").first().weight == 0.0
    assert judging.best_blend_weight(df, "good", "good").first().weight == 0.0  # the smallest of equal weights


@FEW
@given(st.integers(0, 10**6))
def test_weights_equal_the_search(spark, seed):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(30):
        left, right = rng.dirichlet([2, 1, 1]), rng.dirichlet([1, 1, 1])
        rows.append((str(rng.choice(["1", "X", "2"])), *map(float, left), *map(float, right)))
    df = spark.createDataFrame([*rows, (None, *rows[0][1:]), ("1", None, *rows[0][2:])], MIX)
    got = {round(r.weight, 6): r.brier for r in judging.blend_weights(df, "good", "bad").collect()}
    p = np.array([r[1:] for r in rows])
    y = np.array([[r[0] == v for v in ("1", "X", "2")] for r in rows], dtype=float)
    for step in range(21):
        w = step / 20
        want = ((w * p[:, :3] + (1 - w) * p[:, 3:] - y) ** 2).mean()
        assert got[round(w, 6)] == pytest.approx(want, abs=1e-12)


POOL = (
    "match_id string, result string, good_1 double, good_x double, good_2 double, "
    "noise_1 double, noise_x double, noise_2 double"
)


def pool_rows(n=45, seed=31):
    """A source that is right most of the time, and one that is drawn without regard to it."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        label = int(rng.integers(3))
        told = label if rng.random() < 0.9 else int(rng.integers(3))
        good = rng.dirichlet(1.0 + 12.0 * np.eye(3)[told])
        rows.append((f"m{i}", ("1", "X", "2")[label], *map(float, good), *map(float, forecasts(rng, 1)[0])))
    return rows


def test_pool_leans_on_the_informative_source(spark):
    rows = pool_rows()
    df = spark.createDataFrame([*rows, ("new", None, *rows[0][2:])], POOL)
    pool = pooling.fit_pool(df, ("good", "noise"))
    weights = {r.source: r.influence for r in pooling.pool_coefficients(spark, pool).collect()}
    assert weights["good"] > 2 * weights["noise"] and pool.rows == len(rows)
    scored = pooling.apply_pool(df, pool).collect()
    assert len(scored) == len(rows)
    hits = 0
    for row in scored:
        chances = {"1": row.pooled_1, "X": row.pooled_x, "2": row.pooled_2}
        assert sum(chances.values()) == pytest.approx(1.0)
        hits += max(chances, key=chances.get) == row.result
    assert hits > 0.8 * len(rows)


def test_pool_minimises_the_penalised_loss(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(120):
        good, noise = rng.dirichlet([3, 2, 2]), rng.dirichlet([2, 2, 2])
        result = ["1", "X", "2"][rng.choice(3, p=good)]
        rows.append((f"m{i}", result, *map(float, good), *map(float, noise)))
    df = spark.createDataFrame(rows, POOL)
    for interaction in (False, True):
        pool = pooling.fit_pool(df, ("good", "noise"), interaction)
        names = pooling.pool_features(("good", "noise"), interaction)
        x = np.array([tuple(r) for r in df.select(*names.values()).collect()])
        label = np.array([{"1": 0, "2": 1, "X": 2}[r[1]] for r in rows])
        coefficients = pool.model.coefficientMatrix.toArray()
        scores = x @ coefficients.T + pool.model.interceptVector.toArray()
        chances = np.exp(scores - scores.max(axis=1, keepdims=True))
        chances /= chances.sum(axis=1, keepdims=True)
        slope = (chances - np.eye(3)[label]).T @ x + coefficients
        assert abs(slope).max() < 2e-2  # the gradient of the summed loss vanishes
        assert abs((chances - np.eye(3)[label]).sum(axis=0)).max() < 2e-2
        got = pooling.apply_pool(df, pool).orderBy(F.expr("int(substr(match_id, 2))")).collect()
        mine = np.array([(r.pooled_1, r.pooled_2, r.pooled_x) for r in got])
        assert np.allclose(mine, chances, atol=1e-9)
        assert np.allclose(pool.feature_sd, x.std(axis=0))


def test_pool_gaps(spark):
    rows = [r for r in pool_rows() if r[1] != "X"]
    gap = ("gap", "1", None, 0.4, 0.6, *rows[0][5:])
    df = spark.createDataFrame([*rows, gap], POOL)
    pool = pooling.fit_pool(df, ("good", "noise"))
    scored = {r.match_id: r for r in pooling.apply_pool(df, pool).collect()}
    assert scored["gap"].pooled_1 is None
    known = scored[rows[0][0]]
    assert known.pooled_x == 0.0 and known.pooled_1 + known.pooled_2 == pytest.approx(1.0)
