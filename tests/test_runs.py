"""Whole runs on the smallest tables."""

import datetime
import json

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_forecasts import plain_isotonic, plain_ratings

from touchline import binding, landing
from touchline.plans import backtest, build
from touchline.sources import ingest

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def layers(spark, tmp_path):
    name = tmp_path.name.replace("-", "_")
    made = build.Layers(f"{name}_silver", f"{name}_gold", f"{name}_mart", binding.SCOPE)
    build.create_layers(spark, made, str(tmp_path / "tables"))
    return made


def test_build(spark, tmp_path, layers):
    matches = binding.matches(spark, FOLDER)
    landed = landing.land_faults(matches, landing.land_lines(matches, str(tmp_path / "documents")))
    stored = build.load_matches(spark, layers, landed, multi_line=False)
    # unplayed matches stand in good documents and are kept
    assert stored.count() == matches.count()
    assert 0 < stored.filter("result IS NULL").count() == matches.filter("result IS NULL").count()

    account = {r.status: r.documents for r in spark.table(layers.account).collect()}
    rounds = {r.round_number for r in matches.select("round_number").distinct().collect()}
    assert account["error"] == sum(r % 17 == 3 for r in rounds)
    assert account["corrupt"] == sum(r % 23 == 5 for r in rounds)
    assert spark.table(layers.rejects).count() == account["error"] + account["corrupt"]

    build.build_dimensions(spark, layers, F.lit(binding.AS_OF).cast("date"))
    teams = matches.selectExpr("home_team AS t").union(matches.selectExpr("away_team")).distinct().count()
    assert spark.table(f"{layers.gold}.dim_team").count() == teams
    assert spark.table(f"{layers.gold}.dim_league").count() == 3
    seasons = {r.season_key for r in spark.table(f"{layers.gold}.dim_season").collect()}

    audit = build.build_facts(spark, layers)
    inside = stored.filter(F.col("league").isin(list(binding.SCOPE))).count()
    fact = spark.table(layers.fact)
    assert fact.filter("result IS NULL").count() > 0
    summed = spark.table(f"{layers.gold}.fact_league_season")
    assert summed.agg(F.sum("match_count")).first()[0] == fact.filter("result IS NOT NULL").count()
    assert {r.season_key for r in summed.collect()} <= seasons

    metrics, summary = build.add_forecasts(spark, layers)
    metrics = {r.metric: r.value for r in metrics.collect()}
    assert metrics["brier_calibrated_pooled"] < metrics["brier_raw_pooled"]
    assert summary.first().matches == stored.count()
    build.add_forecasts(spark, layers)
    # a frame returned before two updates still reads the version it was made from
    counted = audit.first()
    assert (counted.matches, counted.leagues, counted.without_rating) == (inside, 3, inside)
    fact = spark.table(layers.fact)
    assert fact.count() == inside
    full = fact.filter("calibrated_1 + calibrated_x + calibrated_2 BETWEEN 0.999999 AND 1.000001")
    assert full.filter("elo_home IS NOT NULL").count() == inside

    # the same round again replaces its rows, a newer one adds rows
    first = build.score_newest_round(spark, layers, F.lit("2001-08-01").cast("timestamp"))
    events = first.count()
    assert 0 < events <= 13 and first.filter("gap IS NULL").count() == 0
    again = build.score_newest_round(spark, layers, F.lit("2001-08-02").cast("timestamp"))
    assert {str(r.scored_at)[:10] for r in again.collect()} == {"2001-08-02"}
    assert spark.table(layers.coupon).count() == events

    event = {
        "eventNumber": 1,
        "match": {
            "matchId": 10**6,
            "matchStart": "2001-09-01T15:00:00",
            "participants": [{"name": "Team 1"}, {"name": "Newcomer"}],
            "league": {"name": "Cup"},
        },
        "svenskaFolket": {"one": "40,00", "x": "30,00", "two": "30,00"},
    }
    document = {"draw": {"drawNumber": 10**6, "drawEvents": [event]}}
    (tmp_path / "documents" / "next.txt").write_text(json.dumps(document))
    build.load_matches(spark, layers, landed, multi_line=False)
    # scoring reads what the load's forecasts wrote, and folds no history itself
    assert build.score_newest_round(spark, layers).first().elo_away is None
    build.add_forecasts(spark, layers)
    newest = build.score_newest_round(spark, layers).collect()
    assert [r.away_team for r in newest] == ["Newcomer"] and newest[0].elo_away == 1500.0
    assert spark.table(layers.coupon).count() == events + 1
    build.expire(spark, layers, keep=1)
    assert spark.table(layers.coupon).count() == events + 1


def test_a_corrected_result_changes_later_ratings(spark, layers, tmp_path):
    matches = binding.matches(spark, FOLDER)
    oldest = matches.filter("result = '1'").orderBy("match_start", "match_id").first()
    corrected = matches.withColumns(
        {g: F.when(F.col("match_id") == oldest.match_id, F.lit(v)).otherwise(F.col(g)) for g, v in (("home_goals", 0), ("away_goals", 3))}
    )
    ratings = []
    for name, frame in (("first", matches), ("second", corrected)):
        landed = landing.land_lines(frame, str(tmp_path / name))
        build.load_matches(spark, layers, landed, multi_line=False)
        build.build_dimensions(spark, layers, F.lit(binding.AS_OF).cast("date"))
        build.build_facts(spark, layers)
        build.add_forecasts(spark, layers)
        known = spark.table(layers.forecasts).join(spark.table(layers.matches).selectExpr("match_id AS match_key", "home_team", "match_start"), "match_key")
        later = known.filter((F.col("home_team") == oldest.home_team) & (F.col("match_start") > oldest.match_start))
        ratings.append({r.match_key: r.elo_home for r in later.collect()})
    assert ratings[0].keys() == ratings[1].keys() and ratings[0]
    assert all(ratings[1][k] < v for k, v in ratings[0].items())


def test_a_gap_stops_the_load(spark, layers, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    for number in (1, 2, 3, 5):
        (folder / f"round_{number}.json").write_text(json.dumps({"draw": {"drawNumber": number, "drawEvents": []}}))
    (folder / "round_4.json").write_text('{"draw": {"drawNumber": 4, "drawEv')
    (folder / "readme.json").write_text(json.dumps({"error": "no such round"}))
    files = ingest.landed_files(spark, str(folder))
    assert sorted(r.round_number for r in files.collect()) == [1, 2, 3, 4, 5]
    nothing = files.limit(0)
    plan = ingest.ingest_plan(files, nothing, first_id=1)
    with pytest.raises(RuntimeError, match="1 documents"):
        build.load_matches(spark, layers, str(folder), plan=plan)
    assert {r.reason for r in spark.table(layers.rejects).collect()} == {"corrupt", "error"}
    account = {r.status: r.documents for r in spark.table(layers.account).collect()}
    assert account == {"fetched": 4, "failed": 1, "corrupt": 1, "error": 1}
    (folder / "round_4.json").write_text(json.dumps({"draw": {"drawNumber": 4, "drawEvents": []}}))
    build.load_matches(spark, layers, str(folder), plan=plan)


def interpolated(x, y, asked):
    xs, fit = plain_isotonic(x, y)
    return np.interp(asked, xs, fit)


@pytest.fixture(scope="module")
def frame(spark):
    names = "match_id match_date home_team away_team league result crowd_1 crowd_x crowd_2".split()
    return binding.matches(spark, FOLDER).select(names).toPandas()


def test_backtest_equals_plain_numbers(spark, frame):
    done = backtest.run_backtest(binding.matches(spark, FOLDER), binding.SCOPE, binding.CUTOFF, "match_date")

    rows = list(frame[["match_id", "match_date", "home_team", "away_team", "result"]].itertuples(index=False, name=None))
    ratings = plain_ratings(rows)
    pairs = np.array([ratings[i] for i in frame["match_id"]])
    expected = 1 / (1 + 10 ** ((pairs[:, 1] - pairs[:, 0] - 65) / 400))
    inside = (frame["league"].isin(list(binding.SCOPE)) & frame["result"].notna()).to_numpy()
    before = (frame["match_date"].astype(str) < binding.CUTOFF).to_numpy()
    train, test = inside & before, inside & ~before
    actual = np.array([(frame["result"] == v).to_numpy(dtype=float) for v in ("1", "X", "2")]).T
    crowd = frame[["crowd_1", "crowd_x", "crowd_2"]].to_numpy()
    signal = np.array([expected, 0.5 - abs(expected - 0.5), 1 - expected]).T

    def fitted(source):
        out = np.array([interpolated(source[train, i], actual[train, i], source[:, i]) for i in range(3)]).T
        return out / out.sum(axis=1, keepdims=True)

    calibrated, elo = fitted(crowd), fitted(signal)
    weights = np.arange(21) / 20
    scores = [((w * calibrated + (1 - w) * elo - actual)[train] ** 2).mean() for w in weights]
    weight = weights[int(np.argmin(scores))]
    assert done.weight == pytest.approx(weight)

    got = {r.forecast: r.brier for r in done.briers.collect()}
    forecasts = {
        "even": np.full_like(crowd, 1 / 3),
        "crowd": crowd,
        "calibrated": calibrated,
        "elo": elo,
        "halves": 0.5 * calibrated + 0.5 * elo,
        "best_mix": weight * calibrated + (1 - weight) * elo,
    }
    for name, values in forecasts.items():
        assert got[name] == pytest.approx(((values - actual)[test] ** 2).mean(), abs=1e-9), name
    split = {r.part: (r.matches, r.share) for r in done.split.collect()}
    assert split["train"] == (train.sum(), pytest.approx(train.sum() / inside.sum()))
    assert split["test"][0] == test.sum() == done.scored.count()
    sections = {r.section for r in done.report().select("section").distinct().collect()}
    assert sections == {"split", "brier", "paired", "coefficient", "blend"}
    report = {(r.section, r.item, r.metric): r.value for r in done.report().collect()}
    days = frame["match_date"][inside & before].map(lambda d: (d - datetime.date(1970, 1, 1)).days)
    assert report["split", "train", "first_day"] == days.min() and report["split", "train", "last_day"] == days.max()
    for r in done.pairs.collect():
        sign = {"better": 1, "worse": -1}.get(r.verdict, 0)
        assert report["paired", f"{r.candidate} vs {r.baseline}", "verdict"] == sign
