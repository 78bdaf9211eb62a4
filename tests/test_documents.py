import json

from pyspark.sql import functions as F

from touchline import binding, landing
from touchline.functions import decimal_comma, percent
from touchline.sources import documents


def event(number, match_id, home_goals, away_goals, **other):
    return {
        "eventNumber": number,
        "match": {
            "matchId": match_id,
            "matchStart": "2024-01-01T15:00:00",
            "sportEventStatus": "Ended",
            "participants": [
                {"name": "Home", "result": home_goals, "id": 69, "countryName": "England"},
                {"name": "Away", "result": away_goals, "id": "70", "countryName": "England"},
            ],
            "league": {"name": "Premier League", "id": 1, "country": {"name": "England"}},
        },
        "svenskaFolket": {"one": "45,00", "x": "30", "two": 25},
        "odds": {"one": "1,80", "x": "3.40", "two": 4.2},
        "startOdds": {"one": "1,90", "x": "3,30", "two": "4,00"},
        "favouriteOdds": {"one": "58.52", "x": 24.59, "two": "16,89"},
        "providerIds": [
            {"provider": "Another", "type": "Normal", "id": "1"},
            {"provider": "BetRadar", "type": "Normal", "id": "72221288"},
        ],
        **other,
    }


def land(folder, **files):
    for name, content in files.items():
        text = content if isinstance(content, str) else json.dumps(content, indent=2)
        (folder / f"{name}.json").write_text(text)
    return str(folder / "*.json")


def test_decimals(spark):
    df = spark.createDataFrame([("1,50",), ("0.45",), ("",), ("abc",), ("1.234,5",), (None,)], "t string")
    row = df.select(decimal_comma(F.col("t")).alias("v"), percent(F.col("t")).alias("p")).collect()
    assert [r.v for r in row] == [1.5, 0.45, None, None, None, None]
    assert row[0].p == 0.015


def test_extract(spark, tmp_path):
    document = {
        "draw": {
            "drawNumber": 7,
            "drawEvents": [
                event(1, 123, "2", "1"),
                event(2, 456, None, None, providerIds=[]),
                event(3, 789, "0", "0", providerIds=None),
                event(4, 790, "0", "3"),
            ],
        }
    }
    nobody = event(5, 791, "1", "1")
    nobody["match"]["participants"] = []
    document["draw"]["drawEvents"].append(nobody)
    path = land(tmp_path, draw_7=document)
    rows = {
        r.match_id: r
        for r in documents.extract_events(documents.read_documents(spark, path)).collect()
    }
    assert [rows[i].result for i in (123, 456, 789, 790, 791)] == ["1", None, "X", "2", None]
    one = rows[123]
    assert (one.round_number, one.event_number, one.home_goals, one.away_goals) == (7, 1, 2, 1)
    assert (one.home_team, one.home_team_id, one.away_team_id, one.league_id) == ("Home", 69, 70, 1)
    assert (one.crowd_1, one.crowd_x, one.crowd_2) == (0.45, 0.3, 0.25)
    assert (one.odds_1, one.odds_x, one.odds_2) == (1.8, 3.4, 4.2)
    assert abs(one.favourite_odds_1 + one.favourite_odds_x + one.favourite_odds_2 - 1) < 1e-9
    assert one.betradar_id == "72221288"
    assert rows[456].betradar_id is None and rows[789].betradar_id is None
    assert rows[791].home_team is None


def test_rejected(spark, tmp_path):
    good = {"draw": {"drawNumber": 1, "drawEvents": [event(1, 1, "1", "0")]}}
    path = land(
        tmp_path,
        good=good,
        failed={"error": {"code": 404}, "draw": None},
        empty={"error": None, "draw": {"drawNumber": 2, "drawEvents": []}},
        missing={"draw": {"drawNumber": 3, "drawEvents": None}},
        torn='{"draw": {"drawNumber": 4, "drawEv',
    )
    landed = documents.read_documents(spark, path)
    assert {r["draw"]["drawNumber"] for r in documents.accepted(landed).collect()} == {1, 2, 3}
    assert sorted(r.reason for r in documents.rejected(landed).collect()) == ["corrupt", "error"]
    assert documents.extract_events(documents.accepted(landed)).count() == 1


def test_layouts_agree(spark, tmp_path):
    both = [
        {"draw": {"drawNumber": n, "drawEvents": [event(1, n, "1", "0")]}} for n in (1, 2)
    ]
    array, lines = tmp_path / "array", tmp_path / "lines"
    array.mkdir(), lines.mkdir()
    land(array, all=both)
    land(lines, all="\n".join(json.dumps(d) for d in both))
    read = [
        documents.extract_events(documents.read_documents(spark, str(folder), multi_line)).collect()
        for folder, multi_line in ((array, True), (lines, False))
    ]
    assert sorted(read[0]) == sorted(read[1]) and len(read[0]) == 2


def test_landed_arrays_are_compressed_and_whole(spark, tmp_path):
    """The documents' text is many times the size of the orders; what is read back is all of it."""
    orders = spark.range(4000).selectExpr(
        "id AS o_orderkey", "id % 200 AS o_custkey", "CAST(1000 + id AS DOUBLE) AS o_totalprice",
        "DATE '1998-01-01' AS o_orderdate", "'2-HIGH' AS o_orderpriority",
    )
    orders.write.parquet(str(tmp_path / "orders.parquet"))
    matches = binding.matches(spark, str(tmp_path))
    path = landing.land_arrays(matches, str(tmp_path / "arrays"))
    files = [f for f in (tmp_path / "arrays").iterdir() if f.name.startswith("part-") and f.stat().st_size > 100]
    text = landing.land_lines(matches, str(tmp_path / "lines"))
    lines = sum(f.stat().st_size for f in (tmp_path / "lines").iterdir())
    assert files and sum(f.stat().st_size for f in files) * 4 < lines
    read = documents.extract_events(documents.accepted(documents.read_documents(spark, path))).drop("event_number")
    plain = documents.extract_events(documents.read_documents(spark, text, multi_line=False)).drop("event_number")
    assert read.count() == 4000 and read.exceptAll(plain).isEmpty() and plain.exceptAll(read).isEmpty()
