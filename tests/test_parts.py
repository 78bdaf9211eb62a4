"""Tables in parts: what an update writes and what it leaves alone."""

import pytest
from pyspark.sql import functions as F

from touchline.sources import parts, tables


def _files(df, part):
    found = df.select(part, F.input_file_name().alias("file")).distinct().collect()
    return {(row[0], row[1]) for row in found}


@pytest.fixture
def seasons(spark):
    tables.create_namespaces(spark, ["gold_parts"])
    rows = [(1, "98/99", 1.0, 7), (2, "98/99", None, 7), (3, "99/00", 3.0, 7), (4, None, 4.0, 7), (5, "it's", 5.0, 7)]
    yield parts.publish_parts(spark.createDataFrame(rows, "k int, season string, v double, w int"), "gold_parts.fact", "season")
    spark.sql("DROP DATABASE gold_parts CASCADE")


def test_update_writes_the_parts_that_change(spark, seasons):
    before = _files(seasons, "season")
    assert seasons.columns == ["k", "season", "v", "w"]
    # 1 and 4 get the value they have, 3 another one, 9 is not there
    source = spark.createDataFrame([(1, 1), (3, None), (4, 4), (9, 9), (None, 1)], "k int, v int")
    after = parts.update_parts("gold_parts.fact", source, "k", ["v"], "season")
    assert sorted(r["k"] for r in after.filter("v IS NULL").collect()) == [2, 3]
    assert after.count() == 5 and after.schema == seasons.schema
    changed = before ^ _files(after, "season")
    assert {season for season, _ in changed} == {"99/00"}
    # the part of NULL can change as well, and an update without effect writes no version
    nulls = parts.update_parts("gold_parts.fact", spark.createDataFrame([(4, 0.5)], "k int, v double"), "k", ["v"], "season")
    assert [tuple(r) for r in nulls.filter("season IS NULL").collect()] == [(4, None, 0.5, 7)]
    version = tables.current_version(spark, "gold_parts.fact")
    parts.update_parts("gold_parts.fact", spark.createDataFrame([(4, 0.5)], "k int, v double"), "k", ["v"], "season")
    assert tables.current_version(spark, "gold_parts.fact") == version
    # a frame over the first version still reads it
    assert seasons.filter("v = 3").count() == 1
    with pytest.raises(ValueError, match="several source rows"):
        parts.update_parts("gold_parts.fact", spark.createDataFrame([(9, 1.0), (9, 1.0)], "k int, v double"), "k", ["v"], "season")
    with pytest.raises(ValueError, match="upsert_parts"):
        parts.update_parts("gold_parts.fact", seasons, "k", ["season"], "season")


def test_upsert_moves_rows_between_parts(spark, seasons):
    before = _files(seasons, "season")
    source = spark.createDataFrame([(5, "99/00", 5.5, True), (6, "00/01", 6.0, None)], "k int, season string, v double, late boolean")
    after = parts.upsert_parts("gold_parts.fact", source, "k", "season")
    assert sorted(tuple(r) for r in after.filter("k IN (3, 5, 6)").collect()) == [
        (3, "99/00", 3.0, 7, None), (5, "99/00", 5.5, 7, True), (6, "00/01", 6.0, None, None),
    ]
    assert after.count() == 6 and after.filter("late").count() == 1
    # the part that its only row left is gone
    assert {season for season, _ in before ^ _files(after, "season")} == {"99/00", "00/01", "it's"}
    assert "it's" not in parts.part_places(spark, tables.current_version(spark, "gold_parts.fact"), "season")
    again = parts.upsert_parts("gold_parts.fact", source.limit(0), "k", "season")
    assert _files(again, "season") == _files(after, "season")


def test_killed_update_leaves_parts_and_expiry_keeps_shared_files(spark, seasons):
    name = "gold_parts.fact"
    lost = spark.createDataFrame([(1, 2.0)], "k int, v double")
    failing = spark.table(name).filter("season = '98/99'").withColumn("v", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        parts.publish_parts(failing, name, "season", {"98/99"})
    assert _files(spark.table(name), "season") == _files(seasons, "season")
    # a run that died between writing a version and showing it
    spark.range(1).write.saveAsTable(f"{name}__v2")
    after = parts.update_parts(name, lost, "k", ["v"], "season")
    assert tables.current_version(spark, name).endswith("__v3")
    kept = _files(after, "season")
    tables.expire_versions(spark, name, keep=1)
    assert not spark.catalog.tableExists(f"{name}__v1") and not spark.catalog.tableExists(f"{name}__v2")
    assert _files(spark.table(name), "season") == kept and spark.table(name).count() == 5
    # a version that is shown is never dropped, even if a newer one was left unseen
    spark.range(1).write.saveAsTable(f"{name}__v4")
    tables.expire_versions(spark, name, keep=1)
    assert spark.table(name).count() == 5


def test_parts_of_an_empty_table(spark):
    tables.create_namespaces(spark, ["gold_empty_parts"])
    try:
        empty = spark.createDataFrame([], "k int, season int, v double")
        assert parts.upsert_parts("gold_empty_parts.t", empty, "k", "season").count() == 0
        rows = spark.createDataFrame([(1, 1999, 1.0), (None, 2000, 2.0)], "k int, season int, v double")
        assert parts.upsert_parts("gold_empty_parts.t", rows, "k", "season").count() == 2
        moved = parts.upsert_parts("gold_empty_parts.t", spark.createDataFrame([(1, None, 1.5)], "k int, season int, v double"), "k", "season")
        assert sorted((r["season"] or 0, r["v"]) for r in moved.collect()) == [(0, 1.5), (2000, 2.0)]
    finally:
        spark.sql("DROP DATABASE gold_empty_parts CASCADE")
