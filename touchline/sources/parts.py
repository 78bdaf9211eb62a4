"""Versioned tables in parts: an update writes the parts it changes and keeps the files of the rest.

A version is a partitioned table whose parts may lie anywhere. The next version writes the parts
that change into a new folder, takes over the places of all others, and becomes visible when the
view is switched, as with ``publish``. Until then nothing of the older version has been touched,
so a run that dies leaves it as it was. What meets on the driver are the parts' values and places.

Parts should be few (a season, a month): each costs a catalog entry and at least one file. A NULL
in the part column makes a part of its own. The part column must be a string or a whole number.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.sources.tables import (
    current_version,
    merge_matched,
    merge_upsert,
    next_version,
    prepared,
    require_unique,
    show_version,
)
from touchline.sources.workspace import pinned


def _clause(by: str, value: str | None) -> str:
    if value is None:
        return f"PARTITION (`{by}` = null)"
    escaped = value.replace("\\", "\\\\").replace("'", "\\'")
    return f"PARTITION (`{by}` = '{escaped}')"


def _values(parts: DataFrame, by: str) -> set[str | None]:
    return {row[0] for row in parts.select(F.col(by).cast("string")).distinct().collect()}


def _within(by: str, values: set[str | None]) -> Column:
    named = F.col(by).isin([v for v in values if v is not None])
    return F.when(F.col(by).isNull(), F.lit(None in values)).otherwise(named)


def part_places(spark: SparkSession, version: str, by: str) -> dict[str | None, str]:
    """Where the parts of a version lie."""
    places = {}
    for value in _values(spark.table(version), by):
        described = spark.sql(f"DESCRIBE TABLE EXTENDED {version} {_clause(by, value)}")
        # The first location is the part's, the second the table's.
        places[value] = next(row["data_type"] for row in described.collect() if row["col_name"] == "Location")
    return places


def _data_folder(spark: SparkSession, version: str) -> str:
    database, _, table = version.rpartition(".")
    home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return f"{home}/{table}-{uuid.uuid4().hex}"


def publish_parts(df: DataFrame, name: str, by: str, replaced: set[str | None] | None = None) -> DataFrame:
    """Write ``df`` as the parts ``replaced`` of the next version; without ``replaced``, as all of it.

    Every row of ``df`` must belong to one of these parts. One of them that has no row left
    is gone. Rows are gathered by part, and large parts are split again by adaptive execution.
    """
    spark = df.sparkSession
    shown = current_version(spark, name)
    kept = {} if replaced is None or shown is None else part_places(spark, shown, by)
    version = next_version(spark, name)
    folder = _data_folder(spark, version)
    df.hint("rebalance", F.col(by)).write.partitionBy(by).parquet(folder)
    columns = df.schema.toDDL()
    spark.sql(f"CREATE TABLE {version} ({columns}) USING parquet PARTITIONED BY (`{by}`) LOCATION '{folder}'")
    spark.sql(f"MSCK REPAIR TABLE {version}")
    places = [f"{_clause(by, value)} LOCATION '{place}'" for value, place in kept.items() if value not in replaced]
    if places:
        spark.sql(f"ALTER TABLE {version} ADD {' '.join(places)}")
    return show_version(spark, name, version, df.columns)


def update_parts(name: str, source: DataFrame, on: str, columns: list[str], by: str) -> DataFrame:
    """Update ``columns`` of the rows that have a source row, and write only parts in which a value
    really changes."""
    if by in columns:
        raise ValueError(f"{by} names the part of a row and is changed by upsert_parts")
    spark = source.sparkSession
    source = pinned(source.select(on, *columns), "source")
    require_unique(source, on)
    target = spark.table(name)
    pairs = target.select(on, by, *columns).join(prepared(source, on), F.col(on) == F.col(f"__s_{on}"))
    changed = [~F.col(c).eqNullSafe(F.col(f"__s_{c}").cast(target.schema[c].dataType)) for c in columns]
    touched = _values(pairs.filter(reduce(Column.__or__, changed)), by)
    if not touched:
        return target
    return publish_parts(merge_matched(target.filter(_within(by, touched)), source, on, columns), name, by, touched)


def upsert_parts(name: str, source: DataFrame, on: str, by: str) -> DataFrame:
    """Create the table on the first run; on later ones update matching rows with every source column
    and insert the rest.

    Written are the parts that hold a matching row or get one, so a row may move between
    parts. New source columns widen the table; parts that stay have NULL there.
    """
    spark = source.sparkSession
    source = pinned(source, "source")
    require_unique(source, on)
    if not spark.catalog.tableExists(name):
        return publish_parts(source, name, by)
    target = spark.table(name)
    matching = target.select(on, by).join(source.select(on), on, "left_semi")
    touched = _values(matching, by) | _values(source, by)
    if not touched:
        return target
    return publish_parts(merge_upsert(target.filter(_within(by, touched)), source, on), name, by, touched)
