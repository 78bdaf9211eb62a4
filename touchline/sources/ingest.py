"""Which documents to load, and the account of a load."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The first document of the archive, and how many of the newest are always
# loaded again because they may still change.
FIRST_ID = 4267
REFRESH_WINDOW = 2


def newest_id(listing: DataFrame, id_column: str = "round_number") -> int:
    """The highest id on offer; one row reaches the driver."""
    newest = listing.agg(F.max(id_column)).first()[0]
    if newest is None:
        raise ValueError("the listing is empty")
    return int(newest)


def landed_files(
    spark: SparkSession, path: str, pattern: str = r"_(\d+)\.json$", id_column: str = "round_number"
) -> DataFrame:
    """The ids that stand in the names of the files under ``path``, with their sizes. The files are
    listed, not read; other names have no id and drop out."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "length")
    found = F.regexp_extract("path", pattern, 1).try_cast("bigint")
    return files.withColumn(id_column, found).filter(F.col(id_column).isNotNull())


def ingest_plan(
    listing: DataFrame,
    landed: DataFrame,
    first_id: int = FIRST_ID,
    refresh_window: int = REFRESH_WINDOW,
    id_column: str = "round_number",
) -> DataFrame:
    """Every id from ``first_id`` to the newest with the action ``load``, ``refresh`` or
    ``skip``. The ids come from a distributed range, so the archive may be of any length.
    """
    newest = newest_id(listing, id_column)
    wanted = listing.sparkSession.range(first_id, newest + 1).withColumnRenamed("id", id_column)
    known = landed.select(F.col(id_column).cast("bigint").alias(id_column)).distinct()
    known = known.withColumn("is_landed", F.lit(True))
    action = (
        F.when(F.col("is_landed").isNull(), "load")
        .when(F.col(id_column) > newest - refresh_window, "refresh")
        .otherwise("skip")
    )
    return wanted.join(known, id_column, "left").select(id_column, action.alias("action"))


def to_load(plan: DataFrame) -> DataFrame:
    return plan.filter(F.col("action") != "skip")


def ingest_audit(plan: DataFrame, arrived: DataFrame, id_column: str = "round_number") -> DataFrame:
    """How many documents were fetched, skipped, or asked for without arriving."""
    got = arrived.select(F.col(id_column).cast("bigint").alias(id_column)).distinct()
    got = got.withColumn("has_arrived", F.lit(True))
    status = (
        F.when(F.col("action") == "skip", "skipped")
        .when(F.col("has_arrived"), "fetched")
        .otherwise("failed")
    )
    return (
        plan.join(got, id_column, "left")
        .groupBy(status.alias("status"))
        .agg(F.count("*").alias("documents"))
    )


def require_complete(audit: DataFrame) -> None:
    """Stop the run when anything failed: a silent gap would look like an unplayed round."""
    failed = audit.filter(F.col("status") == "failed").agg(F.sum("documents")).first()[0]
    if failed:
        raise RuntimeError(f"{failed} documents were asked for and did not arrive")
