"""Write the match table as JSON documents, as a feed would have landed them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.functions import triple
from touchline.sources.documents import OUTCOME_FIELDS, PROVIDER

EVENTS_PER_DOCUMENT = 13
DOCUMENTS_PER_FILE = 200


def _text(prefix: str, comma: bool, scale: int) -> Column:
    """A triple as text with two decimals, such as ``45,00``."""
    fields = []
    for name, column in zip(OUTCOME_FIELDS, triple(prefix), strict=True):
        text = F.format_string("%.2f", F.round(F.col(column) * scale, 2))
        fields.append((F.translate(text, ".", ",") if comma else text).alias(name))
    return F.struct(*fields)


def _event() -> Column:
    def side(name: str) -> Column:
        return F.struct(
            F.col(f"{name}_team").alias("name"),
            F.col(f"{name}_goals").cast("string").alias("result"),
            F.col(f"{name}_team_id").cast("string").alias("id"),
            F.col(f"{name}_team_country").alias("countryName"),
        )

    def provider(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("provider"), F.lit("Normal").alias("type"), value.alias("id"))

    other = provider("Another", F.col("match_id").cast("string"))
    wanted = provider(PROVIDER, F.col("betradar_id"))
    return F.struct(
        F.col("event_number").alias("eventNumber"),
        F.struct(
            F.col("match_id").alias("matchId"),
            F.col("match_start").alias("matchStart"),
            F.col("status").alias("sportEventStatus"),
            F.array(side("home"), side("away")).alias("participants"),
            F.struct(
                F.col("league").alias("name"),
                F.col("league_id").cast("string").alias("id"),
                F.struct(F.col("league_country").alias("name")).alias("country"),
            ).alias("league"),
        ).alias("match"),
        _text("crowd", True, 100).alias("svenskaFolket"),
        _text("odds", True, 1).alias("odds"),
        _text("start_odds", True, 1).alias("startOdds"),
        _text("favourite_odds", False, 100).alias("favouriteOdds"),
        F.when(F.col("betradar_id").isNotNull(), F.array(other, wanted))
        .otherwise(F.array(other))
        .alias("providerIds"),
    )


def documents(matches: DataFrame) -> DataFrame:
    """Documents of at most thirteen events of one round, and the file each belongs to.

    Rows are numbered within their input partition, so that no group can grow with the
    data, however the rounds are distributed. Matches not yet started stand beside played
    ones. The flat rows are shuffled, not the text made of them.
    """
    keys = ["round_number", "chunk"]
    row = F.monotonically_increasing_id()
    chunked = matches.withColumn("chunk", F.floor(row / EVENTS_PER_DOCUMENT)).repartition(*keys)
    return (
        chunked.groupBy(*keys)
        .agg(F.collect_list(_event()).alias("events"))
        .select(
            F.floor(F.col("chunk") / DOCUMENTS_PER_FILE).alias("file"),
            F.struct(
                F.lit(None).cast("string").alias("error"),
                F.struct(
                    F.col("round_number").alias("drawNumber"), F.col("events").alias("drawEvents")
                ).alias("draw"),
            ).alias("document"),
        )
    )


def land_lines(matches: DataFrame, path: str) -> str:
    """One document per line."""
    documents(matches).select(F.to_json("document").alias("value")).write.text(path)
    return path


def land_faults(matches: DataFrame, path: str) -> str:
    """Add lines that no match comes from: for some rounds an error, for some a torn document."""
    rounds = matches.select("round_number").distinct()
    error = F.to_json(F.struct(F.concat(F.lit("round not available: "), F.col("round_number").cast("string")).alias("error")))
    torn = F.concat(F.lit('{"draw": {"drawNumber": '), F.col("round_number").cast("string"), F.lit(', "drawEvents": [{'))
    lines = rounds.filter(F.col("round_number") % 17 == 3).select(error.alias("value")).unionByName(
        rounds.filter(F.col("round_number") % 23 == 5).select(torn.alias("value"))
    )
    lines.write.mode("append").text(path)
    return path


def land_arrays(matches: DataFrame, path: str) -> str:
    """Pretty-printed files, each holding an array of documents.

    They are compressed, as their text is many times the size of the table it comes from. Each
    is read by one task anyway.
    """
    files = documents(matches).groupBy("file").agg(F.collect_list("document").alias("all"))
    text = F.to_json("all", {"pretty": "true"})
    one_each = files.select(text.alias("value")).write.option("maxRecordsPerFile", 1)
    one_each.option("zlib.compress.level", "BEST_SPEED").text(path, compression="gzip")
    return path
