"""Benchmark decontamination: documents are searched for the n-grams of test items.

The hash set of the items' n-grams is broadcast after its size has been measured; beyond the
bound the hashes of the windows are shuffled to the n-grams, and documents with equal hashes are
read once more. Every window of a document is looked up by its hash and a hit is verified word by word.

Defined results: a NULL text has no words; an item of fewer than ``n`` words is one window, one
without words none; items with equal windows are all reported; items of one NULL id have the
id ``''``; rows that repeat an id are judged row by row. Other columns are kept by ``remove``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.text import ascii_lower, lower_words, rows_key
from touchline.sources.workspace import pinned

ANY_CASE_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"

#: Bytes of n-grams up to which their hash set is sent to every executor.
BROADCAST_BYTES = 64 << 20


def benchmark_grams(benchmark: DataFrame, n: int, item: str = "item_id", text: str = "text") -> DataFrame:
    """The distinct windows of the items: their hash, words and number of words, and the items."""
    words = benchmark.select(
        F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"),
        lower_words(ascii_lower(F.col(text))).alias("words"),
    ).filter(F.size("words") > 0)
    width = F.least(F.lit(n), F.size("words"))
    starts = F.sequence(F.lit(1), F.size("words") - width + 1)
    windows = words.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, width))).alias("gram"))
    return windows.groupBy("gram").agg(F.sort_array(F.collect_set("item")).alias("items")).select(
        F.xxhash64("gram").alias("key"), "gram", F.size("gram").alias("n"), "items"
    )


def find_hits(docs: DataFrame, grams: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Occurrences of the grams: ``doc_id, row_key, start`` (in words, from 0), ``n, items``."""
    grams = pinned(grams, "grams")
    size = F.octet_length(F.array_join("gram", "")) + F.octet_length(F.array_join("items", "")) + F.lit(64)
    measured = grams.agg(F.sum(size).alias("bytes"), F.sort_array(F.collect_set("n")).alias("widths")).first()
    small = (measured["bytes"] or 0) <= broadcast_bytes
    words = docs.select(
        "doc_id", rows_key(F.col("text")).alias("row_key"), lower_words(ascii_lower(F.col("text"))).alias("words")
    )
    windows = words.select("doc_id", "row_key", "words", F.posexplode("words").alias("start", "word"))
    # At most n widths: those of the items shorter than a window, and n itself.
    widths = F.lit(measured["widths"] or [0]).cast("array<int>")
    if len(measured["widths"]) == 1:
        windows = windows.withColumn("n", F.lit(measured["widths"][0]))
    else:
        windows = windows.withColumn("n", F.explode(widths))
    keyed = windows.filter(F.col("start") + F.col("n") <= F.size("words")).withColumn(
        "key", F.xxhash64(F.slice("words", F.col("start") + 1, F.col("n")))
    )
    if small:
        found = keyed.join(F.broadcast(grams).withColumnRenamed("n", "width"), "key")
        return found.filter(F.slice("words", F.col("start") + 1, F.col("n")) == F.col("gram")).select(
            "doc_id", "row_key", "start", "n", "items"
        )
    # A window travels as its hash and place; the words of a document meet its candidates once.
    places = keyed.select("doc_id", "row_key", "start", "n", "key")
    candidates = places.join(grams.withColumnRenamed("n", "width"), "key").groupBy(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key")).agg(
        F.collect_list(F.struct("start", "n", "gram", "items")).alias("candidates")
    )
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("row_key") == F.col("__key"))
    verified = F.filter("candidates", lambda c: F.slice("words", c["start"] + 1, c["n"]) == c["gram"])
    return words.join(candidates, same).select("doc_id", "row_key", F.inline(verified)).drop("gram")


def hits_by_document(hits: DataFrame) -> DataFrame:
    """Per document with hits: words covered, the covered stretches and the items."""
    once = hits.groupBy("doc_id", "row_key", "start", "n").agg(F.first("items").alias("items"))
    order = Window.partitionBy("doc_id", "row_key").orderBy("start", "n")
    reached = F.max(F.col("start") + F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    end = F.col("start") + F.col("n")
    new_from = F.greatest("start", F.coalesce(reached, F.lit(0)))
    spans = once.withColumn("new_from", new_from).withColumn("until", end)
    fresh = F.col("until") > F.col("new_from")
    return spans.groupBy("doc_id", "row_key").agg(
        F.sum(F.when(fresh, F.col("until") - F.col("new_from")).otherwise(0)).cast("long").alias("n_hit"),
        F.sort_array(F.collect_list(F.when(fresh, F.struct(F.col("new_from").alias("start"), F.col("until"))))).alias("spans"),
        F.sort_array(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def _with_hits(docs: DataFrame, benchmark: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    return docs, hits_by_document(find_hits(docs.select("doc_id", "text"), benchmark_grams(benchmark, n)))


def contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10) -> DataFrame:
    """Per document: ``doc_id, row_key, n_words, n_hit, spans, items``."""
    docs, hits = _with_hits(docs, benchmark, n)
    counted = docs.select(
        "doc_id",
        rows_key(F.col("text")).alias("row_key"),
        F.size(lower_words(ascii_lower(F.col("text")))).cast("long").alias("n_words"),
    )
    h = hits.select(F.col("doc_id").alias("h_id"), F.col("row_key").alias("h_key"), "n_hit", "spans", "items")
    same = F.col("doc_id").eqNullSafe(F.col("h_id")) & (F.col("row_key") == F.col("h_key"))
    return counted.join(h, same, "left").select(
        "doc_id",
        "row_key",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:int,until:int>>")).alias("spans"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def remove_contamination(docs: DataFrame, benchmark: DataFrame, n: int = 10, whole: bool = True) -> DataFrame:
    """Drop contaminated documents, or with ``whole=False`` only the words that are hit, each
    with the separators before it. The columns of ``docs`` stay as they are."""
    _, hits = _with_hits(docs, benchmark, n)
    marks = hits.select(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key"), F.col("spans").alias("__spans"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (rows_key(F.col("text")) == F.col("__key"))
    if whole:
        return docs.join(marks, same, "left_anti")
    pieces = F.regexp_extract_all(F.col("text"), F.lit(f"{NOT_WORD}*{ANY_CASE_WORD}"), F.lit(0))
    # Cut the pieces between the covered stretches out, so that the work is linear in the text.
    edges = F.concat(
        F.array(F.lit(0)), F.flatten(F.transform("__spans", lambda s: F.array(s["start"], s["until"]))), F.array(F.size("__pieces"))
    )
    gaps = F.transform(
        F.sequence(F.lit(1), F.size("__edges"), F.lit(2)),
        lambda i: F.array_join(
            F.slice(
                "__pieces",
                F.element_at("__edges", i) + 1,
                F.element_at("__edges", i + 1) - F.element_at("__edges", i),
            ),
            "",
        ),
    )
    tail = F.regexp_extract("text", f"{NOT_WORD}*\\z", 0)
    cut = docs.join(marks, same, "left").withColumn("__pieces", pieces).withColumn("__edges", edges)
    text = F.when(F.col("__spans").isNull(), F.col("text")).otherwise(F.concat(F.array_join(gaps, ""), tail))
    return cut.withColumn("text", text).select(*docs.columns)
