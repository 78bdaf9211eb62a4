"""Line dedup: multi-line chunks that repeat anywhere in the corpus are removed but once.

A document's lines are cut into chunks where a rolling hash over the hashes of the last
``window`` lines is 0 modulo ``modulus``. The cuts depend on the lines nearby only, so an inserted
line moves them no further than the next cut. Chunks that hold at least two lines with content
and occur more than once are removed, but for the occurrence in the smallest document at its
smallest line, after their bytes have been compared with those of that occurrence.

A passage shorter than a chunk need not hold a whole one, and how a chunk begins depends on the line
before it. With ``short``, the smallest chunks that have two lines of content count too, whatever the
rolling hash: from each line with content to the next one. What either finds is removed; every
removed line is equal to an earlier one, so no line is lost altogether.

Defined results: a NULL text has no lines and stays NULL; an empty text is one empty line; a line
of spaces is no content; with ``short``, one of several equal lines in a row stays; rows equal in id and text count as one document and get the same
result; NULL ids come before all others. Other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.text import let, rows_key
from touchline.sources.workspace import pinned

#: Multiplier of the rolling hash, and hex digits of a line's MD5 that enter it.
BASE, DIGITS = 31, 6


def split_lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_value(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line), 1, DIGITS), 16, 10).cast("long")


def chunk_ends(lines: Column, window: int, modulus: int) -> Column:
    """How many lines lie before each cut, ascending; the last is the number of lines."""

    def ends(values: Column) -> Column:
        def cuts(i: Column) -> Column:
            rolled = sum(
                (
                    F.when(i > back, F.element_at(values, F.greatest(i - back, F.lit(1)))).otherwise(F.lit(0)) * (BASE**back)
                    for back in range(window)
                ),
                F.lit(0),
            )
            return (i == F.size(values)) | (rolled % modulus == 0)

        return F.filter(F.sequence(F.lit(1), F.size(values)), cuts)

    return let(F.transform(lines, line_value), ends)


def _between(ends: Column, function) -> Column:
    """``function(first line from 0, number of lines)`` for each chunk."""
    return F.transform(
        ends,
        lambda end, j: let(
            F.when(j > 0, F.element_at(ends, F.greatest(j, F.lit(1)))).otherwise(F.lit(0)),
            lambda start: function(start, end - start),
        ),
    )


def _joined(lines: Column, start: Column, n: Column) -> Column:
    return F.array_join(F.slice(lines, start + 1, n), "\n")


def neighbours(lines: Column) -> Column:
    """``(start, n)`` from each line with content to the next one."""

    def spans(at: Column) -> Column:
        last = F.greatest(F.size(at) - 1, F.lit(0))
        return F.zip_with(F.slice(at, F.lit(1), last), F.slice(at, F.lit(2), last), lambda a, b: F.struct(a.alias("start"), (b - a + 1).alias("n")))

    return let(F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.trim(F.get(lines, i)) != ""), spans)


def chunks(docs: DataFrame, window: int, modulus: int, short: bool = False) -> DataFrame:
    """The chunks with two lines of content: ``doc_id, row_key, start, n, key, length``."""

    def one(lines: Column, start: Column, n: Column) -> Column:
        content = F.size(F.filter(F.slice(lines, start + 1, n), lambda line: F.trim(line) != ""))
        joined = F.when(n > 1, _joined(lines, start, n))
        return let(
            joined,
            lambda t: F.struct(
                start.alias("start"), n.alias("n"), F.xxhash64(t).alias("key"), F.octet_length(t).alias("length"),
                (t.isNotNull() & (content > 1)).alias("several"),
            ),
        )

    def every(lines: Column) -> Column:
        long = let(
            chunk_ends(lines, window, modulus),
            lambda ends: F.filter(_between(ends, lambda s, n: one(lines, s, n)), lambda c: c["several"]),
        )
        if not short:
            return long

        def pair(span: Column) -> Column:
            joined = _joined(lines, span["start"], span["n"])
            return let(
                joined,
                lambda t: F.struct(
                    span["start"].alias("start"), span["n"].alias("n"), F.xxhash64(t).alias("key"), F.octet_length(t).alias("length"),
                    F.lit(True).alias("several"),
                ),
            )

        return F.array_union(long, F.transform(neighbours(lines), pair))

    found = let(split_lines(F.col("text")), every)
    return (
        docs.filter(F.col("text").isNotNull())
        .select("doc_id", rows_key(F.col("text")).alias("row_key"), F.inline(found))
        .drop("several")
    )


def repeated_chunks(docs: DataFrame, window: int = 2, modulus: int = 4, short: bool = False) -> DataFrame:
    """Chunks to remove: ``doc_id, row_key, start, n``."""
    kinds = {"short": True} if short else {}
    # Read twice and cut twice: written, the chunks would take more room than their shuffles.
    every = chunks(docs.select("doc_id", "text"), window, modulus, **kinds)
    place = F.struct("doc_id", "row_key", "start")
    firsts = (
        every.groupBy("key", "length")
        .agg(F.min(place).alias("first"), F.count("*").alias("times"))
        .filter("times > 1")  # equal rows share a place, which is then the first one
        .select("key", "length", "first")
    )
    # Written, so that both sides of the join are plain shuffles, which Spark splits where a key is hot.
    firsts = pinned(firsts, "firsts")
    marked = every.join(firsts, ["key", "length"]).select(
        "doc_id", "row_key", F.struct("start", "n", "key", (place == F.col("first")).alias("is_first")).alias("chunk")
    )
    # Few of a document's lines travel further: the texts of repeated chunks alone.
    by_document = marked.groupBy(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key")).agg(
        F.collect_set("chunk").alias("found")
    )
    texts = docs.select("doc_id", rows_key(F.col("text")).alias("row_key"), "text")
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("row_key") == F.col("__key"))
    with_text = texts.join(by_document, same).select(
        "doc_id",
        "row_key",
        F.inline(
            let(
                split_lines(F.col("text")),
                lambda lines: F.transform(
                    "found",
                    lambda c: F.struct(
                        c["start"].alias("start"), c["n"].alias("n"), c["key"].alias("key"), c["is_first"].alias("is_first"),
                        _joined(lines, c["start"], c["n"]).alias("bytes"),
                    ),
                ),
            )
        ),
    )
    with_text = pinned(with_text, "repeated")
    kept = pinned(with_text.filter("is_first").select("key", F.col("bytes").alias("first_bytes")).distinct(), "first_bytes")
    others = with_text.filter(~F.col("is_first"))
    return others.join(kept, "key").filter(F.col("bytes") == F.col("first_bytes")).select("doc_id", "row_key", "start", "n")


def mark_repeated(docs: DataFrame, window: int = 2, modulus: int = 4, short: bool = False) -> DataFrame:
    """The documents with ``__spans``, the ``(start, n)`` of the lines to remove, or NULL. Spans do
    not overlap."""
    found = repeated_chunks(docs, window, modulus, short)
    until = F.col("start") + F.col("n")
    order = Window.partitionBy("doc_id", "row_key").orderBy("start", "n").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.greatest("start", F.coalesce(F.max(until).over(order), F.lit(0)))
    spans = (
        found.select("doc_id", "row_key", begin.alias("start"), until.alias("until"))
        .filter(F.col("start") < F.col("until"))
        .groupBy(F.col("doc_id").alias("__id"), F.col("row_key").alias("__key"))
        .agg(F.sort_array(F.collect_list(F.struct("start", (F.col("until") - F.col("start")).alias("n")))).alias("__spans"))
    )
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (rows_key(F.col("text")) == F.col("__key"))
    return docs.join(spans, same, "left").drop("__id", "__key")


def kept_text(text: Column, spans: Column) -> Column:
    """The text without the lines of ``spans``."""

    def keep(lines: Column) -> Column:
        def cut(edges: Column) -> Column:
            stretches = F.transform(
                F.sequence(F.lit(1), F.size(edges), F.lit(2)),
                lambda i: F.slice(lines, F.element_at(edges, i) + 1, F.element_at(edges, i + 1) - F.element_at(edges, i)),
            )
            return F.array_join(F.flatten(stretches), "\n")

        bounds = F.flatten(F.transform(spans, lambda s: F.array(s["start"], s["start"] + s["n"])))
        return let(F.concat(F.array(F.lit(0)), bounds, F.array(F.size(lines))), cut)

    return F.when(spans.isNull(), text).otherwise(let(split_lines(text), keep))


def dedup_lines(docs: DataFrame, window: int = 2, modulus: int = 4, short: bool = False) -> DataFrame:
    """The documents without repeated chunks, with the columns they had."""
    marked = mark_repeated(docs, window, modulus, short)
    return marked.withColumn("text", kept_text(F.col("text"), F.col("__spans"))).select(*docs.columns)
