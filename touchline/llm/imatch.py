"""I-Match fingerprints: hashes of a document's informative terms over random lexicon subsets.

The lexicon are the terms whose inverse document frequency, over all documents, lies in a band.
Its upper end bounds the lexicon whatever the corpus: terms that stand in a share of at least
``exp(-high)`` of the documents number at most ``exp(high)`` times a document's mean count of
distinct terms. The lexicon is therefore broadcast, after its size has been measured.

A single hash over all lexicon terms changes with any of them. Several random subsets are therefore
drawn from the lexicon, each term by a seeded hash at a fixed ``rate`` and alike for all documents,
and each of them is thinned to half, a quarter and so on (``halvings``), so that short and long
documents alike have subsets that hold a few of their terms. Of each subset, a document's distinct
terms are sorted and hashed as one sequence, so a hash is equal if no term of the subset was added
or lost. ``whole`` is the hash of all lexicon terms of the document.

``likeness`` is the share of equal hashes. With several rates, ``rate_likeness`` takes the share
among the subsets that hold a term of either document, at the rate where it is largest.

Defined results: a NULL text counts as empty; where a subset has none of a document's terms, the
hash is ``whole``; a document without lexicon terms is hashed by its whole text, so only equal ones
are alike; two documents that fill too few subsets at every rate are alike if ``whole`` is equal;
terms are lower-cased; NULL ids come first in the order; rows equal in id and text count as one
document. Other columns are not carried.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from touchline.llm.text import let, lower_words
from touchline.sources.workspace import pinned

KEY = ["id0", "row_key"]

#: Bytes of lexicon up to which it is sent to every executor.
BROADCAST_BYTES = 64 << 20

#: A term's depths in up to 16 subsets are packed into a long.
DEPTH_BITS = 4
DEPTH_MASK = (1 << DEPTH_BITS) - 1


def terms(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(lower_words(F.lower(text)))


def lexicon(docs: DataFrame, low: float, high: float) -> DataFrame:
    """``term``: hashes of the terms whose inverse document frequency is within the band."""
    total = docs.count()
    seen = docs.select(F.explode(terms(F.col("text"))).alias("word")).groupBy(F.xxhash64("word").alias("term")).count()
    return seen.filter(F.col("count").between(total * math.exp(-high), total * math.exp(-low))).select("term")


def with_keys(docs: DataFrame) -> DataFrame:
    """``id0, row_key``, which tell different rows apart and are never NULL, ``doc_id``, ``text``."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id0"),
        F.xxhash64("doc_id", F.coalesce("text", F.lit(""))).alias("row_key"),
        "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    )


def in_subset(term: Column, subset: int, rate: float, seed: int = 11) -> Column:
    """Whether a random subset of the lexicon has the term, whatever the document."""
    drawn = F.xxhash64(term, F.lit(seed), F.lit(subset)).bitwiseAND(F.lit((1 << 20) - 1))
    return drawn < F.lit(round(rate * (1 << 20)))


def depths(term: Column, subsets: int, rate: float, halvings: int) -> Column:
    """For each subset, by how many of its rates the term was drawn, packed into a long.

    The draws of a subset are nested, as they compare one hash with falling limits.
    """
    if subsets * DEPTH_BITS > 64 or halvings + 1 > DEPTH_MASK:
        raise ValueError("at most 16 subsets and 14 halvings")
    packed = F.lit(0).cast("long")
    for s in range(subsets):
        drawn = [in_subset(term, s, rate / 2**k).cast("long") for k in range(halvings + 1)]
        packed = packed.bitwiseOR(F.shiftleft(sum(drawn[1:], drawn[0]), DEPTH_BITS * s))
    return packed


def subset_hashes(listed: Column, whole: Column, subset: int, halvings: int) -> Column:
    """The hashes of one subset, from its full rate to its lowest."""

    def drawn(among: Column, least: int) -> Column:
        return F.filter(
            among,
            lambda t: F.shiftrightunsigned(t["depths"], DEPTH_BITS * subset).bitwiseAND(F.lit(DEPTH_MASK)) > least,
        )

    def hashed(among: Column, k: int) -> Column:
        def of(found: Column) -> Column:
            known = F.transform(found, lambda t: t["known"])
            return F.when(F.size(found) == 0, whole).otherwise(F.hash(known, F.lit(subset), F.lit(k)))

        return let(drawn(among, k), of)

    return let(drawn(listed, 0), lambda full: F.array(*[hashed(full, k) for k in range(halvings + 1)]))


def signatures(versions: DataFrame, words: DataFrame, subsets: int, rate: float, halvings: int = 0) -> DataFrame:
    """``versions`` has a text in ``text``, other columns identify it. They come back, once
    each, with ``whole`` and ``hashes``. Each text's terms meet in the task that holds the text."""
    names = [c for c in versions.columns if c != "text"]
    listed = versions.select(*names, F.xxhash64("text").alias("text_key"), terms(F.col("text")).alias("words"))
    exploded = listed.select(*names, "text_key", F.explode_outer("words").alias("word")).withColumn("term", F.xxhash64("word"))
    size = words.count() * 24
    known = words.select(F.col("term").alias("known"), depths(F.col("term"), subsets, rate, halvings).alias("depths"))
    matched = exploded.join(F.broadcast(known) if size <= BROADCAST_BYTES else known, F.col("term") == F.col("known"), "left")
    found = F.when(F.col("known").isNotNull(), F.struct("known", "depths"))
    sets = matched.groupBy(*names, "text_key").agg(F.sort_array(F.collect_set(found)).alias("found"))
    all_terms = F.transform("found", lambda t: t["known"])
    whole = F.when(F.size("found") == 0, F.hash("text_key")).otherwise(F.hash(all_terms))
    known_whole = sets.withColumn("whole", whole)
    hashes = F.flatten(F.array(*[subset_hashes(F.col("found"), F.col("whole"), s, halvings) for s in range(subsets)]))
    return known_whole.select(*names, "whole", hashes.alias("hashes"))


def following(keyed: DataFrame) -> DataFrame:
    """``doc_id, id0, row_key, next_id0, next_row_key``: the next document in the order of ids; the first
    one follows the last. Only keys are sorted; what stands at a partition's end is told the
    first key of the next partition."""
    ranged = (
        keyed.select("doc_id", *KEY)
        .distinct()
        .repartitionByRange("doc_id", "row_key")
        .withColumn("part", F.spark_partition_id())
    )
    ranged = pinned(ranged, "order")
    key = F.struct("doc_id", "id0", "row_key")
    within = Window.partitionBy("part").orderBy("doc_id", "row_key")
    after = ranged.withColumn("next", F.lead(key).over(within))
    parts = Window.orderBy("part")  # one row per partition
    firsts = (
        ranged.groupBy("part")
        .agg(F.min(F.struct("doc_id", "row_key", "id0")).alias("f"))
        .select("part", F.struct("f.doc_id", "f.id0", "f.row_key").alias("first"))
        .withColumn("beyond", F.lead("first").over(parts))
        .withColumn("start", F.first("first").over(parts.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .select("part", F.coalesce("beyond", "start").alias("beyond"))
    )
    chained = after.join(firsts, "part").withColumn("next", F.coalesce("next", "beyond"))
    return chained.select("doc_id", *KEY, F.col("next.id0").alias("next_id0"), F.col("next.row_key").alias("next_row_key"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes, from 0 to 1."""
    same = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda equal: equal)
    return F.size(same) / F.size(a)


def rate_likeness(a: Column, whole_a: Column, b: Column, whole_b: Column, subsets: int, halvings: int, least: int = 4) -> Column:
    """Share of equal hashes among the subsets that hold a term of either document, at the rate
    where it is largest; rates at which fewer than ``least`` are filled do not count."""
    pairs = F.zip_with(a, b, lambda x, y: F.when((x == whole_a) & (y == whole_b), -1).otherwise((x == y).cast("int")))

    def share(codes: Column, k: int) -> Column:
        mine = F.array(*[F.element_at(codes, s * (halvings + 1) + k + 1) for s in range(subsets)])

        def of(mine: Column) -> Column:
            filled = F.size(F.filter(mine, lambda c: c >= 0))
            return F.when(filled >= least, F.size(F.filter(mine, lambda c: c == 1)) / filled)

        return let(mine, of)

    shares = let(pairs, lambda codes: F.array_max(F.array(*[share(codes, k) for k in range(halvings + 1)])))
    return F.coalesce(shares, (whole_a == whole_b).cast("double"))


def shown(hashes: Column) -> Column:
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.lpad(F.hex(h.cast("long").bitwiseAND(F.lit(0xFFFFFFFF))), 8, "0"))), "")


def fingerprints(
    docs: DataFrame, low: float = 1.0, high: float = 7.0, subsets: int = 16, rate: float = 1 / 128, halvings: int = 0
) -> DataFrame:
    """``doc_id, row_key, whole, hashes`` of every document."""
    words = pinned(lexicon(docs, low, high), "lexicon")
    return signatures(with_keys(docs), words, subsets, rate, halvings).select("doc_id", "row_key", "whole", "hashes")


def fingerprints_of_edits(
    docs: DataFrame,
    share: int = 4,
    low: float = 1.0,
    high: float = 7.0,
    subsets: int = 16,
    rate: float = 1 / 128,
    halvings: int = 0,
) -> DataFrame:
    """Fingerprints of every document and of an edited text, in which the last ``1/share`` of its
    code points are replaced by as many from the start of the next document.

    The texts are shuffled once, by key, and read from that shuffle by both joins, which therefore
    take the same columns; the starts travel to the documents before them.
    """
    words = pinned(lexicon(docs, low, high), "lexicon")
    keyed = with_keys(docs)
    n = F.char_length("text")
    cut = F.floor(n / share).cast("int")
    wanted = pinned(keyed.select(*KEY, cut.alias("cut")).distinct().join(following(keyed), KEY), "wanted")

    texts = keyed.select(*KEY, "text")
    asked = wanted.select(
        F.col("next_id0").alias("id0"), F.col("next_row_key").alias("row_key"), F.col("id0").alias("for_id0"), F.col("row_key").alias("for_key"), "cut"
    )
    starts = texts.join(asked, KEY).select(
        F.col("for_id0").alias("id0"), F.col("for_key").alias("row_key"), F.substring(F.col("text"), F.lit(1), F.col("cut")).alias("start")
    )
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.col("start"))
    described = texts.join(starts, KEY).select(*KEY, n.cast("long").alias("n_chars"), "text", edited.alias("edited"))
    versions = described.withColumn("edited_sha256", F.sha2("edited", 256)).select(
        *KEY, "n_chars", "edited_sha256",
        F.inline(F.array(
            F.struct(F.lit(False).alias("is_edited"), F.col("text")), F.struct(F.lit(True).alias("is_edited"), F.col("edited").alias("text"))
        )),
    )
    signed = pinned(signatures(versions, words, subsets, rate, halvings), "signatures")
    own = signed.filter(~F.col("is_edited")).drop("is_edited").join(wanted.drop("cut"), KEY)
    changed = signed.filter("is_edited").select(*KEY, F.col("whole").alias("edited_whole"), F.col("hashes").alias("edited_hashes"))
    beyond = signed.filter(~F.col("is_edited")).select(
        F.col("id0").alias("next_id0"),
        F.col("row_key").alias("next_row_key"),
        F.col("whole").alias("next_whole"),
        F.col("hashes").alias("next_hashes"),
    )
    return (
        own.join(changed, KEY)
        .join(beyond, ["next_id0", "next_row_key"])
        .select(
            "doc_id", "row_key", "n_chars", "edited_sha256",
            "whole", "hashes", "edited_whole", "edited_hashes", "next_whole", "next_hashes",
        )
    )
