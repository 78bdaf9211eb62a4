"""SimHash near-dedup: fingerprints of word shingles, linked at a small Hamming distance.

Links are found on distinct fingerprints, so exact copies cost nothing more. A fingerprint is
embedded as the number of set bits in each of its 32 two-bit segments. The Manhattan distance
of two embeddings is a lower bound of their Hamming distance. Written in unary (a segment's
bits sorted), the embedding is again 64 bits, and the Manhattan distance is the number of
bits in which two of them differ.

Range join on a grid: the segments are dealt to ``distance + 2`` groups. Fingerprints within the
distance agree in all counts of at least two groups, so each pair of groups is a grid whose
cells are the counts of both. Within a cell, pairs are held against the Manhattan bound, then
compared exactly. Cells of more than ``cell_rows`` fingerprints are not paired: their members
are keyed by every fingerprint within half the distance, which two members share if and only if
they link, and those who share one are linked to the smallest of them. Thus no group makes
more than ``cell_rows`` pairs per member, and no link is lost.

Defined results: NULL and empty texts have fingerprint zero, like texts without words, and link
as any other; a text of fewer words than a shingle is one shingle; rows that repeat an id get
one row each; NULL ids stay NULL and represent a
component only if it has no other. Other columns are kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.components import components
from touchline.llm.text import rows_key
from touchline.sources.workspace import pinned

SEED = 42
LOW = 0x5555555555555555


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The 64-bit SimHash of a text as a signed number."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        spans = [joined]
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        spans = [joined[a:b] for a, b in zip(starts[: 1 - shingle or None].tolist(), ends[shingle - 1 :].tolist())]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in spans], dtype="<u8")
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += part.sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, row_key, fingerprint`` (signed 64 bits) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py(), shingle) for t in batch.column("text")]
            columns = [batch.column("doc_id"), batch.column("row_key"), pa.array(prints, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "row_key", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", rows_key(F.col("text")).alias("row_key"), "text")
    return keyed.mapInArrow(run, f"doc_id {kind}, row_key bigint, fingerprint bigint")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def embedding(print_: Column) -> Column:
    """The bits of every two-bit segment, sorted: its count in unary."""
    high = F.shiftrightunsigned(print_, 1)
    both = print_.bitwiseAND(high).bitwiseAND(F.lit(LOW))
    some = print_.bitwiseOR(high).bitwiseAND(F.lit(LOW))
    return F.shiftleft(both, 1).bitwiseOR(some)


def grid_masks(distance: int) -> list[int]:
    """For every pair of segment groups, a mask of its segments."""
    groups = distance + 2
    edges = [round(32 * g / groups) * 2 for g in range(groups + 1)]
    masks = [((1 << edges[g + 1]) - 1) ^ ((1 << edges[g]) - 1) for g in range(groups)]
    return [_signed(a | b) for a, b in combinations(masks, 2)]


def _neighbours(print_: Column, radius: int) -> Column:
    """All fingerprints within ``radius`` bits."""
    flips = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return F.transform(
        F.lit([_signed(f) for f in flips]), lambda flip: print_.bitwiseXOR(flip)
    )


def links(prints: DataFrame, distance: int = 2, cell_rows: int = 64) -> DataFrame:
    """Links ``(a, b)`` that connect all distinct ``fingerprint`` values within the distance.

    For members of large cells they are enough to reach one another, not each single pair.
    """
    if distance % 2:
        raise ValueError("the exact way for large cells needs an even distance")
    embedded = prints.select("fingerprint", embedding(F.col("fingerprint")).alias("e"))
    cells = F.array(*[
        F.struct(F.lit(i).alias("grid"), F.col("e").bitwiseAND(F.lit(m)).alias("cell"))
        for i, m in enumerate(grid_masks(distance))
    ])
    members = embedded.select("fingerprint", "e", F.inline(cells))
    sizes = members.groupBy("grid", "cell").agg(F.count("*").alias("rows")).filter("rows > 1")
    sized = pinned(members.join(sizes, ["grid", "cell"]), "cells")
    small = sized.filter(F.col("rows") <= cell_rows)
    left = small.select("grid", "cell", F.col("fingerprint").alias("a"), F.col("e").alias("ea"))
    right = small.select("grid", "cell", F.col("fingerprint").alias("b"), F.col("e").alias("eb"))
    close = (
        left.join(right, ["grid", "cell"])
        .filter(F.col("a") < F.col("b"))
        .filter(F.bit_count(F.col("ea").bitwiseXOR(F.col("eb"))) <= distance)
        .filter(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
        .select("a", "b")
    )
    crowded = sized.filter(F.col("rows") > cell_rows).select("fingerprint").distinct()
    around = crowded.select("fingerprint", F.explode(_neighbours(F.col("fingerprint"), distance // 2)).alias("point"))
    smallest = around.groupBy("point").agg(
        F.min("fingerprint").alias("a"), F.max("fingerprint").alias("largest")
    ).filter(F.col("a") != F.col("largest"))
    shared = around.join(smallest, "point").filter(F.col("fingerprint") != F.col("a"))
    return close.unionByName(shared.select("a", F.col("fingerprint").alias("b"))).distinct()


def near_groups(docs: DataFrame, shingle: int = 3, distance: int = 2, cell_rows: int = 64) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, row_key, fingerprint, component_id``, the smallest
    id that can be reached over links, and ``chosen``, whether the row represents its component."""
    prints = pinned(fingerprints(docs, shingle), "prints")
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")
    distinct = prints.groupBy("fingerprint").agg(F.min(place).alias("first"))
    roots = components(links(distinct.select("fingerprint"), distance, cell_rows)).select(
        F.col("node").alias("fingerprint"), "root"
    )
    rooted = distinct.join(roots, "fingerprint", "left").withColumn("root", F.coalesce("root", "fingerprint"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    classes = rooted.join(smallest, "root").select("fingerprint", "component")
    return prints.join(classes, "fingerprint").select(
        "doc_id", "row_key", "fingerprint", F.col("component.doc_id").alias("component_id"), (place == F.col("component")).alias("chosen")
    )


def keep_one(docs: DataFrame, shingle: int = 3, distance: int = 2, cell_rows: int = 64) -> DataFrame:
    """The documents that represent their component, with the columns they had. Rows equal in
    id and text count as one document."""
    chosen = near_groups(docs, shingle, distance, cell_rows).filter("chosen").select(
        F.col("doc_id").alias("__id"), F.col("row_key").alias("__key")
    )
    keyed = docs.withColumn("__text_key", rows_key(F.col("text")))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key"))
    return keyed.join(chosen, same, "left_semi").dropDuplicates(["doc_id", "__text_key"]).select(*docs.columns)
