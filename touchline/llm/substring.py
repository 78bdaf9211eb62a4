"""Substring dedup: words covered by a window that starts in an earlier document are removed.

Consecutive windows that share a minimiser form a super-k-mer. They stay together: first only
super-k-mers whose minimiser stands in several documents are kept, then equal ones are put
together, so that copies count once. Where a bucket, the super-k-mers of one minimiser, holds
different ones, their words travel to it as one packed string each; there, sorting all windows
tells in which document each occurs first. Buckets of more than ``bucket_strings`` different
strings are not gathered in a task: their windows are spread and counted one by one.
Windows are told apart by 128 bits of two independent digests of their words.

Every occurrence of a super-k-mer in a later document than its first is covered whole; what its
first document holds is covered where a window occurs in an earlier document still.

Defined results: a NULL text has no words; rows with the same id are one document to each other,
so neither is earlier, and each gets its result; a row without an id is never earlier or later.
Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.superkmers import super_kmers, window_digests
from touchline.sources.workspace import pinned

KEY = ["id0", "row_key"]
STRING = ["minimiser", "s1", "s2", "n"]
RUNS = "runs array<struct<at:int,n:int>>"


def words_of(text: str | None) -> list[bytes]:
    """ASCII white space separates words, and nothing else."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id0"),
        F.xxhash64("doc_id", "text").alias("row_key"),
        "text",
    )


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def find_super_kmers(keyed: DataFrame, window: int, m: int) -> DataFrame:
    """``minimiser, s1, s2`` (digests), ``n`` (windows), ``id0, row_key, start`` of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["minimiser", "s1", "s2", "n", "id0", "row_key", "start"]
        for batch in batches:
            ids, keys = (batch.column(c).to_numpy(zero_copy_only=False) for c in KEY)
            found, rows = [], []
            for i, text in enumerate(batch.column("text")):
                words = words_of(text.as_py())
                if len(words) >= window:
                    found.append(super_kmers(words, window, m))
                    rows.append(np.full(len(found[-1][0]), i))
            if found:
                minimiser, start, n, s1, s2 = (np.concatenate(parts) for parts in zip(*found))
                row = np.concatenate(rows)
                yield pa.RecordBatch.from_arrays(
                    [_signed(minimiser), _signed(s1), _signed(s2), pa.array(n.astype(np.int32)),
                     pa.array(ids[row]), pa.array(keys[row]), pa.array(start.astype(np.int32))],
                    names,
                )

    schema = "minimiser long, s1 long, s2 long, n int, id0 long, row_key long, start int"
    return keyed.filter(F.col("doc_id").isNotNull()).select(*KEY, "text").mapInArrow(run, schema)


def _packed(documents: DataFrame, picks: DataFrame, window: int) -> DataFrame:
    """The words of the picked super-k-mers, taken from their first occurrence."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc_id, text, wanted in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("wanted").to_pylist()):
                words = words_of(text.as_py())
                for w in wanted:
                    stretch = words[w["start"] : w["start"] + w["n"] + window - 1]
                    rows.append((w["minimiser"], w["s1"], w["s2"], w["n"], doc_id, b" ".join(stretch)))
            if rows:
                types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types)], [*STRING, "first", "packed"]
                )

    wanted = picks.groupBy(F.col("at.id0").alias("w_id0"), F.col("at.row_key").alias("w_key")).agg(
        F.collect_list(F.struct("minimiser", "s1", "s2", "n", F.col("at.start").alias("start"))).alias("wanted")
    )
    same = (F.col("id0") == F.col("w_id0")) & (F.col("row_key") == F.col("w_key"))
    return (
        documents.join(wanted, same)
        .select("doc_id", "text", "wanted")
        .mapInArrow(run, "minimiser long, s1 long, s2 long, n int, first long, packed binary")
    )


def _earlier(first: np.ndarray, strings: np.ndarray, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
    """Of each window, whether it occurs in an earlier document than its own string."""
    order = np.lexsort((k2, k1))
    a, b = k1[order], k2[order]
    begins = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    own = first[strings[order]]
    smallest = np.repeat(np.minimum.reduceat(own, begins), np.diff(np.concatenate((begins, [len(a)]))))
    earlier = np.empty(len(a), dtype=bool)
    earlier[order] = smallest < own
    return earlier


def _sorted_buckets(packed: DataFrame, window: int, at_once: int = 2000) -> DataFrame:
    """Per string the runs of windows that occur in an earlier document. A bucket's rows
    follow one another in a partition; whole buckets are sorted together."""

    def solve(rows: list[tuple]) -> pa.RecordBatch:
        digests = [window_digests(r[5].split(b" "), window) for r in rows]
        strings = np.repeat(np.arange(len(rows)), [len(d[0]) for d in digests])
        first = np.array([r[4] for r in rows])
        earlier = _earlier(first, strings, *(np.concatenate([d[i] for d in digests]) for i in (0, 1)))
        out, at = [], 0
        for row, digest in zip(rows, digests):
            flags = np.concatenate(([0], earlier[at : at + len(digest[0])].astype(np.int8), [0]))
            at += len(digest[0])
            steps = np.diff(flags)
            begins, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
            if len(begins):
                out.append((*row[:4], [{"at": int(b), "n": int(e - b)} for b, e in zip(begins, ends)]))
        runs = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), runs]
        columns = list(zip(*out)) or [[]] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], [*STRING, "runs"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if len(held) >= at_once and row[0] != held[-1][0]:
                    yield solve(held)
                    held = []
                held.append(row)
        if held:
            yield solve(held)

    gathered = packed.repartition("minimiser").sortWithinPartitions("minimiser")
    return gathered.select(*STRING, "first", "packed").mapInArrow(run, f"minimiser long, s1 long, s2 long, n int, {RUNS}")


def _spread_buckets(packed: DataFrame, window: int) -> DataFrame:
    """The same for buckets of any size: each window is a row, and no key gathers its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                k1, k2 = window_digests(row[5].split(b" "), window)
                n = len(k1)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(np.full(n, v), t) for v, t in zip(row[:5], [pa.int64()] * 3 + [pa.int32(), pa.int64()])),
                     pa.array(np.arange(n, dtype=np.int32)), _signed(k1), _signed(k2)],
                    [*STRING, "first", "at", "k1", "k2"],
                )

    schema = "minimiser long, s1 long, s2 long, n int, first long, at int, k1 long, k2 long"
    windows = packed.select(*STRING, "first", "packed").mapInArrow(run, schema)
    repeated = windows.groupBy("k1", "k2").agg(F.min("first").alias("smallest"), F.max("first").alias("largest"))
    repeated = repeated.filter(F.col("smallest") < F.col("largest")).drop("largest")
    earlier = windows.join(repeated, ["k1", "k2"]).filter(F.col("smallest") < F.col("first"))
    return earlier.groupBy(*STRING).agg(F.collect_list(F.struct("at", F.lit(1).alias("n"))).alias("runs"))


def covered(keyed: DataFrame, window: int, m: int, bucket_strings: int) -> DataFrame:
    """``id0, row_key, spans``: first windows and numbers of windows to remove, per document."""
    every = pinned(find_super_kmers(keyed, window, m), "superkmers")
    shared = every.groupBy("minimiser").agg(F.min("id0").alias("lowest"), F.max("id0").alias("highest"))
    shared = shared.filter(F.col("lowest") < F.col("highest")).select("minimiser")
    # Sides are written, so that both are plain shuffles, which Spark splits where a key is hot.
    kept = pinned(every.join(pinned(shared, "minimisers"), "minimiser"), "shared")

    strings = pinned(kept.groupBy(*STRING).agg(F.min(F.struct("id0", "row_key", "start")).alias("at")), "strings")
    sizes = strings.groupBy("minimiser").agg(F.count("*").alias("strings")).filter("strings > 1")
    picks = pinned(strings.join(pinned(sizes, "sizes"), "minimiser"), "picks")
    runs = _sorted_buckets(_packed(keyed, picks.filter(F.col("strings") <= bucket_strings), window), window)
    crowded = picks.filter(F.col("strings") > bucket_strings)
    if not crowded.isEmpty():
        runs = runs.unionByName(_spread_buckets(_packed(keyed, crowded, window), window))

    marked = pinned(
        kept.join(strings, STRING).select(*STRING, *KEY, "start", (F.col("id0") > F.col("at.id0")).alias("later")), "marked"
    )
    whole = marked.filter("later").select(*KEY, "start", "n")
    some = (
        marked.filter(~F.col("later"))
        .join(runs, STRING)
        .select(*KEY, "start", F.inline("runs").alias("at", "length"))
        .select(*KEY, (F.col("start") + F.col("at")).alias("start"), F.col("length").alias("n"))
    )
    return whole.unionByName(some).groupBy(*KEY).agg(F.collect_set(F.struct("start", "n")).alias("spans"))


def dedup_substrings(docs: DataFrame, window: int = 50, m: int = 16, bucket_strings: int = 5000) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, n_words, n_removed, kept``, the words that are left,
    joined by one space."""
    keyed = _keyed(docs)
    spans = covered(keyed, window, m, bucket_strings).withColumnsRenamed({"id0": "s_id0", "row_key": "s_key"})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, removed, kept = [], [], []
            for text, found in zip(batch.column("text"), batch.column("spans").to_pylist()):
                words = words_of(text.as_py())
                total.append(len(words))
                if found:
                    steps = np.zeros(len(words) + 1, dtype=np.int64)
                    starts = np.array([s["start"] for s in found])
                    np.add.at(steps, starts, 1)
                    np.add.at(steps, starts + np.array([s["n"] for s in found]) + window - 1, -1)
                    free = (np.cumsum(steps[:-1]) == 0).tolist()
                    words = [w for w, keep in zip(words, free) if keep]
                removed.append(total[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "kept"],
            )

    same = (F.col("id0") == F.col("s_id0")) & (F.col("row_key") == F.col("s_key"))
    joined = keyed.join(spans, same, "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(run, "doc_id long, n_words long, n_removed long, kept string")
