"""Embedding whitening: vectors projected on the leading components of their covariance.

Entries become whole numbers first, so that sums over all vectors are exact. The components are
fitted to the distinct vectors: counts and sums in one pass, the covariance in a second, centred
before anything is multiplied. Each partition adds up its own square matrix, and Spark sums the
matrices row by row. What reaches the driver is one matrix of the vectors' length, whatever their
number; its eigenvectors come from ``feast``. A third pass measures how far the whitened
vectors' covariance is from the identity.

Defined results: rows whose vector is NULL, or holds a NULL, a number that is not finite, or one
beyond 2**62 after scaling, have no result; nor have vectors of another length than most
distinct ones have (of equally common lengths the longest counts). NULL ids are kept, rows
that repeat an id or a vector are whitened one by one. Without two different vectors there are no
components. A ``deviation`` that does not fit a long is NULL. Other columns are kept, but for those
that ``whiten`` writes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.llm.feast import leading
from touchline.sources.workspace import pinned

LARGEST = 2.0**62
WRITTEN = ("deviation", "whitened")


def whole_numbers(vectors: DataFrame, column: str = "embedding", scale: int = 64, offset: int = 1_000_000, into: str = "x") -> DataFrame:
    """The rows whose vectors are usable, with ``floor(scale * entry) + offset`` as longs."""
    entry = F.col(column)
    finite = F.forall(entry, lambda c: F.coalesce(F.abs(c.cast("double") * scale) < LARGEST, F.lit(False)))
    usable = entry.isNotNull() & finite  # a NaN is larger than any number
    whole = F.transform(entry, lambda c: F.floor(c.cast("double") * scale).cast("long") + F.lit(offset).cast("long"))
    return vectors.filter(usable).withColumn(into, whole)


@dataclass(frozen=True)
class Whitening:
    """A fit: the number of distinct vectors, their sums, and the components as columns."""

    n: int
    sums: tuple[int, ...]
    eigenvalues: np.ndarray
    components: np.ndarray
    explained: np.ndarray

    @property
    def length(self) -> int:
        return len(self.sums)


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _shifted(x: np.ndarray, n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """``x`` less the whole part of the mean, exactly, and the numerators over n that are left."""
    whole, rest = zip(*(divmod(s, n) for s in sums)) if sums else ((), ())
    return x - np.array(whole, dtype=np.int64), np.array(rest, dtype=object)


def _centred(x: np.ndarray, n: int, sums: tuple[int, ...]) -> np.ndarray:
    near, rest = _shifted(x, n, sums)
    return near.astype(float) - (rest / n).astype(float)


def _exact_deviation(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """The sum over dimensions of ``(n * x - sum)**2``."""
    near, rest = _shifted(x, n, sums)
    largest = n * (int(np.abs(near).max(initial=0)) + 1)
    exact = np.int64 if largest * largest * max(1, x.shape[1]) < 1 << 63 else object
    apart = near.astype(exact) * n - rest.astype(exact)
    found = (apart * apart).sum(axis=1).tolist()
    return [None if d >= 1 << 63 else d for d in found]


def _sum_of_parts(df: DataFrame, part: Callable[[np.ndarray], np.ndarray], width: int) -> np.ndarray:
    """The sum over all rows, of arrays ``part(rows)`` with ``width`` columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                own = part(_matrix(batch))
                total = own if total is None else total + own
        if total is not None:
            rows = pa.FixedSizeListArray.from_arrays(pa.array(total.ravel()), width).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int64()), rows], ["i", "row"])

    parts = df.select("x").mapInArrow(run, "i long, row array<double>").select("i", F.posexplode("row").alias("j", "value"))
    summed = parts.groupBy("i", "j").agg(F.sum("value").alias("value"))
    rows = summed.groupBy("i").agg(F.sort_array(F.collect_list(F.struct("j", "value"))).alias("row")).orderBy("i").collect()
    return np.array([[c["value"] for c in r["row"]] for r in rows]).reshape(-1, width)


def _count_and_sums(distinct: DataFrame, length: int) -> tuple[int, tuple[int, ...]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * length
        for batch in batches:
            x = _matrix(batch)
            exact = np.int64 if int(np.abs(x).max(initial=0)) * max(1, len(x)) < 1 << 63 else object
            n, sums = n + len(x), [a + int(b) for a, b in zip(sums, x.astype(exact).sum(axis=0))]
        values = pa.array([Decimal(v) for v in [n, *sums]], pa.decimal128(38, 0))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(length + 1), pa.int64()), values], ["i", "value"])

    parts = distinct.select("x").mapInArrow(run, "i long, value decimal(38,0)")
    found = {r["i"]: int(r["value"]) for r in parts.groupBy("i").agg(F.sum("value").cast("decimal(38,0)").alias("value")).collect()}
    return found.get(0, 0), tuple(found.get(i + 1, 0) for i in range(length))


def distinct_vectors(numbers: DataFrame) -> tuple[DataFrame, int]:
    """The distinct vectors of the commonest length, written, and that length."""
    every = pinned(numbers.select("x").distinct(), "vectors")
    lengths = every.groupBy(F.size("x").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).limit(1).collect()
    length = lengths[0]["length"] if lengths else 0
    return every.filter(F.size("x") == length), length


def fit(distinct: DataFrame, length: int, components: int = 16) -> Whitening:
    """Up to ``components`` leading components of distinct vectors ``x`` of one length."""
    n, sums = _count_and_sums(distinct, length)
    if n < 2 or not length:
        return Whitening(n, sums, np.zeros(0), np.zeros((length, 0)), np.zeros(0))

    def products(x: np.ndarray) -> np.ndarray:
        centred = _centred(x, n, sums)
        return centred.T @ centred

    covariance = _sum_of_parts(distinct, products, length) / n
    covariance = (covariance + covariance.T) / 2
    values, vectors = leading(covariance, components)
    return Whitening(n, sums, values, vectors, values / np.trace(covariance) if len(values) else values)


def project(x: np.ndarray, model: Whitening) -> np.ndarray:
    return _centred(x, model.n, model.sums) @ model.components / np.sqrt(model.eigenvalues)


def identity_error(distinct: DataFrame, model: Whitening) -> float | None:
    """The largest absolute entry of the whitened vectors' covariance less the identity."""
    size = len(model.eigenvalues)
    if not size:
        return None
    mean = _sum_of_parts(distinct, lambda x: project(x, model).sum(axis=0, keepdims=True), size)[0] / model.n

    def products(x: np.ndarray) -> np.ndarray:
        centred = project(x, model) - mean
        return centred.T @ centred

    return float(np.abs(_sum_of_parts(distinct, products, size) / model.n - np.eye(size)).max())


def whiten(numbers: DataFrame, model: Whitening) -> DataFrame:
    """The rows of the model's length with ``whitened array<double>`` and ``deviation``, the exact
    sum over dimensions of ``(n * x - sum)**2``; without ``x``."""
    kept = [f for f in numbers.schema.fields if f.name not in ("x", *WRITTEN)]
    schema = T.StructType([*kept, T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pc.equal(pc.list_value_length(batch.column("x")), model.length))
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            size = len(model.eigenvalues)
            offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * size)
            whitened = pa.ListArray.from_arrays(offsets, pa.array(project(x, model).ravel(), pa.float64()))
            deviation = pa.array(_exact_deviation(x, model.n, model.sums), pa.int64())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], deviation, whitened], [*names, "deviation", "whitened"])

    return numbers.select(*names, "x").mapInArrow(run, schema)
