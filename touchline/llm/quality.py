"""Quality classifier: ridge regression on random Fourier features, calibrated.

Every text is described by a few statistics. Cosines of random projections approximate a
Gaussian kernel over them; the ridge weights solve normal equations that are summed per
partition, then by Spark. An isotonic curve over the scores makes them probabilities; it is
fitted on counts per score bin and applied by interpolation. All labelled rows are used.

Defined results: NULL and empty texts have the statistics 0 and get a score like any other;
labels without an id or a value are left out, and a document labelled twice counts twice;
without a label of both kinds, every score is the mean label, or 0.5 without labels. Rows
that repeat an id are scored one by one. ``score_rows`` keeps other columns.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATISTICS = (
    "log_chars upper digits symbols exclaim space newlines high mean_word spread_word short_words "
    "distinct_words top_word word_entropy byte_entropy repeated_lines packed sentence_words capitals"
).split()

_CLASSES = np.zeros((6, 256))
_CLASSES[0, 65:91] = 1
_CLASSES[1, 48:58] = 1
_CLASSES[2, [c for c in range(33, 127) if not chr(c).isalnum() and chr(c) not in ".,;:'\"!?-()"]] = 1
_CLASSES[3, [33, 63]] = 1
_CLASSES[4, [9, 11, 12, 13, 32]] = 1
_CLASSES[5, 128:] = 1

#: Bins of the raw score, from LOWEST to LOWEST + BINS / PER_UNIT.
LOWEST, PER_UNIT, BINS = -0.5, 2000, 4000


def statistics(text: str | None) -> list[float]:
    """The numbers named in ``STATISTICS``, of the whole text."""
    data = (text or "").encode("utf-8", "surrogatepass")
    n = len(data)
    if not n:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    upper, digits, symbols, exclaim, space, high = (_CLASSES @ counts / n).tolist()
    used = counts[counts > 0] / n
    words = data.split()
    k = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    often = np.fromiter(Counter(words).values(), np.float64) if words else np.ones(1)
    shares = often / often.sum()
    lines = data.split(b"\n")
    ends = counts[46] + counts[33] + counts[63]
    return [
        math.log1p(n),
        upper,
        digits,
        symbols,
        exclaim,
        space,
        counts[10] / n,
        high,
        float(lengths.mean()),
        float(lengths.std()),
        float((lengths <= 3).mean()),
        len(often) / k,
        float(shares.max()),
        float(-(shares * np.log(shares)).sum()) / math.log(k + 1),
        float(-(used * np.log(used)).sum()),
        1 - len(set(lines)) / len(lines),
        len(zlib.compress(data, 1)) / n,
        math.log1p(k / (ends + 1)),
        float(sum(w.isupper() for w in words)) / k,
    ]


def statistics_of(docs: DataFrame) -> DataFrame:
    """``doc_id`` and ``stats`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            stats = [statistics(t.as_py()) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(stats, pa.list_(pa.float64()))], ["doc_id", "stats"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, stats array<double>")


@dataclass(frozen=True)
class QualityModel:
    mean: np.ndarray
    scale: np.ndarray
    projection: np.ndarray
    phase: np.ndarray
    weights: np.ndarray
    knots: np.ndarray
    levels: np.ndarray

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return fourier(stats, self.mean, self.scale, self.projection, self.phase) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        return np.interp(self.raw(stats), self.knots, self.levels)


def fourier(stats, mean, scale, projection, phase) -> np.ndarray:
    """Random features with a constant in front. Far outliers are drawn in to 6 deviations."""
    x = np.clip((stats - mean) / scale, -6, 6)
    waves = np.cos(x @ projection + phase) * math.sqrt(2 / len(phase))
    return np.hstack([np.ones((len(x), 1)), waves])


def _stacked(batch: pa.RecordBatch) -> np.ndarray:
    flat = batch.column("stats").flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(batch.num_rows, len(STATISTICS))


def pool_adjacent(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """The non-decreasing sequence closest to ``values`` in weighted squares."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, w, n = blocks.pop()
            u = blocks[-1]
            blocks[-1] = [(u[0] * u[1] + v * w) / (u[1] + w), u[1] + w, u[2] + n]
    return np.concatenate([np.full(n, v) for v, _, n in blocks])


def fit(labelled: DataFrame, label: str, features: int = 192, width: float = 8.0, ridge: float = 1e-2, seed: int = 7) -> QualityModel:
    """Fit on ``labelled(stats, <label>)``; ``width`` is the kernel's, in standard deviations.

    Only sums reach the driver: the normal equations (``features`` squared) and the bins.
    """
    rows = labelled.filter(F.col(label).isNotNull()).select("stats", F.col(label).cast("double").alias("y"))
    d = len(STATISTICS)
    sums = rows.agg(
        F.count("*").alias("n"), F.avg("y").alias("y"),
        *[F.avg(F.col("stats")[i]).alias(f"m{i}") for i in range(d)],
        *[F.stddev_pop(F.col("stats")[i]).alias(f"s{i}") for i in range(d)],
    ).first()
    rng = np.random.default_rng(seed)
    projection = rng.normal(size=(d, features)) / width
    phase = rng.uniform(0, 2 * math.pi, features)
    n, mean_label = sums["n"], sums["y"]
    mean = np.array([sums[f"m{i}"] or 0.0 for i in range(d)])
    scale = np.array([max(sums[f"s{i}"] or 0.0, 1e-6) for i in range(d)])
    if not n or mean_label in (0.0, 1.0):
        level = 0.5 if not n else mean_label
        zero = np.zeros(features + 1)
        return QualityModel(mean, scale, projection, phase, zero, np.array([0.0]), np.array([level]))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((features + 1, features + 2))
        for batch in batches:
            z = fourier(_stacked(batch), mean, scale, projection, phase)
            y = batch.column("y").to_numpy(zero_copy_only=False)
            total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(features + 1), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], ["i", "row"]
        )

    cells = rows.mapInArrow(summed, "i int, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    equations = np.zeros((features + 1, features + 2))
    for i, j, v in cells.groupBy("i", "j").agg(F.sum("v")).collect():
        equations[i, j] = v
    penalty = np.eye(features + 1) * ridge * n / features
    penalty[0, 0] = 0
    weights = np.linalg.solve(equations[:, :-1] + penalty + np.eye(features + 1) * 1e-9, equations[:, -1])
    model = QualityModel(mean, scale, projection, phase, weights, np.array([0.0]), np.array([0.0]))

    def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.clip(np.rint((model.raw(_stacked(batch)) - LOWEST) * PER_UNIT), 0, BINS).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column("y")], ["bin", "y"])

    counted = rows.mapInArrow(binned, "bin int, y double").groupBy("bin").agg(F.count("*").alias("n"), F.avg("y").alias("y"))
    points = sorted(tuple(r) for r in counted.collect())
    x = np.array([LOWEST + b / PER_UNIT for b, _, _ in points])
    weight = np.array([float(k) for _, k, _ in points])
    curve = pool_adjacent(np.array([y for _, _, y in points]), weight)
    # One knot per block, at its mean score: between blocks the curve rises instead of jumping.
    starts = np.flatnonzero(np.concatenate(([True], np.diff(curve) > 0)))
    mass = np.add.reduceat(weight, starts)
    knots = np.add.reduceat(x * weight, starts) / mass
    return QualityModel(mean, scale, projection, phase, weights, knots, np.clip(curve[starts], 0, 1))


def score_statistics(stats: DataFrame, model: QualityModel) -> DataFrame:
    """``doc_id, score`` of every row of ``stats``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(model.score(_stacked(batch)))], ["doc_id", "score"]
            )

    kind = stats.schema["doc_id"].dataType.simpleString()
    return stats.select("doc_id", "stats").mapInArrow(run, f"doc_id {kind}, score double")


def keep_rows(docs: DataFrame, decide: Callable[[np.ndarray], np.ndarray], model: QualityModel) -> DataFrame:
    """The rows whose scores ``decide`` accepts, with the columns they had. Nothing is shuffled:
    the rows pass through the task that scores them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                stats = np.array([statistics(t.as_py()) for t in batch.column("text")])
                yield batch.filter(pa.array(decide(model.score(stats))))

    return docs.mapInArrow(run, docs.schema)


def held_out(doc_id: Column, folds: int = 5) -> Column:
    """Whether a row's labels stay unseen; always so without an id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(True))


def training(stats: DataFrame, labels: DataFrame, label: str) -> DataFrame:
    """The rows to learn from, with their label."""
    return stats.join(_known(labels, label), "doc_id")


def _known(labels: DataFrame, label: str) -> DataFrame:
    return labels.filter(F.col(label).isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id", F.col(label))


def labelled_statistics(docs: DataFrame, labels: DataFrame, label: str, fit_rows: int = 50_000) -> DataFrame:
    """The same from texts, for about ``fit_rows`` labelled rows at most, drawn by a hash of their id.
    Statistics are taken where the texts lie; they, not the texts, travel to the labels."""
    known = _known(labels, label)
    share = min(1.0, fit_rows / max(1, known.count()))
    if share < 1:
        def drawn(rows: DataFrame) -> DataFrame:
            number = F.xxhash64(F.col("doc_id").cast("string"), F.lit("fit")).bitwiseAND(F.lit((1 << 30) - 1))
            return rows.filter(number < F.lit(round(share * (1 << 30))))

        docs, known = drawn(docs), drawn(known)
    return statistics_of(docs).join(known, "doc_id")
