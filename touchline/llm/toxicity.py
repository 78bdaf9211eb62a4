"""Toxicity by multiple-instance learning: labels are of documents, scores of sentences.

A sentence's probability is a logistic function of the lexicon entries in it; a document's is the
noisy-or of its sentences, so it is toxic as soon as one of them is. Weights are trained on the
documents' labels alone, and then locate the offending sentences.

The fit uses at most about ``fit_rows`` labelled documents: per class, a share of the ids
chosen by hash, weighted back to the class's count. Entries are words and word beginnings, as many
languages inflect; the ``lexicon`` entries whose document frequencies differ most between the
classes of that sample are used. Scoring covers all texts.

Defined results: NULL and empty texts have no sentences and the score 0; labels without an id or a
value are left out; without a label of both kinds, all scores are 0. Rows that repeat an id are
scored one by one. Other columns are not carried.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.quality import held_out

SENTENCE = re.compile(r"[^.!?\n]+[.!?]*")
WORD = re.compile(r"[^\W\d_]+")


#: Lengths of the word beginnings, and words whose entries a task remembers.
BEGINNINGS, REMEMBERED = range(4, 8), 200_000


def entries_of(word: str) -> list[str]:
    """The word, and its beginnings with a mark behind."""
    return [word, *(word[:k] + "-" for k in BEGINNINGS if len(word) > k)]


def words_of(sentence: str) -> set[str]:
    return set(WORD.findall(sentence.lower()))


class Finder:
    """Finds the entries of a lexicon in sentences."""

    def __init__(self, lexicon):
        self.lexicon, self.known = frozenset(lexicon), {}

    def __call__(self, sentence: str) -> set[str]:
        found: set[str] = set()
        for word in words_of(sentence):
            entries = self.known.get(word)
            if entries is None:
                if len(self.known) >= REMEMBERED:
                    self.known.clear()
                entries = self.known[word] = [e for e in entries_of(word) if e in self.lexicon]
            found.update(entries)
        return found


@dataclass(frozen=True)
class ToxicityModel:
    weights: dict[str, float]
    bias: float

    def sentences(self, text: str | None, find: Finder) -> list[tuple[int, int, float]]:
        """Start, end and log-odds of each sentence."""
        return [
            (m.start(), m.end(), self.bias + sum(self.weights[e] for e in find(m.group())))
            for m in SENTENCE.finditer(text or "")
        ]


def fit_sample(labels: DataFrame, label: str, fit_rows: int) -> DataFrame:
    """``doc_id, y, weight``: of each class, about half of ``fit_rows`` training labels."""
    known = labels.filter(F.col(label).isNotNull() & ~held_out(F.col("doc_id"))).select(
        "doc_id", F.col(label).cast("int").alias("y")
    )
    counts = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = {y: min(1.0, fit_rows / 2 / n) for y, n in counts.items()}
    rate = F.lit(0.0)
    for y, s in share.items():
        rate = F.when(F.col("y") == y, F.lit(s)).otherwise(rate)
    drawn = F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 20)) < rate * (1 << 20)
    return known.filter(drawn).withColumn("weight", 1 / rate)


def choose_lexicon(sample: DataFrame, lexicon: int) -> list[str]:
    """The entries of ``sample(text, y)`` that tell the classes apart best, by a z-score."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text, y in zip(batch.column("text"), batch.column("y").to_pylist()):
                found = list({e for w in words_of(text.as_py() or "") for e in entries_of(w)})
                yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array([y] * len(found), pa.int32())], ["word", "y"])

    totals = {r["y"]: r["n"] for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if len(totals) < 2:
        return []
    counted = sample.select("text", "y").mapInArrow(distinct, "word string, y int").groupBy("word").agg(
        F.count_if(F.col("y") == 1).alias("in_1"), F.count_if(F.col("y") == 0).alias("in_0")
    )
    p1 = (F.col("in_1") + 0.5) / (totals[1] + 1)
    p0 = (F.col("in_0") + 0.5) / (totals[0] + 1)
    p = (F.col("in_1") + F.col("in_0") + 1) / (totals[0] + totals[1] + 2)
    z = (p1 - p0) / F.sqrt(p * (1 - p) * (1 / totals[1] + 1 / totals[0]))
    best = counted.filter(F.col("in_1") + F.col("in_0") > 1).select("word", F.abs(z).alias("z"))
    return sorted(r["word"] for r in best.orderBy(F.desc("z"), "word").limit(lexicon).collect())


def bags(sample: DataFrame, lexicon: list[str]) -> DataFrame:
    """Per document its number of sentences without a lexicon entry, and of each other sentence the
    entries' numbers: ``y, weight, plain, sizes, words``."""
    number = {w: i for i, w in enumerate(lexicon)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Finder(number)
        for batch in batches:
            plain, sizes, words = [], [], []
            for text in batch.column("text"):
                found = [find(m.group()) for m in SENTENCE.finditer(text.as_py() or "")]
                some = [f for f in found if f]
                plain.append(len(found) - len(some))
                sizes.append([len(f) for f in some])
                words.append([number[w] for f in some for w in sorted(f)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("y"), batch.column("weight"), pa.array(plain, pa.int32()),
                 pa.array(sizes, pa.list_(pa.int32())), pa.array(words, pa.list_(pa.int32()))],
                ["y", "weight", "plain", "sizes", "words"],
            )

    kind = "y int, weight double, plain int, sizes array<int>, words array<int>"
    return sample.select("text", "y", "weight").mapInArrow(run, kind)


def train(rows: pa.Table, lexicon: list[str], rounds: int = 300, rate: float = 0.1, penalty: float = 1e-4) -> ToxicityModel:
    """Descend (Adam) the weighted log loss of the noisy-or."""
    y = rows["y"].to_numpy().astype(float)
    weight = rows["weight"].to_numpy()
    weight = weight / weight.sum()
    plain = rows["plain"].to_numpy().astype(float)
    sizes_of = rows["sizes"].combine_chunks()
    sizes = sizes_of.flatten().to_numpy()
    words = rows["words"].combine_chunks().flatten().to_numpy()
    document = np.repeat(np.arange(len(y)), np.diff(sizes_of.offsets.to_numpy()))
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    values = np.concatenate([np.zeros(len(lexicon)), [-5.0]])
    first, second = np.zeros_like(values), np.zeros_like(values)
    for step in range(1, rounds + 1):
        z = values[-1] + np.bincount(sentence, values[words], len(sizes))
        silent = np.logaddexp(0, values[-1])
        total = np.bincount(document, np.logaddexp(0, z), len(y)) + plain * silent
        slope = weight * np.where(y > 0, -1 / np.expm1(np.clip(total, 1e-6, 50)), 1.0)
        rise = slope[document] / (1 + np.exp(-z))
        gradient = np.bincount(words, rise[sentence], len(lexicon))
        bias = rise.sum() + (slope * plain).sum() / (1 + np.exp(-values[-1]))
        g = np.concatenate([gradient + penalty * values[:-1], [bias]])
        first = 0.9 * first + 0.1 * g
        second = 0.999 * second + 0.001 * g * g
        values = values - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return ToxicityModel({w: float(v) for w, v in zip(lexicon, values)}, float(values[-1]))


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", fit_rows: int = 20_000, lexicon: int = 500) -> ToxicityModel:
    chosen = fit_sample(labels, label, fit_rows)
    # The sample's size is bounded by fit_rows, so that the texts need not be shuffled.
    sample = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "y", "weight")
    words = choose_lexicon(sample, lexicon)
    if not words:
        return ToxicityModel({}, -np.inf)
    return train(bags(sample, words).toArrow(), words)


def score(docs: DataFrame, model: ToxicityModel, offending: float = 0.5) -> DataFrame:
    """``doc_id, score`` and ``offending``, the sentences (start, end, score) that reach a probability."""
    log_odds = np.log(offending / (1 - offending))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = Finder(model.weights)
        for batch in batches:
            scores, located = [], []
            for text in batch.column("text"):
                found = model.sentences(text.as_py(), find)
                total = np.logaddexp(0, np.array([z for _, _, z in found])).sum()
                scores.append(float(-np.expm1(-total)))
                located.append([
                    {"start": a, "until": b, "score": float(1 / (1 + np.exp(-z)))} for a, b, z in found if z >= log_odds
                ])
            spans = pa.list_(pa.struct([("start", pa.int32()), ("until", pa.int32()), ("score", pa.float64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64()), pa.array(located, spans)], ["doc_id", "score", "offending"]
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, score double, offending array<struct<start:int,until:int,score:double>>"
    )
