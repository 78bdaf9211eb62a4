"""Language identification of web pages by Bayesian fusion of four kinds of evidence.

The likelihood of a page's text comes from byte trigrams, counted per language over a sample of
documents whose language is known. How far the language declared in the markup and the address
suffix can be trusted is learned from the pages: both are counted against the languages that the
texts suggest. The prior is that of the page's host, smoothed towards its domain, which is
smoothed towards its suffix and that towards all pages; a page's own text does not count
towards its prior. All counts are grouped aggregates, joined back by key.

The fit covers every language that has a document, and uses at most about ``fit_rows`` documents of
each, chosen by a hash of the id.

Defined results: NULL or empty markup has no text and declares nothing; an address that cannot
be parsed, or NULL, has the host, domain and suffix ``''``; declared languages beyond those known
count as ``other``; without documents of a known language the result has no rows to choose from
and ``ValueError`` is raised. Rows that repeat an id are judged one by one, given equal ids.
Other columns are not carried.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.llm.text import let
from touchline.sources.workspace import pinned

BUCKETS = 1 << 14
#: Trigrams overlap and so repeat one another's evidence.
OVERLAP = 3.0

UNSEEN = re.compile(r"<(script|style|noscript|template)\b.*?</\1\s*>|<!--.*?-->", re.S | re.I)
TAG = re.compile(r"<[^>]*>")
DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,3})(?![A-Za-z])", re.I)
HOST = re.compile(r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#]+)", re.I)


def visible_text(markup: str | None) -> str:
    return html.unescape(TAG.sub(" ", UNSEEN.sub(" ", markup or "")))


def trigram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the byte trigrams of the letters in ``text``, and their counts."""
    data = np.frombuffer(" ".join(re.findall(r"[^\W\d_]+", text.lower())).encode("utf-8", "surrogatepass"), np.uint8)
    if len(data) < 3:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    wide = data.astype(np.uint32)
    codes = (wide[:-2] << 16 | wide[1:-1] << 8 | wide[2:]) * np.uint32(2654435761) >> np.uint32(18)
    counts = np.bincount(codes, minlength=BUCKETS)
    seen = np.flatnonzero(counts)
    return seen, counts[seen]


@dataclass(frozen=True)
class TrigramModel:
    languages: list[str]
    log_share: np.ndarray

    def log_likelihood(self, text: str) -> np.ndarray:
        seen, counts = trigram_counts(text)
        return self.log_share[:, seen] @ counts / OVERLAP


def fit_trigrams(documents: DataFrame, fit_rows: int = 2000, held: int = 200) -> TrigramModel:
    """Counts of the documents' trigrams for every ``lang``. A task holds those of at most ``held``
    languages at a time."""
    known = documents.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        raise ValueError("no documents of a known language to learn from")
    rates = F.map_from_arrays(F.lit(list(sizes)), F.lit([min(1.0, fit_rows / n) for n in sizes.values()]))
    rate = F.element_at(rates, F.col("lang"))
    sample = known.filter(F.pmod(F.xxhash64("doc_id", F.lit("fit")), F.lit(1 << 20)) < rate * (1 << 20))
    names = sorted(sizes)
    number = {lang: i for i, lang in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}

        def table() -> pa.RecordBatch:
            cells = {i: np.flatnonzero(n) for i, n in total.items()}
            rows = [np.full(len(c), i, np.int32) for i, c in cells.items()]
            columns = [rows, [c.astype(np.int32) for c in cells.values()], [total[i][c] for i, c in cells.items()]]
            return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], ["lang", "bucket", "n"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                i = number[lang]
                if i not in total:
                    if len(total) >= held:
                        yield table()
                        total.clear()
                    total[i] = np.zeros(BUCKETS, dtype=np.int64)
                seen, counts = trigram_counts(text.as_py())
                total[i][seen] += counts
        if total:
            yield table()

    summed = sample.select("lang", "text").mapInArrow(count, "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n"))
    counts = np.full((len(names), BUCKETS), 0.5)
    for lang, bucket, n in summed.collect():
        counts[lang, bucket] += n
    return TrigramModel(names, np.log(counts / counts.sum(axis=1, keepdims=True)))


def page_evidence(pages: DataFrame, model: TrigramModel) -> DataFrame:
    """``page_id, host, domain, suffix, declared`` and ``text``, the text's log-likelihoods."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, domains, suffixes, declared, texts = [], [], [], [], []
            for url, markup in zip(batch.column("url"), batch.column("html")):
                markup = markup.as_py() or ""
                found = HOST.match(url.as_py() or "")
                host = found[1].lower().strip(".") if found else ""
                hosts.append(host)
                domains.append(".".join(host.split(".")[-2:]))
                suffixes.append(host.rpartition(".")[2])
                says = DECLARED.search(markup)
                lang = says[1].lower() if says else ""
                declared.append(lang if not lang or lang in model.languages else "other")
                texts.append(model.log_likelihood(visible_text(markup)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("page_id"), *(pa.array(c, pa.string()) for c in (hosts, domains, suffixes, declared)),
                 pa.array(texts, pa.list_(pa.float64()))],
                ["page_id", "host", "domain", "suffix", "declared", "text"],
            )

    kind = pages.schema["page_id"].dataType.simpleString()
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kind}, host string, domain string, suffix string, declared string, text array<double>"
    )


def _normalised(weights: Column) -> Column:
    return let(
        weights,
        lambda w: let(
            F.aggregate(w, F.lit(0.0), lambda a, b: a + b), lambda total: F.transform(w, lambda x: x / total)
        ),
    )


def _shares(logs: Column) -> Column:
    """Probabilities of log weights."""
    return _normalised(let(logs, lambda l: let(F.array_max(l), lambda top: F.transform(l, lambda x: F.exp(x - top)))))


def _sums(rows: DataFrame, key: str, n: int) -> DataFrame:
    """Per key the sums of the text's language shares. Written, so that its size is known and
    a join can split keys that many rows share."""
    total = rows.groupBy(key).agg(F.array(*[F.sum(F.col("shares")[i]) for i in range(n)]).alias(f"{key}_sums"))
    return pinned(total, key)


def identify(pages: DataFrame, documents: DataFrame, fit_rows: int = 2000, strength: float = 5.0, trust: float = 1.0) -> DataFrame:
    """``page_id, lang, probability`` and what led to it: ``text_lang, declared, host`` and the
    host's ``prior`` of the language. ``strength`` is the weight, in pages, of the coarser level
    in a smoothed prior; ``trust`` is added to each count of declared languages and suffixes."""
    model = fit_trigrams(documents, fit_rows)
    n = len(model.languages)
    rows = pinned(page_evidence(pages, model).withColumn("shares", _shares(F.col("text"))), "evidence")
    every = rows.agg(*[F.sum(F.col("shares")[i]) for i in range(n)]).first()
    overall = np.array([x or 0.0 for x in every]) + trust
    overall_shares = F.lit((overall / overall.sum()).tolist())

    for key in ("host", "domain", "suffix", "declared"):
        rows = rows.join(_sums(rows.select(key, "shares"), key, n), key)

    def smoothed(sums: str, coarser: Column) -> Column:
        """Counts of the others, and ``strength`` pages distributed as on the coarser level."""
        others = F.zip_with(sums, "shares", lambda a, b: F.greatest(a - b, F.lit(0.0)))
        return _normalised(F.zip_with(others, coarser, lambda a, b: a + strength * b))

    def likelihood(sums: str) -> Column:
        """Share of a language's pages that look like this one, up to a factor for all languages."""
        others = F.zip_with(sums, "shares", lambda a, b: F.greatest(a - b, F.lit(0.0)) + trust)
        return F.transform(F.zip_with(others, F.lit(overall.tolist()), lambda a, b: a / (b + trust)), lambda p: F.log(p))

    rows = rows.withColumn("by_suffix", smoothed("suffix_sums", overall_shares))
    rows = rows.withColumn("by_domain", smoothed("domain_sums", F.col("by_suffix")))
    rows = rows.withColumn("by_host", smoothed("host_sums", F.col("by_domain")))
    # What is not declared says nothing.
    nothing = F.lit([0.0] * n)
    rows = rows.withColumn("says", F.when(F.col("declared") == "", nothing).otherwise(likelihood("declared_sums")))
    logs = F.zip_with(F.zip_with("text", "says", lambda a, b: a + b), "by_host", lambda a, b: a + F.log(b))
    rows = rows.withColumn("posterior", _shares(logs))
    names = F.lit(model.languages)

    def best(shares: str) -> Column:
        return F.array_position(shares, F.array_max(shares)).cast("int")

    return rows.withColumn("best", best("posterior")).select(
        "page_id",
        F.element_at(names, F.col("best")).alias("lang"),
        F.element_at("posterior", F.col("best")).alias("probability"),
        F.element_at(names, best("shares")).alias("text_lang"),
        "declared",
        "host",
        F.element_at("by_host", F.col("best")).alias("prior"),
    )
