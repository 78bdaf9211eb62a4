"""From raw documents to packed sequences, in stages that are each written and read again.

1. quality: documents that the quality classifier rejects go
2. line_dedup: multi-line chunks, and neighbouring lines, that stand at an earlier place go
3. near_dedup: one document of each group of near SimHash fingerprints stays
4. decontamination: documents that hold a 10-gram of a benchmark item go
5. packing: what is left is cut into sequences of at most 2048 tokens

Each stage takes ``(spark, docs, sf_dir)``. All but the last return the columns of ``docs``.
The classifier learns from about 50,000 labelled rows of its own stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import quality
from touchline.llm.decontam import remove_contamination
from touchline.llm.linededup import dedup_lines
from touchline.llm.packing import pack
from touchline.llm.queries import vocabulary
from touchline.llm.simhash import keep_one
from touchline.llm.text import table
from touchline.sources.workspace import pinned

#: Documents whose probability of good quality is lower are rejected.
QUALITY_THRESHOLD = 0.3


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels")
    stats = pinned(quality.labelled_statistics(docs, labels, "quality"), "stats")
    model = quality.fit(stats, "quality")
    return quality.keep_rows(docs, lambda scores: scores >= QUALITY_THRESHOLD, model)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return dedup_lines(docs, short=True)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, shingle=3, distance=2)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return remove_contamination(docs, table(spark, sf_dir, "benchmark"), n=10)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    pieces = pack(docs, vocabulary("word_bpe_49k.json"), room=2048, end=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


STAGES = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

#: A trained classifier and a tokenizer are beyond SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pinned(stage(spark, docs, sf_dir), name)
    return docs
