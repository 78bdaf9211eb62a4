"""run() against the brute-force versions of its stages, each on what the last one kept."""

import numpy as np
import public_tokenizers
import pytest
from test_decontam import expected, words
from test_dedup import fingerprint, roots, without_repeated_pairs
from tokenizers import Tokenizer

import corpus_pipeline
from touchline.llm import quality

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    """The documents before the first stage and after each."""
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    results = [docs]
    for _, stage in corpus_pipeline.STAGES:
        results.append(stage(spark, results[-1], FOLDER).cache())
    return results


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_columns_stay(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_dedup", "decontamination", "packing"]
    assert all(s.schema == stages[0].schema for s in stages[1:5])


def test_quality_keeps_the_clean(spark, stages):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    before, after = dict(rows(stages[0])), dict(rows(stages[1]))
    assert set(after.items()) < set(before.items())
    clean = [d for d, q in labels.items() if q == 1]
    assert sum(d in after for d in clean) >= 0.97 * len(clean)
    # The same decisions by the same statistics, fitted and applied without Spark tasks.
    stats = quality.labelled_statistics(stages[0], spark.read.parquet(f"{FOLDER}/labels.parquet"), "quality")
    model = quality.fit(stats, "quality")
    scores = model.score(np.array([quality.statistics(t) for t in before.values()]))
    assert {d for d, s in zip(before, scores) if s >= 0.3} == set(after)


def test_line_dedup(stages):
    assert sorted(rows(stages[2]), key=str) == without_repeated_pairs(rows(stages[1]))[0]


def test_near_dedup(stages):
    before = rows(stages[2])
    prints = {d: fingerprint(t) for d, t in before}
    values = sorted(set(prints.values()))
    root = roots(values, [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2])
    smallest = {}
    for d, p in prints.items():
        smallest[root[p]] = min(smallest.get(root[p], d), d)
    assert sorted(rows(stages[3])) == sorted((d, t) for d, t in before if d in smallest.values())


def test_decontamination(spark, stages):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    before = rows(stages[3])
    dirty = {d for d, _, hit, _ in expected(before, items, 10) if hit}
    assert sorted(rows(stages[4])) == sorted((d, t) for d, t in before if d not in dirty)
    assert words("Aé-b") == ["aé", "b"]


def test_packing_and_run(spark, stages):
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    t.encode_special_tokens = True
    lengths = {d: len(t.encode(x or "", add_special_tokens=False).ids) + 1 for d, x in rows(stages[4])}
    ran = corpus_pipeline.run(spark, FOLDER)
    assert ran.columns == stages[5].columns
    for result in (stages[5], ran):
        found = {}
        for r in result.collect():
            found[r["doc_id"]] = found.get(r["doc_id"], 0) + r["length"]
        assert found == lengths


def test_messy_rows_pass_all_stages(spark, tmp_path):
    from messy import documents

    docs = documents(spark)
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
