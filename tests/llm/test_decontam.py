import re

import pytest
from messy import documents, prose, texts
from pyspark.sql import functions as F

from touchline.llm import decontam, imatch, text


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def expected(rows, items, n):
    grams = {}
    for item, text in items:
        w = words(text)
        k = min(n, len(w))
        for i in range(len(w) - k + 1 if w else 0):
            grams.setdefault(tuple(w[i : i + k]), set()).add("" if item is None else str(item))
    found = []
    for doc, text in rows:
        w, hit, which = words(text), set(), set()
        for k in {len(g) for g in grams}:
            for i in range(len(w) - k + 1):
                if (g := tuple(w[i : i + k])) in grams:
                    hit |= set(range(i, i + k))
                    which |= grams[g]
        found.append((doc, len(w), len(hit), sorted(which)))
    return sorted(found, key=str)


ITEMS = [(1, " ".join(prose(99, 25))), (2, "ONE"), (3, None), (4, ""), (5, " ".join(prose(3, 14)).upper()), (None, " ".join(prose(99, 25))), (6, "é, ß! ünï")]


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(i, t, "x") for i, t in ITEMS], "item_id long, text string, words string")


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, -1])
def test_equals_brute_force(spark, benchmark, broadcast_bytes, monkeypatch):
    monkeypatch.setattr(decontam.find_hits, "__defaults__", (broadcast_bytes,))
    got = decontam.contamination(documents(spark), benchmark, n=10).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_hit"], r["items"]) for r in got), key=str) == expected(texts(), ITEMS, 10)


def test_no_window_carries_its_document(spark, benchmark):
    """Beyond the bound, what is shuffled by hash holds no array of words."""
    grams = decontam.benchmark_grams(benchmark, 10)
    hits = decontam.find_hits(documents(spark).select("doc_id", "text"), grams, -1)
    plan = spark.sparkContext._jvm.PythonSQLUtils.explainString(hits._jdf.queryExecution(), "formatted")
    assert "words" in plan
    by_hash = [p for p in plan.split("\n\n") if "Exchange" in p and "hashpartitioning(key" in p]
    joins = [p for p in plan.split("\n\n") if "Join" in p and "keys" in p and "[key" in p]
    assert (by_hash or joins) and not any("words" in p for p in by_hash + joins)


def test_empty_tables(spark, benchmark):
    none = benchmark.limit(0)
    got = decontam.contamination(documents(spark), none, n=10).collect()
    assert len(got) == len(texts()) and all(r["n_hit"] == 0 for r in got)
    assert decontam.contamination(documents(spark, []), benchmark).count() == 0


def test_removes_documents_or_spans(spark, benchmark):
    docs = documents(spark)
    dirty = {(d, w) for d, w, hit, _ in expected(texts(), ITEMS, 10) if hit}
    kept = decontam.remove_contamination(docs, benchmark).collect()
    clean = [(d, t) for d, t in texts() if (d, len(words(t))) not in dirty]
    assert sorted(((r["doc_id"], r["text"]) for r in kept), key=str) == sorted(clean, key=str)

    cut = decontam.remove_contamination(docs, benchmark, whole=False)
    assert cut.columns == docs.columns and cut.count() == len(texts())
    left = [(r["doc_id"], r["text"]) for r in cut.collect()]
    assert set(clean) <= set(left)
    hits = {(d, w): hit for d, w, hit, _ in expected(texts(), ITEMS, 10)}
    before = {d: len(words(t)) for d, t in texts() if d not in (150, None)}
    assert all(len(words(t)) == before[d] - hits[d, before[d]] for d, t in left if d in before)


def test_words_equal_the_pattern(spark):
    """Splitting at separators finds what the contract's pattern finds, and no pattern is run over the texts."""
    texts = ["".join(map(chr, range(0x300))), "a\0b 😀x,Ünï A9-z\n\x7fq", "", "  ", " a", "éİk", "x\x80y z", None, "@a[b`c{d/e:f"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    low = text.ascii_lower(F.col("text"))
    pattern = F.regexp_extract_all(F.coalesce(low, F.lit("")), F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))
    rows = df.select(text.lower_words(low).alias("got"), pattern.alias("want")).collect()
    assert len(rows) == len(texts) and all(r.got == r.want for r in rows)
    plan = imatch.lexicon(df, 0.1, 7.0)._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan
