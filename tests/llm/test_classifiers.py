import numpy as np
import pytest
from messy import documents, texts
from pyspark.sql import functions as F

from touchline.llm import langid, quality, toxicity
from touchline.llm.queries import LLM_QUERIES

FOLDER = "/root/testdata/sf0.01"


def area(scores, labels):
    """Chance that a row labelled 1 scores higher than one labelled 0."""
    ones, zeros = scores[labels == 1][:, None], scores[labels == 0][None, :]
    return ((ones > zeros) + 0.5 * (ones == zeros)).mean()


@pytest.mark.parametrize("query, label, accuracy, ranked", [("op7_quality", "quality", 0.95, 0.98), ("op8_toxicity", "toxic", 0.93, 0.85)])
def test_held_out_rows(spark, query, label, accuracy, ranked):
    got = LLM_QUERIES[query](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").toPandas()
    assert got["score"].between(0, 1).all()
    held = got[got["held_out"]]
    assert (held["predicted"] == held[label]).mean() >= accuracy
    assert area(held["score"].to_numpy(), held[label].to_numpy()) >= ranked


def labels(spark, rows):
    return spark.createDataFrame([(i, q, q, "clash") for i, q in rows], "doc_id long, quality int, toxic int, text string")


FEW = [(i, int(i % 2 == 0)) for i in range(10, 22)] + [(100, None), (None, 1), (10, 1), (999, 0)]


@pytest.mark.parametrize("known", [FEW, [], [(11, 1), (12, 1)]])
def test_messy_rows_are_scored(spark, known):
    docs, marks = documents(spark), labels(spark, known)
    stats = quality.statistics_of(docs)
    scored = quality.score_statistics(stats, quality.fit(quality.training(stats, marks, "quality"), "quality"))
    harm = toxicity.score(docs, toxicity.fit(docs, marks))
    for got in (scored, harm):
        rows = got.collect()
        assert len(rows) == len(texts()) and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["score"] == 0 for r in harm.collect() if r["doc_id"] in (130, 131))
    assert scored.limit(0).count() == quality.score_statistics(quality.statistics_of(documents(spark, [])), quality.fit(quality.training(stats, marks, "quality"), "quality")).count()


def test_filter_keeps_columns(spark):
    docs = documents(spark)
    model = quality.fit(quality.training(quality.statistics_of(docs), labels(spark, FEW), "quality"), "quality")
    assert quality.keep_rows(docs, lambda s: s >= 0, model).exceptAll(docs).isEmpty()
    assert quality.keep_rows(docs, lambda s: s > 1, model).count() == 0
    assert quality.keep_rows(docs, lambda s: s >= 0, model).schema == docs.schema


def test_pool_adjacent_is_the_closest_rising_curve():
    rng = np.random.default_rng(2)
    for _ in range(30):
        v, w = rng.random(12), rng.integers(1, 5, 12).astype(float)
        curve = quality.pool_adjacent(v, w)
        assert (np.diff(curve) >= 0).all()
        best = [max(min(np.average(v[a : b + 1], weights=w[a : b + 1]) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
        assert np.allclose(curve, best)


def test_offending_sentences_are_located(spark):
    mild = "we went home. it was late. the door was open. nothing else"
    rows = [(i, mild.replace("late", f"late {i}") + (". you zorgling fool. bye" if i % 3 == 0 else "")) for i in range(400)]
    docs = documents(spark, rows)
    known = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(400)], "doc_id long, toxic int")
    got = toxicity.score(docs, toxicity.fit(docs, known)).join(docs.select("doc_id", "text"), "doc_id").collect()
    for r in got:
        found = [r["text"][s["start"] : s["until"]].strip() for s in r["offending"]]
        assert found == (["you zorgling fool."] if r["doc_id"] % 3 == 0 else [])
        assert (r["score"] >= 0.5) == (r["doc_id"] % 3 == 0)


def test_sample_is_bounded_and_weighted_back(spark):
    known = spark.range(20_000).select(F.col("id").alias("doc_id"), (F.col("id") % 10 == 0).cast("int").alias("toxic"))
    sample = toxicity.fit_sample(known, "toxic", 2000)
    per = {r["y"]: r for r in sample.groupBy("y").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    assert all(800 < per[y]["n"] < 1200 for y in (0, 1))
    assert abs(per[0]["w"] / 14_400 - 1) < 0.1 and abs(per[1]["w"] / 1600 - 1) < 0.1


def test_language_of_pages(spark):
    samples = spark.read.parquet(f"{FOLDER}/documents.parquet")
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    truth = F.regexp_extract("url", "://[^/]+/([a-z]+)/", 1)
    got = langid.identify(pages, samples).join(pages.select("page_id", truth.alias("truth")), "page_id")
    assert got.filter("lang <> truth").count() <= 2


def test_priors_and_markup_decide_where_text_is_silent(spark):
    german, english = "Der die das und nicht mit einer auf von ", "The and of with this that from which on "
    samples = spark.createDataFrame([(i, t * 5, lang) for i in range(30) for t, lang in ((german, "de"), (english, "en"))], "doc_id long, text string, lang string")
    page = lambda lang, text: f"<html lang='{lang}'><script>the and of</script><p>{text}</p></html>"
    rows = [(i, f"https://a.beispiel.de/{i}", page("de", german * 3), "x") for i in range(60)]
    rows += [(100 + i, f"https://b.example.com/{i}", page("en", english * 3), "x") for i in range(60)]
    rows += [(200, "https://a.beispiel.de/x", "<html></html>", "x"), (201, "https://new.beispiel.de/x", None, "x"), (202, None, page("de-AT", ""), "x"), (203, "nonsense", "", "x"), (None, "https://b.example.com/", None, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, lang string")
    got = {r["page_id"]: r for r in langid.identify(pages, samples).collect()}
    assert len(got) == len(rows)
    assert all(got[i]["lang"] == "de" and got[100 + i]["lang"] == "en" for i in range(60))
    assert [got[i]["lang"] for i in (200, 201, 202, None)] == ["de", "de", "de", "en"]
    assert got[200]["prior"] > 0.9 and all(0 < r["probability"] <= 1 for r in got.values())
    assert langid.identify(pages.limit(0), samples).count() == 0
    with pytest.raises(ValueError):
        langid.identify(pages, samples.limit(0))


def test_rare_languages_are_kept(spark):
    """However many there are, and however few of them a task holds at a time."""
    names = [f"l{i:03d}" for i in range(205)]
    rows = [(2 * i + k, f"{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvw'[i // 100]} " * 9, n) for i, n in enumerate(names) for k in (0, 1)]
    rows += [(1000 + i, "zzzyx " * 9, "xx") for i in range(1)]
    samples = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.fit_trigrams(samples)
    assert model.languages == sorted([*names, "xx"])
    assert model.languages[int(np.argmax(model.log_likelihood("zzzyx zzzyx")))] == "xx"
    few = langid.fit_trigrams(samples.coalesce(1), held=3)
    assert np.array_equal(few.log_share, model.log_share)


def test_statistics_of_a_bounded_draw(spark):
    docs = spark.createDataFrame([(i, f"text number {i}") for i in range(2000)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 2000, 2)], "doc_id long, quality int")
    every = {r["doc_id"] for r in quality.labelled_statistics(docs, labels, "quality").collect()}
    few = {r["doc_id"] for r in quality.labelled_statistics(docs, labels, "quality", fit_rows=100).collect()}
    assert 700 < len(every) < 900 and 60 < len(few) < 150 and few < every
