"""The operators of this part as queries over the test tables, and the same in plain SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.llm import quality, toxicity, whitening
from touchline.llm.bpe import decode, encode
from touchline.llm.chat import PartVisitor, format_conversations, read_loss, read_turns, text_parts
from touchline.llm.decontam import contamination
from touchline.llm.imatch import fingerprints_of_edits, rate_likeness, shown
from touchline.llm.langid import identify
from touchline.llm.linededup import kept_text, mark_repeated, split_lines
from touchline.llm.packing import pack
from touchline.llm.prefixtrie import ordered_codes, path_of, prefix_trie
from touchline.llm.simhash import near_groups
from touchline.llm.substring import dedup_substrings
from touchline.llm.text import table
from touchline.sources.workspace import pinned

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        LLM_QUERIES[function.__name__] = function
        if sql:
            LLM_ORACLES[function.__name__] = sql
        return function

    return register


CONTROL = r"(<|\[)(\\*)(s>|/s>|TURN\]|SAYS\]|PART\]|FILE\]|IMAGE\]|AUDIO\]|DOCUMENT\]|INST\]|/INST\]|SYS\]|/SYS\])"


@query(rf"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(16 + length(regexp_replace(role, '{CONTROL}', '\1\\\2\3', 'g'))
    + length(regexp_replace(text, '{CONTROL}', '\1\\\2\3', 'g'))) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""")
def op1_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation formatted, and its digests read back from the formatted string."""
    visitor = PartVisitor()
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    every = turns.unionByName(tricky).select("conv_id", "turn", "role", text_parts(F.col("text")).alias("parts"))
    done = format_conversations(every, visitor=visitor)
    read = done.select(
        "conv_id",
        read_turns(F.col("formatted"), visitor.template).alias("turns"),
        read_loss(F.col("formatted"), F.col("loss"), visitor.template).alias("learned"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
    spoken = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        "formatted_chars",
    )


WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(f"""
WITH i AS (SELECT item_id, {WORDS} AS w FROM benchmark),
g AS (SELECT item_id, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda s: w[s:s + 9])) AS gram
  FROM i WHERE len(w) > 0),
grams AS (SELECT DISTINCT item_id, gram, len(gram) AS n FROM g),
d AS (SELECT doc_id, {WORDS} AS w FROM documents),
windows AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS s, w FROM d, (SELECT DISTINCT n FROM grams)),
hits AS (SELECT doc_id, s, grams.n, item_id FROM windows JOIN grams
  ON windows.n = grams.n AND windows.w[s:s + windows.n - 1] = grams.gram),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM
  (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM
  (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""")
def op2_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that lie in a 10-gram of a benchmark item."""
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"), n=10)
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query(r"""
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
v AS (SELECT doc_id, l, list_transform(l, lambda x: CAST('0x' || md5(x)[1:6] AS BIGINT)) AS v FROM d),
e AS (SELECT doc_id, l, list_filter(range(1, len(l) + 1), lambda i:
  i = len(l) OR (v[i] + CASE WHEN i > 1 THEN v[i - 1] * 31 ELSE 0 END) % 4 = 0) AS e FROM v),
c AS (SELECT doc_id, l, unnest(list_transform(range(1, len(e) + 1), lambda j:
  {'s': CASE WHEN j > 1 THEN e[j - 1] ELSE 0 END, 'e': e[j]})) AS c FROM e),
w AS (SELECT doc_id, l, list_filter(range(1, len(l) + 1), lambda i: trim(l[i], ' ') <> '') AS w FROM d),
p AS (SELECT doc_id, l, unnest(list_transform(range(1, len(w)), lambda j: {'s': w[j] - 1, 'e': w[j + 1]})) AS c FROM w),
t AS (SELECT doc_id, c.s AS s, c.e - c.s AS n, array_to_string(l[c.s + 1:c.e], chr(10)) AS chunk FROM c
  WHERE len(list_filter(l[c.s + 1:c.e], lambda x: trim(x, ' ') <> '')) > 1
  UNION SELECT doc_id, c.s AS s, c.e - c.s AS n, array_to_string(l[c.s + 1:c.e], chr(10)) AS chunk FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY chunk ORDER BY doc_id, s) AS k FROM t),
gone AS (SELECT doc_id, list(DISTINCT s + i) AS lines FROM (SELECT doc_id, s, unnest(range(1, n + 1)) AS i FROM r WHERE k > 1) GROUP BY doc_id)
SELECT doc_id, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(lines), 0) AS BIGINT) AS n_removed,
  sha256(coalesce(CASE WHEN lines IS NULL THEN text ELSE
    array_to_string(list_transform(list_filter(range(1, len(l) + 1), lambda i: NOT list_contains(lines, i)), lambda i: l[i]), chr(10))
  END, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id)""")
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """How many lines of every document belong to chunks that stand elsewhere, and what is left."""
    marked = mark_repeated(table(spark, folder, "documents"), short=True)
    removed = F.aggregate("__spans", F.lit(0).cast("long"), lambda total, s: total + s["n"])
    return marked.select(
        "doc_id",
        F.when(F.col("text").isNull(), 0).otherwise(F.size(split_lines(F.col("text")))).cast("long").alias("n_lines"),
        F.coalesce(removed, F.lit(0).cast("long")).alias("n_removed"),
        F.sha2(F.coalesce(kept_text(F.col("text"), F.col("__spans")), F.lit("")), 256).alias("kept_sha256"),
    )


@query()
def op6_simhash(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprint of every document and the smallest id it reaches over near fingerprints."""
    groups = near_groups(table(spark, folder, "documents"), shingle=3, distance=2)
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query()
def op7_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Calibrated quality of every document."""
    stats = pinned(quality.statistics_of(table(spark, folder, "documents")), "stats")
    model = quality.fit(quality.training(stats, table(spark, folder, "labels"), "quality"), "quality")
    return quality.score_statistics(stats, model).select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.3, 1).otherwise(0).alias("predicted"),
    )


@query()
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of every document, and the sentences it comes from."""
    docs = table(spark, folder, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels"), "toxic"))
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "offending",
    )


def vocabulary(name: str) -> str:
    """The place of a public vocabulary file, on every machine alike."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op5_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's pieces in sequences of at most 2048 tokens."""
    pieces = pack(table(spark, folder, "documents"), vocabulary("word_bpe_49k.json"), room=2048, end=1)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query()
def op9_imatch(spark: SparkSession, folder: str) -> DataFrame:
    """I-Match fingerprint of every document, of its edited text, and their likeness, over eight
    subsets of the lexicon at rates from 1/4 to 1/1024."""
    subsets, halvings = 8, 8
    found = fingerprints_of_edits(table(spark, folder, "documents"), subsets=subsets, rate=1 / 4, halvings=halvings)

    def near(other: str):
        own, whole = F.col("hashes"), F.col("whole")
        return rate_likeness(own, whole, F.col(f"{other}_hashes"), F.col(f"{other}_whole"), subsets, halvings)

    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        shown(F.concat(F.array("whole"), "hashes")).alias("fingerprint"),
        shown(F.concat(F.array("edited_whole"), "edited_hashes")).alias("edited_fingerprint"),
        near("edited").alias("near_edited"),
        near("next").alias("near_next"),
    )


@query(r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 48)) AS s, w FROM d),
k AS (SELECT doc_id, s, array_to_string(w[s:s + 49], ' ') AS win FROM s),
f AS (SELECT win, min(doc_id) AS first FROM k GROUP BY win),
gone AS (SELECT doc_id, list(DISTINCT p) AS gone FROM
  (SELECT k.doc_id, unnest(range(s, s + 50)) AS p FROM k JOIN f USING (win) WHERE first < doc_id) GROUP BY doc_id),
r AS (SELECT doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(gone, i)), ' ')) AS kept_sha256
FROM r""")
def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of every document without 50-word windows of earlier documents."""
    left = dedup_substrings(table(spark, folder, "documents"), window=50)
    return left.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every page, from its text, markup, address and host."""
    return identify(table(spark, folder, "pages"), table(spark, folder, "documents").select("doc_id", "text", "lang"))


@query()
def op12_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every document, and the text that they give again."""
    path = vocabulary("word_bpe_49k.json")
    encoded = encode(table(spark, folder, "documents").select("doc_id", "text"), path).drop("text")
    return decode(encoded, path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op13_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Every embedding on each of the 16 leading components, scaled to unit variance."""
    numbers = whitening.whole_numbers(table(spark, folder, "embeddings").select("vec_id", "embedding"))
    distinct, length = whitening.distinct_vectors(numbers)
    model = whitening.fit(distinct, length, components=16)
    error = whitening.identity_error(distinct, model)
    shares = F.lit(model.explained.tolist()).cast("array<double>")
    done = whitening.whiten(numbers.drop("embedding"), model)
    return done.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("at") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )


def rebuilt_conversations(turns: DataFrame) -> DataFrame:
    """``conv_id, path``: every conversation c with its first h turns replaced by those of
    conversation c - c % 5, where h is the CRC-32 of its id, modulo 9."""
    convs = pinned(ordered_codes(turns), "codes")
    heads = convs.filter(F.col("conv_id") % 5 == 0).select(F.col("conv_id").alias("base"), F.slice("codes", 1, 8).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9).cast("int")
    joined = convs.withColumn("h", h).withColumn("base", F.col("conv_id") - F.col("conv_id") % 5).join(heads, "base", "left")
    start = F.slice(F.coalesce("head", F.array().cast("array<binary>")), F.lit(1), F.col("h"))
    rest = F.slice("codes", F.col("h") + 1, F.greatest(F.size("codes") - F.col("h"), F.lit(0)))
    return joined.select("conv_id", path_of(F.concat(start, rest)).alias("path"))


@query()
def op11_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """Every distinct beginning of the rebuilt conversations."""
    return prefix_trie(pinned(rebuilt_conversations(table(spark, folder, "conversations")), "sequences"))
