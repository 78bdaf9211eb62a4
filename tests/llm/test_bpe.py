import json
import random

import numpy as np
import public_tokenizers
import pytest
from messy import documents, texts
from tokenizers import Tokenizer

from touchline.llm.bpe import Encoder, Vocabulary, decode, encode

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "It's we've don't'S", "Ünï Ω ΑΣ ΟΔΥΣΣΕΥΣ İstanbul ǅ ſ K", "a\x1cb\x1d c\x85d\xa0e f​g", "é ́x ﬁ ½ 12３",
    "hi <|endoftext|> <|startoftext|>there", "<|ENDOFTEXT|> <|endoftext|", "e<|endoftext|>́", "日本語 текст 😀👍🏽", "x" * 5000,
    "... !!! a.b,c?", "", "   ", "\n\t", "don’t 'tis '", "aaaaaaaaaaaaa" * 50, "hahahahahahahaha", "\x00\x7f\xad", "日本 <|endoftext|>Ω",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return Vocabulary(PATH)


def test_equals_the_library(spark, library):
    rows = [(i, t) for i, (_, t) in enumerate([*texts(), *[(0, t) for t in ODD]])] + [(None, "no id"), (3, "again"), (3, "again")]
    got = decode(encode(documents(spark, rows).repartition(3), PATH, size=4000), PATH, ids=1000)
    assert set(documents(spark, []).columns) < set(got.columns)
    found = sorted((str(r["doc_id"]), r["text"] or "", r["ids"], r["decoded"], r["lang"]) for r in got.collect())
    want = []
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        want.append((str(i), text or "", ids, library.decode(ids, skip_special_tokens=False), "en"))
    assert found == sorted(want)


def test_column_names_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "one two", "kept")], "doc_id long, body string, ids string").select("*")
    got = encode(docs, PATH, column="body", into="tokens")
    assert got.columns == ["doc_id", "body", "ids", "tokens"] and got.first()["ids"] == "kept"
    assert encode(docs.withColumnRenamed("body", "text"), PATH).columns == ["doc_id", "text", "ids"]
    assert decode(encode(documents(spark, []), PATH), PATH).count() == 0
    nulls = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r["decoded"] for r in decode(nulls, PATH).collect()] == ["", ""]


def test_every_latin_letter_in_a_word(library):
    around = [f"{c} a{c} {c}B Zz{c}y {c}. {c}{c}" for c in map(chr, range(0x250))]
    assert Encoder(PATH).encode(around) == [np.array(library.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in around]


def test_guesses_that_fail_are_merged(library):
    drawn = random.Random(3)
    words = ["".join(drawn.choice("abehinrst") for _ in range(drawn.randint(1, 14))) for _ in range(8000)]
    words += ["".join(drawn.choice("ab") for _ in range(drawn.randint(1, 30))) for _ in range(2000)]
    encoder = Encoder(PATH)
    got = encoder.encode(words)
    assert got == [np.array(e.ids, "<u4").tobytes() for e in library.encode_batch(words, add_special_tokens=False)]
    assert 0 < encoder.merged < len(set(words))


def test_a_merge_across_is_found_for_every_pair(vocabulary):
    """Against merging the joined text, for pairs of frequent and of random tokens."""
    drawn = random.Random(5)
    inner = [i for t, i in vocabulary.ids.items() if not t.endswith("</w>")]
    both = list(vocabulary.ids.values())
    pairs = [(drawn.choice(inner), drawn.choice(both)) for _ in range(4000)]
    pairs += [(drawn.choice(inner[:900]), drawn.choice(both[:900])) for _ in range(6000)] + [(i, i) for i in inner[:900]]
    pairs = [(a, b) for a, b in pairs if vocabulary.texts[b] != "</w>"]
    left, right = np.array(pairs).T
    got = vocabulary.merged_across(left, right)

    def merged(a, b):
        text = vocabulary.texts[a] + vocabulary.texts[b]
        if text.endswith("</w>"):
            return vocabulary.merge(text[:-4])
        symbols = [vocabulary.symbol[c] for c in text]
        while True:
            ranks = [vocabulary.merges.get(p, (10**9, 0)) for p in zip(symbols, symbols[1:])]
            if not ranks or min(ranks)[0] == 10**9:
                return symbols
            at = ranks.index(min(ranks))
            symbols[at : at + 2] = [ranks[at][1]]

    assert got.tolist() == [merged(a, b) != [a, b] for a, b in pairs]
    assert 0.05 < got.mean() < 0.95


def test_whole_tokens_are_those_that_their_text_gives(vocabulary):
    made = [(t, i) for t, i in vocabulary.ids.items() if t.endswith("</w>") and len(t) > 4][::7]
    assert [bool(vocabulary.whole[i]) for _, i in made] == [vocabulary.merge(t[:-4]) == [i] for t, i in made]


def test_memory_is_bounded_and_changes_nothing(library):
    drawn = random.Random(9)
    common = ["the", "of", "and.", "it's"]
    batches = [[" ".join([*common, *("".join(drawn.choices("abcdefgh", k=3)) for _ in range(40))]) for _ in range(5)] for _ in range(30)]
    encoder = Encoder(PATH, remembered=300)
    for batch in batches:
        assert encoder.encode(batch) == [np.array(library.encode(t).ids, "<u4").tobytes() for t in batch]
        assert len(encoder.known) == len(encoder.lengths) == len(encoder.used) <= 500
        assert encoder.lengths.sum() == len(encoder.table)
        assert {"the", "of", "and", "it's"} <= set(encoder.known.to_pylist())


def test_other_kinds_of_vocabulary_are_refused(tmp_path):
    with pytest.raises(ValueError, match="no byte-level BPE with word ends"):
        Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    with open(PATH, encoding="utf-8") as file:
        written = json.load(file)
    written["model"]["merges"][0], written["model"]["merges"][-1] = written["model"]["merges"][-1], written["model"]["merges"][0]
    changed = tmp_path / "late.json"
    changed.write_text(json.dumps(written), encoding="utf-8")
    with pytest.raises(ValueError, match="before it is made"):
        Vocabulary(str(changed))


def test_query_equals_the_library(spark, library):
    import hashlib

    from touchline.llm.queries import op12_bpe

    folder = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in op12_bpe(spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        ids = library.encode(doc["text"] or "", add_special_tokens=False).ids
        row = got[doc["doc_id"]]
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
