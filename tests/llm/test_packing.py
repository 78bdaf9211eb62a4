import random
import zlib
from itertools import pairwise

import numpy as np
import public_tokenizers
import pytest
from messy import documents, texts
from tokenizers import Tokenizer

from touchline.llm.packing import WordTokenizer, choose_cuts, pack

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def tokenizer():
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return t


def test_word_memory_equals_the_tokenizer(tokenizer):
    odd = [
        "It's we've don't'S", "Ünï Ω ΑΣ ΟΔΥΣΣΕΥΣ İstanbul ǅ ſ K", "a\x1cb\x1d c\x85d\xa0e f​g", "é ́x ﬁ ½ 12３",
        "<|endoftext|> <|startoftext|>hi", "日本語 текст 😀👍🏽", "x" * 5000, "... !!! a.b,c?", "", "   ", "\n\t", "don’t 'tis '",
    ]
    words = WordTokenizer(PATH)
    for _ in range(2):
        got = [np.frombuffer(b, "<u4").tolist() for b in words.batch(odd)]
        assert got == [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in odd]


def cost(cuts, penalty, room, opening):
    lengths = [b - a for a, b in pairwise(cuts)]
    return sum(penalty[b] + opening + (0 if n & (n - 1) == 0 else room - n) for n, b in zip(lengths, cuts[1:]))


def test_cuts_cost_least():
    drawn = random.Random(1)
    for _ in range(60):
        places = [0]
        while len(places) < 14:
            places.append(places[-1] + drawn.randint(1, 11))
        penalty = {p: drawn.choice([0, 1, 3]) for p in places}
        room, opening = drawn.choice([12, 16, 20]), drawn.choice([0, 2])
        best = {0: 0.0}
        for b in places[1:]:
            best[b] = min(best[a] + cost([a, b], penalty, room, opening) for a in places if 0 < b - a <= room)
        cuts = choose_cuts(np.array(places), np.array([float(penalty[p]) for p in places]), room, opening)
        assert cuts[0] == 0 and cuts[-1] == places[-1] and all(0 < b - a <= room for a, b in pairwise(cuts))
        assert cost(cuts, penalty, room, opening) == best[places[-1]]


@pytest.mark.parametrize("room, block", [(2048, 1 << 19), (64, 256), (100, 1000)])
def test_every_id_lies_in_one_piece(spark, tokenizer, room, block):
    rows = [(i if d is None or d == 150 else d, t) for i, (d, t) in enumerate(texts(), 1000)]
    got = pack(documents(spark, rows).repartition(3), PATH, room=room, block=block).collect()
    pieces, sequences = {}, {}
    for r in got:
        pieces.setdefault(r["doc_id"], []).append(r)
        sequences.setdefault(r["sequence_id"], []).append(r)
    for doc, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        own = sorted(pieces[doc], key=lambda r: r["start"])
        assert b"".join(r["ids"] for r in own) == ids.tobytes()
        assert [r["start"] for r in own] == list(np.cumsum([0] + [r["length"] for r in own[:-1]]))
        assert all(r["doc_tokens"] == len(ids) and len(r["ids"]) == 4 * r["length"] for r in own)
        assert all(zlib.crc32(r["ids"]) >= 0 for r in own)
    for rs in sequences.values():
        rs.sort(key=lambda r: r["offset"])
        assert [r["offset"] for r in rs] == list(np.cumsum([0] + [r["length"] for r in rs[:-1]]))
        assert sum(r["length"] for r in rs) <= room


def test_null_ids_and_empty_tables(spark):
    assert {r["doc_id"] for r in pack(documents(spark, [(None, "a"), (None, None)]), PATH).collect()} == {None}
    assert pack(documents(spark, []), PATH).count() == 0


ADDED = [
    "hi <|endoftext|> there", "x<|startoftext|><|endoftext|>. Y", "<|ENDOFTEXT|> <|endoftext|", "a\x1cb <|endoftext|>", "日本 <|endoftext|>Ω",
    "hi there <|EndOfText|>",
]


def test_added_tokens_are_those_of_the_file(spark):
    as_named = Tokenizer.from_file(PATH)
    want = [as_named.encode(t, add_special_tokens=False).ids + [1] for t in ADDED]
    assert want[0] == [1883, 49407, 997, 1]
    words = WordTokenizer(PATH, added=True)
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in words.batch(ADDED)] == want
    pieces = pack(documents(spark, list(enumerate(ADDED))), PATH).orderBy("doc_id", "start").collect()
    for i, ids in enumerate(want):
        own = [r for r in pieces if r["doc_id"] == i]
        assert b"".join(r["ids"] for r in own) == np.array(ids, "<u4").tobytes()
        assert {r["doc_tokens"] for r in own} == {len(ids)}
