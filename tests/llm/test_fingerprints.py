import hashlib
import math
import struct
from collections import Counter

import xxhash
from messy import documents, prose, texts
from pyspark.sql import functions as F

from touchline.llm.imatch import fingerprints, fingerprints_of_edits, in_subset, lexicon, likeness, rate_likeness, shown, with_keys


def test_edits_equal_brute_force(spark):
    rows = [(d, t) for d, t in texts() if d not in (None, 150)]
    rows = sorted(rows)
    want = {}
    for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        t, after = t or "", after or ""
        k = len(t) // 4
        edited = t[: len(t) - k] + after[:k]
        want[d] = (len(t), hashlib.sha256(edited.encode()).hexdigest())
    got = fingerprints_of_edits(documents(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == want
    assert len(got) == len(rows)


def test_messy_rows_give_one_row_for_each_text(spark):
    got = fingerprints_of_edits(documents(spark)).collect()
    # A NULL and an empty text are the same text.
    assert len(got) == len({(d, t or "") for d, t in texts()})
    by_text = {}
    for r in fingerprints(documents(spark)).collect():
        by_text.setdefault(r["row_key"], set()).add(tuple(r["hashes"]))
    assert all(len(h) == 1 for h in by_text.values())


def test_likeness_follows_the_edit(spark):
    rows = [(i, " ".join(w + str(j % 9) for j, w in enumerate(prose(i, 400)))) for i in range(40)] + [(50, "x"), (51, "x")]
    got = fingerprints_of_edits(documents(spark, rows), low=0.1).select(
        "doc_id", likeness(F.col("hashes"), F.col("edited_hashes")).alias("e"), likeness(F.col("hashes"), F.col("next_hashes")).alias("n"),
        shown(F.col("hashes")).alias("f"),
    ).collect()
    long = [r for r in got if r["doc_id"] < 40]
    assert all(0 <= r["n"] <= 1 and 0 <= r["e"] <= 1 and len(r["f"]) == 128 for r in got)
    assert sum(r["e"] for r in long) > sum(r["n"] for r in long)
    assert next(r["n"] for r in got if r["doc_id"] == 50) == 1.0


def test_lexicon_keeps_the_band(spark):
    rows = [(i, f"all w{i % 2} v{i}") for i in range(64)]
    kept = {r["term"] for r in lexicon(with_keys(documents(spark, rows)), low=0.5, high=3.0).collect()}
    words = spark.createDataFrame([("all",), ("w0",), ("w1",), ("v1",)], "w string")
    hashes = {r["w"]: r["h"] for r in words.select("w", F.xxhash64("w").alias("h")).collect()}
    assert kept == {hashes["w0"], hashes["w1"]}


def test_empty_table(spark):
    assert fingerprints_of_edits(documents(spark, [])).count() == 0


def test_hashes_depend_on_all_terms_of_fixed_subsets(spark):
    """Two hashes are equal if and only if the documents have the same terms in that subset."""
    vocabulary = [f"t{i}" for i in range(300)]
    rows = [(i, " ".join(w for j, w in enumerate(vocabulary) if j not in (i, i + 1))) for i in range(200)]
    rows += [(300, "t1 t2"), (301, "t2, t1"), (302, "nothing"), (303, "nothing"), (304, "else")]
    docs = documents(spark, rows)
    drawn = spark.createDataFrame([(w,) for w in vocabulary], "w string").withColumn("term", F.xxhash64("w"))
    subsets = [
        {r["w"] for r in drawn.filter(in_subset(F.col("term"), s, 0.125)).collect()} for s in range(4)
    ]
    assert all(15 < len(x) < 65 for x in subsets) and len(set(map(frozenset, subsets))) == 4
    got = {r["doc_id"]: r["hashes"] for r in fingerprints(docs, low=0.0, high=3.0, subsets=4, rate=0.125).collect()}

    def subset_terms(text, s):
        found = set(text.replace(",", "").split()) & set(vocabulary)
        return frozenset(found & subsets[s]) or ("all", frozenset(found)) if found else text

    for s in range(4):
        want = {d: subset_terms(t, s) for d, t in rows}
        for a, _ in rows:
            for b, _ in rows:
                assert (got[a][s] == got[b][s]) == (want[a] == want[b]), (s, a, b)


def signed(value, bits):
    return value - (1 << bits) if value >> (bits - 1) else value


def murmur_chain(values, seed=42):
    """Spark's ``hash`` over longs (``q``) and ints (``i``), each seeded by the one before."""

    def rotate(x, by):
        return ((x << by) | (x >> (32 - by))) & 0xFFFFFFFF

    h = seed
    for kind, value in values:
        raw = struct.pack("<" + kind, value)
        for at in range(0, len(raw), 4):
            k = rotate(struct.unpack_from("<I", raw, at)[0] * 0xCC9E2D51 & 0xFFFFFFFF, 15) * 0x1B873593 & 0xFFFFFFFF
            h = (rotate(h ^ k, 13) * 5 + 0xE6546B64) & 0xFFFFFFFF
        h ^= len(raw)
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            h = (h ^ (h >> shift)) * factor & 0xFFFFFFFF
        h ^= h >> 16
    return signed(h, 32)


def brute_force(rows, low, high, subsets, rate, halvings):
    """``id -> (whole, hashes)`` from plain sets, lists and the definitions of the hashes."""
    found = {d: set((t or "").split()) for d, t in rows}
    seen = Counter(w for s in found.values() for w in s)
    band = {w for w, c in seen.items() if len(rows) * math.exp(-high) <= c <= len(rows) * math.exp(-low)}
    key = {w: signed(xxhash.xxh64_intdigest(w.encode(), 42), 64) for w in band}

    def drawn(w, s, k):
        h = xxhash.xxh64_intdigest(struct.pack("<q", key[w]), 42)
        for part in (11, s):
            h = xxhash.xxh64_intdigest(struct.pack("<i", part), h)
        return h % (1 << 20) < round(rate / 2**k * (1 << 20))

    out = {}
    for d, t in rows:
        mine = sorted((key[w], w) for w in found[d] & band)
        text = signed(xxhash.xxh64_intdigest((t or "").encode(), 42), 64)
        whole = murmur_chain([("q", k) for k, _ in mine] or [("q", text)])
        hashes = []
        for s in range(subsets):
            for k in range(halvings + 1):
                part = [("q", key) for key, w in mine if drawn(w, s, k)]
                hashes.append(murmur_chain([*part, ("i", s), ("i", k)]) if part else whole)
        out[d] = (whole, hashes)
    return out


def messy_rows():
    rows = [(i, " ".join(f"w{(i * 7 + j * j) % 211}" for j in range(5 + i * 3 % 90))) for i in range(70)]
    return rows + [(80, None), (81, ""), (82, "alone"), (83, rows[5][1]), (84, "w1 w2 w2 w1")]


def test_every_hash_equals_brute_force(spark):
    rows = messy_rows()
    asked = {"low": 0.2, "high": 4.0, "subsets": 5, "rate": 0.5, "halvings": 3}
    want = brute_force(rows, **asked)
    got = {r["doc_id"]: (r["whole"], r["hashes"]) for r in fingerprints(documents(spark, [*rows, rows[3]]), **asked).collect()}
    assert got == want
    assert got[83] == got[5] and len({tuple(h) for _, h in got.values()}) > 60


def test_rate_likeness_equals_brute_force(spark):
    rows = messy_rows()
    subsets, halvings, least = 5, 3, 3
    found = fingerprints_of_edits(documents(spark, rows), low=0.2, high=4.0, subsets=subsets, rate=0.5, halvings=halvings)
    columns = [F.col(c) for c in ("hashes", "whole", "edited_hashes", "edited_whole")]
    got = found.withColumn("near", rate_likeness(*columns, subsets, halvings, least)).collect()

    def near(r):
        shares = []
        for k in range(halvings + 1):
            pairs = [(r["hashes"][i], r["edited_hashes"][i]) for i in range(k, subsets * (halvings + 1), halvings + 1)]
            filled = [x == y for x, y in pairs if (x, y) != (r["whole"], r["edited_whole"])]
            if len(filled) >= least:
                shares.append(sum(filled) / len(filled))
        return max(shares) if shares else float(r["whole"] == r["edited_whole"])

    assert len(got) == len(rows)
    assert all(abs(r["near"] - near(r)) < 1e-12 for r in got)
    # Edited texts of nothing are the same texts.
    assert {r["doc_id"]: r["near"] for r in got}[81] == 1.0


def test_edited_texts_are_nearer_than_the_next(spark):
    """A quarter of each text changes, whatever its length; no two texts share terms."""
    rows = [(i, " ".join(f"w{i}x{j * 37 % 9973}" for j in range(n))) for i, n in enumerate([40, 200, 1500] * 20)]
    found = fingerprints_of_edits(documents(spark, rows), low=0.1, high=7.0, subsets=8, rate=1 / 4, halvings=8)
    near = {
        other: rate_likeness(F.col("hashes"), F.col("whole"), F.col(f"{other}_hashes"), F.col(f"{other}_whole"), 8, 8).alias(other)
        for other in ("edited", "next")
    }
    got = found.select("doc_id", *near.values()).collect()
    for length in range(3):
        of = [r for r in got if r["doc_id"] % 3 == length]
        assert sum(r["edited"] for r in of) / len(of) > 0.4
        assert sum(r["next"] for r in of) / len(of) < 0.1
