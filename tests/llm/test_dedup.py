"""Line, substring and near dedup against brute force."""

import hashlib
import random
import re

import pytest
import xxhash
from messy import documents, prose, texts
from pyspark.sql import functions as F

from touchline.llm.components import components
from touchline.llm.linededup import dedup_lines, mark_repeated
from touchline.llm.simhash import embedding, grid_masks, keep_one, links, near_groups
from touchline.llm.substring import dedup_substrings


def pairs(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


# Lines


def kept_lines(rows, modulus=4):
    """Rows equal in id and text are one document."""
    order = sorted({(d, t) for d, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0, _row_key(r[1])))
    seen, result = set(), {}
    for doc, text in order:
        lines = text.split("\n")
        v = [int(hashlib.md5(x.encode()).hexdigest()[:6], 16) for x in lines]
        kept, start = [], 0
        for i in range(len(lines)):
            if i == len(lines) - 1 or (v[i] + (31 * v[i - 1] if i else 0)) % modulus == 0:
                chunk = lines[start : i + 1]
                start = i + 1
                if sum(x.strip(" ") != "" for x in chunk) > 1 and tuple(chunk) in seen:
                    continue
                seen.add(tuple(chunk))
                kept += chunk
        result[doc, text] = "\n".join(kept)
    return sorted(((d, result.get((d, t))) for d, t in rows), key=str)


def _row_key(text):
    value = xxhash.xxh64_intdigest(text.encode(), 42)
    return value - (1 << 64) if value >> 63 else value


@pytest.mark.parametrize("modulus", [1, 2, 4])
def test_lines_equal_brute_force(spark, modulus):
    passage = ["  ".join(prose(i, 4)) for i in range(300, 312)]
    rows = texts() + [(200 + i, "\n".join([f"own {i}", *passage[i:], "", f"end {i}"])) for i in range(6)]
    got = dedup_lines(documents(spark, rows), modulus=modulus)
    assert got.columns == documents(spark, []).columns
    assert pairs(got, "doc_id", "text") == kept_lines(rows, modulus)


def without_repeated_pairs(rows, modulus=4):
    """Every chunk, and every stretch from a line with content to the next, goes but for its first place."""
    order = sorted({(d, t) for d, t in rows if t is not None}, key=lambda r: (r[0] is not None, r[0] or 0, _row_key(r[1])))
    places, found = {}, []
    for at, (doc, text) in enumerate(order):
        lines = text.split("\n")
        v = [int(hashlib.md5(x.encode()).hexdigest()[:6], 16) for x in lines]
        full = [i for i, x in enumerate(lines) if x.strip(" ")]
        spans, start = set(zip(full, full[1:])), 0
        for i in range(len(lines)):
            if i == len(lines) - 1 or (v[i] + (31 * v[i - 1] if i else 0)) % modulus == 0:
                if sum(start <= j <= i for j in full) > 1:
                    spans.add((start, i))
                start = i + 1
        for a, b in spans:
            chunk = tuple(lines[a : b + 1])
            places[chunk] = min(places.get(chunk, (at, a)), (at, a))
            found.append((at, a, b, chunk))
    gone = {(at, i) for at, a, b, chunk in found if places[chunk] != (at, a) for i in range(a, b + 1)}
    left = {r: "\n".join(x for i, x in enumerate(r[1].split("\n")) if (at, i) not in gone) for at, r in enumerate(order)}
    return sorted(((d, left.get((d, t))) for d, t in rows), key=str), gone, order


@pytest.mark.parametrize("modulus", [1, 4])
def test_short_passages_equal_brute_force(spark, modulus):
    passage = ["  ".join(prose(i, 4)) for i in range(300, 312)]
    rows = texts() + [(200 + i, "\n".join([f"own {i}", *passage[i:], "", f"end {i}"])) for i in range(6)]
    rows += [(300, "same\n" * 8), (301, "x\nsame\nsame\nsame\ny"), (302, "a\n \nb\nc"), (303, "k\na\n \nb\nl"), (304, "p\nq\np\nq\np\nq")]
    got = dedup_lines(documents(spark, rows), modulus=modulus, short=True)
    assert pairs(got, "doc_id", "text") == without_repeated_pairs(rows, modulus)[0]


def test_recall_of_repeated_runs(spark):
    """Lines in runs of two or more lines with content that also stand at an earlier place."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    seen, repeated = {}, set()
    for doc, text in sorted(rows):
        lines = (text or "").split("\n")
        full = [i for i, x in enumerate(lines) if x.strip(" ")]
        for a, b in zip(full, full[1:]):
            if seen.setdefault(tuple(lines[a : b + 1]), (doc, a)) != (doc, a):
                repeated |= {(doc, i) for i in range(a, b + 1)}
    spans = mark_repeated(docs, short=True).filter("__spans IS NOT NULL").select("doc_id", "__spans").collect()
    removed = {(r["doc_id"], i) for r in spans for s in r["__spans"] for i in range(s["start"], s["start"] + s["n"])}
    assert len(repeated) > 50 and len(repeated & removed) >= 0.9 * len(repeated)


def test_lines_survive_hash_collisions(spark, monkeypatch):
    """Chunks with equal hashes are compared byte by byte."""
    from touchline.llm import linededup

    monkeypatch.setattr(linededup, "chunks", _with_equal_keys(linededup.chunks))
    rows = [(1, "aaa\nbbb"), (2, "ccc\nddd"), (3, "aaa\nbbb")]
    assert pairs(dedup_lines(documents(spark, rows), modulus=1 << 30), "doc_id", "text") == [(1, "aaa\nbbb"), (2, "ccc\nddd"), (3, "")]


def _with_equal_keys(chunks):
    return lambda *a: chunks(*a).withColumn("key", F.lit(1).cast("long"))


def test_lines_of_empty_table(spark):
    assert mark_repeated(documents(spark, [])).count() == 0


# Substrings


def left(rows, window):
    words = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in words:
        for i in range(len(w) - window + 1):
            if d is not None:
                k = tuple(w[i : i + window])
                first[k] = min(first.get(k, d), d)
    found = []
    for d, w in words:
        gone = set()
        for i in range(len(w) - window + 1):
            if d is not None and first[tuple(w[i : i + window])] < d:
                gone |= set(range(i, i + window))
        found.append((d, len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(found, key=str)


def thue_morse(n):
    return [bin(i).count("1") % 2 for i in range(n)]


def test_different_long_sequences_have_different_digests():
    from touchline.llm.superkmers import super_kmers, window_digests

    one = [(b"ka", b"zu")[bit] for bit in thue_morse(2048)]
    other = [(b"zu", b"ka")[bit] for bit in thue_morse(2048)]
    a, b = (window_digests(w, 2048) for w in (one, other))
    assert a[0][0] != b[0][0] and a[1][0] != b[1][0]
    runs = [{(int(s), int(n)): (int(x), int(y)) for _, s, n, x, y in zip(*super_kmers(w, 2000, 16))} for w in (one, other)]
    assert all(runs[0][k] != runs[1][k] for k in runs[0].keys() & runs[1].keys())


def test_long_windows_equal_brute_force(spark):
    long = " ".join(("ka", "zu")[bit] for bit in thue_morse(300))
    rows = [(1, long), (2, "own " + long + " end"), (3, long.replace("ka", "x").replace("zu", "ka").replace("x", "zu"))]
    got = dedup_substrings(documents(spark, rows), window=200)
    assert pairs(got, "doc_id", "n_words", "n_removed", "kept") == left(rows, 200)


@pytest.mark.parametrize("window, m, bucket_strings", [(10, 4, 5000), (10, 4, 1), (50, 16, 5000), (3, 3, 2), (1, 1, 1)])
def test_substrings_equal_brute_force(spark, window, m, bucket_strings):
    rows = texts() + [(300, "a b\x1cc " * 70), (301, "a b\x1cc " * 60)]
    got = dedup_substrings(documents(spark, rows), window, m, bucket_strings)
    assert pairs(got, "doc_id", "n_words", "n_removed", "kept") == left(rows, window)


def test_substrings_of_empty_table(spark):
    assert dedup_substrings(documents(spark, [])).count() == 0


# Near duplicates


def fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def roots(nodes, linked):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in linked:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("cell_rows", [64, 1])
def test_groups_equal_brute_force(spark, cell_rows):
    rows = texts()
    prints = {t: fingerprint(t) for _, t in rows}
    values = sorted(set(prints.values()))
    root = roots(values, [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 2])
    smallest = {}
    for d, t in rows:
        if d is not None:
            r = root[prints[t]]
            smallest[r] = min(smallest.get(r, d), d)
    want = sorted(((d, prints[t], smallest.get(root[prints[t]])) for d, t in rows), key=str)
    got = near_groups(documents(spark, rows), cell_rows=cell_rows)
    assert sorted(((r["doc_id"], r["fingerprint"] % (1 << 64), r["component_id"]) for r in got.collect()), key=str) == want

    kept = keep_one(documents(spark, rows), cell_rows=cell_rows)
    assert kept.columns == documents(spark, []).columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len({root[p] for p in prints.values()})
    assert {i for i in ids if i is not None} == set(smallest.values())


def test_links_connect_all_that_are_near(spark):
    drawn = random.Random(3)
    centres = [drawn.getrandbits(64) for _ in range(20)]
    values = {c ^ sum(1 << b for b in drawn.sample(range(64), drawn.randint(0, 4))) for c in centres for _ in range(40)}
    signed = {v - (1 << 64) if v >> 63 else v for v in values}
    df = spark.createDataFrame([(v,) for v in signed], "fingerprint long")
    near = {(a, b) for a in signed for b in signed if a < b and ((a ^ b) % (1 << 64)).bit_count() <= 2}
    exact = {tuple(r) for r in links(df, 2, 10_000).collect()}
    assert exact == near
    for cell_rows in (1, 5):
        found = {tuple(r) for r in links(df, 2, cell_rows).collect()}
        assert roots(signed, found) == roots(signed, near)


def test_embedding_distance_is_a_lower_bound(spark):
    drawn = random.Random(5)
    rows = [tuple(drawn.getrandbits(63) for _ in "ab") for _ in range(200)]
    df = spark.createDataFrame(rows, "a long, b long")
    shown = df.select("a", "b", F.bit_count(embedding(F.col("a")).bitwiseXOR(embedding(F.col("b")))).alias("d")).collect()

    def counts(x):
        return [(x >> 2 * i & 1) + (x >> 2 * i + 1 & 1) for i in range(32)]

    for a, b, d in shown:
        assert d == sum(abs(x - y) for x, y in zip(counts(a), counts(b))) <= (a ^ b).bit_count()
    assert len(grid_masks(2)) == 6


def test_components(spark):
    drawn = random.Random(9)
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 50)]
    loose = [(2000 + drawn.randrange(300), 2000 + drawn.randrange(300)) for _ in range(150)]
    every = [p for p in chain + star + loose if p[0] != p[1]]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(every, "a long, b long")).collect()}
    nodes = {n for p in every for n in p}
    assert got == roots(nodes, every)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
