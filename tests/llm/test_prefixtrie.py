import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from touchline.llm.doublearray import DoubleArray, number_turns
from touchline.llm.prefixtrie import ordered_codes, path_of, prefix_trie
from touchline.llm.queries import op11_prefix_trie, rebuilt_conversations

SCHEMA = "conv_id long, turn long, role string, text string, path string, n long, first long"
FOLDER = "/root/testdata/sf0.001"


def ordered(rows) -> dict[int, list[tuple]]:
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [t[2:] for t in sorted(found)] for c, found in turns.items()}


def rebuilt(convs):
    found = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        found[c] = convs.get(c - c % 5, [])[:h] + own[h:]
    return found


def brute(convs) -> list[tuple]:
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        below = [totals[child] for child in children[node]]
        totals[node] = (sum(b[0] for b in below) or int(not below), own + sum(b[1] for b in below))
    rows = []
    for node, own in members.items():
        ends = ",".join(str(c) for c in sorted(own) if len(convs[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(own), len(node), parent, len(own), len(children[node]), *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def rows_of(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert df.columns == names
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(op11_prefix_trie(spark, FOLDER)) == brute(rebuilt(ordered(rows)))


def tables():
    drawn = random.Random(4)
    popular = [(0, "user", "hello é"), (1, "assistant", "hi")]
    many = []
    for c in range(120):
        turns = popular[: drawn.choice([0, 1, 2, 2])] if c % 3 else popular + [(2, "user", "same")] * 2
        turns = turns + [(t + 5, drawn.choice(["user", "tool"]), drawn.choice("abc")) for t in range(drawn.choice([0, 1, 2, 6]) if c % 3 else 0)]
        many += [(c, *t) for t in turns]
    yield many
    yield [(None, 1, "a", "b"), (1, None, "z", None), (1, None, None, "x"), (1, 0, "a", ""), (1, 0, "a", ""), (2, 0, None, None), (-3, 1, "a", "b")]
    yield [(c, t, "r", f"{c if t > 45 else 0}") for c in range(12) for t in range(50)]  # alike beyond the head
    yield [(7, t, "r", "x" * t) for t in range(300)]
    yield []


@pytest.mark.parametrize("at", range(5))
@pytest.mark.parametrize("shard_turns, head", [(20_000, 32), (3, 2), (40, 1)])
def test_nodes_equal_brute_force(spark, at, shard_turns, head):
    rows = list(tables())[at]
    turns = spark.createDataFrame([(*r, "p", 1, 2) for r in rows], SCHEMA).repartition(3)
    convs = ordered(rows)
    sequences = ordered_codes(turns).select("conv_id", path_of(F.col("codes")).alias("path"))
    assert rows_of(prefix_trie(sequences, shard_turns, head)) == brute(convs)
    if at < 2:
        assert rows_of(prefix_trie(rebuilt_conversations(turns), shard_turns, head)) == brute(rebuilt(convs))


def test_members_of_a_popular_path_meet_in_blocks(spark):
    convs = spark.range(-3, 20_000).select(F.col("id").alias("conv_id"), F.lit(bytes(24)).alias("path"))
    root, node = sorted(prefix_trie(convs).collect(), key=lambda r: r["depth"])
    assert node["n_convs"] == root["n_convs"] == 20_003 and node["conv_id"] == -3 and node["n_leaves"] == 1
    assert node["ends_sha256"] == hashlib.sha256(",".join(map(str, range(-3, 20_000))).encode()).hexdigest()
    assert root["ends_sha256"] == hashlib.sha256(b"").hexdigest()


@pytest.mark.parametrize("turns, sequences, longest", [(5, 200, 6), (1000, 3000, 4), (3, 500, 9), (400, 300, 1)])
def test_double_array_holds_each_node_once(turns, sequences, longest):
    drawn = np.random.default_rng(turns)
    made = {tuple(drawn.integers(0, turns, drawn.integers(0, longest + 1)).tolist()) for _ in range(sequences)}
    made = sorted(made)
    lengths = np.array([len(m) for m in made])
    labels, count = number_turns(np.array([t for m in made for t in m], dtype=np.int64), lengths)
    assert sorted(set(labels.tolist())) == list(range(count))
    trie = DoubleArray(labels, lengths)
    reached = trie.walk()
    nodes = {}
    for m, start in zip(made, trie.starts.tolist()):
        for d in range(len(m)):
            assert nodes.setdefault(m[: d + 1], reached[start + d]) == reached[start + d]
    assert len(set(nodes.values())) == len(nodes) == (trie.check >= 0).sum()
    assert trie.root not in nodes.values()
