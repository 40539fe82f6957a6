"""Prefix trie against a brute-force trie."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from candlewick.llm import prefix_trie, queries
from oracle_compare import duck

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(v)] for c, v in convs.items()}
    nodes = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq = own.get(c - c % 5, [])[:h] + turns[h:]
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append((c, d == len(seq)))
    out = []
    for key, members in nodes.items():
        below = [k for k in nodes if k[: len(key)] == key]
        kids = {len(k) for k in below}
        leaf = sum(not any(o[:-1] == k for o in below if o) for k in below)
        saved = sum((len(nodes[k]) - 1) * len(k[-1][1].encode()) for k in below if k)
        ends = ",".join(str(c) for c in sorted(c for c, last in members if last))
        up = min(c for c, _ in nodes[key[:-1]]) if key else None
        n_children = sum(len(k) == len(key) + 1 for k in below) if kids else 0
        out.append((min(c for c, _ in members), len(key), up, len(members), n_children, leaf, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def odd_rows(seed: int, n: int):
    rng = random.Random(seed)
    rows = [(1, None, "user", "early"), (1, None, "user", "early"), (1, 3, None, None), (2, 5, "user", ""), (None, 1, "user", "lost"), (7, 1, "a", "é" * 5000)]
    rows += [(50, i, "user", "go") for i in range(40)] + [(c, i, "user", "go") for c in (51, 52, 53, 54) for i in range(38)]
    for c in range(10, 10 + n):
        rows += [(c, i, rng.choice("ab"), rng.choice("xy")) for i in range(rng.randrange(1, 6))]
    return rows


@pytest.mark.parametrize("weight,bucket", [(1, 5), (20, 50), (4096, 20_000)])
def test_trie_equals_brute_force(spark, weight, bucket):
    rows = odd_rows(weight, 25)
    table = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit("x").alias(c) for c in ("CONV", "depth", "bytes", "k1", "held")])
    got = prefix_trie.prefix_trie(table, local_weight=weight, bucket_nodes=bucket)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_trie_of_long_conversation_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "CHUNK", 7)
    monkeypatch.setattr(prefix_trie, "ID_RANGE", 3)
    rows = odd_rows(9, 10)
    got = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), local_weight=30)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows)


def test_trie_of_nothing(spark):
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_roll_component_on_a_chain_and_a_star():
    for parent in ([-1] + list(range(999)), [-1] + [0] * 999):
        total = [[0] for _ in parent]
        prefix_trie.roll_component(list(range(1000)), parent, [(1,)] * 1000, total)
        size = [1] * 1000
        for v in range(999, 0, -1):
            size[parent[v]] += size[v]
        assert [t[0] for t in total] == size


def test_trie_sql(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.QUERIES["op12_prefix_trie"](spark, sf).collect()
    want = duck(sf).execute(queries.ORACLE["op12_prefix_trie"]).fetchall()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr) and len(got) > 20
