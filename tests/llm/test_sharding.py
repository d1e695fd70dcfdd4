"""Operator 6 against an exhaustive minimax search."""

import zlib
from collections import defaultdict

import numpy as np
import pytest

from wattline.llm import sharding

SCHEMA = "doc_id long, text string, shard string, row int"


def feasible(sizes, capacity, shards):
    used, room = 1, capacity
    for s in sizes:
        if s > capacity:
            return False
        if s > room:
            used, room = used + 1, capacity
        room -= s
    return used <= shards


@pytest.mark.parametrize("seed,shards", [(0, 8), (1, 3), (2, 1), (3, 5)])
def test_smallest_capacity(spark, seed, shards):
    rng = np.random.default_rng(seed)
    sizes = [int(x) for x in rng.integers(1, 200, int(rng.integers(1, 60)))] + ([900] if seed == 1 else [])
    sums = spark.createDataFrame([(int(x),) for x in np.cumsum(sizes)], "upto long")
    capacity, cuts = sharding.smallest_capacity(sums, sum(sizes), max(sizes), shards)
    want = next(c for c in range(1, sum(sizes) + 1) if feasible(sizes, c, shards))
    assert capacity == want and len(cuts) == shards and cuts[-1] == sum(sizes)
    assert max(b - a for a, b in zip([0, *cuts], cuts)) <= want


def test_documents(spark):
    rng = np.random.default_rng(7)
    rows = [(i, "é" * int(rng.integers(0, 60)) + str(i % 150), "x", i) for i in range(400)]
    rows += [(1000 + i, "copy of a hot text", "x", None) for i in range(200)] + [rows[3]] * 2
    rows += [(None, None, None, None), (5000, None, "", 1), (5001, "", "", 1), (None, "z" * 5000, "", 1)]
    got = sharding.shard_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == sorted(
        ((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, _, _ in rows), key=repr)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    slots, size, of = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in got:
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
        of[r.size, r.text_crc32].add(r.shard)
    assert set(slots) == set(range(8)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of.values())
    groups = defaultdict(int)
    for _, t, _, _ in rows:
        groups[t or ""] += len((t or "").encode()) + 1
    assert max(size.values()) <= -(-sum(groups.values()) // 8) + max(groups.values())


def test_empty_and_single(spark):
    assert sharding.shard_documents(spark.createDataFrame([], SCHEMA)).count() == 0
    one = sharding.shard_documents(spark.createDataFrame([(1, "a", "", 1)], SCHEMA)).collect()
    assert [(r.shard, r.slot, r.size) for r in one] == [(0, 0, 2)]
