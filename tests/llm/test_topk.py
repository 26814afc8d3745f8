import random

import numpy as np
import pytest
from helpers import connection, have_data, same

from kindred.llm import topk


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>")


def brute(rows, k, is_query):
    clean = []
    for i, v in rows:
        if v is not None and all(x is not None and np.isfinite(x) for x in v):
            clean.append((i, [int(np.floor(256 * float(np.float32(x)))) for x in v]))
    out = []
    for at, (q, v) in enumerate(clean):
        if q is not None and is_query(q):
            s = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), c is None, c or 0) for other, (c, w) in enumerate(clean) if other != at)
            out += [(q, r, None if lost else c, -x) for r, (x, lost, c) in enumerate(s[:k], 1)]
    return sorted(out, key=repr)


def ours(spark, rows, k, every):
    v = topk.quantised(vectors(spark, rows), "vec_id", "embedding")
    return sorted(map(tuple, topk.top_products(v, v.filter(f"id % {every} = 0"), k).collect()), key=repr)


@pytest.mark.parametrize("seed", range(6))
def test_against_all_products(spark, seed, monkeypatch):
    r = random.Random(seed)
    monkeypatch.setattr(topk, "PART_ROWS", 60)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 20)
    d, scale = r.choice([2, 3, 8]), r.choice([0.01, 1.0, 30.0])
    rows = [(i, [r.gauss(0, 1) * scale * (1 + (i % 7)) for _ in range(d)]) for i in range(200)]
    rows += [(1000 + i, rows[i][1]) for i in range(40)]  # ties
    rows += [(i, rows[i][1]) for i in range(0, 20, 3)]  # the same row twice
    rows += [(i, rows[i + 1][1]) for i in range(0, 30, 2)] + [(None, rows[i][1]) for i in range(10)]
    assert ours(spark, rows, 5, 3) == brute(rows, 5, lambda q: q % 3 == 0)


def test_buckets_prune_but_lose_nothing():
    r = np.random.default_rng(5)
    base = r.normal(size=(40, 16))
    rows = np.floor(np.repeat(base, 50, axis=0) * 256 + r.normal(size=(2000, 16)) * 8).astype(np.int64)
    ids = r.permutation(2000)
    q = rows[::40]
    qi, ci, s = topk.search(q, ids[::40], rows, ids, ids, 5)
    for i in range(len(q)):
        all_ = sorted((-int(x), int(c)) for x, c in zip(rows @ q[i], ids, strict=True) if c != ids[::40][i])[:5]
        assert [(-int(s[j]), int(ids[ci[j]])) for j in np.flatnonzero(qi == i)] == all_


def test_short_parts_are_never_paired_with_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "PART_ROWS", 50)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 10)
    r = random.Random(1)
    rows = [(i, [r.gauss(0, 1) * 1.01 ** (i % 500) for _ in range(4)]) for i in range(1000)]
    v = topk.quantised(vectors(spark, rows), "vec_id", "embedding")
    placed = topk.stored(topk.cut_by_length(v, 50, "part"), "t")
    seeded = topk.stored(topk._seeds(placed, v.filter("id % 5 = 0"), 5, 4), "t")
    blocks, pairs = topk.pairing(placed, seeded)
    n_parts, n_blocks = placed.select("part").distinct().count(), blocks.select("block").distinct().count()
    assert n_parts >= 15 and n_blocks >= 15 and pairs.count() < 0.5 * n_parts * n_blocks
    longest = {x["part"]: x["n"] for x in placed.groupBy("part").agg({"norm": "max"}).toDF("part", "n").collect()}
    assert [longest[p] for p in sorted(longest)] == sorted(longest.values(), reverse=True)
    assert ours(spark, rows, 5, 5) == brute(rows, 5, lambda q: q % 5 == 0)


def test_values_beyond_exact_floats(spark):
    rows = [(0, [3e6, -3e6]), (1, [3e6, 1.0]), (2, [3e6, 1.01])]
    assert ours(spark, rows, 5, 1) == brute(rows, 5, lambda q: True)


def test_edges(spark):
    assert ours(spark, [], 5, 1) == []
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]), (6, [1.0]), (7, []), (0, [0.5, 0.5])]
    assert ours(spark, rows, 5, 1) == brute(rows, 5, lambda q: True)
    assert ours(spark, [(0, [1.0])], 5, 1) == []
    # Two rows of one id are two candidates, and each is the other's.
    assert ours(spark, [(1, [0.5, 0.5]), (1, [0.9, 0.0]), (50, [1.0, 0.0])], 1, 50) == [(50, 1, 1, 58880)]
    wide = [(i, [float(i % 3)] * 20_000) for i in range(6)]
    assert ours(spark, wide, 2, 2) == brute(wide, 2, lambda q: q % 2 == 0)


@pytest.mark.skipif(not have_data(), reason="no test tables")
def test_query(spark, sf):
    same(topk.op5_exact_topk(spark, sf), connection(sf), topk.OP5_SQL)
