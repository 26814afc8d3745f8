import random
import re

import numpy as np
import pandas as pd
import pytest
from helpers import have_data

from kindred.llm import ngram_join
from kindred.llm.components import components
from kindred.llm.ngram_join import SignatureTree, dual_traversal, jaccard_components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute(rows):
    sets = {d: shingles(t) for d, t in rows}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            shared = len(sets[a] & sets[b])
            if shared and 100 * shared >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted((d, len(s), find(d)) for d, s in sets.items())


def ours(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted(map(tuple, jaccard_components(df).collect()))


def corpus(seed, families, size, words, edits):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(5000)]
    common = [r.choice(vocabulary) for _ in range(30)]
    rows = []
    for _ in range(families):
        base = [r.choice(vocabulary) for _ in range(r.randint(1, words))]
        for _ in range(r.randint(1, size)):
            t = list(base)
            for _ in range(r.randint(0, edits)):
                t[r.randrange(len(t))] = r.choice(vocabulary)
            if r.random() < 0.3:
                t = common + t
            rows.append((len(rows), r.choice([" ", "\n", " \t "]).join(t)))
    return rows


@pytest.mark.parametrize(("seed", "families", "size", "words", "edits"), [(1, 60, 4, 60, 3), (2, 10, 30, 80, 8), (3, 80, 3, 12, 1), (4, 6, 40, 300, 12)])
def test_against_all_pairs(spark, seed, families, size, words, edits):
    rows = corpus(seed, families, size, words, edits)
    assert ours(spark, rows) == brute(rows)


def test_trees_find_what_pivots_leave(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "PIVOT_ROUNDS", 0)
    monkeypatch.setattr(ngram_join, "CHUNK_ROWS", 8)
    rows = corpus(5, 5, 40, 120, 6)
    assert ours(spark, rows) == brute(rows)


def test_threshold_is_inclusive(spark):
    base = [f"a{i}" for i in range(49)]  # 45 shingles
    rows = [(0, " ".join(base)), (1, " ".join(base[:40])), (2, " ".join(base[:39]))]
    assert ours(spark, rows) == [(0, 45, 0), (1, 36, 0), (2, 35, 0)]
    assert ours(spark, [rows[0], rows[2]]) == [(0, 45, 0), (2, 35, 2)]


def test_edges(spark):
    assert ours(spark, []) == []
    rows = [(5, None), (6, ""), (7, " \n "), (3, "One two"), (4, "one\ttwo"), (8, "one"), (9, "É"), (10, "é"), (2, "a b c d e"), (1, "A B C D E")]
    assert ours(spark, rows) == brute(rows)
    df = spark.createDataFrame([(1, "a b", 9, 9), (1, "a b", 9, 9), (None, "a b", 9, 9)], "doc_id long, text string, component_id int, n int")
    got = sorted(map(tuple, jaccard_components(df).collect()), key=repr)
    assert got[:2] == [(1, 1, 1), (1, 1, 1)] and len(got) == 3


@pytest.mark.parametrize("chunk", [8, 1024])
def test_every_link_between_different_sets(spark, monkeypatch, chunk):
    monkeypatch.setattr(ngram_join, "CHUNK_ROWS", chunk)
    rows = corpus(6, 8, 30, 250, 4) + [(5000, None), (5001, "")]
    sets = {d: shingles(t) for d, t in rows}
    links, members = ngram_join.jaccard_pairs(spark.createDataFrame(rows, "doc_id long, text string"))
    members = members.collect()
    of = {}
    for m in members:
        assert m["n_shingles"] == len(sets[m["doc_id"]])
        of.setdefault(m["class"], set()).add(sets[m["doc_id"]])
    assert all(len(v) == 1 for c, v in of.items() if c is not None) and of[None] == {frozenset()}
    kind = {c: next(iter(v)) for c, v in of.items() if c is not None}
    ids = sorted(kind)
    assert len(set(kind.values())) == len(ids)
    want = {(b, a) for i, a in enumerate(ids) for b in ids[i + 1 :] if 100 * len(kind[a] & kind[b]) >= 80 * len(kind[a] | kind[b])}
    got = [(r["a"], r["b"]) for r in links.collect()]
    assert set(got) == want and len(got) == len(want) and len(want) > 50
    assert all(m["n_links"] == sum(m["class"] in p for p in want) for m in members)


def test_one_id_with_several_texts(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (0, "other words")]
    got = sorted(map(tuple, jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()))
    assert got == [(0, 1, 0), (1, 36, 1), (1, 36, 1), (2, 37, 1), (3, 37, 1)]


@pytest.mark.skipif(not have_data(), reason="no test tables")
def test_query_against_brute_force(spark, sf):
    rows = [(r[0], r[1]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, ngram_join.op6_ngram_jaccard_join(spark, sf).collect())) == brute(rows)


def test_long_near_copies(spark, monkeypatch):
    """200,000 words each: no key carries the others of its set."""
    monkeypatch.setattr(ngram_join, "PIVOT_ROUNDS", 0)
    long = [f"x{i}" for i in range(200_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[:-900] + ["z"] * 900)), (3, " ".join(f"q{i}" for i in range(500)))]
    assert [r[2] for r in ours(spark, rows)] == [1, 1, 3]


def test_very_long_text(spark):
    long = " ".join(f"x{i}" for i in range(300_000))
    assert ours(spark, [(1, long), (2, long + " tail"), (3, "y " * 50)]) == [(1, 299_996, 1), (2, 299_997, 1), (3, 1, 3)]


def test_dual_traversal_keeps_all_links():
    r = random.Random(7)
    sets = [{r.randrange(2**60) for _ in range(r.randint(5, 80))} for _ in range(20)]
    sets += [s - {next(iter(s))} for s in sets]
    rows = pd.DataFrame({"bitmap": [ngram_join._bitmap(np.array(sorted(s), dtype=np.uint64)) for s in sets], "n": [len(s) for s in sets], "comp": range(40)})
    rows = rows.sort_values("n").reset_index()
    tree = SignatureTree.of(rows)
    i, j = dual_traversal(tree, tree, True)
    got = {tuple(sorted((int(rows["index"][a]), int(rows["index"][b])))) for a, b in zip(i, j, strict=True)}
    want = {(a, b) for a in range(40) for b in range(a + 1, 40) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    assert want <= got and len(got) <= 2 * len(want) + 5


def test_components(spark):
    r = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 200 + i) for i in range(50)] + [(r.randrange(300, 330), r.randrange(300, 330)) for _ in range(20)] + [(500, 500)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long")
    for one_task in (0, 1000):
        got = {r["node"]: r["component"] for r in components(df, one_task).collect()}
        assert got == {n: find(n) for n in list(root)}
        assert components(df.limit(0), one_task).count() == 0
