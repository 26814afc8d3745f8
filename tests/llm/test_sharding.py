from collections import Counter, defaultdict

import pytest

from kindred.llm.common import stored
from kindred.llm.sharding import _shares, propagate, shard_documents


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def checked(rows, shards, n):
    assert len(rows) == n
    sizes = Counter(r["shard"] for r in rows)
    counts = [sizes.get(s, 0) for s in range(shards)]
    assert max(counts) - min(counts) <= 1
    for s, k in sizes.items():
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(k))


def test_groups_stay_together(spark):
    import random

    r = random.Random(4)
    rows = [(i, f"text {i}") for i in range(300)] + [(300 + i, f"group {r.randrange(30)}") for i in range(100)]
    out = shard_documents(docs(spark, rows)).collect()
    checked(out, 8, 400)
    where = defaultdict(set)
    text = dict(rows)
    for x in out:
        where[text[x["doc_id"]]].add(x["shard"])
    assert sum(len(v) > 1 for v in where.values()) <= 2


def test_hot_group_fills_whole_shards(spark):
    rows = [(i, "same") for i in range(100)] + [(100 + i, f"t{i}") for i in range(200)]
    out = shard_documents(docs(spark, rows)).collect()
    checked(out, 8, 300)
    hot = Counter(r["shard"] for r in out if r["doc_id"] < 100)
    assert sorted(hot.values())[-2:] == [38, 38] or max(hot.values()) >= 37
    assert len(hot) <= 4


def test_sizes_and_checksums(spark):
    out = {r["doc_id"]: r for r in shard_documents(docs(spark, [(1, "é"), (2, None), (3, "")])).collect()}
    assert [out[i]["size"] for i in (1, 2, 3)] == [3, 1, 1]
    assert out[2]["text_crc32"] == 0 and out[1]["law"] == "rows" and out[1]["grown_shard"] is None


@pytest.mark.parametrize("rows", [[], [(1, "a")], [(None, "a"), (1, None), (1, None)], [(5, "x")] * 9])
def test_edges(spark, rows):
    checked(shard_documents(docs(spark, rows)).collect(), 8, len(rows))


def test_extra_columns_with_clashing_names(spark):
    df = spark.createDataFrame([(1, "a", 7, 8), (2, "a", 7, 8)], "doc_id long, text string, shard int, slot int")
    checked(shard_documents(df).collect(), 8, 2)


def several(spark, loose):
    """40 documents in groups of five, the first five of which share a second group, and `loose` without links."""
    nodes = stored(spark.range(40 + loose).select("id").withColumnRenamed("id", "doc"), "t")
    members = stored(spark.createDataFrame([(i, f"a{i // 5}") for i in range(40)] + [(i, "b") for i in range(5)], "doc long, grp string"), "t")
    return {r["doc"]: r["shard"] for r in propagate(nodes, members, 4).collect()}


def test_links_in_several_groups(spark):
    out = several(spark, 80)
    assert Counter(out.values()) == {s: 30 for s in range(4)}
    assert all(len({out[5 * g + i] for i in range(5)}) == 1 for g in range(8))


def test_full_shards_keep_the_law(spark):
    out = several(spark, 0)
    assert Counter(out.values()) == {s: 10 for s in range(4)}


def test_shares_swap_and_fill():
    assert _shares({(0, 1): 10, (1, 0): 4}, [0, 3]) == {(0, 1): 0.7, (1, 0): 1.0}


def test_intermediate_tables_can_be_swept(spark):
    import os

    from kindred.llm.common import fresh_path, sweep

    stored(spark.range(3), "t")
    folder = os.path.dirname(fresh_path(spark, "t")).removeprefix("file://")
    assert os.listdir(folder)
    sweep(spark)
    assert not os.path.exists(folder)
