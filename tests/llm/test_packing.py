import bisect
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from helpers import have_data

from kindred.llm import packing
from kindred.llm.packing import END, cuts, pack, plan, sequences
from kindred.llm.tokenize import VOCABULARY, Encoder


def placed(table, histogram, capacity):
    """Every (sequence, offset, length) of a plan; checks that each number is used once."""
    seen, out = defaultdict(set), []
    for length, first, n, copies, sequence, offset in table.itertuples(index=False):
        for i in range(n):
            assert first + i not in seen[length]
            seen[length].add(first + i)
            out.append((sequence + i // copies, offset + i % copies * length, length))
    assert {k: len(v) for k, v in seen.items()} == {k: v for k, v in histogram.items() if v}
    by = defaultdict(list)
    for s, o, n in out:
        by[s].append((o, n))
    for parts in by.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(by)


@pytest.mark.parametrize("seed", range(8))
def test_plans(seed):
    r = random.Random(seed)
    capacity = r.choice([64, 200, 1024])
    n = r.choice([1, 10, 300, 5000])
    shape = r.choice([lambda: r.randint(1, capacity), lambda: min(capacity, int(r.expovariate(4 / capacity)) + 1), lambda: r.choice([capacity // 2 + 1, capacity // 3, 3])])
    lengths = [shape() for _ in range(n)]
    histogram = {k: lengths.count(k) for k in set(lengths)}
    used = placed(plan(histogram, capacity), histogram, capacity)
    assert used <= best_fit(lengths, capacity) * 1.006 + 2


def best_fit(lengths, capacity):
    """Sequences of plain best fit, longest first."""
    free, n = [], 0
    for x in sorted(lengths, reverse=True):
        at = bisect.bisect_left(free, x)
        if at == len(free):
            n += 1
            bisect.insort(free, capacity - x)
        else:
            bisect.insort(free, free.pop(at) - x)
    return n


def test_plan_of_nothing_and_of_one_length():
    assert len(plan({})) == 0
    assert placed(plan({1: 5000}, 1024), {1: 5000}, 1024) == 5
    assert placed(plan({1024: 7}, 1024), {1024: 7}, 1024) == 7
    assert placed(plan({512: 101}, 1024), {512: 101}, 1024) == 51


def test_cuts():
    assert cuts(1024, 1024) == [(0, 1024)]
    assert cuts(1025, 1024) == [(0, 1), (1, 1024)]
    assert cuts(5, 4) == [(0, 1), (1, 4)] and cuts(3, 4) == [(0, 3)]


def test_documents(spark):
    from tokenizers import Tokenizer
    import public_tokenizers

    t = Tokenizer.from_file(public_tokenizers.path(VOCABULARY))
    r = random.Random(2)
    texts = [None, "", "hello world", "<|endoftext|> é 漢字 🙂"] + [" ".join(r.choice(["alpha", "béta", "gamma!", "42"]) for _ in range(r.choice([5, 90, 900, 4000]))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = pack(df).collect()
    ids = {i: [*t.encode(x or "", add_special_tokens=False).ids, END] for i, x in enumerate(texts)}
    got = defaultdict(list)
    for x in rows:
        got[x["doc_id"]].append((x["piece"], x["start"], x["length"], x["ids_crc32"]))
    for i, want in ids.items():
        parts = sorted(got[i])
        assert [(p, s, n) for p, s, n, _ in parts] == [(k, s, n) for k, (s, n) in enumerate(cuts(len(want), 1024))]
        assert all(c == zlib.crc32(np.array(want[s : s + n], dtype="<u4").tobytes()) for _, s, n, c in parts)
    by = defaultdict(list)
    for x in rows:
        by[x["sequence_id"]].append((x["offset"], x["length"], x["doc_id"], x["start"]))
    for parts in by.values():
        at = 0
        for o, n, _, _ in sorted(parts):
            assert o == at
            at += n
        assert at <= 1024
    whole = {x["sequence_id"]: x["ids"] for x in sequences(df, spark.createDataFrame(rows)).collect()}
    assert whole == {s: [v for _, n, d, a in sorted(parts) for v in ids[d][a : a + n]] for s, parts in by.items()}


def test_edges(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    df = spark.createDataFrame([(1, "a", 3, 4), (1, "a", 3, 4), (None, "b", 3, 4)], "doc_id long, text string, length int, sequence_id int")
    rows = pack(df).collect()
    assert len(rows) == 3 and sorted(r["offset"] for r in rows) == [0, 2, 4]


def test_ids_beside_nulls_stay_exact(spark):
    big = 2**53 + 1
    rows = pack(spark.createDataFrame([(big, "a"), (None, "b"), (big + 2, "c " * 2000)], "doc_id long, text string")).collect()
    assert {r["doc_id"] for r in rows} == {big, None, big + 2}


@pytest.mark.skipif(not have_data(), reason="no test tables")
def test_every_text_is_encoded_as_by_tokenizers(spark):
    from tokenizers import Tokenizer
    import public_tokenizers

    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("text").collect()]
    want = Tokenizer.from_file(public_tokenizers.path(VOCABULARY)).encode_batch(texts, add_special_tokens=False)
    assert all(Encoder().encode(t).tolist() == w.ids for t, w in zip(texts, want, strict=True))


@pytest.mark.skipif(not have_data(), reason="no test tables")
def test_query_packs_a_whole_table_tightly(spark, sf):
    rows = packing.op7_best_fit_packing(spark, sf).collect()
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in by.values():
        assert [o for o, _ in sorted(parts)] == np.cumsum([0, *(n for _, n in sorted(parts))])[:-1].tolist() and sum(n for _, n in parts) <= 1024
    lengths = [r["length"] for r in rows]
    assert {r["doc_id"] for r in rows} == {r[0] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id").collect()}
    assert len(by) <= best_fit(lengths, 1024) * 1.006 + 2


@pytest.mark.parametrize("text", ["plain words, 12's", "é à ü ß – “quoted” …", "漢字かな交じり", "à combining", "tabs\t\tand\n\n new  lines ", "🙂🙂", "", "x" * 3000, "١٢٣ عربي", "<|endoftext|>", "Ⅷ ½ №"])
def test_encoder_equals_tokenizers(text):
    from tokenizers import Tokenizer
    import public_tokenizers

    assert Encoder().encode(text).tolist() == Tokenizer.from_file(public_tokenizers.path(VOCABULARY)).encode(text, add_special_tokens=False).ids
