"""What Python workers hold: none of another kind for the driver's rows, small arrays, and no free memory behind a task."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from kindred.llm import wordhash
from kindred.llm.common import freeing, local_table
from kindred.llm.decontaminate import leaks, without_leaks
from kindred.llm.ngram_join import jaccard_components
from kindred.llm.secret_scan import SecretFilter, redact, scan


def test_rows_of_the_driver_start_no_other_workers(spark, monkeypatch):
    rows = [(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "token = '0123456789abcdef0123'"), (4, None)]
    docs, items = local_table(spark, rows, "doc_id long, text string"), local_table(spark, [], "item_id long, text string")

    def refused(*args, **kwargs):
        raise AssertionError("rows went to workers that no UDF uses")

    monkeypatch.setattr(type(spark.sparkContext), "parallelize", refused)
    found = {r["doc_id"]: r["component_id"] for r in jaccard_components(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4}
    judge = SecretFilter.default(spark, docs)
    assert redact(docs, scan(docs, judge)).count() == 4 and leaks(docs, items).count() == 0 and without_leaks(docs, items).count() == 4


def test_local_table(spark):
    rows = [(2**53 + 1, "é", 0.5, [1.0, 2.0]), (None, None, None, None), (3, "", -0.0, [])]
    df = local_table(spark, rows, "a long, b string, c double, d array<double>")
    assert [tuple(r) for r in df.collect()] == rows and df.schema.simpleString() == "struct<a:bigint,b:string,c:double,d:array<double>>"
    assert local_table(spark, [], "a int, b array<string>").count() == 0


def test_hashing_holds_small_arrays_and_keeps_less():
    texts = pa.array([f"word{i} and some more of them " * 40 for i in range(4000)])
    tracemalloc.start()
    try:
        n = sum(len(s) for at, data, ends in wordhash.chunks(texts) for s in wordhash.shingle_sets(data, ends, 5))
        long = wordhash.words(np.full(5 << 20, 97, dtype=np.uint8), np.array([0, 5 << 20]))
        kept, _ = tracemalloc.get_traced_memory()
        tracemalloc.reset_peak()
        assert n == sum(len(s) for at, data, ends in wordhash.chunks(texts) for s in wordhash.shingle_sets(data, ends, 5))
        _, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert len(long[0]) == 1 and kept < 8e6 and peak < 25e6


def test_hashes_do_not_depend_on_chunks():
    texts = pa.array([" ".join(f"w{i * j}" for j in range(1, 400)) for i in range(600)])
    small, large = ([s.tolist() for at, data, ends in wordhash.chunks(texts, size) for s in wordhash.shingle_sets(data, ends, 5)] for size in (1 << 14, 1 << 21))
    assert small == large and len(small) == 600


def _resident():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * 4096


def test_a_worker_gives_free_memory_back():
    if not hasattr(__import__("ctypes").CDLL(None), "malloc_trim"):
        pytest.skip("no glibc")
    kept = []

    def work(batches):
        held = []
        for _ in batches:
            for _ in range(2000):  # what is kept lies between what is freed
                held.append(bytearray(b"x" * 60_000))
                kept.append(bytearray(b"x" * 1000))
            yield len(held)

    before = _resident()
    assert list(freeing(work)(iter([1]))) == [2000]
    assert _resident() - before < 40e6
    assert work.__name__ == freeing(work).__name__ == "work"
