import random

from kindred.llm import token_counts
from kindred.llm.tokenize import Encoder


def table(spark, lengths, block=None):
    df = spark.createDataFrame([(n,) for n in lengths], "n_tokens long")
    return token_counts.limit_table(token_counts.length_histogram(df))


def test_against_brute_force(spark):
    r = random.Random(1)
    lengths = [r.choice([0, 1, 5, r.randint(1, 20_000), 4096, 8191]) for _ in range(400)]
    t = table(spark, lengths)
    rows = t.collect()
    assert sorted(x["context_limit"] for x in rows) == sorted(set(lengths))
    for x in rows:
        limit = x["context_limit"]
        assert x["n_docs"] == lengths.count(limit)
        assert x["docs_at_least"] == sum(n >= limit for n in lengths) and x["tokens_at_least"] == sum(n for n in lengths if n >= limit)
        assert x["docs_over"] == sum(n > limit for n in lengths) and x["truncated_tokens"] == sum(min(n, limit) for n in lengths)
        assert x["tokens_cut"] == sum(lengths) - x["truncated_tokens"] and (x["total_docs"], x["total_tokens"]) == (400, sum(lengths))
        assert abs(x["quantile"] - sum(n <= limit for n in lengths) / 400) < 1e-12
    for limit in (0, 3, 777, 4096, 5000, 10**9):
        assert token_counts.truncated_total(t, limit) == sum(min(n, limit) for n in lengths)
    for share in (0.1, 0.5, 0.9, 1.0):
        assert token_counts.quantile_length(t, share) == min(n for n in set(lengths) if sum(m <= n for m in lengths) >= share * 400)


def test_lengths_of_whole_texts(spark):
    texts = [None, "", "hello there", "hello there", "é" * 9, "word " * 50_000]
    df = spark.createDataFrame([(t, 1) for t in texts], "text string, length int")
    e = Encoder()
    assert [r["n_tokens"] for r in token_counts.token_lengths(df).collect()] == [0 if t is None else len(e.encode(t)) for t in texts]


def test_empty(spark):
    t = table(spark, [])
    assert t.count() == 0 and token_counts.truncated_total(t, 5) == 0 and token_counts.quantile_length(t, 0.5) is None
