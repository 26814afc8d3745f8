import random

import numpy as np
import pytest
from helpers import have_data

from kindred.llm.decontaminate import WORD, ItemIndex, edit_match, leaks, op3_decontamination, without_leaks, word_hashes

ITEM = "the quick brown fox jumps over the lazy dog while seven small wizards quietly pack my box with five dozen jugs"


def docs(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def items(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "item_id long, text string")


def test_exact_case_and_punctuation(spark):
    texts = [f"Intro here. {ITEM} And more.", ITEM.upper().replace(" ", ",  "), "nothing of the kind is in here at all, fox jumps over", None, ""]
    got = leaks(docs(spark, texts), items(spark, ITEM)).collect()
    assert sorted((r["doc_id"], r["edit_distance"]) for r in got) == [(0, 0), (1, 0)]
    r = next(r for r in got if r["doc_id"] == 0)
    assert texts[0][r["char_start"] : r["char_end"]] == ITEM and (r["word_start"], r["word_end"]) == (2, 23)


def slow(item, text, limit):
    best = None
    for a in range(len(text) + 1):
        row = list(range(len(item) + 1))
        best = row[-1] if best is None else min(best, row[-1])
        for w in text[a:]:
            new = [row[0] + 1]
            for i, x in enumerate(item):
                new.append(min(row[i] + (x != w), row[i + 1] + 1, new[-1] + 1))
            row = new
            best = min(best, row[-1])
    return best if best <= limit else None


@pytest.mark.parametrize("seed", range(4))
def test_against_brute_force(spark, seed):
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    bench = [[r.choice(vocabulary) for _ in range(r.randint(5, 25))] for _ in range(6)]
    texts = []
    for _ in range(25):
        w = [r.choice(vocabulary) for _ in range(r.randint(0, 20))]
        if r.random() < 0.8:
            x = list(r.choice(bench))
            for _ in range(r.randint(0, len(x) // 4)):
                at = r.randrange(len(x))
                x[at : at + r.randint(0, 1)] = [r.choice(vocabulary)] * r.randint(0, 1)
            w += x + [r.choice(vocabulary) for _ in range(r.randint(0, 20))]
        texts.append(w)
    want = {(d, i): e for d, t in enumerate(texts) for i, x in enumerate(bench) if (e := slow(x, t, int(len(x) * 0.2 + 1e-9))) is not None}
    got = {(x["doc_id"], x["item_id"]): x["edit_distance"] for x in leaks(docs(spark, [" ".join(t) for t in texts]), items(spark, *(" ".join(x) for x in bench))).collect()}
    assert set(got) <= set(want)
    assert len(set(want) - set(got)) <= 0.02 * len(want) and all(got[k] == want[k] for k in got)


@pytest.mark.parametrize(("n_items", "n_words", "trials"), [(1, 5, 60), (1, 20, 60), (3, 20, 20), (20, 60, 3), (1, 120, 30), (200, 30, 1), (1, 300, 10), (1, 3000, 1)])
def test_recall_of_the_sampled_keys_alone(n_items, n_words, trials):
    """Passages edited as much as allowed; a lower share than the target only within what so few trials say."""
    r = random.Random(9)
    vocabulary = [f"v{i}" for i in range(3000)]
    bench = [[r.choice(vocabulary) for _ in range(n_words)] for _ in range(n_items)]
    index = ItemIndex(list(range(n_items)), [" ".join(x) for x in bench])
    found = asked = 0
    for i, x in enumerate(bench):
        for _ in range(trials):
            w = list(x)
            for at in r.sample(range(n_words), n_words // 5):
                w[at] = f"new{r.randrange(10**6)}"
            text = " ".join([r.choice(vocabulary) for _ in range(50)] + w + [r.choice(vocabulary) for _ in range(50)])
            asked += 1
            found += any(m[1] == i for m in index.matches([text], rest=False))
    assert found >= 0.95 * asked


def test_repetitions_follow_the_lower_bound():
    from kindred.llm.decontaminate import repeats_for

    assert repeats_for(1000, 1000, 0.99) == 1 and repeats_for(0, 1000, 0.99) == 96
    assert repeats_for(500, 1000, 0.99) == 8 and repeats_for(300, 1000, 0.99) > repeats_for(400, 1000, 0.99)


def test_long_items_take_bounded_memory():
    import tracemalloc

    x = [f"u{i}" for i in range(3000)]
    index = ItemIndex([1], [" ".join(x)])
    text = " ".join(["y"] * 3000 + x[:1000] + ["z"] * 500 + x[1500:] + ["y"] * 3000)
    tracemalloc.start()
    got = index.matches([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got[0][2] == 500 and peak < 300e6


def test_letters_that_grow_and_scripts_without_spaces(spark):
    item = "alpha beta gamma delta epsilon"
    texts = ["İstanbul İİİ x " + item + " end now", "這是一個測試句子其中包含很多漢字", "前文" + "測試句子其中包含" + "後文"]
    got = {(r["doc_id"], r["item_id"]): r for r in leaks(docs(spark, texts), items(spark, item, "測試句子其中包含")).collect()}
    r = got[0, 0]
    assert texts[0][r["char_start"] : r["char_end"]] == item and r["word_start"] == 3
    r = got[2, 1]
    assert texts[2][r["char_start"] : r["char_end"]] == "測試句子其中包含" and (1, 1) in got
    for t in [*texts, "a_b-c½ é̃ ﬁx 12x ไทย ああ x"]:
        hashes, first = word_hashes([t])
        assert len(hashes) == len(WORD.findall(t))


@pytest.mark.parametrize("seed", range(3))
def test_no_passage_is_lost_whatever_the_number_of_items(seed):
    r = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(3000)]
    for n in (15, 60, 150):
        x = [r.choice(vocabulary) for _ in range(n)]
        index = ItemIndex([7], [" ".join(x)])
        for _ in range(5):
            w = list(x)
            for at in r.sample(range(n), n // 5):
                w[at] = f"new{r.randrange(10**6)}"
            text = " ".join([r.choice(vocabulary) for _ in range(50)] + w + [r.choice(vocabulary) for _ in range(50)])
            assert [m[1:3] for m in index.matches([text])] == [(0, slow(x, text.split(), n // 5))]
            assert index.matches([" ".join(w)]) == [(0, 0, *edit_match(index.items[0], word_hashes([" ".join(w)])[0]))]


def test_edit_match():
    item, region = np.array([1, 2, 3, 4], dtype=np.uint64), np.array([9, 1, 2, 4, 9, 1, 2, 3, 4], dtype=np.uint64)
    assert edit_match(item, region) == (0, 5, 9)
    assert edit_match(item, region[:5]) == (1, 1, 4)


def test_the_query_finds_short_items_whole(spark, tmp_path):
    docs(spark, ["Say: Who wrote Hamlet? Yes.", "who wrote hamnet", "hamlet wrote who", ITEM]).write.parquet(f"{tmp_path}/documents.parquet")
    items(spark, "who wrote Hamlet?", "yes", ITEM, "", "!").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted((r["doc_id"], r["item_id"], r["edit_distance"], r["word_start"], r["word_end"]) for r in op3_decontamination(spark, str(tmp_path)).collect())
    assert got == [(0, 0, 0, 1, 4), (0, 1, 0, 4, 5), (3, 2, 0, 0, 21)]


def test_edges(spark):
    assert leaks(docs(spark, []), items(spark, ITEM)).count() == 0
    assert leaks(docs(spark, [ITEM]), items(spark)).count() == 0
    assert leaks(docs(spark, ["the"]), items(spark, "the", None, "")).count() == 0  # too short to identify anything
    d = spark.createDataFrame([(1, ITEM, "x", 3), (1, ITEM, "x", 3), (None, ITEM, "x", 3)], "doc_id long, text string, item_id string, similarity int")
    b = spark.createDataFrame([(7, ITEM), (7, ITEM), (None, ITEM)], "item_id long, text string")
    assert [(r["doc_id"], r["item_id"]) for r in leaks(d, b).orderBy("doc_id").collect()] == [(None, 7), (1, 7), (1, 7)]
    d = spark.createDataFrame([(2**53 + 1, ITEM), (None, ITEM), (2**53 + 3, "clean"), (5, None)], "doc_id long, text string")
    assert {r["doc_id"] for r in leaks(d, b).collect()} == {2**53 + 1, None}
    assert sorted(map(tuple, without_leaks(d.withColumn("holds_item", d.doc_id), b).collect())) == [(5, None, 5), (2**53 + 3, "clean", 2**53 + 3)]
    assert without_leaks(d, b.limit(0)).count() == 4
    long = " ".join(f"z{i}" for i in range(200_000)) + " " + ITEM
    assert leaks(docs(spark, [long]), items(spark, ITEM)).first()["word_start"] == 200_000


@pytest.mark.skipif(not have_data(), reason="no test tables")
def test_query_against_brute_force(spark, sf):
    """Every pair of document and item whose shared words allow a match, by edit distances of whole texts."""
    texts = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    bench = {r[0]: r[1] for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()}
    plain = lambda t: [m[0].lower() for m in WORD.finditer(t)]
    want = {}
    for i, t in bench.items():
        x = plain(t)
        k, number = int(len(x) * 0.2 + 1e-9), {}
        item = np.array([number.setdefault(w, len(number) + 1) for w in x], dtype=np.uint64)
        for d, text in texts.items():
            region = np.array([number.get(w, 0) for w in plain(text)], dtype=np.uint64)
            if len(set(x) & set(plain(text))) >= (len(set(x)) - k) and len(region):
                distance = edit_match(item, region)[0]
                if distance <= k:
                    want[d, i] = distance
    got = {(r["doc_id"], r["item_id"]): r["edit_distance"] for r in op3_decontamination(spark, sf).collect()}
    assert got == want and len(want) >= 3
