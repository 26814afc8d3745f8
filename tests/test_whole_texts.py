"""Queries over entities read every character of a document."""

import random

import duckdb
import pytest
from helpers import same

from kindred.functions.text import common_prefix, common_suffix, edit_distance, grams
from kindred.plans.registry import ORACLE_SQL, QUERIES
from kindred.sources.tables import document_entities

LONG = "A name of more than sixty characters that goes on until its first full stop comes. "
ROWS = [
    (0, LONG + "x " * 100 + "lastword 77\n\nsecond line. of it", "en"), (1, LONG + "x " * 100 + "lastword 77", "en"), (2, LONG + "y " * 100 + "otherword 88", "en"),
    (3, "\nno name\nno name", "en"), (4, "", "en"), (5, None, "en"), (6, "no name", "fr"),
]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("whole"))
    rows = [(i, t, lang, None if t is None else len(t)) for i, t, lang in ROWS]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").write.parquet(f"{path}/documents.parquet")
    return path


def test_every_line_is_a_record_once_a_source(spark, folder):
    got = [r.asDict() for r in document_entities(spark, folder).collect()]
    want = {}
    for i, t, _ in ROWS:
        for place, line in enumerate((t or "").split("\n")):
            if line.strip():
                want.setdefault((f"S{i % 3 + 1}", line), i * 2**20 + place)
    assert {(r["source"], r["business_name"] + r["business_address"].partition(" ")[2]): r["seq"] for r in got} == want and len(got) == len(want)
    assert all(r["entity_id"] == f"{r['source']}-{r['seq']}" for r in got)


def test_words_at_the_end_reach_the_queries(spark, folder):
    words = {r["entity_id"]: r["value"] for r in QUERIES["norm_address"](spark, folder).collect()}
    assert words["S1-0"].endswith("lastword 77") and words[f"S3-{2 * 2**20}"].endswith("otherword 88")
    alike = {r["target_entity_id"]: r["addr_token_jaccard"] for r in QUERIES["feat_all_labelled"](spark, folder).collect() if r["source1_entity_id"] == "S1-0"}
    assert alike[f"S2-{2**20}"] == 1.0 and alike[f"S3-{2 * 2**20}"] < 0.5


def test_planted_faults_are_found(spark, folder):
    got = {(r["rule"], r["detail"]) for r in QUERIES["validate_violations"](spark, folder).collect()}
    assert {("candidates_unknown_target", "S2-unknown"), ("matches_unknown_target", "S2-unknown")} <= got


def test_grams_and_common_parts_of_any_characters(spark):
    rows = [("", "a"), ("ab", "abc"), ("🙂a🙂b", "🙂a🙂c"), ("abcabc", "xbcabc"), ("x" * 20_000, "x" * 19_999 + "y"), ("é", "é")]
    df = spark.createDataFrame(rows, "a string, b string")
    for n in (2, 3, 4):
        for (a, _), r in zip(rows, df.select(grams(df.a, n).alias("g")).collect(), strict=True):
            assert set(r["g"]) == ({a[i : i + n] for i in range(len(a) - n + 1)} if len(a) >= n else {a} - {""}) and len(r["g"]) == len(set(r["g"]))
    same = lambda a, b: next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    got = df.select(common_prefix(df.a, df.b), common_suffix(df.a, df.b)).collect()
    assert [tuple(r) for r in got] == [(same(a, b), same(a[::-1], b[::-1])) for a, b in rows]


def test_edit_distance_is_that_of_the_whole_matrix():
    def plain(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            before, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
        return row[-1]

    draw = random.Random(7)
    texts = ["", "a", "é🙂", "aaaa", "kitten", "sitting"] + ["".join(draw.choice("abé🙂"[: draw.randint(1, 4)]) for _ in range(draw.randint(1, 150))) for _ in range(60)]
    assert all(edit_distance(a, b) == plain(a, b) for a in texts for b in draw.sample(texts, 12))


def test_edit_similarity_reads_whole_names(spark, tmp_path):
    """before, names that differ behind their 80th character alone were told to be 1 alike."""
    head = "one two three four five six seven eight nine ten " * 2
    tails = ["x" * 40 + " same end", "y" * 40 + " same end", "z " * 300 + "end", "w " * 300 + "end", "w " * 310 + "é end", "v " * 5000]
    rows = [(i, f"{head}{t}. it", "en", len(head) + len(t) + 4) for i, t in enumerate(tails)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["edit_similarity"](spark, str(tmp_path))
    found = {(r["s1_id"], r["target_id"]): r["value"] for r in got.collect()}
    size = len(head) + len(tails[0])
    assert found["S1-0", f"S2-{2**20}"] == round(1 - 40 / size, 9) and 0 < min(found.values()) <= max(found.values()) < 1
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    same(got, con, ORACLE_SQL["edit_similarity"])
