"""The pipeline against its stages worked out by hand, and plain rules for what stays."""

import hashlib
from collections import defaultdict

import corpus_pipeline
import pytest
from helpers import have_data
from test_ngram_join import shingles

PROSE = "the old house stood near the river and all of its windows looked out over the green fields towards the far hills where sheep were grazing"
ITEM = "a benchmark passage that nobody should ever train on because it holds the answers to the questions of a public test set"


@pytest.fixture
def folder(spark, tmp_path):
    def lines(seed, n=60):
        w = PROSE.split()
        return " ".join(w[(i * 7 + seed * (i + 3) * 5) % len(w)] for i in range(n))

    secret = hashlib.sha1(b"z").hexdigest()
    texts = [lines(i) for i in range(12)]
    texts += [texts[0], texts[1] + " indeed", "12345 67890 ### !!!", "", None, f"{lines(31)} {ITEM.upper()} {lines(32)}", f'{lines(33)} token = "{secret}" {lines(34)}']
    rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stage_by_stage(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    kept = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, folder)
        docs.write.parquet(f"{folder}/stage{k}")
        docs = spark.read.parquet(f"{folder}/stage{k}")
        if k < 4:
            assert docs.columns == columns
            kept.append({r["doc_id"]: r["text"] for r in docs.collect()})
    assert set(kept[0]) == set(range(14)) | {17, 18}
    assert set(kept[1]) == set(range(12)) | {17, 18}
    assert set(kept[2]) == set(range(12)) | {18}
    assert set(kept[3]) == set(kept[2]) and "[SECRET]" in kept[3][18] and hashlib.sha1(b"z").hexdigest() not in kept[3][18]
    assert {r["doc_id"] for r in docs.collect()} == set(kept[3])
    whole = corpus_pipeline.run(spark, folder)
    assert sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in whole.collect()) == sorted((r["doc_id"], r["piece"], r["ids_crc32"]) for r in docs.collect())


def test_repeated_rows_nulls_and_more_columns(spark):
    rows = [(1, PROSE, "en", "s", 9, 5.0, "a"), (1, PROSE, "en", "s", 9, 5.0, "a"), (None, PROSE + " x", "en", "s", 9, 5.0, "b"), (2, None, None, None, None, None, None), (3, "", "en", "s", 0, 1.0, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score double, lang_pred string")
    out = corpus_pipeline.near_duplicates(spark, docs, "")
    assert out.columns == docs.columns and sorted(r["doc_id"] or 0 for r in out.collect()) == [0, 1, 2, 3]
    out = corpus_pipeline.language(spark, docs, "").collect()
    assert sorted((r["doc_id"] or 0, r["score"], r["lang_pred"]) for r in out) == [(0, 5.0, "b"), (1, 5.0, "a"), (1, 5.0, "a")]


def test_rows_with_null_or_repeated_ids_are_treated_by_themselves(spark, folder):
    secret = hashlib.sha1(b"y").hexdigest()
    other = " ".join(f"word{i}" for i in range(60))
    leak, key, clean = f"{PROSE} {ITEM}", f'{PROSE} token = "{secret}" {PROSE}', f"{other} and the rest of it"
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    row = lambda i, t: (i, t, "en", "s", len(t))
    docs = spark.createDataFrame([row(None, leak), row(None, clean), row(7, leak), row(7, clean)], schema)
    assert sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.decontaminated(spark, docs, folder).collect()), key=str) == [(7, clean), (None, clean)]
    docs = spark.createDataFrame([row(None, key), row(7, key), row(7, clean)], schema)
    out = corpus_pipeline.without_secrets(spark, docs, folder)
    cut = key.replace(secret, "[SECRET]")
    assert out.columns == docs.columns and sorted(((r["doc_id"], r["text"]) for r in out.collect()), key=str) == [(7, cut), (7, clean), (None, cut)]
    docs = spark.createDataFrame([row(1, PROSE), row(7, PROSE), row(7, clean), row(None, PROSE)], schema)
    out = corpus_pipeline.near_duplicates(spark, docs, folder).collect()
    assert sorted(((r["doc_id"], r["text"]) for r in out), key=str) == [(1, PROSE), (7, clean), (None, PROSE)]


def test_empty_table(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.read.parquet(f"{folder}/benchmark.parquet").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0


@pytest.mark.skipif(not have_data(), reason="no test tables")
def test_clean_documents_stay(spark, sf):
    """Every document with words that is in no component and holds no benchmark passage survives to the end."""
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    items = [r["text"] for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    sets = {d: shingles(t) for d, t in docs.items()}
    near = defaultdict(set)
    for d, s in sets.items():
        for x in s:
            near[x].add(d)
    lone = [d for d, s in sets.items() if len(s) > 20 and all(5 * len(s & sets[e]) < 4 * len(s | sets[e]) for x in s for e in near[x] if e != d)]
    clean = {d for d in lone if not any(i.lower()[:40] in docs[d].lower() for i in items)}
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, sf).collect()}
    assert len(clean) > 100 and clean <= got
