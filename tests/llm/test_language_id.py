import zlib

import numpy as np
import pytest
from helpers import have_data

from kindred.llm import language_id
from kindred.llm.language_id import LetterVectors, identify, learn, predict, trigrams

EN = "the cat sat on the mat and then it went to the house with the other animals of the wood"
DE = "der hund lief durch den wald und dann nach hause zu den anderen tieren die dort waren"


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_trigrams():
    codes, counts = trigrams("Ab a")
    plain = lambda s: (ord(s[0]) << 42) | (ord(s[1]) << 21) | ord(s[2])
    assert dict(zip(codes.tolist(), counts.tolist(), strict=True)) == {plain(" ab"): 1, plain("ab "): 1, plain("b a"): 1, plain(" a "): 1}


def test_binding_permutes_by_place():
    v = LetterVectors(512, 1)
    ab = lambda s: v.trigram((ord(s[0]) << 42) | (ord(s[1]) << 21) | ord(s[2]))
    assert (ab("abc") == np.roll(v.letter(97), 2) * np.roll(v.letter(98), 1) * v.letter(99)).all()
    assert abs(int(ab("abc") @ ab("cba").astype(int))) < 150  # order matters: nearly orthogonal
    again = LetterVectors(512, 1)
    assert (again.letter(0x4E00) == v.letter(0x4E00)).all()


def test_cosines_equal_those_of_whole_vectors(spark):
    rows = [(i, EN if i % 2 else DE, "en" if i % 2 else "de") for i in range(8)]
    prototypes = learn(docs(spark, rows), dimensions=256)
    v = LetterVectors(256, language_id.SEED)
    got = predict(docs(spark, [(1, "the dog went home", None)]), prototypes, dimensions=256).first()
    text = v.bundle(*trigrams("the dog went home"))
    cos = {r["lang"]: float(text @ np.array(r["v"]) / np.linalg.norm(text) / np.linalg.norm(r["v"])) for r in prototypes.collect()}
    assert got["lang_pred"] == max(cos, key=cos.get) == "en" and abs(got["score"] - cos["en"]) < 1e-5


def test_held_out_by_checksum(spark):
    rows = [(i, EN, "en") for i in range(40)]
    got = {r["doc_id"]: r["held_out"] for r in identify(docs(spark, rows)).collect()}
    assert got == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in range(40)}


def test_blocks_of_languages_give_the_same(spark, monkeypatch):
    r = np.random.default_rng(3)
    rows = [(i, " ".join("".join(chr(97 + x) for x in r.integers(0, 26, 5)) for _ in range(12)), f"l{i:02d}") for i in range(30)]
    df = docs(spark, rows)
    monkeypatch.setattr(language_id, "HELD_TRIGRAMS", 50)
    monkeypatch.setattr(language_id, "HELD_LANGUAGES", 3)
    prototypes = learn(df.repartition(2), dimensions=128)
    assert prototypes.count() == 30
    got = [sorted((x["doc_id"], x["lang_pred"], x["score"]) for x in predict(df, prototypes, dimensions=128, block=b).collect()) for b in (2000, 7, 1)]
    assert got[0] == got[1] == got[2] and all(lang == f"l{i:02d}" for i, lang, _ in got[0])


def test_edges(spark):
    assert identify(docs(spark, [])).count() == 0
    rows = [(i, EN, "en") for i in range(9)] + [(20, None, "en"), (21, "", None), (22, "123 $$ _ ½ Ⅷ ²", "en"), (23, "a", None), (None, DE, "zz"), (9, EN, "en"), (9, EN, "en"), (24, (EN + " ") * 3000, None)]
    got = identify(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    by = {r["doc_id"]: r for r in got}
    assert [by[i]["lang_pred"] for i in (20, 21, 22)] == ["und"] * 3 and by[20]["score"] == 0
    assert by[24]["lang_pred"] == "en" and by[None]["lang_pred"] == "en" and all(0 <= r["score"] <= 1 for r in got)
    nothing = identify(docs(spark, [(i, EN, None) for i in range(5)])).collect()
    assert {r["lang_pred"] for r in nothing} == {"und"}
    extra = spark.createDataFrame([(1, EN, "en", "x", 2.0)], "doc_id long, text string, lang string, lang_pred string, score double")
    assert identify(extra).count() == 1


@pytest.mark.skipif(not have_data(), reason="no test tables")
def test_held_out_accuracy(spark):
    d = "/root/testdata/sf0.01"
    truth = {r[0]: r[1] for r in spark.read.parquet(f"{d}/documents.parquet").select("doc_id", "lang").collect()}
    got = [r for r in language_id.op8_language_id(spark, d).collect() if r["held_out"]]
    assert sum(r["lang_pred"] == truth[r["doc_id"]] for r in got) >= 0.97 * len(got)


def test_kept_trigrams_take_a_byte_a_sign():
    """The table of a worker takes 16 MB; sums are exact whatever is kept of them."""
    letters, text = LetterVectors(), "the house in the garden behind the house " * 3
    assert letters.table.nbytes == 16_384 * 1024
    codes, counts = trigrams(text)
    assert np.array_equal(letters.bundle(codes, counts), sum(n * letters.trigram(int(c)).astype(float) for c, n in zip(codes, counts, strict=True)))
