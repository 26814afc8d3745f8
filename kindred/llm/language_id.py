"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1. A trigram's vector binds (multiplies) its letters' vectors after
permuting (rotating) them by their place; a text's vector bundles (adds) those of all its trigrams; a language's
prototype bundles its training texts. A text gets the language whose prototype has the highest cosine with it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm.common import column_name, freeing, stored

DIMENSIONS, SEED = 1024, 20240229
#: Prototypes that workers get at once, and trigrams and languages that a worker sums up before it passes them on.
LANGUAGE_BLOCK, HELD_TRIGRAMS, HELD_LANGUAGES = 2000, 400_000, 500
#: Trigram vectors that a worker keeps (a byte for each sign). Others are bound anew when they occur. Rows widened at once.
KEPT_TRIGRAMS, WIDENED = 16_384, 256


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


class LetterVectors:
    """Vectors by code point, from a seed: any worker makes the same ones."""

    def __init__(self, dimensions: int = DIMENSIONS, seed: int = SEED) -> None:
        self.d, self.seed, self.rows = dimensions, seed, {}
        self.known: dict[int, int] = {}
        self.table = np.empty((KEPT_TRIGRAMS, dimensions), dtype=np.int8)

    def letter(self, point: int) -> np.ndarray:
        if point not in self.rows:
            bits = np.random.Generator(np.random.Philox(key=[self.seed, point])).integers(0, 2, self.d, dtype=np.int8)
            if len(self.rows) > 20_000:
                self.rows.clear()
            self.rows[point] = 2 * bits - 1
        return self.rows[point]

    def trigram(self, code: int) -> np.ndarray:
        a, b, c = code >> 42, (code >> 21) & 0x1FFFFF, code & 0x1FFFFF
        return np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)

    def bundle(self, codes: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The sum of the trigrams' vectors times their weights."""
        places = np.empty(len(codes), dtype=np.int64)
        rest = []
        for i, code in enumerate(codes.tolist()):
            at = self.known.get(code)
            if at is None:
                if len(self.known) < KEPT_TRIGRAMS:
                    at = self.known[code] = len(self.known)
                    self.table[at] = self.trigram(code)
                else:
                    rest.append(i)
                    at = -1
            places[i] = at
        kept = places >= 0
        weight, at = weights[kept].astype(np.float32), places[kept]
        out = np.zeros(self.d)
        for i in range(0, len(at), WIDENED):
            out += weight[i : i + WIDENED] @ self.table[at[i : i + WIDENED]].astype(np.float32)
        for i in rest:
            out += weights[i] * self.trigram(int(codes[i]))
        return out


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigram codes of the whole text and their counts.

    Letters are lower-cased; each run of other characters becomes one space, also before and behind the text.
    """
    words = re.sub(r"[\W\d_]+", " ", f" {text} ".lower())
    points = np.frombuffer(words.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
    if len(points) < 3:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    codes = (points[:-2] << 42) | (points[1:-1] << 21) | points[2:]
    return np.unique(codes, return_counts=True)


def learn(labelled: DataFrame, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, seed: int = SEED) -> DataFrame:
    """Prototypes (lang, v; stored) of all labelled rows; rows with a null text or label, or no letter, teach nothing.

    Each text counts with its trigrams' relative frequencies, so a long one weighs as much as a short one. Workers
    return one vector a language and partition; Spark sums them by (language, coordinate).
    """

    def bundled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, sums, done = LetterVectors(dimensions, seed), {}, {}
        held = 0
        for batch in batches:
            for t, label in zip((x.as_py() for x in batch["text"]), batch["lang"].to_pylist(), strict=True):  # one text at a time
                if not has_letter(t):
                    continue
                codes, counts = trigrams(t)
                if not len(codes):
                    continue
                mine = sums.setdefault(label, {})
                total, before = counts.sum(), len(mine)
                for code, n in zip(codes.tolist(), (counts / total).tolist(), strict=True):
                    mine[code] = mine.get(code, 0.0) + n
                held += len(mine) - before
                if held > HELD_TRIGRAMS:  # binds what it holds before the dictionaries grow without end
                    for key, x in sums.items():
                        done[key] = done.get(key, 0) + vectors.bundle(np.array(list(x), dtype=np.int64), np.array(list(x.values())))
                    sums, held = {}, 0
                    if len(done) > HELD_LANGUAGES:
                        yield _vectors(done)
                        done = {}
        for label, mine in sums.items():
            done[label] = done.get(label, 0) + vectors.bundle(np.array(list(mine), dtype=np.int64), np.array(list(mine.values())))
        for label in list(done):
            yield _vectors({label: done.pop(label)})

    rows = labelled.select(F.col(text).alias("text"), F.col(lang).alias("lang")).filter("text is not null and lang is not null")
    sums = rows.mapInArrow(freeing(bundled), "lang string, v array<double>").select("lang", F.posexplode("v").alias("place", "x")).groupBy("lang", "place").agg(F.sum("x").alias("x"))
    found = sums.groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("place", "x"))).alias("p"))  # `dimensions` entries each
    return stored(found.select("lang", F.col("p.x").alias("v")), "prototypes")


def _vectors(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"lang": pa.array(list(sums), pa.string()), "v": pa.array(list(sums.values()), pa.list_(pa.float64()))})


def predict(docs: DataFrame, prototypes: DataFrame, text: str = "text", dimensions: int = DIMENSIONS, seed: int = SEED, block: int = LANGUAGE_BLOCK) -> DataFrame:
    """Adds lang_pred and score, the cosine (negative ones count as 0).

    prototypes: lang, v. A null text, one without a letter, and any text if nothing was learned get `und` and 0. Equal
    cosines go to the language that sorts first. Columns of the input with these names are replaced. Prototypes are
    sent to workers in blocks of so many languages; each further block is one more pass over the texts' trigrams.
    """
    found: list[Column] = []
    names: list[str] = []
    rows: list[list[float]] = []

    def judged(known: int) -> Column:
        return _nearest(names, np.array(rows), known, dimensions, seed)(F.col(text))

    known = 0
    for r in prototypes.orderBy("lang").toLocalIterator():  # at most `block` of them are held
        names.append(r["lang"])
        rows.append(r["v"])
        if len(names) == block:
            found.append(judged(known))
            known, names, rows = known + block, [], []
    if names:
        found.append(judged(known))
    columns = [column_name(docs, f"nearest_{i}") for i in range(len(found))]
    out = docs.withColumns(dict(zip(columns, found, strict=True))) if found else docs
    best = F.greatest(*columns) if len(columns) > 1 else F.col(columns[0]) if columns else F.lit(None).cast("struct<score:double,place:long,lang_pred:string>")
    chosen = column_name(docs, "nearest")
    out = out.withColumn(chosen, best).drop(*columns)
    score = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(F.col(chosen)["score"], F.lit(0.0))))
    return out.withColumns({"lang_pred": F.coalesce(F.col(chosen)["lang_pred"], F.lit("und")), "score": score}).drop(chosen)


def _nearest(names: list[str], vectors: np.ndarray, known: int, dimensions: int, seed: int):
    """A UDF: (highest cosine, minus its language's place among all, language), null for texts without a letter."""
    matrix = vectors / np.maximum(np.linalg.norm(vectors, axis=1), 1e-300)[:, None]

    kind = pa.struct({"score": pa.float64(), "place": pa.int64(), "lang_pred": pa.string()})

    @F.arrow_udf("score double, place long, lang_pred string")
    @freeing
    def predicted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        letters = LetterVectors(dimensions, seed)
        for texts in batches:
            out = []
            for t in (x.as_py() for x in texts):  # one text at a time
                if t is None or not has_letter(t):
                    out.append({"score": None, "place": None, "lang_pred": None})
                    continue
                v = letters.bundle(*trigrams(t))
                cosines = np.round(matrix @ v / max(np.linalg.norm(v), 1e-300), 6)
                k = int(cosines.argmax())
                out.append({"score": float(cosines[k]), "place": -known - k, "lang_pred": names[k]})
            yield pa.array(out, kind)

    return predicted


def held_out(doc_id: str) -> Column:
    """True where crc32 of the id as text leaves 2 when divided by 4. A null id is held out of training too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame) -> DataFrame:
    """docs with held_out, lang_pred and score; learned from docs' own labels that are not held out."""
    split = docs.withColumn("held_out", held_out("doc_id"))
    return predict(split, learn(split.filter(~F.col("held_out") & F.col("doc_id").isNotNull())))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    return identify(docs).select("doc_id", "held_out", "lang_pred", "score")
