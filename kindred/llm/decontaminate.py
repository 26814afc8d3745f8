"""Benchmark decontamination: CGK embedding, bit sampling, exact edit distances. The alphabet is words.

A window of a document may hold an item if their edit distance over words is at most a fifth of the item's words.
If so, one of the item's `edits + 1` equal segments stands unchanged in the window, so windows are set only around
segments that occur (nothing is lost), each of its item's size and at every shift up to the edits. A window is embedded
by CGK random walks (a shared random bit for each step and word says whether the walk moves on), which turn a small edit
distance into a small Hamming distance with the item's embedding. Each repetition samples a few coordinates into a key;
windows with a key of an item in any repetition are its candidates. Candidates are verified by the exact edit distance.

The number of repetitions follows for each size of items from TRIALS random edits as far as allowed: the lower confidence
bound of one repetition's chance to agree gives the repetitions that reach the target recall. Segments whose own window
no key finds are verified exactly at the end, so that no match depends on chance.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm.common import column_name, freeing, local_table
from kindred.llm.wordhash import CHUNK, grams, mixed, words

SIMILARITY, TARGET_RECALL, SAMPLED, LEAST_WORDS = 0.8, 0.99, 2, 5
#: Up to so many words SAMPLED coordinates make a key; the walks of longer items part too often for more than one.
FEW_WORDS = 64
#: Random edits that are tried for each size, repetitions at most, and the z value of the confidence bound (99 %).
TRIALS, MOST_REPEATS, Z = 1000, 96, 2.33
MOST_WORDS = 4096
#: Items whose index is sent to workers at once, and their characters; more items take more passes over the documents.
ITEM_BLOCK, ITEM_CHARS = 20_000, 8 << 20
#: Words of regions that are verified at once, and walks that are on their way at once.
CELLS, WALKS = 500_000, 1 << 18
#: Scripts without spaces between words: each letter is a word.
_ALONE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003134f"
WORD = re.compile(f"(?=[{_ALONE}])[^\\W_]|[^\\W_{_ALONE}]+")
_NOT_WORD = re.compile(r"[\W_]+")
_LETTER_ALONE = re.compile(f"([{_ALONE}])")
_ODD = np.uint64(0x9E3779B97F4A7C15)
_ASCII_SEPARATOR = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
RESULT = "doc_id long, item_id long, edit_distance int, similarity double, word_start long, word_end long, char_start long, char_end long"


def _plain(text: str) -> bytes:
    """The same words as WORD finds, lower-cased, with ASCII between them."""
    if text.isascii():
        return text.encode()
    text = _LETTER_ALONE.sub(r" \1 ", _NOT_WORD.sub(" ", text))
    return text.lower().encode("utf-8", "replace")  # lower-casing comes last: it may add marks, which belong to the word


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of the first word of each text and the number of all): lower-cased runs of letters
    and digits."""
    raw = list(map(_plain, texts))
    ends = np.cumsum([0, *map(len, raw)])
    return words(np.frombuffer(b"".join(raw), dtype=np.uint8), ends, _ASCII_SEPARATOR)


def edits_allowed(n: int, similarity: float = SIMILARITY) -> int:
    return int(n * (1 - similarity) + 1e-9)


def embed(windows: np.ndarray, lengths: np.ndarray, seeds: np.ndarray, places: np.ndarray) -> np.ndarray:
    """(window, repetition, sample): CGK embeddings of windows at the sampled steps.

    windows hold words, then zeros; seeds: (repetition, step); places: the steps (repetition, sample) that are sampled.
    Only the samples are kept, so memory doesn't depend on the number of steps.
    """
    n, steps = len(windows), int(places.max(initial=-1)) + 1
    out = np.zeros((n, *places.shape), dtype=np.uint64)
    flat, begin = windows.ravel(), (np.arange(n) * windows.shape[1])[:, None]
    at = np.repeat(begin, len(seeds), axis=1)
    last, turns = begin + lengths[:, None], np.ascontiguousarray(seeds.T)
    due: dict[int, list[tuple[int, int]]] = {}
    for r, picked in enumerate(places.tolist()):
        for s, step in enumerate(picked):
            due.setdefault(step, []).append((r, s))
    for j in range(steps):
        x = flat.take(at)
        for r, s in due.get(j, ()):
            out[:, r, s] = x[:, r]
        at += (((x ^ turns[j]) * _ODD) >> np.uint64(63)).view(np.int64)
        np.minimum(at, last, out=at)
    return out


def repeats_for(agree: int, trials: int, target: float) -> int:
    """Repetitions that reach the target by the lower (Wilson) bound of one's chance."""
    p, z2 = agree / trials, Z * Z
    low = (p + z2 / (2 * trials) - Z * math.sqrt(p * (1 - p) / trials + z2 / (4 * trials * trials))) / (1 + z2 / trials)
    return MOST_REPEATS if low <= 0 else 1 if low >= target else min(MOST_REPEATS, math.ceil(math.log(1 - target) / math.log(1 - low)))


def edit_match(item: np.ndarray, region: np.ndarray) -> tuple[int, int, int]:
    """(distance, start, end) of the part of region that is nearest to item; the earliest end of the nearest ones."""
    d, end = _nearest_end(item, region)
    if end == 0:
        return d, 0, 0
    _, back = _nearest_end(item[::-1], region[:end][::-1], anchored=d)
    return d, end - back, end


def _nearest_end(item: np.ndarray, region: np.ndarray, anchored: int | None = None) -> tuple[int, int]:
    place = np.arange(len(region) + 1)
    row = place.copy() if anchored is not None else np.zeros(len(region) + 1, dtype=np.int64)
    for i, w in enumerate(item.tolist(), start=1):
        new = np.empty_like(row)
        new[0] = i
        new[1:] = np.minimum(row[:-1] + (region != w), row[1:] + 1)
        row = np.minimum.accumulate(new - place) + place
    if anchored is not None:
        return anchored, int(np.flatnonzero(row == anchored)[0])
    return int(row.min()), int(row.argmin())


def _distances(items: np.ndarray, regions: np.ndarray, outside: np.ndarray) -> np.ndarray:
    """Edit distance of each item to the nearest part of its region; places outside match nothing."""
    place = np.arange(regions.shape[1] + 1, dtype=np.int32)
    row = np.zeros((len(items), len(place)), dtype=np.int32)
    for i in range(items.shape[1]):
        new = np.empty_like(row)
        new[:, 0] = i + 1
        new[:, 1:] = np.minimum(row[:, :-1] + ((regions != items[:, i : i + 1]) | outside), row[:, 1:] + 1)
        row = np.minimum.accumulate(new - place, axis=1) + place
    return row.min(1)


def _walks(rng: np.random.Generator, repeats: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(seeds, sampled steps): a walk over a text takes about two steps a word."""
    sampled = SAMPLED if size <= FEW_WORDS else 1
    return rng.integers(0, 2**64, (repeats, 2 * size), dtype=np.uint64), (rng.random((repeats, sampled)) * 2 * size).astype(np.int64)


class ItemIndex:
    """Segments and LSH keys of a block of items."""

    def __init__(self, ids: list[int], texts: list[str], similarity: float = SIMILARITY, target: float = TARGET_RECALL, least_words: int = LEAST_WORDS) -> None:
        hashes, first = word_hashes(texts)
        self.ids, self.items, self.edits = [], [], []
        for i, (a, b) in zip(ids, zip(first.tolist(), first[1:].tolist(), strict=False), strict=True):
            if b - a >= max(1, least_words):
                self.ids.append(i)
                self.items.append(hashes[a:b])
                self.edits.append(edits_allowed(b - a, similarity))
        segments: dict[int, list[tuple[int, int, int]]] = {}
        for i, (item, k) in enumerate(zip(self.items, self.edits, strict=True)):
            bounds = [len(item) * j // (k + 1) for j in range(k + 2)]
            for a, b in zip(bounds, bounds[1:], strict=False):
                segments.setdefault(b - a, []).append((int(grams(item[a:b], b - a)[0]), i, a))
        self.segments = {n: tuple(np.array(c, dtype=t) for c, t in zip(zip(*sorted(x), strict=True), (np.uint64, np.int64, np.int64), strict=True)) for n, x in segments.items()}
        self.similarity, self.target, self.sizes = similarity, target, np.array([len(x) for x in self.items], dtype=np.int64)
        self.width = max(map(len, self.items), default=1)
        self.repeats: dict[int, int] = {}  # by class of sizes
        keys, owners = [np.empty(0, dtype=np.uint64)], [np.empty(0, dtype=np.int64)]
        for n in np.unique(self.sizes).tolist():
            same = np.flatnonzero(self.sizes == n)
            for some in np.array_split(same, -(-len(same) // 1024)):
                found = self.keys(np.array([self.items[i] for i in some.tolist()]), np.full(len(some), n), n)
                keys.append(found.ravel())
                owners.append(np.repeat(some, found.shape[1]))
        flat, owner = np.concatenate(keys), np.concatenate(owners)
        flat, owner = flat[flat != 0], owner[flat != 0]
        order = np.lexsort((owner, flat))
        self.key_table, self.key_owner = flat[order], owner[order]

    def walks(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(seeds, sampled steps) for items of this size."""
        rng = np.random.Generator(np.random.Philox(key=[17, size]))
        repeats = self.repeats_of(size)
        return _walks(rng, repeats, size)

    def keys(self, windows: np.ndarray, lengths: np.ndarray, size: int, walks: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        """(window, repetition): a key of the sampled coordinates of windows for items of this size.

        0 where all of them lie behind the end of the walk, which any two windows have in common.
        """
        seeds, places = walks or self.walks(size)
        padded = np.concatenate([windows, np.zeros((len(windows), 1), dtype=np.uint64)], axis=1)
        out = []
        for a in range(0, len(windows), step := max(1, WALKS // len(seeds))):
            picked = embed(padded[a : a + step], lengths[a : a + step], seeds, places)
            key = (np.arange(len(seeds), dtype=np.uint64) * np.uint64(1 << 32) + np.uint64(size))[None, :].repeat(len(picked), 0)
            for j in range(picked.shape[2]):
                key = mixed(key * _ODD + picked[:, :, j])
            out.append(np.where(picked.any(2), key, np.uint64(0)))
        return np.concatenate(out) if out else np.empty((0, len(seeds)), dtype=np.uint64)

    def repeats_of(self, size: int) -> int:
        """Repetitions for a size, those of the largest size in its class (a quarter of an octave), which is the hardest.

        The chance hardly falls from 1000 words on, so larger ones than MOST_WORDS are tried at that size.
        """
        top = min(MOST_WORDS, math.ceil(2 ** (math.ceil(4 * math.log2(size)) / 4)))
        if top not in self.repeats:
            self.repeats[top] = repeats_for(*self.agreement(top), self.target)
        return self.repeats[top]

    def agreement(self, size: int, trials: int = TRIALS) -> tuple[int, int]:
        """(trials in which one repetition's key of a text edited as far as allowed is the text's own, trials)."""
        rng = np.random.Generator(np.random.Philox(key=[23, size]))
        k = edits_allowed(size, self.similarity)
        agree = 0
        for _ in range(20):  # each share has walks of its own
            n = trials // 20
            texts = rng.integers(1, 2**63, (n, size), dtype=np.uint64)
            edited = np.zeros((n, size), dtype=np.uint64)
            lengths = np.zeros(n, dtype=np.int64)
            for i in range(n):
                row = texts[i].tolist()
                for at, kind, new in zip(rng.integers(0, size, k).tolist(), rng.integers(0, 3, k).tolist(), rng.integers(1, 2**63, k).tolist(), strict=True):
                    at = min(at, len(row) - 1)
                    if kind == 0:
                        row[at] = new
                    elif kind == 1:
                        row.insert(at, new)
                    elif len(row) > 1:
                        del row[at]
                row = row[:size]
                edited[i, : len(row)] = row
                lengths[i] = len(row)
            walks = _walks(rng, 1, size)
            own = self.keys(texts, np.full(n, size), size, walks)
            agree += int(((own == self.keys(edited, lengths, size, walks)) & (own != 0)).sum())
        return agree, trials // 20 * 20

    def hits(self, hashes: np.ndarray, first: np.ndarray) -> pd.DataFrame:
        """(text, item, start) of the places where items would begin by their segments; start may lie before the text."""
        found = []
        for n, (keys, items, offsets) in self.segments.items():
            g = grams(hashes, n)
            lo = np.searchsorted(keys, g)
            hit = np.flatnonzero(keys[np.minimum(lo, len(keys) - 1)] == g)
            if not len(hit):
                continue
            lo = lo[hit]
            hi = np.searchsorted(keys, g[hit], side="right")
            pos = np.repeat(hit, hi - lo)
            which = np.concatenate([np.arange(a, b) for a, b in zip(lo.tolist(), hi.tolist(), strict=True)])
            text = np.searchsorted(first, pos, side="right") - 1
            inside = pos + n <= first[text + 1]
            pos, which, text = pos[inside], which[inside], text[inside]
            found.append(pd.DataFrame({"text": text, "item": items[which], "start": pos - offsets[which]}))
        if not found:
            return pd.DataFrame({"text": [], "item": [], "start": []}, dtype="int64")
        return pd.concat(found).drop_duplicates(ignore_index=True)

    def windows(self, hits: pd.DataFrame, first: np.ndarray) -> pd.DataFrame:
        """(text, start, size) of all windows around hits."""
        text, item, start = (hits[c].to_numpy() for c in ("text", "item", "start"))
        k, size = np.array(self.edits, dtype=np.int64)[item], self.sizes[item]
        shifts = np.repeat(np.arange(len(text)), 2 * k + 1)
        shift = np.concatenate([np.arange(-x, x + 1) for x in k.tolist()]) if len(k) else np.empty(0, dtype=np.int64)
        start = np.maximum(first[text][shifts], start[shifts] + shift)
        out = pd.DataFrame({"text": text[shifts], "start": start, "size": size[shifts]}).drop_duplicates(ignore_index=True)
        return out[out["start"] < first[out["text"] + 1]].reset_index(drop=True)

    def verified(self, hits: pd.DataFrame, hashes: np.ndarray, first: np.ndarray) -> pd.DataFrame:
        """The hits that have a match around them, by exact edit distances of many hits at once."""
        sizes, kept = self.sizes[hits["item"].to_numpy()], []
        for n in np.unique(sizes).tolist():
            k = edits_allowed(n, self.similarity)
            same, rows = np.flatnonzero(sizes == n), max(1, CELLS // (n + 2 * k))
            for at in range(0, len(same), rows):
                row = same[at : at + rows]
                text, item, start = (hits[c].to_numpy()[row] for c in ("text", "item", "start"))
                place = start[:, None] - k + np.arange(n + 2 * k)
                outside = (place < first[text][:, None]) | (place >= first[text + 1][:, None])
                region = hashes[np.clip(place, 0, len(hashes) - 1)]
                which = np.array([self.items[i] for i in item.tolist()])
                missed = np.zeros(len(row), dtype=np.int64)
                alive = np.arange(len(row))
                for j in range(n):  # a match lacks at most k of the item's words
                    missed[alive] += ~((region[alive] == which[alive, j : j + 1]) & ~outside[alive]).any(1)
                    alive = alive[missed[alive] <= k]
                kept.append(row[alive[_distances(which[alive], region[alive], outside[alive]) <= k]])
        return hits.iloc[np.sort(np.concatenate(kept))] if kept else hits

    def matches(self, texts: list[str], rest: bool = True) -> list[tuple]:
        """(text index, item index, distance, start word, end word) of the nearest match of each item in each text.

        rest: whether segments whose windows no key finds are verified too.
        """
        hashes, first = word_hashes(texts)
        hits = self.hits(hashes, first)
        w = self.windows(hits, first)
        candidates: dict[tuple[int, int], list[int]] = {}
        for n in np.unique(w["size"].to_numpy()).tolist():
            text, start = (w[c].to_numpy()[w["size"].to_numpy() == n] for c in ("text", "start"))
            for at in range(0, len(text), step := max(1, CELLS // n)):
                t, s = text[at : at + step], start[at : at + step]
                lengths = np.minimum(s + n, first[t + 1]) - s
                place = s[:, None] + np.arange(n)
                inside = np.arange(n) < lengths[:, None]
                keys = self.keys(np.where(inside, hashes[np.minimum(place, len(hashes) - 1)], np.uint64(0)), lengths, n)
                lo, hi = np.searchsorted(self.key_table, keys), np.searchsorted(self.key_table, keys, side="right")
                for i, r in zip(*np.nonzero(hi > lo), strict=True):
                    for item in self.key_owner[lo[i, r] : hi[i, r]].tolist():
                        candidates.setdefault((int(t[i]), item), []).append(int(s[i]))
        seen = {(*key, start) for key, starts in candidates.items() for start in starts}
        left = np.array([x not in seen for x in zip(*(hits[c].tolist() for c in ("text", "item", "start")), strict=True)], dtype=bool)
        if rest:
            for t, i, start in self.verified(hits[left].reset_index(drop=True), hashes, first).itertuples(index=False):
                candidates.setdefault((t, i), []).append(start)
        out = []
        for (t, i), starts in candidates.items():
            item, k, best = self.items[i], self.edits[i], None
            starts = sorted(set(starts))
            at = 0
            while at < len(starts):  # neighbouring windows share one region
                to = at
                while to + 1 < len(starts) and starts[to + 1] - starts[to] <= len(item):
                    to += 1
                a, b = max(int(first[t]), starts[at] - k), min(int(first[t + 1]), starts[to] + len(item) + 2 * k)
                d, x, y = edit_match(item, hashes[a:b])
                if d <= k and (best is None or d < best[0]):
                    best = d, a + x - int(first[t]), a + y - int(first[t])
                at = to + 1
            if best:
                out.append((t, i, *best))
        return sorted(out)


def _groups(texts: list[str]) -> Iterator[tuple[int, int]]:
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= CHUNK):
            size += len(texts[end])
            end += 1
        yield at, end
        at = end


def _indexes(items: DataFrame, similarity: float, target: float, least_words: int) -> Iterator[ItemIndex]:
    """Indexes of blocks of distinct items, each of a bounded number of items and characters."""
    rows = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").alias("text")).filter("item_id is not null and text is not null").distinct()
    block: list = []
    size = 0

    def index() -> ItemIndex:
        block.sort(key=lambda r: (r["item_id"], r["text"]))
        return ItemIndex([r["item_id"] for r in block], [r["text"] for r in block], similarity, target, least_words)

    for row in rows.toLocalIterator():
        if block and (len(block) == ITEM_BLOCK or size + len(row["text"]) > ITEM_CHARS):
            yield index()
            block, size = [], 0
        block.append(row)
        size += len(row["text"])
    if block:
        yield index()


def leaks(docs: DataFrame, items: DataFrame, similarity: float = SIMILARITY, target: float = TARGET_RECALL, least_words: int = LEAST_WORDS) -> DataFrame:
    """A row for each document and item whose nearest passage has a similarity (1 - edits / item's words) of 0.8 or more.

    word_start, word_end and char_start, char_end say where the passage stands in the whole text. Null texts hold
    nothing; a null doc_id stays null in the result, and items without an id are left out. Items of fewer words than
    least_words are left out, and shorter ones than five words match only whole and unedited. Repeated document rows give
    repeated results; repeated items count once. Other columns are ignored. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    kinds = {"long": pa.int64(), "int": pa.int32(), "double": pa.float64()}
    schema = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in RESULT.split(", "))])
    asked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).filter("text is not null")

    def searched(block: ItemIndex) -> DataFrame:
        index = spark.sparkContext.broadcast(block)

        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            x: ItemIndex = index.value
            for batch in batches:
                ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                found = []
                for a, b in _groups(texts):
                    for t, i, d, start, end in x.matches(texts[a:b]):
                        spans = [m.span() for m in WORD.finditer(texts[a + t])]
                        chars = (spans[min(start, len(spans) - 1)][0], spans[min(end, len(spans)) - 1][1])
                        found.append((ids[a + t], x.ids[i], d, round(1 - d / len(x.items[i]), 9), start, end, *chars))
                columns = zip(*found, strict=True) if found else [()] * len(schema)
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        return asked.mapInArrow(freeing(find), RESULT)

    out: DataFrame | None = None
    for block in _indexes(items, similarity, target, least_words):
        found = searched(block)
        out = found if out is None else out.union(found)
    return out if out is not None else local_table(spark, [], RESULT)


def without_leaks(docs: DataFrame, items: DataFrame, text: str = "text", similarity: float = SIMILARITY, target: float = TARGET_RECALL, least_words: int = LEAST_WORDS) -> DataFrame:
    """The rows of docs that hold no item, by the same search, in one pass for each block of items.

    A row is judged by its own text, whatever its id is. Rows with a null text stay.
    """
    spark, hit = docs.sparkSession, column_name(docs, "holds_item")
    for block in _indexes(items, similarity, target, least_words):
        docs = docs.withColumn(hit, _holds(spark.sparkContext.broadcast(block))(F.col(text))).filter(~F.col(hit)).drop(hit)
    return docs


def _holds(index: Broadcast):
    """A UDF that says whether a text holds an item of the index."""

    @F.arrow_udf("boolean")
    @freeing
    def holds(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            found = np.zeros(len(batch), dtype=bool)
            at, group, size = 0, [], 0
            for i, text in enumerate(x.as_py() or "" for x in batch):  # no more texts than a group's are held
                if group and size + len(text) > CHUNK:
                    found[[at + m[0] for m in index.value.matches(group)]] = True
                    at, group, size = i, [], 0
                group.append(text)
                size += len(text)
            if group:
                found[[at + m[0] for m in index.value.matches(group)]] = True
            yield pa.array(found)

    return holds


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), least_words=1)
