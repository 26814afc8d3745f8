"""Best-fit packing by linear grouping.

Only the histogram of piece lengths (at most `capacity` rows) reaches the driver. There

1. large pieces (over capacity / 8) are sorted, cut into groups of equal cardinality and rounded up to their group's
   largest length;
2. configurations (which groups fill one sequence) are optimised for these few sizes: column generation with a
   knapsack for each new configuration, whole parts of the solution kept;
3. actual lengths replace the rounded ones, run by run, which leaves gaps;
4. large pieces that are left over and then small ones go, longest first, each into the tightest gap that holds it.

Everything works on runs of equal sequences, so the plan has a few thousand rows at any number of documents. Pieces
get a gapless number among those of their length, and the plan turns (length, number) into (sequence, offset).
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm.common import buckets_for, column_name, freeing, numbered, stored
from kindred.llm.tokenize import END, VOCABULARY, Encoder

CAPACITY, GROUPS, SMALL_SHARE = 1024, 128, 8
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n ids: only the first may be shorter than the capacity."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece of each document's ids and the end id. A null text is like an empty one."""
    schema = pa.schema([(name, pa.int32() if kind == "int" else pa.int64()) for name, kind in map(str.split, PIECES.split(", "))])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(vocabulary)
        for batch in batches:  # Arrow keeps ids exact beside nulls
            known: dict[str, list] = {}
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = text or ""
                if text not in known:
                    ids = np.append(encoder.encode(text), END).astype("<u4")
                    known[text] = [(k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(cuts(len(ids), capacity))]
                rows += [(doc_id, *x) for x in known[text]]
            columns = zip(*rows, strict=True) if rows else [()] * len(schema)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")).mapInArrow(freeing(cut), PIECES)


@dataclass
class Run:
    """`count` equal sequences. slots: (length, first number, copies): sequence i holds, one after the other, the
    pieces of that length numbered first + i * copies onwards."""

    count: int
    used: int = 0
    slots: list[tuple[int, int, int]] = field(default_factory=list)

    def part(self, start: int, count: int) -> Run:
        return Run(count, self.used, [(n, first + start * copies, copies) for n, first, copies in self.slots])


def configurations(sizes: list[int], demands: list[int], capacity: int) -> list[tuple[np.ndarray, float]]:
    """Optimal fractional mix of configurations for the sizes: (count of each size, times used)."""
    k = len(sizes)
    s, d = np.array(sizes), np.array(demands, dtype=float)
    basis = np.diag([capacity // n for n in sizes]).astype(float)
    inverse = np.diag([1 / (capacity // n) for n in sizes])
    times = lambda v: (inverse * v).sum(1)  # noqa: E731  no BLAS here: its threads can block one another on a driver that has forked
    rest = np.arange(capacity + 1)[:, None] - s[None, :]
    rest[rest < 0] = capacity + 1  # the place of minus infinity
    most = capacity // int(s.min())
    for _ in range(40 * k + 200):
        # The most valuable configuration at these duals: values of at most 0, 1, … items in each room.
        worth, value, choices = np.maximum(inverse.sum(0), 0), np.zeros(capacity + 2), []
        value[-1] = -np.inf
        for _ in range(most):
            found = value[rest] + worth
            j = found.argmax(1)
            best = found[np.arange(capacity + 1), j]
            better = best > value[:-1] + 1e-12
            if not better.any():
                break
            choices.append(np.where(better, j, -1))
            value[:-1] = np.where(better, best, value[:-1])
        if value[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(k), capacity
        for chosen in reversed(choices):
            if chosen[c] >= 0:
                column[chosen[c]] += 1
                c -= int(s[chosen[c]])
        step, amounts = times(column), times(d)
        ratio = np.where(step > 1e-9, np.maximum(amounts, 0) / np.where(step > 1e-9, step, 1), np.inf)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        basis[:, out] = column
        row = inverse[out] / step[out]
        inverse = inverse - step[:, None] * row[None, :]
        inverse[out] = row
    amounts = times(d)
    return [(basis[:, j], float(amounts[j])) for j in range(k) if amounts[j] > 0]


class _Stock:
    """Numbered pieces of one group, longest first, handed out in runs of one length."""

    def __init__(self, runs: list[tuple[int, int, int]]) -> None:
        self.runs = list(runs)[::-1]

    @property
    def left(self) -> int:
        return sum(n for _, _, n in self.runs)

    def take(self, n: int) -> list[tuple[int, int, int]]:
        out = []
        while n:
            length, first, m = self.runs.pop()
            out.append((length, first, min(m, n)))
            if m > n:
                self.runs.append((length, first + n, m - n))
            n -= min(m, n)
        return out


class _Gaps:
    """Runs by what is free in their sequences."""

    def __init__(self, capacity: int) -> None:
        self.capacity, self.by, self.full = capacity, {}, []
        self.free: list[int] = []

    def add(self, run: Run) -> None:
        room = self.capacity - run.used
        if not run.count:
            return
        if not room:
            self.full.append(run)
        elif room in self.by:
            self.by[room].append(run)
        else:
            self.by[room] = [run]
            bisect.insort(self.free, room)

    def best_fit(self, length: int, first: int, n: int) -> None:
        """Puts n pieces of this length, each into the tightest gap; opens sequences when none holds one."""
        while n:
            at = bisect.bisect_left(self.free, length)
            if at == len(self.free):
                each = self.capacity // length
                self.add(Run(n // each, each * length, [(length, first, each)]))
                if rest := n % each:
                    self.add(Run(1, rest * length, [(length, first + n - rest, rest)]))
                return
            room = self.free[at]
            run = self.by[room].pop()
            if not self.by[room]:
                del self.by[room]
                self.free.pop(at)
            each = room // length
            whole = min(run.count, n // each)
            rest = min(n - whole * each, each - 1) if whole < run.count else 0
            used = 0
            if whole:
                part = run.part(0, whole)
                self.add(Run(whole, run.used + each * length, [*part.slots, (length, first, each)]))
                used = whole
            if rest:
                part = run.part(whole, 1)
                self.add(Run(1, run.used + rest * length, [*part.slots, (length, first + whole * each, rest)]))
                used += 1
            self.add(run.part(used, run.count - used))
            first += whole * each + rest
            n -= whole * each + rest

    def runs(self) -> list[Run]:
        return [*self.full, *(r for room in self.free for r in self.by[room])]


def plan(histogram: dict[int, int], capacity: int = CAPACITY, groups: int = GROUPS) -> pd.DataFrame:
    """length, first, n, copies, sequence, offset: pieces numbered first to first + n - 1 of that length go, `copies` to
    each, into the sequences from `sequence` on, from `offset` on."""
    gaps = _Gaps(capacity)
    if n := histogram.get(capacity, 0):
        gaps.add(Run(n, capacity, [(capacity, 0, 1)]))
    large = [(length, 0, histogram[length]) for length in sorted(histogram, reverse=True) if capacity // SMALL_SHARE < length < capacity]
    total = sum(n for _, _, n in large)
    if total:
        stock, stocks = _Stock(large), []
        bounds = [total * j // groups for j in range(groups + 1)]
        for a, b in zip(bounds, bounds[1:], strict=False):
            if b > a:
                stocks.append(_Stock(stock.take(b - a)))
        by_size: dict[int, list] = {}
        for x in stocks:  # groups that are rounded to the same size count as one
            by_size.setdefault(max(r[0] for r in x.runs), []).extend(x.runs[::-1])
        sizes = sorted(by_size, reverse=True)
        stocks = [_Stock(by_size[s]) for s in sizes]
        for counts, times in configurations(sizes, [x.left for x in stocks], capacity):
            m = int(times + 1e-9)
            m = min([m, *(int(stocks[j].left // c) for j, c in enumerate(counts) if c > 0)])
            if not m:
                continue
            taken = [stocks[j].take(m) for j, c in enumerate(counts) for _ in range(int(c))]
            ends = sorted({e for runs in taken for e in np.cumsum([r[2] for r in runs]).tolist()})
            start = 0
            for end in ends:  # between two ends every slot has one length
                slots = []
                for runs in taken:
                    at = 0
                    for length, first, n in runs:
                        if at <= start < at + n:
                            slots.append((length, first + start - at, 1))
                            break
                        at += n
                gaps.add(Run(end - start, sum(x[0] for x in slots), slots))
                start = end
        for length, first, n in sorted((r for x in stocks for r in x.runs), reverse=True):
            gaps.best_fit(length, first, n)
    for length in range(capacity // SMALL_SHARE, 0, -1):
        if n := histogram.get(length, 0):
            gaps.best_fit(length, 0, n)
    rows, sequence = [], 0
    for run in gaps.runs():
        offset = 0
        for length, first, copies in run.slots:
            rows.append((length, first, run.count * copies, copies, sequence, offset))
            offset += length * copies
        sequence += run.count
    return pd.DataFrame(rows, columns=["length", "first", "n", "copies", "sequence", "offset"], dtype="int64").sort_values(["length", "first"], ignore_index=True)


def place(cut: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS) -> DataFrame:
    """Adds sequence_id and offset to pieces (a stored table). An empty table stays empty."""
    histogram = {int(r["length"]): int(r["n"]) for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # at most `capacity` rows
    table = plan(histogram, capacity, groups)
    key = (table["length"].to_numpy() << 44) + table["first"].to_numpy()
    copies, sequence, offset, first = (table[c].to_numpy() for c in ("copies", "sequence", "offset", "first"))

    @F.pandas_udf("sequence_id long, offset long")
    def placed(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        n, t = length.to_numpy(np.int64), number.to_numpy(np.int64)
        at = np.searchsorted(key, (n << 44) + t, side="right") - 1
        i = t - first[at]
        return pd.DataFrame({"sequence_id": sequence[at] + i // copies[at], "offset": offset[at] + i % copies[at] * n})

    number, spot = column_name(cut, "number"), column_name(cut, "place")
    out = numbered(cut, ["length"], ["doc_id", "piece", "start"], number, buckets_for(sum(histogram.values()))).withColumn(spot, placed("length", number))
    return out.withColumns({c: F.col(spot)[c] for c in ("sequence_id", "offset")}).drop(spot, number)


def pack(docs: DataFrame, capacity: int = CAPACITY, groups: int = GROUPS, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for every piece of every document.

    Documents of more than `capacity` ids (end id included) are cut; others stay whole. A null text is like an empty
    one: its only id is the end id. Repeated rows are packed once each. Other columns of docs are not read.
    """
    return place(stored(pieces(docs, capacity, vocabulary), "pieces"), capacity, groups)


def sequences(docs: DataFrame, placed: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """sequence_id, ids array<int>: the packed sequences themselves. doc_id must identify a document."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = Encoder(vocabulary)
        for pdf in batches:
            ids = [np.append(encoder.encode(t or ""), END)[s : s + n].astype(np.int64).tolist() for t, s, n in zip(pdf["text"], pdf["start"], pdf["length"], strict=True)]
            yield pd.DataFrame({"sequence_id": pdf["sequence_id"], "offset": pdf["offset"], "ids": ids})

    joined = placed.join(docs.select("doc_id", "text"), "doc_id").select("sequence_id", "offset", "start", "length", "text")
    parts = joined.mapInPandas(cut, "sequence_id long, offset long, ids array<long>")
    return parts.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p")).select("sequence_id", F.flatten(F.transform("p", lambda x: x["ids"])).alias("ids"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
