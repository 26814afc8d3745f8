"""Exact top-k inner products by norm buckets.

Candidates are cut into parts by length (norm), longest first, so that a part holds a range of lengths. Queries are seeded
with their k best products among the longest part; with t a query's k-th best score and q its own length, a vector must
be at least t / q long to count. Queries are cut into blocks by that length, and a part that is shorter than all that a
block needs is never paired with it.

Within a pair of part and block the part is cut into buckets by length. With l a bucket's greatest length, t / (q * l) is
the cosine that a vector of the bucket must reach at least:

* over 1: this bucket and all shorter ones are skipped (length pruning);
* high: only candidates whose coordinate at the query's strongest one lies in the feasible interval of that cosine are
  verified (coordinate pruning);
* else: candidates shorter than t / q are skipped (length pruning within the bucket).

Those left are verified by their integer products. Queries come in blocks of fixed size, so no task and no broadcast
holds all of them; each pair of (part, block) returns k rows a query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kindred.llm.common import stored

PART_ROWS, BUCKET_ROWS, BLOCK_ROWS = 8192, 512, 2048
#: From this local cosine on, coordinates prune better than lengths.
COORDINATE_FROM = 0.6
#: Lengths are counted in so many classes an octave; a class with more rows than a part is dealt by row number.
LENGTH_CLASSES = 4096
#: Below this share of pairs that may count, single pairs are verified and no whole block.
SPARSE = 0.05


def quantised(vectors: DataFrame, id_col: str, vector_col: str, scale: float = 256.0) -> DataFrame:
    """(row, id, v array<long>, norm): floor(scale * x) of every row, with a number of its own (stored).

    Vectors that are null or hold null, NaN or infinite components go. Rows that repeat an id, or have a null one, stay.
    """
    x = F.col(vector_col)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != F.lit(float("inf"))))
    v = F.transform(x, lambda e: F.floor(e.cast("double") * F.lit(scale)).cast("bigint"))
    clean = vectors.filter(x.isNotNull()).filter(finite).select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("bigint").alias("id"), v.alias("v"))
    square = F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e.cast("double"))
    return stored(clean.withColumn("norm", F.sqrt(square)), "vectors")


def _matrix(rows: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(rows), width), dtype=np.int64)
    for i, x in enumerate(rows):
        out[i, : len(x)] = x
    return out


def search(queries: np.ndarray, query_rows: np.ndarray, rows: np.ndarray, row_numbers: np.ndarray, ties: np.ndarray, k: int, least: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query index, row index, score) of each query's k best rows in this part but itself; equal scores by `ties`.

    least: a score for each query below which no row counts.
    """
    largest = int(np.abs(queries).max(initial=0)), int(np.abs(rows).max(initial=0))
    width = max(1, rows.shape[1])
    plain = largest[0] * largest[1] * width < 2**53 and max(largest) ** 2 * width < 2**53
    kind = np.float64 if plain else np.int64  # both exact; the first has fast products
    if largest[0] * largest[1] * width >= 2**63:
        kind = object
    lowest = -np.inf if kind is np.float64 else -(2**62)
    q, c = queries.astype(kind), rows.astype(kind)
    norm = np.sqrt((rows.astype(np.float64) ** 2).sum(1))
    q_norm = np.sqrt((queries.astype(np.float64) ** 2).sum(1))
    order = np.lexsort((ties, -norm))
    c, norm, numbers, tie_of = c[order], norm[order], row_numbers[order], ties[order]
    unit = rows[order] / np.maximum(norm, 1e-300)[:, None]
    focus = np.abs(queries).argmax(1) if queries.size else np.zeros(len(queries), dtype=np.int64)
    focus_at = queries[np.arange(len(queries)), focus] / np.maximum(q_norm, 1e-300) if queries.size else np.zeros(len(queries))
    best_s = np.full((len(q), k), lowest, dtype=kind)
    best_i = np.full((len(q), k), -1, dtype=np.int64)
    floor = np.full(len(q), -np.inf) if least is None else least.astype(np.float64)
    live = np.arange(len(q))
    for at in range(0, len(c), BUCKET_ROWS):
        part, top = slice(at, at + BUCKET_ROWS), norm[at]
        t = np.maximum(floor[live], np.where(best_i[live, -1] >= 0, best_s[live, -1].astype(np.float64), -np.inf))
        reach = q_norm[live] * top
        # A rounding margin, so that equal scores that win by their order are not pruned.
        keep = ~(t > reach * (1 + 1e-9))
        live, t, reach = live[keep], t[keep], reach[keep]
        if not len(live):
            break
        cosine = np.where(reach > 0, t / np.maximum(reach, 1e-300), -np.inf)
        by_coordinate = cosine >= COORDINATE_FROM
        for chosen in (np.flatnonzero(~by_coordinate), np.flatnonzero(by_coordinate)):
            if not len(chosen):
                continue
            mine, cos = live[chosen], cosine[chosen] - 1e-9
            need = norm[None, part] * q_norm[mine, None] * (1 + 1e-9) >= t[chosen, None]
            if by_coordinate[chosen[0]]:
                f = focus_at[mine]
                middle, spread = f * cos, np.sqrt(np.maximum(0, (1 - f * f) * (1 - np.minimum(cos, 1) ** 2))) + 1e-9
                x = unit[part][:, focus[mine]].T
                sure = np.abs(f) >= cos  # the interval's far end is then 1 or -1
                upper = np.where(sure & (f > 0), 1.0, middle + spread)[:, None]
                lower = np.where(sure & (f < 0), -1.0, middle - spread)[:, None]
                need &= (x >= lower - 1e-9) & (x <= upper + 1e-9)
            need &= query_rows[mine, None] != numbers[part][None, :]
            hit = np.flatnonzero(need.any(1))
            mine, need = mine[hit], need[hit]
            used = np.flatnonzero(need.any(0))
            if not len(used):
                continue
            need = need[:, used]
            scores = np.full(need.shape, lowest, dtype=kind)
            if kind is not object and need.sum() < SPARSE * need.size:
                for lo in range(0, len(mine), 64):  # pairs of few queries at a time bound the copies
                    i, j = np.nonzero(need[lo : lo + 64])
                    scores[lo + i, j] = (q[mine[lo + i]] * c[part][used[j]]).sum(1)
            else:
                scores = np.where(need, q[mine] @ c[part][used].T, lowest)
            all_s = np.concatenate([best_s[mine], scores], 1)
            all_i = np.concatenate([best_i[mine], np.broadcast_to(used + at, scores.shape)], 1)
            all_i = np.where(all_s == lowest, -1, all_i)
            tie = np.where(all_i >= 0, tie_of[all_i], np.iinfo(np.int64).max)
            pick = np.lexsort((tie, -all_s), axis=1)[:, :k]
            best_s[mine], best_i[mine] = np.take_along_axis(all_s, pick, 1), np.take_along_axis(all_i, pick, 1)
    qi, at = np.nonzero(best_i >= 0)
    good = best_s[qi, at].astype(np.float64) >= floor[qi]
    return qi[good], order[best_i[qi, at]][good], best_s[qi, at][good]


def _length_class() -> Column:
    """Falls with the length; equal lengths share a class. Zero vectors come last."""
    return F.when(F.col("norm") > 0, -F.floor(F.log2("norm") * LENGTH_CLASSES)).otherwise(F.lit(2**40)).cast("long")


def cut_by_length(vectors: DataFrame, rows: int, into: str) -> DataFrame:
    """vectors with a number: those with greater norms have smaller numbers, and about `rows` vectors share one.

    Only class counts are summed up in order (a row for each class of lengths that occurs), so no task sorts all rows.
    """
    classes = vectors.groupBy(_length_class().alias("cls")).agg(F.count(F.lit(1)).alias("n")).withColumn("octave", F.floor(F.col("cls") / LENGTH_CLASSES))
    before = Window.orderBy("octave").rowsBetween(Window.unboundedPreceding, -1)  # a row for each doubling of lengths
    inside = Window.partitionBy("octave").orderBy("cls").rowsBetween(Window.unboundedPreceding, -1)
    octaves = classes.groupBy("octave").agg(F.sum("n").alias("m")).select("octave", F.coalesce(F.sum("m").over(before), F.lit(0)).alias("earlier"))
    starts = classes.join(octaves, "octave").select("cls", "n", (F.col("earlier") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("first"))
    place = F.col("first") + F.pmod(F.xxhash64("row"), F.col("n"))  # rows of one class are spread over its places
    return vectors.withColumn("cls", _length_class()).join(starts, "cls").withColumn(into, F.floor(place / rows).cast("int")).drop("cls", "n", "first")


def _seeds(placed: DataFrame, queries: DataFrame, k: int, width: int) -> DataFrame:
    """queries with least: the k-th best score of each among the longest part, null if that has too few rows."""

    def joined(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        q, c = _matrix(right["v"], width), _matrix(left["v"], width)
        mine, numbers = right["row"].to_numpy(np.int64), left["row"].to_numpy(np.int64)
        out = pd.DataFrame({"row": mine, "least": pd.array([None] * len(right), dtype="Float64")})
        if len(q) and len(c):
            qi, _, s = search(q, mine, c, numbers, numbers, k)
            found = pd.DataFrame({"q": qi, "s": s.astype(np.float64)}).groupby("q")["s"].agg(["min", "size"])
            full = found[found["size"] >= k]
            out.loc[full.index, "least"] = full["min"].to_numpy()
        return out

    groups = max(1, -(-queries.count() // BLOCK_ROWS))
    asked = queries.select("row", "v", F.pmod(F.xxhash64("row"), F.lit(groups)).cast("int").alias("block"))
    longest = placed.filter("part = 0").select("row", "v", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("block"))
    found = longest.groupBy("block").cogroup(asked.groupBy("block")).applyInPandas(joined, "row long, least double")
    return queries.join(found, "row", "left")


def pairing(placed: DataFrame, seeded: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(queries with block, pairs (part, block) that may hold a result).

    placed: vectors with part; seeded: queries with least. A query needs vectors of the length least / norm at least, and
    blocks are cut by that length, so a block takes the parts from the first to the last one that is long enough.
    """
    need = F.when((F.col("least") > 0) & (F.col("norm") > 0), F.col("least") / F.col("norm")).otherwise(F.lit(0.0))
    asked = seeded.withColumn("own", F.col("norm")).withColumn("norm", need)
    blocks = cut_by_length(asked, BLOCK_ROWS, "block").withColumnsRenamed({"norm": "need", "own": "norm"})
    lengths = placed.groupBy("part").agg(F.max("norm").alias("length")).select("length", "part", F.lit(None).cast("int").alias("block"))
    wanted = blocks.groupBy("block").agg(F.min("need").alias("length")).select((F.col("length") * (1 - 1e-9)).alias("length"), F.lit(None).cast("int").alias("part"), "block")
    # A row for each part and block, that is for thousands of vectors.
    longer = Window.orderBy(F.desc("length"), F.asc_nulls_last("part")).rowsBetween(Window.unboundedPreceding, 0)
    last = lengths.union(wanted).withColumn("last", F.max("part").over(longer)).filter("block is not null and last is not null")
    return blocks, last.select(F.explode(F.sequence(F.lit(0), "last")).alias("part"), "block")


def top_products(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query row's k best rows other than itself.

    vectors and queries (a part of vectors): as quantised() makes them. Ties go to the smaller id, null ids last; rows
    that agree in id and score come in any order among themselves. Rows that repeat an id are rows of their own, as
    candidates and as queries. Shorter vectors count as padded with zeros. A query with fewer than k candidates gets
    them all; without candidates or queries the result is empty.
    """
    width = max(1, vectors.agg(F.max(F.size("v"))).first()[0] or 1)
    placed = stored(cut_by_length(vectors, PART_ROWS, "part"), "parts")
    seeded = stored(_seeds(placed, queries, k, width), "seeds")
    blocks, pairs = pairing(placed, seeded)
    blocks, pairs = stored(blocks, "blocks"), stored(pairs, "pairs")
    rows = placed.join(pairs, "part").select("part", "block", "row", "id", "v")
    asked = blocks.join(pairs, "block").select("part", "block", "row", "id", "v", "least")

    def joined(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        q, c = _matrix(right["v"], width), _matrix(left["v"], width)
        if not len(q) or not len(c):
            return pd.DataFrame({"query": [], "row": [], "score": []}).astype("int64")
        numbers, mine = left["row"].to_numpy(np.int64), right["row"].to_numpy(np.int64)
        qi, ci, s = search(q, mine, c, numbers, left["order"].to_numpy(np.int64), k, right["least"].fillna(-np.inf).to_numpy())
        return pd.DataFrame({"query": mine[qi], "row": numbers[ci], "score": s.astype(np.int64)})

    # Ids cross into pandas only as an order without nulls, which keeps them exact.
    rows = rows.withColumn("order", F.coalesce("id", F.lit(2**63 - 1)))
    local = rows.drop("id").groupBy("part", "block").cogroup(asked.drop("id").groupBy("part", "block")).applyInPandas(joined, "query long, row long, score long")
    named = local.join(vectors.select("row", F.col("id").alias("vec_id")), "row").join(queries.select(F.col("row").alias("query"), F.col("id").alias("query_id")), "query")
    best = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"))
    out = named.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return out.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = quantised(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"), "vec_id", "embedding")
    return top_products(vectors, vectors.filter(F.col("id") % 50 == 0), 5)


OP5_SQL = """
WITH clean AS (
  SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.row AS query, q.vec_id AS query_id, c.vec_id AS vec_id,
         list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM clean q JOIN clean c ON q.vec_id % 50 = 0 AND q.row <> c.row
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank, vec_id, score
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
