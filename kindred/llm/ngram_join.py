"""N-gram Jaccard join with signature trees.

Texts are sets of 64-bit hashes of their 5-word shingles. Equal sets are one class. A class has a sketch: its
SKETCH smallest hashes. Two sets of Jaccard similarity 0.8 or more share at least `required(n)` of the SKETCH smallest
hashes of their union, and so of their sketches: always for sets of up to 136 shingles, and else but for a probability
under 5e-15 for each linked pair (a binomial tail; hashes are uniform, whatever the texts are), which is far below
what a corpus of any size would show. So a class is looked up only by the `s - required + 1` rarest hashes of its
sketch of s: passages that many documents share drop out first, and a class with too few hashes that occur elsewhere
isn't looked up at all.

Classes that share such a hash form a group. First each class is verified against one pivot of its groups, which
links most copies with as many comparisons as classes. Classes of groups that still hold several components are looked
up again by their whole sets: a partner shares at least four fifths of a set, so one of the rarest fifth of it.

What these groups leave goes through signature trees: leaves have the bitmap of a set's hashes and its size, inner nodes
the OR of their children's bitmaps and the range of their sizes, and a dual traversal drops a pair of nodes when the
shared bits, the sizes or the common component show that no pair below can be a new link. Groups of any size are split
by sizes and into chunks whose pairs are separate tasks. What is left is verified on whole sets, and components of the
links are found with star steps. Nothing is capped. Without the pivots and the components the same trees list every
link between different sets (`jaccard_pairs`).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm.common import freeing, local_table, stored
from kindred.llm.components import components
from kindred.llm.wordhash import chunks, shingle_sets

N, SKETCH, LEAST, BITS, FANOUT, CHUNK_ROWS, PIVOT_ROUNDS = 5, 48, 14, 2048, 8, 1024, 2
#: The threshold: PERCENT * union <= 100 * intersection. The bounds below hold for 80 and more.
PERCENT = 80


def required(n: Column) -> Column:
    """How many hashes the sketches of a class of n shingles and of any partner share at least."""
    return F.least(F.ceil(n * 0.8), F.greatest(F.lit(LEAST), F.lit(SKETCH) - F.floor(n / 4))).cast("int")


def _bitmap(hashes: np.ndarray) -> bytes:
    bits = np.zeros(BITS, dtype=np.uint8)
    bits[(hashes >> np.uint64(20)) % np.uint64(BITS)] = 1
    return np.packbits(bits).tobytes()


def sketches(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = N) -> DataFrame:
    """doc_id, text_hash, n_shingles, set (16 bytes that name the set), sketch of every row."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("n_shingles", pa.int64()), ("set", pa.binary()), ("sketch", pa.list_(pa.int64()))])

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, ends in chunks(batch.column(2)):
                sizes, names, small = [], [], []
                for s in shingle_sets(data, ends, n):
                    sizes.append(len(s))
                    names.append(xxhash.xxh3_128_digest(s.tobytes()))
                    small.append(s[:SKETCH].view(np.int64))
                own = [batch.column(c).slice(at, len(sizes)) for c in (0, 1)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), _lists(small)], schema=schema)

    asked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))
    return asked.mapInArrow(freeing(sketched), "doc_id long, text_hash long, n_shingles long, set binary, sketch array<long>")


def _lists(rows: list[np.ndarray]) -> pa.ListArray:
    offsets = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows) if rows else np.empty(0, dtype=np.int64)))


def whole_sets(texts: DataFrame, n: int = N) -> DataFrame:
    """rep, n, tokens (the whole set), bitmap of texts (rep, text)."""
    schema = pa.schema([("rep", pa.int64()), ("n", pa.int64()), ("tokens", pa.list_(pa.int64())), ("bitmap", pa.binary())])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data, ends in chunks(batch.column(1)):
                sets = list(shingle_sets(data, ends, n))
                columns = [batch.column(0).slice(at, len(sets)), pa.array(map(len, sets), pa.int64()), _lists([s.view(np.int64) for s in sets]), pa.array(map(_bitmap, sets), pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return texts.select("rep", "text").mapInArrow(freeing(hashed), "rep long, n long, tokens array<long>, bitmap binary")


def similar(pairs: DataFrame, texts: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """Those of the pairs (a, b) whose whole texts' sets reach the threshold. texts: rep, text."""

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept_id, kept = None, np.empty(0, dtype=np.uint64)
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            good = []
            for at, data, ends in chunks(batch.column(2)):
                for i, s in enumerate(shingle_sets(data, ends, n), start=at):
                    if b[i] != kept_id:  # rows arrive by b, so one pivot is hashed once
                        _, d, e = next(chunks(batch.column(3).slice(i, 1)))
                        kept_id, kept = b[i], next(iter(shingle_sets(d, e, n)))
                    shared = len(np.intersect1d(s, kept, assume_unique=True))
                    if shared and 100 * shared >= percent * (len(s) + len(kept) - shared):
                        good.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in good], pa.int64()), pa.array([b[i] for i in good], pa.int64())], names=["a", "b"])

    both = pairs.join(texts.select(F.col("rep").alias("a"), F.col("text").alias("ta")), "a").join(texts.select(F.col("rep").alias("b"), F.col("text").alias("tb")), "b")
    return both.select("a", "b", "ta", "tb").mapInArrow(freeing(verified), "a long, b long")


class SignatureTree:
    """Levels of nodes, leaves first. A leaf is one class."""

    def __init__(self, maps: np.ndarray, sizes: np.ndarray, spare: np.ndarray, comps: np.ndarray) -> None:
        """spare: how many hashes of a set fell on bits that others had set."""
        level = maps, sizes, sizes, spare, comps, comps
        self.levels = [level]
        while len(level[0]) > 1:
            at = np.arange(0, len(level[0]), FANOUT)
            reduce = (np.bitwise_or, np.minimum, np.maximum, np.maximum, np.minimum, np.maximum)
            level = tuple(f.reduceat(x, at, axis=0) for f, x in zip(reduce, level, strict=True))
            self.levels.append(level)

    @staticmethod
    def of(rows: pd.DataFrame) -> SignatureTree:
        return SignatureTree(*_leaves(rows))


def _leaves(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bitmaps, sizes, spare hashes, components) of rows."""
    maps = np.frombuffer(b"".join(rows["bitmap"]), dtype=np.uint64).reshape(len(rows), BITS // 64)
    sizes = rows["n"].to_numpy(np.int64)
    return maps, sizes, sizes - np.bitwise_count(maps).sum(1).astype(np.int64), rows["comp"].to_numpy(np.int64)


def dual_traversal(x: SignatureTree, y: SignatureTree, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Leaf pairs that may be new links; for same, x is y and each pair comes once."""
    depth = max(len(x.levels), len(y.levels)) - 1
    i, j = np.zeros(1, dtype=np.int64), np.zeros(1, dtype=np.int64)
    for d in range(depth, -1, -1):
        a, b = (t.levels[min(d, len(t.levels) - 1)] for t in (x, y))
        if d < depth:
            pairs = []
            for side, t in ((i, x), (j, y)):
                grown = d < len(t.levels) - 1
                kids = side[:, None] * FANOUT + np.arange(FANOUT) if grown else side[:, None]
                pairs.append(kids)
            i = np.repeat(pairs[0], pairs[1].shape[1], axis=1).ravel()
            j = np.tile(pairs[1], (1, pairs[0].shape[1])).ravel()
            ok = (i < len(a[0])) & (j < len(b[0]))
            if same:
                ok &= i <= j
            i, j = i[ok], j[ok]
        keep = []
        for at in range(0, len(i), 1 << 14):
            p, q = i[at : at + (1 << 14)], j[at : at + (1 << 14)]
            ok = (5 * a[2][p] >= 4 * b[1][q]) & (5 * b[2][q] >= 4 * a[1][p])
            ok &= ~((a[4][p] == a[5][p]) & (b[4][q] == b[5][q]) & (a[4][p] == b[4][q]))
            p, q = p[ok], q[ok]
            overlap = np.bitwise_count(a[0][p] & b[0][q]).sum(1) + np.minimum(a[3][p], b[3][q])
            # 100 * shared >= 80 * union, so 9 * shared >= 4 * (both sizes).
            ok[np.flatnonzero(ok)[9 * overlap < 4 * (a[1][p] + b[1][q])]] = False
            keep.append(ok)
        ok = np.concatenate(keep) if keep else np.empty(0, dtype=bool)
        i, j = i[ok], j[ok]
    return (i[i != j], j[i != j]) if same else (i, j)


def _size_class() -> Column:
    """Sets of one class or of neighbouring ones may be similar; others differ by more than a quarter in size."""
    return F.floor(F.log(F.col("n").cast("double")) / float(np.log(1.26))).cast("int")


def tree_pairs(groups: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of groups (token, rep, n, comp, bitmap): those that the trees can't rule out, each once.

    A group is dealt by sizes first, and sizes that many of its sets have into chunks; a cell holds a chunk, or two of
    the same or of neighbouring size classes.
    """
    rows = groups.withColumn("cls", _size_class())
    sizes = rows.groupBy("token", "cls").agg(F.ceil(F.count(F.lit(1)) / CHUNK_ROWS).cast("int").alias("chunks"))
    next_to = lambda step, name: sizes.select("token", (F.col("cls") + step).alias("cls"), F.col("chunks").alias(name))
    sizes = sizes.join(next_to(-1, "above"), ["token", "cls"], "left").join(next_to(1, "below"), ["token", "cls"], "left").fillna(0, ["above", "below"])
    dealt = rows.join(sizes, ["token", "cls"]).withColumn("mine", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    upto = lambda n: F.filter(F.sequence(F.lit(0), F.greatest(F.col(n) - 1, F.lit(0))), lambda i: i < F.col(n))
    mine, cls = F.col("mine"), F.col("cls")
    cell = lambda c, kind, x, y, side: F.struct(c.alias("cls"), F.lit(kind).alias("kind"), x.alias("x"), y.alias("y"), side.alias("side"))
    cells = F.concat(
        F.transform(upto("chunks"), lambda i: cell(cls, 0, F.least(mine, i), F.greatest(mine, i), F.when(mine <= i, F.lit(0)).otherwise(F.lit(1)))),
        F.transform(upto("above"), lambda i: cell(cls, 1, mine, i, F.lit(0))),
        F.transform(upto("below"), lambda i: cell(cls - 1, 1, i, mine, F.lit(1))),
    )
    key = ["token", "cls", "kind", "x", "y"]
    dealt = dealt.select("token", F.explode(cells).alias("c"), "comp", "n", "rep", "bitmap").select("token", "c.*", "comp", "n", "rep", "bitmap")

    def traversed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # the last cell so far, which may go on
        for pdf in batches:
            rows = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
            starts = np.flatnonzero((rows[key] != rows[key].shift()).any(axis=1).to_numpy())
            if len(starts) > 1:
                yield _cells(rows.iloc[: starts[-1]], starts[:-1])
            held = rows.iloc[starts[-1] :] if len(starts) else None
        if held is not None and len(held):
            yield _cells(held, np.zeros(1, dtype=np.int64))

    ordered = dealt.repartition(*key).sortWithinPartitions(*key, "side", "comp", "n", "rep")
    return ordered.mapInPandas(freeing(traversed), "a long, b long").distinct()


def _cells(rows: pd.DataFrame, starts: np.ndarray) -> pd.DataFrame:
    """Pairs of whole cells, which begin at starts. Cells of one node's size are tested all at once, others by trees."""
    sizes = np.diff(np.append(starts, len(rows)))
    out = [_pairs(rows.iloc[a : a + n]) for a, n in zip(starts.tolist(), sizes.tolist(), strict=True) if n > FANOUT]
    small = np.repeat(sizes <= FANOUT, sizes)
    cell = np.repeat(np.arange(len(sizes)), sizes)[small]
    if len(cell):
        part = rows[small]
        maps, n, spare, comp = _leaves(part)
        own, side, rep = ((part["kind"] == 0) & (part["x"] == part["y"])).to_numpy(), part["side"].to_numpy(), part["rep"].to_numpy()
        for d in range(1, FANOUT):
            i = np.flatnonzero(cell[:-d] == cell[d:]) if len(cell) > d else np.empty(0, dtype=np.int64)
            j = i + d
            ok = (own[i] | (side[i] != side[j])) & (comp[i] != comp[j]) & (5 * n[i] >= 4 * n[j]) & (5 * n[j] >= 4 * n[i])
            i, j = i[ok], j[ok]
            ok = 9 * (np.bitwise_count(maps[i] & maps[j]).sum(1) + np.minimum(spare[i], spare[j])) >= 4 * (n[i] + n[j])
            i, j = i[ok], j[ok]
            out.append(pd.DataFrame({"a": np.maximum(rep[i], rep[j]), "b": np.minimum(rep[i], rep[j])}))
    return pd.concat(out).drop_duplicates()


def _pairs(rows: pd.DataFrame) -> pd.DataFrame:
    own = rows["kind"].iloc[0] == 0 and rows["x"].iloc[0] == rows["y"].iloc[0]
    left = rows[rows["side"] == 0]
    right = left if own else rows[rows["side"] == 1]
    if not len(left) or not len(right):
        return pd.DataFrame({"a": [], "b": []}, dtype="int64")
    x = SignatureTree.of(left)
    i, j = dual_traversal(x, x if own else SignatureTree.of(right), own)
    a, b = left["rep"].to_numpy()[i], right["rep"].to_numpy()[j]
    return pd.DataFrame({"a": np.maximum(a, b), "b": np.minimum(a, b)})


def _labels(links: DataFrame) -> DataFrame:
    return components(links).select(F.col("node").alias("rep"), "component")


def _with_components(keys: DataFrame, labels: DataFrame) -> DataFrame:
    return keys.join(labels, "rep", "left").withColumn("comp", F.coalesce("component", "rep")).drop("component")


def _mixed(keys: DataFrame, turn: int = 0) -> DataFrame:
    """token, pivot, pc, pn of groups with several components: one class of each, and its component and size.

    In even turns it is the class whose tokens stand in most sets, which is the likeliest to be near to many (a text that
    others were made from); in odd ones any.
    """
    any_ = F.xxhash64("rep", F.lit(turn))
    order = [-F.col("shared"), any_] if turn % 2 == 0 else [any_, F.col("shared")]
    first = F.min(F.struct(order[0].alias("o"), order[1].alias("h"), F.col("rep").alias("pivot"), F.col("comp").alias("pc"), F.col("n").alias("pn"))).alias("p")
    return keys.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), first).filter("lo <> hi").select("token", "p.pivot", "p.pc", "p.pn")


def rarest(sets: DataFrame, places: Column) -> DataFrame:
    """rep, n, token, shared: the first `places` tokens of each set (rep, n, tokens) in the order by rarity.

    Tokens of one set alone come first; they use up places and are not returned. shared: in how many sets its tokens
    stand, summed up.
    """
    tokens = sets.select("rep", "n", F.size("tokens").alias("s"), F.explode("tokens").alias("token"))
    common = tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    mine = tokens.join(common, "token").groupBy("rep").agg(F.first("n").alias("n"), F.first("s").alias("s"), F.sort_array(F.collect_list(F.struct("df", "token"))).alias("t"))
    left = (places - (F.col("s") - F.size("t"))).cast("int")
    shared = F.aggregate("t.df", F.lit(0).cast("long"), lambda x, df: x + df)
    kept = mine.withColumns({"left": left, "shared": shared}).filter("left > 0")
    return kept.select("rep", "n", "shared", F.explode(F.slice("t.token", 1, F.col("left"))).alias("token"))


def _pivot_pairs(keys: DataFrame, turn: int) -> DataFrame:
    """(a, b): each class of another component than the pivots of its groups, and the one that it meets most often."""
    comparable = 5 * F.least("n", "pn") >= 4 * F.greatest("n", "pn")
    met = keys.join(_mixed(keys, turn), "token").filter((F.col("comp") != F.col("pc")) & comparable)
    return met.groupBy(F.col("rep").alias("a")).agg(F.mode("pivot", True).alias("b"))


def join_classes(classes: DataFrame, docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """rep, component of the classes that have links. classes: rep, n, sketch (stored); docs: rep, text."""
    spark = classes.sparkSession
    labels = local_table(spark, [], "rep long, component long")
    places = F.least(F.col("n"), F.lit(SKETCH)) - required(F.col("n")) + 1
    keys = stored(rarest(classes.select("rep", "n", F.col("sketch").alias("tokens")), places), "keys")
    alike = keys.groupBy("token").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("token")
    texts = stored(docs.join(keys.join(alike, "token", "left_semi").select("rep").distinct(), "rep", "left_semi").dropDuplicates(["rep"]), "texts")
    links = None
    sets = None
    for turn in range(2 * PIVOT_ROUNDS):
        if turn == PIVOT_ROUNDS:
            mixed = _with_components(keys, labels)
            left = mixed.join(_mixed(mixed).select("token"), "token", "left_semi").select("rep").distinct()
            sets = stored(whole_sets(texts.join(left, "rep", "left_semi"), n), "sets")
            keys = stored(rarest(sets, F.floor(F.col("n") / 5) + 1), "keys")
        found = stored(similar(_pivot_pairs(_with_components(keys, labels), turn), texts, n, percent), "links")
        links = found if links is None else links.union(found)
        labels = stored(_labels(links), "labels")
    if sets is None:
        sets = stored(whole_sets(texts, n), "sets")
        keys = stored(rarest(sets, F.floor(F.col("n") / 5) + 1), "keys")
    groups = _with_components(keys, labels)
    groups = groups.join(_mixed(groups).select("token"), "token", "left_semi").join(sets.select("rep", "bitmap"), "rep")
    found = stored(similar(tree_pairs(groups), texts, n, percent), "links")
    return _labels(found if links is None else links.union(found))


def _classes(docs: DataFrame, id_col: str, text: str, n: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(sketches of every row, classes, texts by class): a class is a set with a number of its own."""
    every = stored(sketches(docs, id_col, text, n), "sketches")
    named = every.filter("n_shingles > 0 and doc_id is not null")
    first = named.groupBy("set").agg(F.min(F.struct("doc_id", "text_hash", F.col("n_shingles").alias("n"), "sketch")).alias("c"))
    classes = stored(first.select("set", F.monotonically_increasing_id().alias("rep"), "c.*"), "classes")
    # An id may stand with several texts, so a class's text is known by its id and hash.
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    return every, classes, own.join(classes.select("doc_id", "text_hash", "rep"), ["doc_id", "text_hash"]).select("rep", "text")


def jaccard_pairs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(links, members): all links (a, b) between classes of equal sets, and class, doc_id, n_shingles, n_links of rows.

    The whole join: prefixes of whole sets and signature trees alone, and no pair is left out because others connect
    its classes. n_links counts the other classes that a row's class is linked with; equal sets are one class and not
    linked with themselves. A row without words has no class, one with a null doc_id neither, and no links.
    """
    if percent < 80:
        raise ValueError("the prefix bounds hold for 80 percent and more")
    every, classes, texts = _classes(docs, id_col, text, n)
    texts = stored(texts.dropDuplicates(["rep"]), "texts")
    sets = stored(whole_sets(texts, n), "sets")
    keys = stored(rarest(sets, F.floor(F.col("n") / 5) + 1), "keys").withColumn("comp", F.col("rep"))
    alike = keys.groupBy("token").agg(F.count(F.lit(1)).alias("k")).filter("k > 1").select("token")
    groups = keys.join(alike, "token", "left_semi").join(sets.select("rep", "bitmap"), "rep")
    links = stored(similar(tree_pairs(groups), texts, n, percent), "links")
    counts = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count(F.lit(1)).alias("n_links"))
    known = classes.select("set", "rep").join(counts, "rep", "left")
    named = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    members = every.select("doc_id", "n_shingles", "set").withColumn("set", F.when(named, F.col("set"))).join(known, "set", "left")
    return links, members.select(F.col("rep").alias("class"), "doc_id", "n_shingles", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text: str = "text", n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row.

    A null text and one without words have no shingles and their own id as component. Fewer than n words are one
    shingle. Equal sets are linked. component_id is the smallest doc_id that links lead to. Rows that repeat a doc_id
    are all returned, each by its own text; a null doc_id gets a null component. Other columns of docs are not read.
    """
    if percent < 80:
        raise ValueError("the sketch bounds hold for 80 percent and more")
    every, classes, texts = _classes(docs, id_col, text, n)
    comps = stored(join_classes(classes, texts, n, percent), "components")
    linked = classes.join(comps, "rep")
    first = linked.groupBy("component").agg(F.min("doc_id").alias("first"))
    by_set = classes.join(linked.join(first, "component").select("rep", "first"), "rep", "left").select("set", F.coalesce("first", "doc_id").alias("component"))
    out = every.select("doc_id", "n_shingles", "set").join(by_set, "set", "left")
    alone = F.col("n_shingles") == 0
    lost = F.col("doc_id").isNull()
    return out.select("doc_id", "n_shingles", F.when(alone | lost, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
