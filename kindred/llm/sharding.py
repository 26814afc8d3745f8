"""Sharding by balanced label propagation.

Documents start in shards of equal counts. In each turn a document that is linked with others counts its neighbours by
shard and asks to move to the shard that holds most of them; a shard takes as many as ask to leave it for the others'
shards, and as many more as it has room for. Documents without links have no edges to cut, so their places count as room, and they fill what is left at the
end. Links are given as groups (a document belongs to any number of them, and all members of a group are neighbours),
so a group of any size costs a row for each member, not for each pair.

The law is `rows`: counts of two shards differ by one at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm.common import buckets_for, forget, numbered, stored

TURNS = 12


def _order(*cols: str, seed: int) -> Column:
    return F.pmod(F.xxhash64(*cols, F.lit(seed)), F.lit(1 << 30))


def _shares(wanted: dict[tuple[int, int], int], room: list[int]) -> dict[tuple[int, int], float]:
    """How many of those that want to move from a to b may: as many as want the reverse, and a part of b's room."""
    swaps = {(a, b): min(n, wanted.get((b, a), 0)) for (a, b), n in wanted.items()}
    rest = [sum(n - swaps[a, b] for (a, b), n in wanted.items() if b == t) for t in range(len(room))]
    return {(a, b): (swaps[a, b] + (n - swaps[a, b]) * min(1.0, room[b] / max(1, rest[b]))) / n for (a, b), n in wanted.items()}


def propagate(docs: DataFrame, members: DataFrame, shards: int, turns: int = TURNS) -> DataFrame:
    """doc, shard for docs (doc: distinct longs, a stored table) under links members (doc, grp, stored)."""
    total = docs.count()
    buckets = buckets_for(total)
    room_all = [total // shards + (s < total % shards) for s in range(shards)]
    sizes = members.groupBy("grp").agg(F.count(F.lit(1)).alias("k")).filter("k > 1")
    linked = stored(members.join(sizes.select("grp"), "grp", "left_semi"), "members")
    state = stored(linked.select("doc").distinct().withColumn("shard", F.pmod(F.xxhash64("doc"), F.lit(shards)).cast("int")), "labels")
    leaving = [1] * shards
    for turn in range(turns):
        placed = {r["shard"]: r["n"] for r in state.groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a shard
        room = [max(0, room_all[s] - placed.get(s, 0)) for s in range(shards)]
        # A full shard that nobody wants to leave is closed: its neighbours look for the next best one.
        open_to = [s for s in range(shards) if room[s] or leaving[s]]
        # Neighbours by (group, shard); one row of `shards` counts for each group.
        counts = linked.join(state, "doc").groupBy("grp", "shard").agg(F.count(F.lit(1)).alias("n"))
        rows = counts.groupBy("grp").agg(F.map_from_entries(F.collect_list(F.struct("shard", "n"))).alias("near"))
        near = linked.join(rows, "grp").select("doc", "grp", F.explode("near").alias("target", "n"))
        scores = near.groupBy("doc", "target").agg(F.sum("n").alias("n"), F.min("grp").alias("grp"))
        ranked = scores.join(state, "doc").filter(F.col("target").isin(open_to) | (F.col("target") == F.col("shard")))
        # Ties go to the same shard for all members of a group, and to different shards for different groups.
        best = ranked.groupBy("doc").agg(F.max(F.struct(F.col("n"), _order("grp", "target", seed=5).alias("o"), F.col("target"))).alias("b"), F.first("shard").alias("shard"))
        asked = stored(best.select("doc", "shard", F.col("b.target").alias("target")), "asked")
        wanted = {(r["shard"], r["target"]): r["n"] for r in asked.filter("target <> shard").groupBy("shard", "target").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a pair of shards
        if not wanted:
            forget(asked)
            break
        leaving = [sum(n for (a, _), n in wanted.items() if a == s) for s in range(shards)]
        share = F.element_at(F.create_map(*(F.lit(x) for (a, b), p in _shares(wanted, room).items() for x in (a * shards + b, p))), F.col("shard") * shards + F.col("target"))
        taken = _order("doc", seed=100 + turn) < share * (1 << 30)
        before, state = state, stored(asked.select("doc", F.when((F.col("target") != F.col("shard")) & F.coalesce(taken, F.lit(False)), F.col("target")).otherwise(F.col("shard")).alias("shard")), "labels")
        forget(before, asked)
    # Places: linked documents keep their shard as far as its quota goes; the others fill the rest in order.
    quota = F.element_at(F.create_map(*(F.lit(x) for s in range(shards) for x in (s, room_all[s]))), F.col("shard"))
    home = numbered(state, ["shard"], ["doc"], "at", buckets).withColumn("stays", F.col("at") < quota)
    kept = stored(home, "home")
    filled = {r["shard"]: r["n"] for r in kept.filter("stays").groupBy("shard").agg(F.count(F.lit(1)).alias("n")).collect()}
    loose = stored(docs.select("doc").join(kept.filter("stays").select("doc"), "doc", "left_anti"), "loose")
    ends, at = [], 0
    for s in range(shards):
        at += room_all[s] - filled.get(s, 0)
        ends.append(at)
    place = F.lit(shards - 1)
    for s in reversed(range(shards)):
        place = F.when(F.col("at") < ends[s], F.lit(s)).otherwise(place)
    return kept.filter("stays").select("doc", "shard").union(numbered(loose, [], ["doc"], "at", buckets).select("doc", place.cast("int").alias("shard")))


def shard_documents(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row of docs.

    Documents with equal texts are linked; a null text is like an empty one (size 1). Rows are told apart by a number of
    their own, so repeated rows and null ids get places too. slot counts the documents of a shard from 0 without gaps.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(t) + 1).cast("long").alias("size"), F.crc32(t.cast("binary")).alias("text_crc32"), F.md5(t.cast("binary")).alias("grp"))
    rows = stored(rows, "rows")
    buckets = buckets_for(rows.count())
    named = stored(numbered(rows, [], ["doc_id", "grp"], "doc", buckets), "named")
    placed = propagate(named.select("doc"), named.select("doc", "grp"), shards)
    joined = stored(named.drop("grp").join(placed, "doc"), "sharded")
    out = numbered(joined, ["shard"], ["doc"], "slot", buckets)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op1_label_propagation_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
