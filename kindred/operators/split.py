"""Reproducible splits and samples."""

from __future__ import annotations

import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKETS = 4096


def split_by_hash(ids: DataFrame, ratio: float = 0.2, seed: int = 42, id_col: str = "entity_id") -> DataFrame:
    """id and is_validation: exactly round-half-even(n * ratio) of the distinct ids, the first in order of md5(seed|id).

    Ranks are made within the 4096 buckets of the hash's first digits and the buckets' counts, so no task sorts all.
    """
    if not 0 < ratio < 1:
        raise ValueError("ratio must lie between 0 and 1")
    h = ids.select(id_col).distinct().withColumn("h", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col)).cast("binary")))
    h = h.withColumn("bucket", F.conv(F.substring("h", 1, 3), 16, 10).cast("int"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)  # at most 4096 rows
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    counts = h.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.bround(F.sum("n").over(every) * ratio).alias("take"))
    inside = Window.partitionBy("bucket").orderBy("h", id_col)
    return h.join(counts, "bucket").select(id_col, (F.col("start") + F.row_number().over(inside) <= F.col("take")).alias("is_validation"))


def split_by_shuffle(ids: list[str], ratio: float = 0.2, seed: int = 42) -> tuple[list[str], list[str]]:
    """(train, validation) of ids that fit on the driver, by a seeded shuffle of the sorted ids."""
    if not 0 < ratio < 1:
        raise ValueError("ratio must lie between 0 and 1")
    order = sorted(ids)
    random.Random(seed).shuffle(order)
    n = round(len(order) * ratio)
    return sorted(order[n:]), sorted(order[:n])


def with_distractors(targets: DataFrame, needed: DataFrame, per_source: int) -> DataFrame:
    """All targets whose entity_id is needed, and the first per_source others of each source by seq."""
    want = needed.select(F.col("target_id").alias("entity_id")).distinct()
    kept = targets.join(want, "entity_id", "left_semi")
    order = Window.partitionBy("source").orderBy("seq")
    others = targets.join(want, "entity_id", "left_anti").withColumn("__k", F.row_number().over(order)).filter(F.col("__k") <= per_source).drop("__k")
    return kept.unionByName(others)
