"""Pair scores, the threshold and the best K candidates of each query."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kindred.functions import fixed
from kindred.functions.text import flag, jaccard

VIEWS = ["country", "name_raw", "name_norm", "name_compact", "name_tokens", "name_sorted", "name_grams", "leet_compact", "dba_compacts", "addr_raw", "addr_norm", "addr_compact", "addr_tokens", "addr_numbers", "addr_salient"]
SLIM = ["country", "name_compact", "name_tokens", "name_grams", "leet_compact", "dba_compacts", "addr_tokens", "addr_numbers"]


def side(records: DataFrame, prefix: str, id_col: str, views: Sequence[str]) -> DataFrame:
    return records.select(F.col("entity_id").alias(id_col), *(F.col(v).alias(f"{prefix}_{v}") for v in views))


def with_views(pairs: DataFrame, queries: DataFrame, targets: DataFrame, views: Sequence[str] = SLIM) -> DataFrame:
    """pairs (s1_id, target_id, …) with q_ and t_ columns of both records."""
    return pairs.join(side(queries, "q", "s1_id", views), "s1_id").join(side(targets, "t", "target_id", views), "target_id")


def containment() -> Column:
    q, t, ql, tl = (F.col(c) for c in ("q_name_compact", "t_name_compact", "q_leet_compact", "t_leet_compact"))
    return (
        F.when((q == "") | (t == ""), F.lit(0.0))
        .when((q == t) | (ql == t) | (tl == q), F.lit(1.0))
        .when(F.array_contains("t_dba_compacts", q) | F.array_contains("q_dba_compacts", t), F.lit(1.0))
        .when(F.contains(q, t) | F.contains(t, q), F.lit(0.6))
        .when((F.length(q) >= 4) & (F.length(t) >= 4) & (F.left(q, F.lit(4)) == F.left(t, F.lit(4))), F.lit(0.3))
        .otherwise(F.lit(0.0))
    )


def name_gram_similarity() -> Column:
    return jaccard(F.col("q_name_grams"), F.col("t_name_grams"))


def name_token_similarity() -> Column:
    return jaccard(F.array_distinct("q_name_tokens"), F.array_distinct("t_name_tokens"))


def addr_token_similarity() -> Column:
    return jaccard(F.array_distinct("q_addr_tokens"), F.array_distinct("t_addr_tokens"))


def number_match() -> Column:
    return flag(F.arrays_overlap("q_addr_numbers", "t_addr_numbers"))


def bypassed() -> Column:
    return F.arrays_overlap("strategies", F.array(*map(F.lit, fixed.BYPASS_STRATEGIES)))


def weighted() -> Column:
    return 0.35 * name_gram_similarity() + 0.30 * name_token_similarity() + 0.20 * containment() + 0.10 * addr_token_similarity() + 0.05 * number_match()


def pair_scores(viewed: DataFrame) -> DataFrame:
    """Adds score: -1 for different countries, 1 for the safest strategies, else the weighted sum."""
    q, t = F.col("q_country"), F.col("t_country")
    return viewed.withColumn("score", F.when((q != "") & (t != "") & (q != t), F.lit(-1.0)).when(bypassed(), F.lit(1.0)).otherwise(weighted()))


def ranked(scored: DataFrame, threshold: float = fixed.SCORE_THRESHOLD, keep_bypass: bool = True) -> DataFrame:
    """Pairs that reach the threshold, with rank from 1: higher scores first, then those that were retrieved first."""
    sure = F.arrays_overlap("strategies", F.array(F.lit("exact_name"), F.lit("sorted_name_tokens")))
    kept = scored.filter("score >= 0")
    if keep_bypass:
        kept = kept.withColumn("score", F.when(sure, F.greatest("score", F.lit(1.0))).otherwise(F.col("score"))).filter(sure | (F.col("score") >= threshold))
    else:
        kept = kept.filter(F.col("score") >= threshold)
    order = Window.partitionBy("s1_id").orderBy(F.desc("score"), "first_rank")
    return kept.withColumn("rank", F.row_number().over(order))


def top_k(scored: DataFrame, k: int = fixed.TOP_K, threshold: float = fixed.SCORE_THRESHOLD, keep_bypass: bool = True) -> DataFrame:
    return ranked(scored, threshold, keep_bypass).filter(F.col("rank") <= k)


def refine(pairs: DataFrame, queries: DataFrame, targets: DataFrame, k: int = fixed.TOP_K, threshold: float = fixed.SCORE_THRESHOLD) -> DataFrame:
    """s1_id, target_id, strategies, first_rank, score, rank. Views are slim here and widened after the cut."""
    return top_k(pair_scores(with_views(pairs, queries, targets)), k, threshold).select("s1_id", "target_id", "strategies", "first_rank", "score", "rank")


def per_anchor(anchors: DataFrame, pairs: DataFrame, into: str) -> DataFrame:
    """source1_entity_id and the sorted ids joined by commas, for every anchor; empty without any."""
    lists = pairs.groupBy("s1_id").agg(F.array_join(F.array_sort(F.collect_set("target_id")), ",").alias(into))
    own = anchors.select(F.col("entity_id").alias("s1_id"))
    return own.join(lists, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce(into, F.lit("")).alias(into))


def empty_candidates(source1: DataFrame) -> DataFrame:
    """The baseline: every anchor with no candidates."""
    if "entity_id" not in source1.columns:
        raise ValueError("source1 has no entity_id")
    return source1.select(F.col("entity_id").alias("source1_entity_id"), F.array().cast("array<string>").alias("candidates"))
