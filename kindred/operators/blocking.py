"""Candidate generation: ten composite keys, equi-joins, a cap on block sizes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.functions import fixed

_token = lambda i: F.try_element_at("name_tokens", F.lit(i))
_number = lambda: F.array_min("addr_numbers")


def longest_token(tokens: Column) -> Column:
    """The first of the longest tokens; empty without tokens."""
    return F.aggregate(tokens, F.lit(""), lambda best, w: F.when(F.length(w) > F.length(best), w).otherwise(best))


def _when(condition: Column, *parts: Column | str) -> Column:
    return F.array_compact(F.array(F.when(condition, F.concat(F.col("country"), F.lit("|"), *(F.lit(p) if isinstance(p, str) else p for p in parts)))))


def _alias_keys(is_query: bool) -> Column:
    own = F.filter(F.array("name_compact"), lambda k: k != "") if is_query else F.array().cast("array<string>")
    return F.transform(F.concat("dba_compacts", own), lambda k: F.concat(F.col("country"), F.lit("|"), k))


#: Keys of each strategy as an array, from whether the record is a query. More can be registered here.
KEYS: dict[str, Callable[[bool], Column]] = {
    "exact_name": lambda q: _when(F.col("name_compact") != "", F.col("name_compact")),
    "sorted_name_tokens": lambda q: _when(F.col("name_sorted") != "", F.col("name_sorted")),
    "first_two_name_tokens": lambda q: _when(F.size("name_tokens") >= 2, _token(1), "_", _token(2)),
    "longest_name_token": lambda q: _when(F.length(longest_token(F.col("name_tokens"))) >= 5, longest_token(F.col("name_tokens"))),
    "name_prefix_6": lambda q: _when(F.length("name_compact") >= 6, F.substring("name_compact", 1, 6)),
    "name_address_combo": lambda q: _when((F.size("name_tokens") >= 1) & _number().isNotNull(), _token(1), "|", _number()),
    "address_exact_combo": lambda q: _when(_number().isNotNull() & (F.size("addr_tokens") >= 1), _number(), "|", F.try_element_at("addr_tokens", F.lit(1))),
    "name_leet_compact": lambda q: _when(F.col("leet_compact") != "", F.col("leet_compact")),
    "name_dba_alias": _alias_keys,
    "address_salient_combo": lambda q: _when(_number().isNotNull() & (F.size("addr_salient") >= 1), _number(), "|", F.try_element_at("addr_salient", F.lit(1))),
}


def block_keys(records: DataFrame, strategies: Sequence[str] = fixed.STRATEGIES, is_query: bool = False) -> DataFrame:
    """entity_id, seq, strategy, strategy_ord, key_ord, key: the keys of normalised records, repeated ones included."""
    unknown = [s for s in strategies if s not in KEYS]
    if unknown:
        raise ValueError(f"unknown strategies: {unknown}")
    order = {s: i for i, s in enumerate(KEYS)}

    def named(s: str) -> Column:
        return F.transform(KEYS[s](is_query), lambda k, i: F.struct(F.lit(order[s]).cast("int").alias("strategy_ord"), i.cast("int").alias("key_ord"), F.lit(s).alias("strategy"), k.alias("key")))

    per = [named(s) for s in strategies]
    rows = records.select("entity_id", "seq", F.explode(F.concat(*per) if len(per) > 1 else per[0]).alias("k"))
    return rows.select("entity_id", "seq", "k.strategy", "k.strategy_ord", "k.key_ord", "k.key")


def block_sizes(target_keys: DataFrame) -> DataFrame:
    """strategy, key, n: entries of each block; an id that has a key twice counts twice."""
    return target_keys.groupBy("strategy", "key").agg(F.count(F.lit(1)).alias("n"))


def block_pairs(query_keys: DataFrame, target_keys: DataFrame, max_block_size: int = fixed.MAX_BLOCK_SIZE) -> DataFrame:
    """A row for each query key, target entry and block of at most max_block_size entries; larger blocks are not used.

    Sizes are counted partially before their shuffle and only over keys that queries have; the join sees no block
    beyond the cap, so a hot key costs its count alone.
    """
    asked = query_keys.select("strategy", "key").distinct()
    usable = block_sizes(target_keys.join(asked, ["strategy", "key"], "left_semi")).filter(F.col("n") <= max_block_size).select("strategy", "key")
    entries = target_keys.join(usable, ["strategy", "key"]).select("strategy", "key", F.col("entity_id").alias("target_id"), F.col("seq").alias("target_seq"))
    return query_keys.select(F.col("entity_id").alias("s1_id"), "strategy", "strategy_ord", "key_ord", "key").join(entries, ["strategy", "key"])


def candidate_pairs(matches: DataFrame) -> DataFrame:
    """s1_id, target_id, strategies (sorted), first_rank: the union of all blocks with its provenance."""
    return matches.groupBy("s1_id", "target_id").agg(F.array_sort(F.collect_set("strategy")).alias("strategies"), F.min(F.struct("strategy_ord", "key_ord", "target_seq")).alias("first_rank"))


def retrieve(queries: DataFrame, targets: DataFrame, strategies: Sequence[str] = fixed.STRATEGIES, max_block_size: int = fixed.MAX_BLOCK_SIZE) -> DataFrame:
    return candidate_pairs(block_pairs(block_keys(queries, strategies, True), block_keys(targets, strategies), max_block_size))


def strategy_contribution(pairs: DataFrame) -> DataFrame:
    """strategy, n_pairs"""
    return pairs.select(F.explode("strategies").alias("strategy")).groupBy("strategy").agg(F.count(F.lit(1)).alias("n_pairs"))
