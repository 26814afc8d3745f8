"""Checks of result files, each a query for its violations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CANDIDATE_HEADER = ["source1_entity_id", "candidate_entity_ids"]
MATCH_HEADER = ["source1_entity_id", "matched_entity_ids"]

_c = F.col


def _lists(rows: DataFrame, ids: str) -> DataFrame:
    return rows.withColumn("items", F.when(F.coalesce(ids, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(ids, ",")))


def _out_of_order(rows: DataFrame) -> DataFrame:
    """Lines (line, source1_entity_id) whose id sorts before the line above. Neighbours meet by a join on line numbers."""
    above = rows.select((_c("line") + 1).alias("line"), _c("source1_entity_id").alias("above"))
    return rows.join(above, "line").filter(_c("source1_entity_id") < _c("above"))


def violations(candidates: DataFrame, matches: DataFrame, source1: DataFrame, targets: DataFrame) -> DataFrame:
    """rule, s1_id, detail. Both files as (line, source1_entity_id, ids); source1 and targets: entity_id.

    The files are right if the result is empty. Surplus rows of either file are reported.
    """
    c, m = _lists(candidates, "candidate_entity_ids"), _lists(matches, "matched_entity_ids")
    known, pool = source1.select(_c("entity_id").alias("source1_entity_id")).distinct(), targets.select(_c("entity_id").alias("item")).distinct()
    s1 = _c("source1_entity_id")
    out = []

    def add(df: DataFrame, rule: str, detail) -> None:
        out.append(df.select(F.lit(rule).alias("rule"), s1.alias("s1_id"), detail.cast("string").alias("detail")))

    for name, f in (("candidates", c), ("matches", m)):
        items = f.select("source1_entity_id", F.explode("items").alias("item"))
        add(f.join(known, "source1_entity_id", "left_anti"), f"{name}_unknown_s1", _c("line"))
        add(f.groupBy("source1_entity_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), f"{name}_duplicate_s1", _c("n"))
        add(known.join(f, "source1_entity_id", "left_anti"), f"{name}_missing_s1", F.lit(""))
        add(_out_of_order(f.select("line", "source1_entity_id")), f"{name}_not_sorted", _c("line"))
        add(f.filter(F.size("items") != F.size(F.array_distinct("items"))), f"{name}_duplicate_ids", _c("line"))
        add(items.filter(_c("item").startswith("S1-")), f"{name}_self_match", _c("item"))
        add(items.filter(~_c("item").startswith("S1-")).join(pool, "item", "left_anti"), f"{name}_unknown_target", _c("item"))
    both = c.select("line", s1.alias("source1_entity_id"), _c("items").alias("cands")).join(m.select("line", s1.alias("other"), _c("items").alias("found")), "line", "full_outer")
    add(both.filter(~F.coalesce(s1, F.lit("")).eqNullSafe(F.coalesce("other", F.lit("")))), "lines_differ", _c("other"))
    extra = both.filter(s1 == _c("other")).withColumn("extra", F.array_except("found", "cands")).filter(F.size("extra") > 0)
    add(extra, "match_not_in_candidates", F.array_join("extra", ","))
    result = out[0]
    for x in out[1:]:
        result = result.union(x)
    return result


def check_headers(candidates: DataFrame, matches: DataFrame) -> list[str]:
    out = []
    for name, df, want in (("candidates", candidates, CANDIDATE_HEADER), ("matches", matches, MATCH_HEADER)):
        if [x for x in df.columns if x != "line"] != want:
            out.append(f"{name}: header {df.columns} is not {want}")
    return out
