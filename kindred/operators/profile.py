"""Profiles of sources, truth and features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_c = F.col


def source_profile(entities: DataFrame) -> DataFrame:
    """A row per source and text column: rows, missing, distinct values, least, mean and greatest length."""
    cols = ["business_name", "business_address", "country"]
    long = entities.select("source", F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.coalesce(c, F.lit("")).alias("value")) for c in cols))).alias("x")).select("source", "x.*")
    return long.groupBy("source", "column").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(_c("value") == "").alias("n_missing"), F.count_distinct("value").alias("n_distinct"),
        F.min(F.length("value")).alias("min_length"), F.avg(F.length("value")).alias("avg_length"), F.max(F.length("value")).alias("max_length"),
    )


def country_distribution(entities: DataFrame) -> DataFrame:
    return entities.groupBy("source", _c("country")).agg(F.count(F.lit(1)).alias("n"))


def malformed_lines(lines: DataFrame, fields: int = 4) -> DataFrame:
    """n_lines, n_malformed of raw lines (value)."""
    return lines.agg(F.count(F.lit(1)).alias("n_lines"), F.count_if(F.size(F.split("value", "\t", -1)) != fields).alias("n_malformed"))


def truth_histogram(truth: DataFrame) -> DataFrame:
    """n_matches, n_s2, n_s3, anchors"""
    of = lambda s: F.size(F.filter("targets", lambda x: x.startswith(s)))
    return truth.groupBy(F.size("targets").alias("n_matches"), of("S2").alias("n_s2"), of("S3").alias("n_s3")).agg(F.count(F.lit(1)).alias("anchors"))


def truth_summary(truth: DataFrame) -> DataFrame:
    """One row: anchors without, with one, with several matches; links, distinct targets, targets of several anchors."""
    n = F.size("targets")
    counts = truth.agg(F.count_if(n == 0).alias("zero"), F.count_if(n == 1).alias("single"), F.count_if(n > 1).alias("multi"), F.coalesce(F.sum(n), F.lit(0)).cast("long").alias("links"))
    per = truth.select("s1_id", F.explode("targets").alias("t")).groupBy("t").agg(F.count_distinct("s1_id").alias("k"))
    return counts.join(per.agg(F.count(F.lit(1)).alias("unique_targets"), F.count_if(_c("k") > 1).alias("multi_anchor_targets")), F.lit(True))


def id_overlap(a: DataFrame, b: DataFrame, id_col: str = "entity_id") -> DataFrame:
    """n_a, n_b, n_both of distinct ids."""
    both = a.select(id_col, F.lit(1).alias("a"), F.lit(0).alias("b")).union(b.select(id_col, F.lit(0), F.lit(1))).groupBy(id_col).agg(F.max("a").alias("a"), F.max("b").alias("b"))
    return both.agg(F.sum("a").alias("n_a"), F.sum("b").alias("n_b"), F.sum(_c("a") * _c("b")).alias("n_both"))


def feature_audit(features: DataFrame, columns: Sequence[str], label: str = "label") -> DataFrame:
    """A row per feature: missing share, distinct values, range, mean, median, deviation, constancy, correlation with
    the label and class means. One pass over the unpivoted values."""
    long = features.select(_c(label).cast("double").alias("y"), F.explode(F.array(*(F.struct(F.lit(c).alias("feature"), _c(c).alias("x")) for c in columns))).alias("f")).select("y", "f.*")
    x = _c("x")
    out = long.groupBy("feature").agg(
        F.avg(x.isNull().cast("double")).alias("missing_share"), F.count_distinct(x).alias("n_unique"), F.min(x).alias("min"), F.max(x).alias("max"), F.avg(x).alias("mean"),
        F.percentile(x, F.lit(0.5)).alias("median"), F.stddev_samp(x).alias("std"), F.try_divide(F.covar_pop(x, "y"), F.stddev_pop(x) * F.stddev_pop("y")).alias("r"),
        F.avg(F.when(_c("y") == 1, x)).alias("mean_positive"), F.avg(F.when(_c("y") == 0, x)).alias("mean_negative"),
    )
    constant = (F.coalesce("std", F.lit(0.0)) < 1e-7) | (_c("n_unique") <= 1)
    out = out.withColumns({"is_constant": constant, "is_near_constant": ~constant & (_c("std") < 1e-4)})
    return out.withColumn("label_correlation", F.when(constant, F.lit(0.0)).otherwise(F.coalesce("r", F.lit(0.0)))).drop("r")


def correlated_pairs(features: DataFrame, columns: Sequence[str], least: float = 0.9) -> DataFrame:
    """a, b, r of feature pairs with |r| of at least 0.9; one aggregation over all pairs of columns."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    sums = features.agg(*(F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b)).alias(f"{i}") for i, (a, b) in enumerate(pairs)))
    rows = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), _c(f"`{i}`").alias("r")) for i, (a, b) in enumerate(pairs)))).alias("p")
    return sums.select(rows).select("p.*").filter(F.abs("r") >= least)
