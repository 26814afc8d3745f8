"""Metrics of predictions and candidates, as aggregations. Truth is wide: s1_id, targets array<string>."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kindred.functions import fixed

_c = F.col


def wide(anchors: DataFrame, pairs: DataFrame, into: str) -> DataFrame:
    """s1_id and its distinct targets, for all anchors (s1_id)."""
    lists = pairs.groupBy("s1_id").agg(F.array_sort(F.collect_set("target_id")).alias(into))
    return anchors.select("s1_id").join(lists, "s1_id", "left").withColumn(into, F.coalesce(into, F.array().cast("array<string>")))


def anchor_metrics(truth: DataFrame, predicted: DataFrame, beta: float = 0.5) -> DataFrame:
    """s1_id, precision, recall, f_beta, tp, fp, fn, exact_match, is_singleton for every anchor of truth (s1_id, targets).

    predicted: s1_id, target_id. No truth and no prediction is right; only one of both is wrong.
    """
    both = truth.join(wide(truth, predicted, "found"), "s1_id")
    n, m, tp = F.size("targets"), F.size("found"), F.size(F.array_intersect("targets", "found"))
    empty = (n == 0) & (m == 0)
    p = F.when(empty, F.lit(1.0)).when((n == 0) | (m == 0), F.lit(0.0)).otherwise(tp / m)
    r = F.when(empty, F.lit(1.0)).when((n == 0) | (m == 0), F.lit(0.0)).otherwise(tp / n)
    b = beta * beta
    f = F.when(b * p + r > 0, (1 + b) * p * r / (b * p + r)).otherwise(F.lit(0.0))
    return both.select("s1_id", p.alias("precision"), r.alias("recall"), f.alias("f_beta"), tp.alias("tp"), (m - tp).alias("fp"), (n - tp).alias("fn"), ((n == tp) & (m == tp)).alias("exact_match"), (n == 0).alias("is_singleton"), n.alias("n_true"))


def _mean_if(value: Column, condition: Column) -> Column:
    return F.coalesce(F.avg(F.when(condition, value)), F.lit(0.0))


def evaluate_predictions(truth: DataFrame, predicted: DataFrame, beta: float = 0.5) -> DataFrame:
    """One row of macro averages over all anchors of truth; all zero without any."""
    m = anchor_metrics(truth, predicted, beta)
    single = _c("is_singleton")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long").alias(f"total_{c}")
    return m.agg(
        F.coalesce(F.avg("f_beta"), F.lit(0.0)).alias("macro_f05"),
        F.coalesce(F.avg("precision"), F.lit(0.0)).alias("macro_precision"),
        F.coalesce(F.avg("recall"), F.lit(0.0)).alias("macro_recall"),
        F.coalesce(F.avg(_c("exact_match").cast("double")), F.lit(0.0)).alias("exact_match_accuracy"),
        total("tp"),
        total("fp"),
        total("fn"),
        F.count_if(single).alias("singleton_count"),
        _mean_if(_c("exact_match").cast("double"), single).alias("singleton_accuracy"),
        F.count_if(~single).alias("non_singleton_count"),
        _mean_if(_c("f_beta"), ~single).alias("non_singleton_macro_f05"),
    )


def _rate(found: Column, all_: Column) -> Column:
    return F.when(all_ == 0, F.lit(1.0)).otherwise(found / all_)


def anchor_coverage(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """s1_id, and per anchor: links and captured links (also of S2 and S3), candidates."""
    both = truth.join(wide(truth, candidates, "found"), "s1_id")
    hit = F.array_intersect("targets", "found")
    of = lambda a, s: F.size(F.filter(a, lambda x: x.startswith(s)))
    cols = {"links": F.size("targets"), "captured": F.size(hit), "n_candidates": F.size("found")}
    for s in ("S2", "S3"):
        cols |= {f"links_{s.lower()}": of("targets", s), f"captured_{s.lower()}": of(hit, s), f"candidates_{s.lower()}": of("found", s)}
    return both.select("s1_id", *(v.alias(k) for k, v in cols.items()))


def evaluate_candidate_blocking(truth: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row: link recall, coverage and the distribution of candidate counts. Rates of nothing are 1."""
    c = anchor_coverage(truth, candidates)
    total = lambda x: F.coalesce(F.sum(x), F.lit(0)).cast("long")
    linked, full = F.count_if(_c("links") > 0), F.count_if((_c("links") > 0) & (_c("captured") == _c("links")))
    n, cands = F.count(F.lit(1)), _c("n_candidates")
    share = lambda cond: F.when(n == 0, F.lit(0.0)).otherwise(100.0 * F.count_if(cond) / n)
    lone = F.count_if(_c("links") == 0)
    return c.agg(
        _rate(total("captured"), total("links")).alias("candidate_recall_overall"),
        _rate(total("captured_s2"), total("links_s2")).alias("candidate_recall_s2"),
        _rate(total("captured_s3"), total("links_s3")).alias("candidate_recall_s3"),
        _rate(full, linked).alias("s1_coverage"),
        total("links").alias("total_true_links"),
        total("captured").alias("retrieved_true_links"),
        n.alias("total_s1_evaluated"),
        linked.alias("non_singleton_s1_count"),
        full.alias("fully_covered_s1_count"),
        F.coalesce(F.avg(cands), F.lit(0.0)).alias("candidate_avg"),
        F.coalesce(F.percentile(cands, F.lit(0.5)), F.lit(0.0)).alias("candidate_median"),
        F.coalesce(F.min(cands), F.lit(0)).alias("candidate_min"),
        F.coalesce(F.max(cands), F.lit(0)).alias("candidate_max"),
        *(F.coalesce(F.percentile(cands, F.lit(p / 100)), F.lit(0.0)).alias(f"candidate_p{p}") for p in (90, 95, 99)),
        share(cands == 0).alias("pct_zero_candidates"),
        share(cands > 100).alias("pct_gt_100_candidates"),
        share(cands > 1000).alias("pct_gt_1000_candidates"),
        share(cands > 10000).alias("pct_gt_10000_candidates"),
        lone.alias("singleton_s1_count"),
        F.when(lone == 0, F.lit(0.0)).otherwise(100.0 * F.count_if((_c("links") == 0) & (cands == 0)) / lone).alias("singleton_pct_clean_zero_cands"),
        _mean_if(cands.cast("double"), _c("links") == 0).alias("singleton_candidate_avg"),
    )


def recall_by(truth: DataFrame, candidates: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """grp, links, captured, recall by a group of anchors: (s1_id, grp), or the number of true links (1 to 4, 5+)."""
    c = anchor_coverage(truth, candidates)
    if groups is None:
        c = c.filter("links > 0").withColumn("grp", F.when(_c("links") >= 5, F.lit("5+")).otherwise(_c("links").cast("string")))
    else:
        c = c.join(groups, "s1_id")
    return c.groupBy("grp").agg(F.sum("links").alias("links"), F.sum("captured").alias("captured")).withColumn("recall", _rate(_c("captured"), _c("links")))


def reduction(anchors: DataFrame, candidates: DataFrame, pool: int) -> DataFrame:
    """total_theoretical_pairs, total_final_candidate_pairs, reduction_ratio (infinite without pairs), percentage."""
    n = anchors.agg(F.count(F.lit(1)).alias("n"))
    pairs = candidates.select("s1_id", "target_id").distinct().agg(F.count(F.lit(1)).alias("m"))
    all_ = (_c("n") * pool).cast("long")
    return n.join(pairs, F.lit(True)).select(
        all_.alias("total_theoretical_pairs"),
        _c("m").alias("total_final_candidate_pairs"),
        F.when(_c("m") == 0, F.lit(float("inf"))).otherwise(all_ / _c("m")).alias("reduction_ratio"),
        F.when(all_ == 0, F.lit(0.0)).otherwise(100.0 * (1 - _c("m") / all_)).alias("reduction_percentage"),
    )


def threshold_sweep(scored: DataFrame, truth: DataFrame, thresholds: Sequence[float] | None = None) -> DataFrame:
    """threshold, macro_f05, macro_precision, macro_recall, predicted_match_count, is_best, over scored (s1_id,
    target_id, prob) and wide truth. The 19 thresholds make one aggregation by (anchor, threshold); the first of the
    best ones is marked."""
    steps = thresholds or [round(0.05 * i, 2) for i in range(1, 20)]
    grid = F.explode(F.array(*map(F.lit, steps))).alias("threshold")
    long = truth.select("s1_id", F.explode("targets").alias("target_id"), F.lit(1).alias("hit"))
    judged = scored.select("s1_id", "target_id", "prob").join(long, ["s1_id", "target_id"], "left")
    at = judged.select("s1_id", "prob", F.coalesce("hit", F.lit(0)).alias("hit"), grid).filter("prob >= threshold").groupBy("s1_id", "threshold").agg(F.count(F.lit(1)).alias("m"), F.sum("hit").alias("tp"))
    every = truth.select("s1_id", F.size("targets").alias("n"), grid)
    full = every.join(at, ["s1_id", "threshold"], "left").fillna(0, ["m", "tp"])
    none = (_c("n") == 0) & (_c("m") == 0)
    p = F.when(none, F.lit(1.0)).when((_c("n") == 0) | (_c("m") == 0), F.lit(0.0)).otherwise(_c("tp") / _c("m"))
    r = F.when(none, F.lit(1.0)).when((_c("n") == 0) | (_c("m") == 0), F.lit(0.0)).otherwise(_c("tp") / _c("n"))
    f = F.when(0.25 * p + r > 0, 1.25 * p * r / (0.25 * p + r)).otherwise(F.lit(0.0))
    rows = full.groupBy("threshold").agg(F.avg(f).alias("macro_f05"), F.avg(p).alias("macro_precision"), F.avg(r).alias("macro_recall"), F.sum("m").alias("predicted_match_count"))
    best = Window.orderBy(F.round("macro_f05", 12).desc(), "threshold")  # 19 rows
    return rows.withColumn("is_best", F.row_number().over(best) == 1)


def recall_ceilings(truth: DataFrame, scored: DataFrame, threshold: float = fixed.MATCH_THRESHOLD) -> DataFrame:
    """One row: links in truth, among candidates and found by the model, with three percentages and two miss counts."""
    long = truth.select("s1_id", F.explode("targets").alias("target_id"))
    m = long.join(scored.select("s1_id", "target_id", "prob"), ["s1_id", "target_id"], "left")
    n, cand, hit = F.count(F.lit(1)), F.count_if(_c("prob").isNotNull()), F.count_if(_c("prob") >= threshold)
    pct = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(F.round(100.0 * a / b, 2))
    return m.agg(
        n.alias("total_ground_truth_links"), cand.alias("candidate_represented_true_links"), hit.alias("model_captured_true_links"),
        pct(cand, n).alias("candidate_generation_recall_ceiling_pct"), pct(hit, cand).alias("model_recall_within_candidates_pct"), pct(hit, n).alias("final_end_to_end_recall_pct"),
        (n - cand).alias("blocking_miss_count"), (cand - hit).alias("model_discrimination_miss_count"),
    )


def _by_score(scored: DataFrame) -> DataFrame:
    """prob, pos, neg and what ranks higher: sums over distinct scores, by blocks of scores and within them."""
    g = scored.groupBy("prob").agg(F.sum("label").alias("pos"), F.sum(1 - _c("label")).alias("neg")).withColumn("block", F.floor(_c("prob") * 1000))
    above = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)  # 1001 rows
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    b = g.groupBy("block").agg(F.sum("pos").alias("bp"), F.sum("neg").alias("bn"))
    b = b.select("block", F.coalesce(F.sum("bp").over(above), F.lit(0)).alias("p0"), F.coalesce(F.sum("bn").over(above), F.lit(0)).alias("n0"), F.sum("bp").over(every).alias("all_pos"), F.sum("bn").over(every).alias("all_neg"))
    inside = Window.partitionBy("block").orderBy(F.desc("prob")).rowsBetween(Window.unboundedPreceding, 0)
    return g.join(b, "block").withColumns({"cum_pos": F.sum("pos").over(inside) + _c("p0"), "cum_neg": F.sum("neg").over(inside) + _c("n0")})


def _won_share() -> Column:
    """roc_auc, as an aggregate of _by_score."""
    won = F.sum(_c("pos") * (_c("all_neg") - _c("cum_neg") + _c("neg") / 2.0))
    p, n = F.first("all_pos"), F.first("all_neg")
    return F.when((p > 0) & (n > 0), won / (p * n)).otherwise(F.lit(0.5))


def _mean_precision() -> Column:
    """average_precision, as an aggregate of _by_score."""
    step = _c("pos") / _c("all_pos") * _c("cum_pos") / (_c("cum_pos") + _c("cum_neg"))
    return F.coalesce(F.sum(F.when(_c("all_pos") > 0, step)), F.lit(0.0))


def roc_auc(scored: DataFrame) -> DataFrame:
    """roc_auc of (prob in 0 to 1, label 0 or 1) with ties counted half; 0.5 if a class is missing."""
    return _by_score(scored).agg(_won_share().alias("roc_auc"))


def average_precision(scored: DataFrame) -> DataFrame:
    """average_precision: sum of recall steps times precision; 0 without positives."""
    return _by_score(scored).agg(_mean_precision().alias("average_precision"))


def evaluate_at_threshold(scored: DataFrame, truth: DataFrame, threshold: float = fixed.MATCH_THRESHOLD) -> DataFrame:
    """One row of entity and pair metrics of scored (s1_id, target_id, prob, label) at a threshold, rounded to 4."""
    m = anchor_metrics(truth, scored.filter(_c("prob") >= threshold).select("s1_id", "target_id"))
    entity = m.agg(
        F.avg("f_beta").alias("macro_f05"), F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
        _mean_if(_c("f_beta"), _c("n_true") == 1).alias("singleton_f05"), _mean_if(_c("f_beta"), _c("n_true") > 1).alias("multi_match_f05"),
        _mean_if(_c("exact_match").cast("double"), _c("n_true") == 0).alias("zero_match_accuracy"),
    )
    # Counts of pairs are sums over distinct scores, which both curves read as well: one aggregation of all rows.
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    chosen_if = lambda c: F.when(_c("prob") >= threshold, c).otherwise(F.lit(0))
    tp, chosen, pos = total(chosen_if(_c("pos"))), total(chosen_if(_c("pos") + _c("neg"))), total(_c("pos"))
    ratio = lambda a, b: F.when(b == 0, F.lit(0.0)).otherwise(a / b)
    pair = _by_score(scored).agg(ratio(tp, chosen).alias("pairwise_precision"), ratio(tp, pos).alias("pairwise_recall"), chosen.alias("predicted_match_count"), _won_share().alias("roc_auc"), _mean_precision().alias("pr_auc"))
    row = entity.join(pair, F.lit(True))
    names = ["macro_f05", "macro_precision", "macro_recall", "pairwise_precision", "pairwise_recall", "roc_auc", "pr_auc", "singleton_f05", "multi_match_f05", "zero_match_accuracy"]
    return row.select(F.lit(threshold).alias("threshold"), *(F.round(n, 4).alias(n) for n in names), "predicted_match_count")


#: What error_categories reads.
ERROR_FEATURES = [
    "name_token_jaccard", "addr_token_jaccard", "addr_normalized_exact", "addr_exact_number_match", "name_compact_exact",
    "view_dba_alias_match", "qual_has_legal_suffix", "name_edit_similarity", "qual_mixed_script_pair", "qual_addr_missing_t",
    "name_char_3gram_jaccard", "refine_composite_score",
]


def error_categories(scored: DataFrame, threshold: float = fixed.MATCH_THRESHOLD) -> DataFrame:
    """kind, category, n of wrong pairs: overlapping causes, and `other` for what their sum leaves.

    scored: features, label and prob.
    """
    wrong_yes, wrong_no = (_c("label") == 0) & (_c("prob") >= threshold), (_c("label") == 1) & (_c("prob") < threshold)
    name, addr = _c("name_token_jaccard"), _c("addr_token_jaccard")
    causes = {
        ("false_positive", "same_address_different_business"): (_c("addr_normalized_exact") == 1) & (name < 0.3),
        ("false_positive", "shared_commercial_complex"): (_c("addr_exact_number_match") == 1) & (name < 0.5),
        ("false_positive", "generic_name_collision"): (_c("name_compact_exact") == 1) & (addr < 0.2),
        ("false_positive", "dba_confusion"): _c("view_dba_alias_match") == 1,
        ("false_positive", "address_only_evidence"): (addr >= 0.7) & (name < 0.2),
        ("false_positive", "legal_suffix_collisions"): (_c("qual_has_legal_suffix") == 1) & (_c("name_edit_similarity") >= 0.6) & (addr < 0.3),
        ("false_negative", "cross_script_names"): _c("qual_mixed_script_pair") == 1,
        ("false_negative", "missing_address"): _c("qual_addr_missing_t") == 1,
        ("false_negative", "weak_address"): (addr < 0.2) & (_c("qual_addr_missing_t") == 0),
        ("false_negative", "brand_renames"): (name < 0.2) & (addr >= 0.6),
        ("false_negative", "severe_typos"): (name < 0.5) & (_c("name_char_3gram_jaccard") >= 0.3),
        ("false_negative", "borderline_refinement_score"): (_c("refine_composite_score") >= 0.15) & (_c("refine_composite_score") < 0.35),
    }
    of = {"false_positive": wrong_yes, "false_negative": wrong_no}
    sums = scored.agg(*(F.count_if(of[k] & v).alias(f"{k}:{c}") for (k, c), v in causes.items()), *(F.count_if(v).alias(k) for k, v in of.items()))
    for k in of:
        parts = [_c(f"`{k}:{c}`") for kk, c in causes if kk == k]
        sums = sums.withColumn(f"{k}:other", F.greatest(F.lit(0), _c(k) - sum(parts[1:], parts[0])))
    cols = [c for c in sums.columns if ":" in c]
    rows = F.explode(F.array(*(F.struct(F.lit(c.split(":")[0]).alias("kind"), F.lit(c.split(":")[1]).alias("category"), _c(f"`{c}`").cast("long").alias("n")) for c in cols)))
    return sums.select(rows.alias("r")).select("r.*")


def candidate_diagnostics(anchors: DataFrame, candidates: DataFrame, thresholds: Sequence[float] = (0.15, 0.25, 0.5, 0.7, 0.9)) -> DataFrame:
    """One row: distribution of candidates per anchor, quantiles of their scores, and how many reach each threshold.

    anchors: s1_id; candidates: s1_id, target_id, score.
    """
    per = anchors.select("s1_id").join(candidates.groupBy("s1_id").agg(F.count(F.lit(1)).alias("n")), "s1_id", "left").fillna(0, ["n"])
    counts = per.agg(
        F.avg("n").alias("mean"), *(F.percentile("n", F.lit(p)).alias(k) for k, p in (("median", 0.5), ("p90", 0.9), ("p95", 0.95), ("p99", 0.99))),
        F.max("n").alias("max"), F.avg((_c("n") == 0).cast("double")).alias("zero_share"),
    )
    scores = candidates.agg(
        F.count(F.lit(1)).alias("n_pairs"), *(F.percentile("score", F.lit(p / 100)).alias(f"score_p{p:02d}") for p in (1, 5, 25, 50, 75, 95, 99)),
        *(F.count_if(_c("score") >= t).alias(f"at_least_{round(100 * t)}") for t in thresholds),
    )
    return counts.join(scores, F.lit(True))
