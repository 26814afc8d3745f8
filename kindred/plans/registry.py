"""Queries of the linkage operators over the entity view of documents, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions import fixed, text
from kindred.operators import blocking, diagnostics, features, metrics, model, normalize, profile, refine, split, validate
from kindred.plans import sql
from kindred.plans.pipeline import LinkageConfig, LinkagePipeline, one_anchor_per_target
from kindred.sources.tables import document_entities


def _c(name: str) -> Column:
    return F.col(name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


#: What the last query keeps in memory and on disk; the next one lets it go.
_KEPT: list[Callable[[], object]] = []


def _query(name: str, oracle: str | None = None):
    def put(f: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf: str) -> DataFrame:
            close()
            return f(spark, sf)

        QUERIES[name] = run
        if oracle is not None:
            ORACLE_SQL[name] = sql.with_views(oracle)
        return f

    return put


def close() -> None:
    """Frees the tables that the last query keeps. Its result can still be read; it is worked out anew then."""
    while _KEPT:
        _KEPT.pop()()


def _ents(spark: SparkSession, sf: str) -> DataFrame:
    return document_entities(spark, sf)


def _norm(spark: SparkSession, sf: str) -> DataFrame:
    return normalize.normalized(_ents(spark, sf))


def _pipe(spark: SparkSession, sf: str, **config) -> LinkagePipeline:
    e = _ents(spark, sf)
    p = LinkagePipeline(e.filter("source = 'S1'"), e.filter("source <> 'S1'"), LinkageConfig(**config))
    _KEPT.append(p.close)
    return p


def _joined(c: str) -> Column:
    return F.array_join(c, " ")


def _r(c: Column | str) -> Column:
    return F.round(c, 9)


def _truth_long(spark: SparkSession, sf: str) -> DataFrame:
    """Pseudo truth: records of different sources whose names and addresses are equal but for their case."""
    same = ["name", "address"]
    e = _ents(spark, sf).select("entity_id", "source", F.lower("business_name").alias("name"), F.lower("business_address").alias("address"))
    a, b = e.filter("source = 'S1'"), e.filter("source <> 'S1'")
    return a.select(_c("entity_id").alias("s1_id"), *same).join(b.select(_c("entity_id").alias("target_id"), *same), same).select("s1_id", "target_id")


def _truth(spark: SparkSession, sf: str) -> DataFrame:
    anchors = _ents(spark, sf).filter("source = 'S1'").select(_c("entity_id").alias("s1_id"))
    return metrics.wide(anchors, _truth_long(spark, sf), "targets")


def _links(p: LinkagePipeline) -> DataFrame:
    """_truth_long from a pipeline's records, which it keeps: equal texts by 128 bits of hash, so no text is dealt again."""

    def hashed(records: DataFrame, id_col: str) -> DataFrame:
        texts = F.lower("name_raw"), F.lit("\x1f"), F.lower("addr_raw")
        return records.select(_c("entity_id").alias(id_col), F.xxhash64(*texts).alias("h1"), F.xxhash64(F.lit("2"), *texts).alias("h2"))

    return hashed(p.anchors, "s1_id").join(hashed(p.targets, "target_id"), ["h1", "h2"]).select("s1_id", "target_id")


def _linked(p: LinkagePipeline) -> DataFrame:
    """_truth from a pipeline's records."""
    return metrics.wide(p.anchors.select(_c("entity_id").alias("s1_id")), _links(p), "targets")


# Normalisation: one view each.
_VIEWS: dict[str, tuple[Callable[[], Column], str]] = {
    "norm_name": (lambda: _c("name_norm"), "name_norm"),
    "norm_compact": (lambda: _c("name_compact"), "name_compact"),
    "norm_tokens": (lambda: _joined("name_tokens"), "array_to_string(name_tokens, ' ')"),
    "norm_sorted_tokens": (lambda: _c("name_sorted"), "name_sorted"),
    "norm_ngrams": (lambda: F.array_join(F.array_sort("name_grams"), "|"), "array_to_string(list_sort(name_grams), '|')"),
    "norm_leet": (lambda: _c("leet_compact"), "leet_compact"),
    "norm_dba": (lambda: F.array_join("dba_compacts", "|"), "array_to_string(dba_compacts, '|')"),
    "norm_address": (lambda: _c("addr_norm"), "addr_norm"),
    "addr_tokens": (lambda: _joined("addr_tokens"), "array_to_string(addr_tokens, ' ')"),
    "addr_numbers": (lambda: F.array_join(F.array_sort("addr_numbers"), " "), "array_to_string(list_sort(addr_numbers), ' ')"),
    "addr_salient": (lambda: _joined("addr_salient"), "array_to_string(addr_salient, ' ')"),
    "norm_country": (lambda: _c("country"), "country"),
}
for _name, (_view, _sql) in _VIEWS.items():
    _query(_name, f"SELECT entity_id, coalesce({_sql}, '') AS value FROM norm")(lambda spark, sf, view=_view: _norm(spark, sf).select("entity_id", view().alias("value")))


@_query("norm_accents", "SELECT entity_id, name_fold AS value FROM folded")
def _(spark, sf):
    return _ents(spark, sf).select("entity_id", text.fold_accents("business_name").alias("value"))


@_query("norm_legal_suffix", f"SELECT entity_id, regexp_replace(lower(name_fold), '{sql.LEGAL}', ' ', 'gi') AS value FROM folded")
def _(spark, sf):
    return _ents(spark, sf).select("entity_id", normalize.without_legal(F.lower(text.fold_accents("business_name"))).alias("value"))


@_query("norm_url", sql.URL_ORACLE)
def _(spark, sf):
    p = spark.read.parquet(f"{sf}/pages.parquet")
    return p.select("page_id", F.regexp_replace(F.regexp_replace(F.lower("url"), "(?i)" + fixed.URL_PREFIX, ""), "(?i)" + fixed.DOMAIN_SUFFIX, "").alias("value"))


# Blocking.
for _s in fixed.STRATEGIES:
    _query(f"key_{_s}", f"SELECT entity_id, key FROM qkeys WHERE strategy = '{_s}'")(lambda spark, sf, s=_s: blocking.block_keys(_norm(spark, sf).filter("source = 'S1'"), [s], True).select("entity_id", "key"))


@_query("block_sizes", "SELECT strategy, key, count(*) AS n FROM tkeys GROUP BY strategy, key")
def _(spark, sf):
    return blocking.block_sizes(blocking.block_keys(_norm(spark, sf).filter("source <> 'S1'")))


@_query("block_pairs", "SELECT s1_id, strategy, key, target_id FROM matches")
def _(spark, sf):
    n = _norm(spark, sf)
    q, t = blocking.block_keys(n.filter("source = 'S1'"), is_query=True), blocking.block_keys(n.filter("source <> 'S1'"))
    return blocking.block_pairs(q, t).select("s1_id", "strategy", "key", "target_id")


@_query("block_cap", sql.capped(5))
def _(spark, sf):
    return _pipe(spark, sf, max_block_size=5).raw_pairs().select("s1_id", "target_id", F.array_join("strategies", ",").alias("strategies"))


@_query("pair_provenance", "SELECT s1_id, target_id, array_to_string(strategies, ',') AS strategies, array_to_string(first_rank, ',') AS first_rank FROM pairs")
def _(spark, sf):
    return _pipe(spark, sf).raw_pairs().select("s1_id", "target_id", F.array_join("strategies", ",").alias("strategies"), F.concat_ws(",", "first_rank.strategy_ord", "first_rank.key_ord", "first_rank.target_seq").alias("first_rank"))


@_query("strategy_contribution", "SELECT strategy, count(*) AS n_pairs FROM (SELECT unnest(strategies) AS strategy FROM pairs) GROUP BY strategy")
def _(spark, sf):
    return blocking.strategy_contribution(_pipe(spark, sf).raw_pairs())


@_query("zero_candidate_anchors", "SELECT entity_id FROM norm WHERE source = 'S1' AND entity_id NOT IN (SELECT s1_id FROM pairs)")
def _(spark, sf):
    p = _pipe(spark, sf)
    return p.anchors.select("entity_id").join(p.raw_pairs().select(_c("s1_id").alias("entity_id")), "entity_id", "left_anti")


@_query("country_counts", "SELECT country, count(*) AS n FROM norm WHERE source = 'S1' GROUP BY country")
def _(spark, sf):
    return _norm(spark, sf).filter("source = 'S1'").groupBy("country").agg(F.count(F.lit(1)).alias("n"))


# Refinement.
@_query("pair_score", "SELECT s1_id, target_id, round(score, 9) AS score FROM scored")
def _(spark, sf):
    return _pipe(spark, sf).scored_pairs().select("s1_id", "target_id", _r("score").alias("score"))


@_query("topk_candidates", "SELECT s1_id, target_id, round(score, 9) AS score, rank FROM ranked WHERE rank <= 50")
def _(spark, sf):
    return _pipe(spark, sf).candidates().select("s1_id", "target_id", _r("score").alias("score"), "rank")


@_query("topk_three", "SELECT s1_id, target_id, rank FROM ranked WHERE rank <= 3")
def _(spark, sf):
    return _pipe(spark, sf, top_k=3).candidates().select("s1_id", "target_id", "rank")


@_query("candidate_pairs_wide", sql.WIDE)
def _(spark, sf):
    return _pipe(spark, sf).candidate_lists()


@_query("k_sensitivity", sql.K_SENSITIVITY)
def _(spark, sf):
    out = diagnostics.k_sensitivity(_truth_long(spark, sf), refine.ranked(_pipe(spark, sf).scored_pairs()), (1, 2, 50, 75, 100, 150))
    return out.withColumn("recall", _r("recall"))


@_query("ablation_strategies", sql.ABLATION)
def _(spark, sf):
    truth = _truth(spark, sf)
    out = None
    for name in ("EXP-001", "EXP-002", "EXP-003"):
        p = _pipe(spark, sf, strategies=diagnostics.EXPERIMENTS[name][0])
        row = metrics.anchor_coverage(truth, p.raw_pairs()).agg(F.sum("n_candidates").alias("n_pairs"), F.sum("captured").alias("captured")).select(F.lit(name).alias("experiment"), "n_pairs", "captured")
        out = row if out is None else out.union(row)
    return out


# String metrics, over candidate pairs.
_METRICS = {
    "jaccard_tokens": "name_token_jaccard",
    "char_ngram_jaccard": "name_char_3gram_jaccard",
    "edit_similarity": "name_whole_edit_similarity",
    "prefix_similarity": "name_prefix_similarity",
    "suffix_similarity": "name_suffix_similarity",
    "containment": "refine_containment",
}
for _name, _feature in _METRICS.items():
    _query(_name, sql.WHOLE_EDIT if _name == "edit_similarity" else f"SELECT s1_id, target_id, round({_feature}, 9) AS value FROM feats")(
        lambda spark, sf, f=_feature: _pipe(spark, sf).features(columns=[f]).select(_c("source1_entity_id").alias("s1_id"), _c("target_entity_id").alias("target_id"), _r(f).alias("value"))
    )


@_query("non_latin", "SELECT entity_id, regexp_matches(name_raw, '[\\x{0250}-\\x{10FFFF}]') AND regexp_matches(regexp_replace(name_raw, '[\\x{0000}-\\x{024F}]', '', 'g'), '\\pL') AS value FROM norm")
def _(spark, sf):
    return _ents(spark, sf).select("entity_id", text.has_non_latin(F.coalesce("business_name", F.lit(""))).alias("value"))


# Features by group; frequencies from the anchors.
def _features(spark, sf, columns: Sequence[str] = fixed.FEATURES) -> DataFrame:
    p = _pipe(spark, sf)
    return p.features(features.FrequencyStore(p.anchors), columns=columns)


for _g, _cols in fixed.FEATURE_GROUPS.items():
    _list = ", ".join(f"round({c}, 9) AS {c}" for c in _cols)
    _query(f"feat_{_g}", f"SELECT s1_id AS source1_entity_id, target_id AS target_entity_id, {_list} FROM feats")(lambda spark, sf, cols=_cols: _features(spark, sf, cols).select("source1_entity_id", "target_entity_id", *(_r(c).alias(c) for c in cols)))


@_query("feat_all_labelled", f"SELECT s1_id AS source1_entity_id, target_id AS target_entity_id, target_source, label, {', '.join(f'round({c}, 9) AS {c}' for c in fixed.FEATURES)} FROM labelled")
def _(spark, sf):
    p = _pipe(spark, sf)
    rows = features.labelled_by_anchor(p.features(features.FrequencyStore(p.anchors)), _linked(p))
    return rows.select("source1_entity_id", "target_entity_id", "target_source", "label", *(_r(c).alias(c) if c in fixed.FRACTIONS else c for c in fixed.FEATURES))


# Metrics. Matches: candidates with a score of 0.5 or more; their probability is the composite score.
def _predicted(spark, sf) -> DataFrame:
    return _pipe(spark, sf).candidates().filter("score >= 0.5").select("s1_id", "target_id")


def _scored(spark, sf, columns: Sequence[str] = fixed.FEATURES) -> DataFrame:
    f = features.labelled(_features(spark, sf, list(dict.fromkeys([*columns, "refine_composite_score"]))), _truth_long(spark, sf))
    return f.withColumns({"s1_id": _c("source1_entity_id"), "target_id": _c("target_entity_id"), "prob": F.round("refine_composite_score", 6)})


def _judged(p: LinkagePipeline, truth: DataFrame) -> DataFrame:
    """s1_id, target_id, prob, label of candidates, for metrics that read no feature: a candidate's score is its composite
    score. Candidates are dealt by anchor already, where wide truth meets them."""
    rows = p.candidates().select("s1_id", "target_id", F.round("score", 6).alias("prob")).join(truth, "s1_id")
    return rows.select("s1_id", "target_id", "prob", F.array_contains("targets", _c("target_id")).cast("int").alias("label"))


def _kept_rows(rows: DataFrame) -> DataFrame:
    """Rows that are worked out once and kept until the next query."""
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    _KEPT.append(kept.unpersist)
    return kept


def _curve_rows(p: LinkagePipeline) -> DataFrame:
    """prob, label of candidates, kept: a curve reads them for its blocks of scores and within these."""
    return _kept_rows(_judged(p, _linked(p)).select("prob", "label"))


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*(_r(c).alias(c) if t == "double" else _c(c) for c, t in df.dtypes))


@_query("f05_per_anchor", sql.PER_ANCHOR)
def _(spark, sf):
    return _rounded(metrics.anchor_metrics(_truth(spark, sf), _predicted(spark, sf))).drop("n_true")


@_query("f05_macro", sql.MACRO)
def _(spark, sf):
    return _rounded(metrics.evaluate_predictions(_truth(spark, sf), _predicted(spark, sf)))


@_query("blocking_metrics", sql.BLOCKING)
def _(spark, sf):
    return _rounded(metrics.evaluate_candidate_blocking(_truth(spark, sf), _pipe(spark, sf).candidates()))


@_query("candidate_count_dist", "SELECT n_candidates, count(*) AS anchors FROM coverage GROUP BY n_candidates")
def _(spark, sf):
    return metrics.anchor_coverage(_truth(spark, sf), _pipe(spark, sf).candidates()).groupBy("n_candidates").agg(F.count(F.lit(1)).alias("anchors"))


@_query("recall_by_country", "SELECT country AS grp, sum(links)::BIGINT AS links, sum(captured)::BIGINT AS captured, round(CASE WHEN sum(links) = 0 THEN 1.0 ELSE sum(captured) / sum(links) END, 9) AS recall FROM coverage JOIN norm ON s1_id = entity_id GROUP BY country")
def _(spark, sf):
    p = _pipe(spark, sf)
    groups = p.anchors.select(_c("entity_id").alias("s1_id"), _c("country").alias("grp"))
    return _rounded(metrics.recall_by(_truth(spark, sf), p.candidates(), groups))


@_query("recall_by_bucket", "SELECT CASE WHEN links >= 5 THEN '5+' ELSE links::VARCHAR END AS grp, sum(links)::BIGINT AS links, sum(captured)::BIGINT AS captured, round(sum(captured) / sum(links), 9) AS recall FROM coverage WHERE links > 0 GROUP BY 1")
def _(spark, sf):
    return _rounded(metrics.recall_by(_truth(spark, sf), _pipe(spark, sf).candidates()))


@_query("reduction_ratio", sql.REDUCTION)
def _(spark, sf):
    p = _pipe(spark, sf)
    return _rounded(metrics.reduction(p.anchors, p.candidates(), 10_320_219))


@_query("false_negatives", sql.FALSE_NEGATIVES)
def _(spark, sf):
    return diagnostics.false_negatives(_truth_long(spark, sf), _pipe(spark, sf, strategies=["address_salient_combo"]).raw_pairs(), _ents(spark, sf))


@_query("loss_attribution", sql.LOSS)
def _(spark, sf):
    p = _pipe(spark, sf, strategies=["name_address_combo", "name_prefix_6"], top_k=1, score_threshold=0.9)
    s = p.scored_pairs()
    return diagnostics.loss_attribution(_truth_long(spark, sf), p.targets, p.raw_pairs(), s, refine.top_k(s, 1, 0.9), 0.9)


@_query("threshold_sweep", sql.SWEEP)
def _(spark, sf):
    return _rounded(metrics.threshold_sweep(_scored(spark, sf), _truth(spark, sf)))


@_query("recall_ceilings", sql.CEILINGS)
def _(spark, sf):
    return metrics.recall_ceilings(_truth(spark, sf), _scored(spark, sf))


@_query("error_categories", sql.ERRORS)
def _(spark, sf):
    return metrics.error_categories(_scored(spark, sf, metrics.ERROR_FEATURES))


@_query("roc_auc", sql.ROC)
def _(spark, sf):
    return _rounded(metrics.roc_auc(_curve_rows(_pipe(spark, sf))))


@_query("average_precision", sql.AP)
def _(spark, sf):
    return _rounded(metrics.average_precision(_curve_rows(_pipe(spark, sf))))


@_query("feature_audit", sql.AUDIT)
def _(spark, sf):
    return _rounded(profile.feature_audit(_scored(spark, sf), fixed.FEATURES)).select("feature", "n_unique", "min", "max", "mean", "median", "std", "is_constant", F.round("label_correlation", 6).alias("label_correlation"))


@_query("label_correlation", sql.TOP_CORRELATION)
def _(spark, sf):
    a = profile.feature_audit(_scored(spark, sf), fixed.FEATURES)
    return a.select("feature", F.round(F.abs("label_correlation"), 4).alias("r")).orderBy(F.desc("r"), "feature").limit(10)


@_query("candidate_diagnostics", sql.DIAGNOSTICS)
def _(spark, sf):
    p = _pipe(spark, sf)
    return _rounded(metrics.candidate_diagnostics(p.anchors.select(_c("entity_id").alias("s1_id")), p.candidates().withColumn("score", F.round("score", 6))))


@_query("one_anchor_per_target", "SELECT s1_id, target_id, round(score, 9) AS prob FROM (SELECT *, row_number() OVER (PARTITION BY target_id ORDER BY round(score, 9) DESC, s1_id) AS k FROM cands) WHERE k = 1")
def _(spark, sf):
    return one_anchor_per_target(_pipe(spark, sf).candidates().select("s1_id", "target_id", _r("score").alias("prob")))


# Splits, profiles, checks.
@_query("split_md5", sql.SPLIT)
def _(spark, sf):
    return split.split_by_hash(_ents(spark, sf).filter("source = 'S1'"))


@_query("distractor_sample", sql.DISTRACTORS)
def _(spark, sf):
    e = _ents(spark, sf).filter("source <> 'S1'")
    return split.with_distractors(e, _truth_long(spark, sf), 50).select("entity_id", "source")


@_query("source_profile", sql.PROFILE)
def _(spark, sf):
    return _rounded(profile.source_profile(_ents(spark, sf)))


@_query("country_distribution", "SELECT source, country, count(*) AS n FROM ents GROUP BY source, country")
def _(spark, sf):
    return profile.country_distribution(_ents(spark, sf))


@_query("gt_histogram", "SELECT len(targets) AS n_matches, len(list_filter(targets, lambda x: starts_with(x, 'S2'))) AS n_s2, len(list_filter(targets, lambda x: starts_with(x, 'S3'))) AS n_s3, count(*) AS anchors FROM truth GROUP BY 1, 2, 3")
def _(spark, sf):
    return profile.truth_histogram(_truth(spark, sf))


@_query("gt_summary", sql.GT_SUMMARY)
def _(spark, sf):
    return profile.truth_summary(_truth(spark, sf))


@_query("id_overlap", "SELECT (SELECT count(DISTINCT o_custkey) FROM orders) AS n_a, (SELECT count(DISTINCT c_custkey) FROM customer) AS n_b, (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer)) AS n_both")
def _(spark, sf):
    a = spark.read.parquet(f"{sf}/orders.parquet").select(_c("o_custkey").alias("entity_id"))
    return profile.id_overlap(a, spark.read.parquet(f"{sf}/customer.parquet").select(_c("c_custkey").alias("entity_id")))


@_query("validate_violations", sql.VIOLATIONS)
def _(spark, sf):
    """Result files with known faults: candidates of one strategy, matches of all, two anchors' lines swapped, and an
    id that no target has. A record's number is its line."""
    p = _pipe(spark, sf, strategies=["exact_name"])
    s1 = _c("source1_entity_id")
    line = F.when(s1 == "S1-0", 1).when(s1 == "S1-1", 0).otherwise(F.regexp_extract(s1, r"\d+$", 0).cast("long"))
    file = lambda df, c: df.withColumns({"line": line, c: F.when(s1 == "S1-0", F.concat_ws(",", F.when(_c(c) != "", _c(c)), F.lit("S2-unknown"))).otherwise(_c(c))})
    wide = file(refine.per_anchor(p.anchors, p.raw_pairs(), "candidate_entity_ids"), "candidate_entity_ids")
    found = file(refine.per_anchor(p.anchors, _truth_long(spark, sf), "matched_entity_ids"), "matched_entity_ids")
    out = validate.violations(wide, found, p.anchors, p.targets)
    return out.withColumn("detail", F.when(_c("rule") != "match_not_in_candidates", _c("detail")))


# Models, at their full sizes.
def _model_scores(kind: str, columns: Sequence[str] = fixed.FEATURES, **options):
    def run(spark, sf):
        rows = _kept_rows(_scored(spark, sf).drop("prob"))
        fitted = model.train(rows, kind, columns, **options)
        return model.predict(fitted, rows).select("s1_id", "target_id", "label", F.round("prob", 6).alias("prob"))

    return run


for _name, _kind in (("lr", "logistic"), ("rf", "random_forest"), ("gbt", "hist_gradient_boosting"), ("extra_trees", "extra_trees")):
    _query(f"model_{_name}_scores")(_model_scores(_kind))
_query("model_lr_balanced_scores")(_model_scores("logistic", balanced=True))


@_query("model_at_threshold")
def _(spark, sf):
    """Entity and pair metrics of the logistic model at the decision threshold."""
    scored = _model_scores("logistic")(spark, sf)
    return metrics.evaluate_at_threshold(scored, _truth(spark, sf))


@_query("model_ablations")
def _(spark, sf):
    """Each feature subset of the ablation experiments: its size, and its best threshold by macro F0.5."""
    rows = _kept_rows(_scored(spark, sf).drop("prob"))
    return model.run_ablations(rows, _truth(spark, sf), "logistic")


@_query("evaluate_at_threshold", sql.AT_THRESHOLD)
def _(spark, sf):
    p = _pipe(spark, sf)
    truth = _linked(p)
    return metrics.evaluate_at_threshold(_kept_rows(_judged(p, truth)), truth)


@_query("correlated_pairs", sql.CORRELATED)
def _(spark, sf):
    return profile.correlated_pairs(_features(spark, sf, fixed.FEATURE_GROUPS["name"]), fixed.FEATURE_GROUPS["name"], 0.9).select("a", "b", F.round("r", 6).alias("r"))


@_query("malformed_lines", "SELECT count(*) AS n_lines, count(*) FILTER (len(string_split(line, '|')) <> 1) AS n_malformed FROM source_lines")
def _(spark, sf):
    """Lines of the documents, with a bar in the place of the tab."""
    lines = spark.read.parquet(f"{sf}/documents.parquet").select(F.explode(F.split("text", "\n", -1)).alias("line"))
    return profile.malformed_lines(lines.select(F.translate("line", "|", "\t").alias("value")), 1)


@_query("baseline_candidates", "SELECT entity_id AS source1_entity_id, 0 AS n_candidates FROM ents WHERE source = 'S1'")
def _(spark, sf):
    return refine.empty_candidates(_ents(spark, sf).filter("source = 'S1'")).select("source1_entity_id", F.size("candidates").alias("n_candidates"))


@_query("experiments", sql.EXPERIMENTS)
def _(spark, sf):
    """The retrieval experiments: every set of strategies, with and without refinement."""
    p = _pipe(spark, sf)
    return _rounded(diagnostics.run_experiments(p.anchors, p.targets, _linked(p)))


@_query("pipeline_matches")
def _(spark, sf):
    p = _pipe(spark, sf)
    store = features.FrequencyStore(p.anchors)
    rows = _kept_rows(features.labelled(p.features(store), _truth_long(spark, sf)))
    return p.match_lists(model.train(rows, "logistic"), store)
