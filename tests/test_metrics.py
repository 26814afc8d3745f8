import math

import pytest

from kindred.operators import diagnostics, metrics, profile, split, validate


def truth_of(spark, d):
    return spark.createDataFrame([(k, sorted(v)) for k, v in d.items()], "s1_id string, targets array<string>")


def pairs_of(spark, d):
    return spark.createDataFrame([(k, t) for k, v in d.items() for t in v], "s1_id string, target_id string")


@pytest.mark.parametrize(
    ("true", "found", "want"),
    [({"S2-1", "S3-1"}, {"S2-1", "S3-1"}, (1, 1, 1)), (set(), set(), (1, 1, 1)), (set(), {"S2-1"}, (0, 0, 0)), ({"S2-1"}, set(), (0, 0, 0)), ({"S2-1", "S2-2"}, {"S2-1"}, (1, 0.5, 5 / 6)), ({"S2-1"}, {"S2-1", "S2-2"}, (0.5, 1, 5 / 9))],
)
def test_anchor_metrics(spark, true, found, want):
    r = metrics.anchor_metrics(truth_of(spark, {"S1-1": true}), pairs_of(spark, {"S1-1": found})).first()
    assert (r["precision"], r["recall"]) == want[:2] and math.isclose(r["f_beta"], want[2])


def test_macro(spark):
    truth = {"S1-1": {"S2-1"}, "S1-2": set(), "S1-3": {"S2-2", "S3-3"}}
    r = metrics.evaluate_predictions(truth_of(spark, truth), pairs_of(spark, {"S1-1": {"S2-1"}, "S1-3": {"S2-2"}, "S1-9": {"S2-7"}})).first()
    assert math.isclose(r["macro_f05"], (1 + 1 + 5 / 6) / 3) and math.isclose(r["exact_match_accuracy"], 2 / 3)
    assert (r["total_tp"], r["total_fp"], r["total_fn"], r["singleton_count"], r["singleton_accuracy"]) == (2, 0, 1, 1, 1)
    assert metrics.evaluate_predictions(truth_of(spark, {}), pairs_of(spark, {})).first()["macro_f05"] == 0


def test_blocking_metrics(spark):
    truth = {"S1-1": {"S2-1", "S3-1"}, "S1-2": {"S2-2"}, "S1-3": set()}
    cands = pairs_of(spark, {"S1-1": {"S2-1", "S3-1", "S3-7"}})
    r = metrics.evaluate_candidate_blocking(truth_of(spark, truth), cands).first()
    assert math.isclose(r["candidate_recall_overall"], 2 / 3) and (r["candidate_recall_s2"], r["candidate_recall_s3"], r["s1_coverage"]) == (0.5, 1, 0.5)
    assert (r["candidate_max"], r["candidate_min"], r["singleton_pct_clean_zero_cands"]) == (3, 0, 100)
    by = {x["grp"]: x["recall"] for x in metrics.recall_by(truth_of(spark, truth), cands).collect()}
    assert by == {"1": 0, "2": 1}
    assert metrics.reduction(truth_of(spark, truth), cands, 10).first()["reduction_ratio"] == 10
    assert metrics.reduction(truth_of(spark, truth), pairs_of(spark, {}), 10).first()["reduction_ratio"] == math.inf


def test_ceilings_sweep_and_curves(spark):
    truth = truth_of(spark, {"S1-1": {"S2-1", "S2-2", "S2-3"}})
    scored = spark.createDataFrame([("S1-1", "S2-1", 0.9, 1), ("S1-1", "S2-2", 0.2, 1), ("S1-1", "S2-8", 0.5, 0)], "s1_id string, target_id string, prob double, label int")
    r = metrics.recall_ceilings(truth, scored).first()
    assert (r["candidate_generation_recall_ceiling_pct"], r["model_recall_within_candidates_pct"], r["final_end_to_end_recall_pct"]) == (66.67, 50.0, 33.33)
    sweep = metrics.threshold_sweep(scored, truth).orderBy("threshold").collect()
    assert len(sweep) == 19 and sum(x["is_best"] for x in sweep) == 1
    assert metrics.roc_auc(scored).first()[0] == 0.5
    assert math.isclose(metrics.average_precision(scored).first()[0], 0.5 * 1 + 0.5 * 2 / 3)
    none = scored.filter("label = 7")
    assert metrics.roc_auc(none).first()[0] == 0.5 or metrics.roc_auc(none).first()[0] is None
    row = metrics.evaluate_at_threshold(scored, truth, 0.7).first()
    assert (row["pairwise_precision"], row["pairwise_recall"], row["predicted_match_count"]) == (1, 0.5, 1)


def test_ties_in_roc(spark):
    s = spark.createDataFrame([(0.5, 1), (0.5, 0), (0.9, 1), (0.1, 0)], "prob double, label int")
    assert metrics.roc_auc(s).first()[0] == 0.875


def test_split(spark):
    ids = spark.createDataFrame([(f"S1-{i}",) for i in range(1000)], "entity_id string")
    rows = {r[0]: r[1] for r in split.split_by_hash(ids).collect()}
    assert sum(rows.values()) == 200 and rows == {r[0]: r[1] for r in split.split_by_hash(ids.repartition(7)).collect()}
    assert rows != {r[0]: r[1] for r in split.split_by_hash(ids, seed=7).collect()}
    train, val = split.split_by_shuffle([f"S1-{i}" for i in range(1000)])
    assert len(val) == 200 and not set(train) & set(val)
    for bad in (0, 1, 1.5):
        with pytest.raises(ValueError):
            split.split_by_hash(ids, bad)


def test_loss_and_k(spark):
    truth = pairs_of(spark, {"S1-1": ["S2-1", "S2-2", "S2-3", "S2-4", "S2-9"]})
    pool = spark.createDataFrame([(f"S2-{i}",) for i in (1, 2, 3, 4)], "entity_id string")
    scored = spark.createDataFrame([("S1-1", "S2-1", 0.9), ("S1-1", "S2-2", 0.1), ("S1-1", "S2-3", 0.8)], "s1_id string, target_id string, score double")
    got = {r["stage"]: r["n"] for r in diagnostics.loss_attribution(truth, pool, scored, scored, pairs_of(spark, {"S1-1": ["S2-1"]})).collect()}
    assert got == {"OTHER": 1, "BLOCKING_MISS": 1, "REFINEMENT_MISS": 1, "TOP_K_MISS": 1}
    ranked = spark.createDataFrame([("S1-1", "S2-1", 1), ("S1-1", "S2-3", 60)], "s1_id string, target_id string, rank int")
    assert [(r["k"], r["captured"]) for r in diagnostics.k_sensitivity(truth, ranked).orderBy("k").collect()] == [(50, 1), (75, 2), (100, 2), (150, 2)]


def files(spark, cands, found):
    make = lambda rows, c: spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"line int, source1_entity_id string, {c} string")
    s1 = spark.createDataFrame([("S1-1",), ("S1-2",)], "entity_id string")
    pool = spark.createDataFrame([("S2-1",), ("S3-1",)], "entity_id string")
    out = validate.violations(make(cands, "candidate_entity_ids"), make(found, "matched_entity_ids"), s1, pool).collect()
    return {r["rule"] for r in out}


def test_validator(spark):
    good = [("S1-1", "S2-1,S3-1"), ("S1-2", "")]
    assert files(spark, good, [("S1-1", "S2-1"), ("S1-2", "")]) == set()
    assert files(spark, good, [("S1-1", ""), ("S1-2", "S2-1")]) == {"match_not_in_candidates"}
    assert "candidates_self_match" in files(spark, [("S1-1", "S1-2"), ("S1-2", "")], good[:0] + [("S1-1", ""), ("S1-2", "")])
    assert "candidates_unknown_target" in files(spark, [("S1-1", "S2-77"), ("S1-2", "")], [("S1-1", ""), ("S1-2", "")])
    assert {"candidates_not_sorted", "lines_differ"} <= files(spark, good[::-1], [("S1-1", ""), ("S1-2", "")])
    assert {"matches_missing_s1", "lines_differ"} <= files(spark, good, [("S1-1", "")])
    assert "candidates_duplicate_s1" in files(spark, [*good, ("S1-2", "")], [("S1-1", ""), ("S1-2", "")])
    assert "candidates_duplicate_ids" in files(spark, [("S1-1", "S2-1,S2-1"), ("S1-2", "")], [("S1-1", ""), ("S1-2", "")])
    assert validate.check_headers(spark.createDataFrame([], "a string"), spark.createDataFrame([], "source1_entity_id string, matched_entity_ids string")) != []


def test_profiles(spark):
    t = truth_of(spark, {"S1-1": {"S2-1", "S3-1"}, "S1-2": {"S2-1"}, "S1-3": set()})
    assert profile.truth_summary(t).first().asDict() == {"zero": 1, "single": 1, "multi": 1, "links": 3, "unique_targets": 2, "multi_anchor_targets": 1}
    f = spark.createDataFrame([(1.0, 2.0, 0.0, 1), (2.0, 4.0, 0.0, 0), (3.0, 6.0, 0.0, 1)], "a double, b double, c double, label int")
    audit = {r["feature"]: r for r in profile.feature_audit(f, ["a", "b", "c"]).collect()}
    assert audit["c"]["is_constant"] and not audit["a"]["is_constant"] and audit["b"]["median"] == 4
    assert [(r["a"], r["b"]) for r in profile.correlated_pairs(f, ["a", "b", "c"]).collect()] == [("a", "b")]
