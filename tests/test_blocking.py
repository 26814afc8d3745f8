import pytest
from helpers import entities

from kindred.operators import blocking, refine
from kindred.operators.normalize import normalized
from kindred.plans.pipeline import LinkageConfig, LinkagePipeline


def link(spark, anchors, targets, **config):
    return LinkagePipeline(entities(spark, anchors), entities(spark, targets), LinkageConfig(**config))


def test_union_of_strategies_with_provenance(spark):
    p = link(spark, [("S1-1", "Alpha Logistics", "12 Main St Springfield", "US")], [("S2-1", "Alpha Logistics", "99 Other Rd", "US"), ("S3-1", "Zeta Foods", "12 Main St Springfield", "US"), ("S3-2", "Omega", "7 Far", "US")])
    rows = {r["target_id"]: r["strategies"] for r in p.raw_pairs().collect()}
    assert set(rows) == {"S2-1", "S3-1"}
    assert {"exact_name", "sorted_name_tokens", "name_prefix_6", "name_leet_compact"} <= set(rows["S2-1"])
    assert rows["S3-1"] == ["address_exact_combo", "address_salient_combo"]


def test_countries_are_isolated(spark):
    p = link(spark, [("S1-1", "Alpha Logistics", "", "FRANCE")], [("S2-1", "Alpha Logistics", "", "INDIA")])
    assert p.raw_pairs().count() == 0


def test_alias_strategy_is_asymmetric(spark):
    only = {"strategies": ["name_dba_alias"]}
    assert link(spark, [("S1-1", "Orane Brothers", "", "US")], [("S2-1", "Ectonyla dba Orane Brothers Ltd", "", "US")], **only).raw_pairs().count() == 1
    assert link(spark, [("S1-1", "Ectonyla dba Orane Brothers Ltd", "", "US")], [("S2-1", "Orane Brothers", "", "US")], **only).raw_pairs().count() == 0


def test_block_cap_counts_target_entries(spark):
    targets = [(f"S2-{i}", "Subway", "", "US") for i in range(6)]
    anchors = [("S1-1", "Subway", "", "US")]
    assert link(spark, anchors, targets, max_block_size=6, strategies=["exact_name"]).raw_pairs().count() == 6
    assert link(spark, anchors, targets, max_block_size=5, strategies=["exact_name"]).raw_pairs().count() == 0
    twice = [("S2-1", "Foo Foo dba Foo Foo", "", "US")]  # the same alias twice is two entries
    alias = {"strategies": ["name_dba_alias"]}
    assert link(spark, [("S1-1", "Foo Foo", "", "US")], twice, max_block_size=2, **alias).raw_pairs().count() == 1
    assert link(spark, [("S1-1", "Foo Foo", "", "US")], twice, max_block_size=1, **alias).raw_pairs().count() == 0


def test_unknown_strategy(spark):
    with pytest.raises(ValueError):
        blocking.block_keys(normalized(entities(spark, [("S1-1", "a", "b", "c")])), ["nope"])


def test_cross_script_by_salient_address(spark):
    p = link(spark, [("S1-1", "शर्मा ट्रेडर्स", "Office No.18, Greater Noida", "IN")], [("S2-1", "Sharma Traders", "Office No. 18, Greater Noida", "IN")])
    assert "address_salient_combo" in p.raw_pairs().first()["strategies"]


def test_refinement_threshold_ties_and_k(spark):
    anchors = [("S1-1", "Subway", "1 Main", "US"), ("S1-2", "Nobody Here", "", "US")]
    targets = [(f"S2-{i}", "Subway", "1 Main", "US") for i in (5, 3, 9, 1)] + [("S3-1", "Subway Xylophone Zebra", "77 Elsewhere", "US")]
    p = link(spark, anchors, targets, top_k=3)
    got = [r["target_id"] for r in p.candidates().orderBy("rank").collect()]
    assert got == ["S2-5", "S2-3", "S2-9"]  # equal scores: the order of the targets
    wide = {r["source1_entity_id"]: r["candidate_entity_ids"] for r in p.candidate_lists().collect()}
    assert wide == {"S1-1": "S2-3,S2-5,S2-9", "S1-2": ""}
    low = link(spark, [("S1-1", "Alphabeta", "", "US")], [("S2-1", "Alphabetic Quizzical Jukebox Symphony", "", "US")], strategies=["name_prefix_6"], score_threshold=0.2)
    assert low.raw_pairs().count() == 1 and low.candidates().count() == 0


def test_country_conflict_scores_minus_one(spark):
    pairs = spark.createDataFrame([("S1-1", "S2-1", ["name_prefix_6"])], "s1_id string, target_id string, strategies array<string>")
    q, t = normalized(entities(spark, [("S1-1", "Alpha", "", "US")])), normalized(entities(spark, [("S2-1", "Alpha", "", "IN")]))
    assert refine.pair_scores(refine.with_views(pairs, q, t)).first()["score"] == -1.0


def test_plans_have_no_cartesian_product_and_limit_groups(spark):
    p = link(spark, [("S1-1", "Alpha", "", "US")], [("S2-1", "Alpha", "", "US")])
    plan = p.candidates()._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan and "WindowGroupLimit" in plan


def test_stream_of_anchors(spark, tmp_path):
    from kindred.streaming.anchors import link_stream

    anchors = entities(spark, [("S1-1", "Alpha Logistics", "", "US"), ("S1-2", "Beta", "", "US")])
    anchors.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(anchors.schema).parquet(str(tmp_path / "in"))
    q = link_stream(stream, entities(spark, [("S2-1", "Alpha Logistics", "", "US")]), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(60)
    assert [(r["s1_id"], r["target_id"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [("S1-1", "S2-1")]
