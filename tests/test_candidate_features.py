import pytest
from helpers import entities
from pyspark.sql import functions as F

from kindred.functions import fixed
from kindred.operators import blockwise, diagnostics, metrics, normalize, pairvalues, refine
from kindred.operators.features import FrequencyStore, labelled, labelled_by_anchor, pair_features
from kindred.plans import registry
from kindred.plans.pipeline import LinkagePipeline


def _rows(df):
    return sorted(map(tuple, df.collect()))


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.fixture
def odd(spark):
    names = [("Foo Foo dba Foo Foo", "1 a High Street 12345"), ("Bar t/a Foo Foo", ""), ("é Café The", "7 é 007"), ("ab", "12345 ab"), ("", "12 High St 12"), ("M/S Foo Foo", None), ("x" * 90, "5 5 5"), ("\U0001d4b3 Foo Foo Ltd", "1 a"), (None, None), ("@r0yal Foods", "9 Elm Street"), ("royal foods", "9 elm st 12345-6789"), ("www.foo-foo.com", "शर्मा 1 a Nagar")]
    q = entities(spark, [(f"S1-{i}", *names[i % len(names)], ["US", "", None][i % 3]) for i in range(48)])
    t = entities(spark, [(f"S{2 + i % 3}-{i}", *names[i % len(names)], ["US", ""][i % 2]) for i in range(36)])
    p = LinkagePipeline(q, t)
    yield p
    p.close()


def test_values_in_blocks_are_those_of_joins(odd, monkeypatch):
    monkeypatch.setattr(pairvalues, "CHARACTERS_AT_ONCE", 64)
    store = FrequencyStore(odd.anchors)
    joined = pair_features(odd.candidates(), odd.anchors, odd.targets, store).cache()
    assert joined.count() > 50
    assert _rows(odd.features(store)) == _rows(joined)
    for columns in [["refine_containment"], fixed.FEATURE_GROUPS["cross"], metrics.ERROR_FEATURES]:
        ids = ["source1_entity_id", "target_entity_id", "target_source"]
        assert _rows(odd.features(store, columns=columns)) == _rows(joined.select(*ids, *columns))


@pytest.mark.parametrize("name", ["containment", "error_categories", "correlated_pairs", "feat_name", "feat_address", "feat_cross", "feat_quality", "feat_frequency"])
def test_no_candidate_joins_texts(spark, sf, name):
    """F10, F11, F12, F19 to F23: before, each candidate was joined with all views of both records it needs."""
    plan = _plan(registry.QUERIES[name](spark, sf))
    assert "t_name_norm" not in plan and "t_name_compact" not in plan and "t_name_tokens" not in plan and "t_addr_norm" not in plan and "t_a4" not in plan
    assert "MapInArrow" in plan
    registry.close()


def test_legal_forms_are_found_where_they_were(spark):
    """One pattern with what all begin with tested once matches as its alternatives did."""
    names = ["Acme L.L.C. of x", "acme ınc.", "ſ.a.r.l. x", "Kompany co.x", "nv", "a.g", "sas sasu s.a.s.u.", "éco inc", "pvt.  ltd", "gmbh&co", "x_inc", "société anonyme", "s.a", "SA.S", "limited liability company", "inc1", "l.l.p", "", "ag bv nv gie"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    before = "(?iU)" + "|".join(fixed.LEGAL_SUFFIXES)
    out = df.select("n", F.regexp_replace("n", before, " ").alias("a"), normalize.without_legal(F.col("n")).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in out) and any(r["a"] != r["n"] for r in out)


def test_keys_are_worked_out_once(odd):
    """before, keys of all records were worked out for the sizes of blocks and again for their entries."""
    plan = _plan(odd.raw_pairs())
    assert blockwise.KEPT in odd.anchors.columns and blockwise.KEPT in plan
    slim = [p.drop(blockwise.KEPT) for p in (odd.anchors, odd.targets)]
    for strategies in (fixed.STRATEGIES, ["exact_name", "name_dba_alias"]):
        assert _rows(blockwise.pairs(odd.anchors, odd.targets, strategies)) == _rows(blockwise.pairs(*slim, strategies))


@pytest.mark.parametrize("name", ["roc_auc", "average_precision", "evaluate_at_threshold"])
def test_score_metrics_make_candidates_once(spark, sf, name):
    """F1, F2, F5: before, all features were worked out for them, and pairs anew for each reading of the scores."""
    df = registry.QUERIES[name](spark, sf)
    assert "InMemoryRelation" in df._jdf.queryExecution().withCachedData().toString()
    assert "addr_postal_code_match" not in _plan(df) and "name_edit_similarity" not in _plan(df)
    registry.close()


def test_links_of_kept_records_are_those_of_texts(spark, sf):
    p = registry._pipe(spark, sf)
    assert _rows(registry._links(p)) == _rows(registry._truth_long(spark, sf)) != []
    judged = registry._judged(p, registry._linked(p))
    want = registry._scored(spark, sf).select("s1_id", "target_id", "prob", "label")
    assert _rows(judged) == _rows(want)
    registry.close()


def test_experiments_make_pairs_once(odd, spark, sf, monkeypatch):
    """before, records were dealt and pairs made anew for each of nine experiments."""
    plan = _plan(registry.QUERIES["experiments"](spark, sf))
    assert plan.count("MapInArrow") == 1
    registry.close()
    monkeypatch.setattr(blockwise, "QUERIES_AT_ONCE", 3)
    links = odd.anchors.join(odd.targets.select("name_norm", F.col("entity_id").alias("t")), "name_norm").filter("name_norm <> ''").groupBy("entity_id").agg(F.collect_set("t").alias("links"))
    links = odd.anchors.select("entity_id").join(links, "entity_id", "left").filter("entity_id <> 'S1-0'").withColumn("links", F.coalesce("links", F.array().cast("array<string>"))).cache()
    sets = [*diagnostics.EXPERIMENTS.values(), (["name_dba_alias", "exact_name"], 0.9, 2), (["name_prefix_6", "name_leet_compact"], 0.0, 1)]
    got = {r["set"]: (r["n_pairs"], r["captured"]) for r in blockwise.compared(odd.anchors, odd.targets, links, sets).collect()}
    for i, (strategies, threshold, k) in enumerate(sets):
        if k is None:
            pairs = blockwise.pairs(odd.anchors, odd.targets, strategies)
        else:
            pairs = refine.top_k(blockwise.scored_pairs(odd.anchors, odd.targets, strategies), k, threshold)
        met = pairs.join(links.withColumnRenamed("entity_id", "s1_id"), "s1_id")
        assert got[i] == met.select(F.count("*"), F.count_if(F.array_contains("links", F.col("target_id")))).first()
    assert any(c for _, c in got.values())


def test_labelled_features_are_dealt_once(odd, spark, sf):
    """before, rows of 87 features were dealt again for the target's frequencies and for labels."""
    assert _plan(registry.QUERIES["feat_all_labelled"](spark, sf)).split("MapInArrow")[0].count("Join ") == 1  # wide truth, by anchor
    registry.close()
    store = FrequencyStore(odd.anchors)
    rows = odd.features(store).cache()
    pairs = rows.filter("name_normalized_exact = 1").select(F.col("source1_entity_id").alias("s1_id"), F.col("target_entity_id").alias("target_id")).cache()
    truth = metrics.wide(pairs.select("s1_id").distinct(), pairs, "targets")
    columns = ["source1_entity_id", "target_entity_id", "label"]
    assert _rows(labelled_by_anchor(rows, truth).select(columns)) == _rows(labelled(rows, pairs).select(columns))
    whole = [f for f in fixed.FEATURES if f not in fixed.FRACTIONS]
    assert rows.filter(" or ".join(f"{f} <> floor({f})" for f in whole)).isEmpty()
