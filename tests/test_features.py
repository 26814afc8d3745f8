import math

import pytest
from helpers import entities

from kindred.functions import fixed
from kindred.operators.features import FrequencyStore, labelled, pair_features
from kindred.operators.normalize import normalized


def features(spark, q, t, strategies=(), train=None):
    pairs = spark.createDataFrame([("S1-1", "S2-1", list(strategies))], "s1_id string, target_id string, strategies array<string>")
    store = FrequencyStore(normalized(entities(spark, train))) if train else None
    rows = pair_features(pairs, normalized(entities(spark, [("S1-1", *q)])), normalized(entities(spark, [("S2-1", *t)])), store)
    return rows.first().asDict()


def test_schema(spark):
    f = features(spark, ("a", "b", "c"), ("a", "b", "c"))
    assert len(fixed.FEATURES) == 87 and list(f)[3:] == fixed.FEATURES and f["target_source"] == "S2"


def test_typos_and_identities(spark):
    f = features(spark, ("Alpha Logistics", "501 Elton Street, Suite 4", "US"), ("Alppha Logstics", "00501 Elton St, Ste 4", "US"))
    assert f["name_edit_similarity"] > 0.7 and f["name_char_3gram_jaccard"] >= 0.5
    assert f["addr_exact_number_match"] == 1 and f["country_exact_match"] == 1
    same = [("name_sorted_token_jaccard", "name_token_jaccard"), ("refine_token_sim", "name_token_jaccard"), ("refine_ngram_sim", "name_char_3gram_jaccard"), ("addr_leading_zero_number_match", "addr_exact_number_match"), ("refine_addr_token_sim", "addr_token_jaccard"), ("view_compact_name_match", "name_compact_exact"), ("country_normalized_match", "country_exact_match")]
    assert all(f[a] == f[b] for a, b in same)


def test_reordered_suffix_alias_leet(spark):
    assert features(spark, ("Royal Foods", "", ""), ("Foods Royal", "", ""))["name_token_jaccard"] == 1.0
    assert features(spark, ("Royal Foods Ltd", "", ""), ("Royal Foods", "", ""))["name_compact_exact"] == 1.0
    assert features(spark, ("Orane Brothers", "", ""), ("X1 dba Orane Brothers", "", ""))["view_dba_alias_match"] == 1.0
    assert features(spark, ("@r0yal", "", ""), ("royal", "", ""))["view_leet_name_exact"] == 1.0


def test_address_missing_and_postal(spark):
    f = features(spark, ("a", "", "US"), ("a", "12 Road 12345", "FR"))
    assert f["addr_is_missing_either"] == 1 and f["qual_addr_missing_q"] == 1 and f["country_conflict"] == 1
    assert features(spark, ("a", "1 Oak 12345", ""), ("a", "2 Elm 12345", ""))["addr_postal_code_match"] == 1


def test_scripts_and_marks(spark):
    f = features(spark, ("शर्मा", "", ""), ("www.sharma.com dba Sharma Inc", "", ""))
    assert (f["qual_non_latin_script_q"], f["qual_non_latin_script_t"], f["qual_mixed_script_pair"], f["qual_has_url_domain"], f["qual_has_legal_suffix"], f["qual_has_dba"]) == (1, 0, 1, 1, 1, 1)


def test_provenance_and_bypass(spark):
    f = features(spark, ("a b", "", ""), ("x y", "", ""), ["exact_name", "name_prefix_6", "name_dba_alias"])
    assert (f["prov_exact_name"], f["prov_name_prefix"], f["prov_name_dba"], f["prov_name_leet"], f["prov_strategy_count"]) == (1, 1, 1, 0, 3)
    assert f["refine_provenance_bypass"] == 1 and f["refine_composite_score"] == 1.0


def test_frequencies(spark):
    train = [(f"S1-{i}", "Subway", "", "US") for i in range(5)] + [("S1-9", "Subway", "", "FR")]
    f = features(spark, ("Subway", "", "US"), ("Unseen Shop", "", "US"), train=train)
    assert (f["freq_q_name"], f["freq_q_country_name"], f["freq_t_name"], f["freq_t_country_name"]) == (6, 5, 0, 0)


def test_empty_pair_is_finite(spark):
    f = features(spark, (None, None, None), ("", "", ""))
    assert all(isinstance(f[c], float) and math.isfinite(f[c]) for c in fixed.FEATURES)


def test_label(spark):
    pairs = spark.createDataFrame([("S1-1", "S2-1", ["exact_name"]), ("S1-1", "S2-2", ["exact_name"])], "s1_id string, target_id string, strategies array<string>")
    q, t = normalized(entities(spark, [("S1-1", "a", "", "")])), normalized(entities(spark, [("S2-1", "a", "", ""), ("S2-2", "a", "", "")]))
    truth = spark.createDataFrame([("S1-1", "S2-2"), ("S1-1", "S2-2")], "s1_id string, target_id string")
    assert {r["target_entity_id"]: r["label"] for r in labelled(pair_features(pairs, q, t), truth).collect()} == {"S2-1": 0, "S2-2": 1}


@pytest.mark.parametrize("kind", ["logistic", "random_forest", "hist_gradient_boosting", "extra_trees"])
def test_models(spark, kind):
    import random

    from kindred.operators import model

    r = random.Random(42)
    cols = fixed.FEATURES[:6]
    rows = [(f"S1-{i // 5}", f"S2-{i}", *(x := [r.random() for _ in cols]), int(x[0] > 0.5 and x[1] > 0.4)) for i in range(100)]
    df = spark.createDataFrame(rows, "s1_id string, target_id string, " + ", ".join(f"{c} double" for c in cols) + ", label int")
    fitted = model.train(df, kind, cols, balanced=kind == "logistic", trees=5, depth=3)
    got = model.predict(fitted, df).collect()
    assert all(0 <= x["prob"] <= 1 for x in got)
    good = sum((x["prob"] > 0.5) == (x["label"] == 1) for x in got)
    assert good > 75
    with pytest.raises(ValueError):
        model.train(df, "nope", cols)


def test_model_round_trip(spark, tmp_path):
    from kindred.operators import model

    df = spark.createDataFrame([(float(i % 2), i % 2) for i in range(20)], "x double, label int")
    fitted = model.train(df, "MODEL-001", ["x"])
    model.save(fitted, str(tmp_path / "m"), ["x"])
    again, meta = model.load(str(tmp_path / "m"))
    assert meta["features"] == ["x"] and meta["threshold"] == 0.7
    assert model.predict(again, df).collect() == model.predict(fitted, df).collect()
