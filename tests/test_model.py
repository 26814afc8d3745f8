"""Models on rows whose label is a function of two features."""

import random

import pytest
from pyspark.sql import functions as F

from kindred.operators import model

COLUMNS = ["a", "b", "same"]


@pytest.fixture(scope="module")
def rows(spark):
    r = random.Random(1)
    data = [(f"S1-{i // 5}", f"S2-{i}", r.random(), r.random(), 0.5) for i in range(400)]
    df = spark.createDataFrame(data, "source1_entity_id string, target_entity_id string, a double, b double, same double")
    return df.withColumn("label", (F.col("a") + F.col("b") > 1.2).cast("int")).cache()


def share(scored):
    return scored.filter((F.col("prob") >= 0.5) == (F.col("label") == 1)).count() / scored.count()


@pytest.mark.parametrize(("kind", "size"), [("MODEL-001", {}), ("MODEL-002", {"trees": 8}), ("MODEL-003", {"trees": 4, "depth": 3}), ("MODEL-004", {"trees": 12})])
def test_models_learn(rows, kind, size):
    scored = model.predict(model.train(rows, kind, COLUMNS, **size), rows)
    assert share(scored) >= 0.85 and set(scored.columns) == set(rows.columns) | {"prob"}


def test_random_thresholds_are_no_second_name_of_the_forest(rows, tmp_path):
    fitted = [model.train(rows, k, COLUMNS, trees=6) for k in ("random_forest", "extra_trees")]
    probs = [[r["prob"] for r in model.predict(m, rows).orderBy("target_entity_id").collect()] for m in fitted]
    assert probs[0] != probs[1]
    model.save(fitted[1], str(tmp_path / "m"), COLUMNS, 0.4)
    again, meta = model.load(str(tmp_path / "m"))
    assert [r["prob"] for r in model.predict(again, rows).orderBy("target_entity_id").collect()] == probs[1] and meta["threshold"] == 0.4


def test_balanced_weights_raise_the_probability_of_the_rare_class(rows):
    plain, balanced = (model.predict(model.train(rows, "logistic", COLUMNS, balanced=b), rows).agg(F.avg("prob")).first()[0] for b in (False, True))
    assert balanced > plain


def test_champion_and_ablations(rows, monkeypatch):
    truth = rows.groupBy(F.col("source1_entity_id").alias("s1_id")).agg(F.collect_list(F.when(F.col("label") == 1, F.col("target_entity_id"))).alias("targets"))
    fitted = {"one": model.train(rows, "logistic", ["same", "a"]), "two": model.train(rows, "logistic", COLUMNS)}
    name, threshold, found = model.champion(fitted, rows, truth)
    assert name == "two" and 0 < threshold < 1 and len(found) == 2
    monkeypatch.setattr(model, "ABLATIONS", {"X": ["a"], "Y": COLUMNS})
    got = {r["experiment"]: r["macro_f05"] for r in model.run_ablations(rows, truth, "logistic").collect()}
    assert got["Y"] > got["X"]


def test_unknown_models_are_refused(rows):
    with pytest.raises(ValueError):
        model.train(rows, "MODEL-009", COLUMNS)
