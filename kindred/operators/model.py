"""Classifiers of pairs, in Spark ML."""

from __future__ import annotations

import json
import math
import random
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions import fixed
from kindred.operators import metrics

MODELS = {"MODEL-001": "logistic", "MODEL-002": "random_forest", "MODEL-003": "hist_gradient_boosting", "MODEL-004": "extra_trees"}

#: Feature subsets of the ablation experiments.
_G = fixed.FEATURE_GROUPS
ABLATIONS = {
    "EXP-015": _G["name"],
    "EXP-016": _G["name"] + _G["address"],
    "EXP-017": _G["name"] + _G["address"] + _G["cross"],
    "EXP-018": _G["name"] + _G["address"] + _G["cross"] + _G["country"] + _G["view"],
    "EXP-019": _G["name"] + _G["address"] + _G["cross"] + _G["country"] + _G["view"] + _G["provenance"],
    "EXP-020": _G["name"] + _G["address"] + _G["cross"] + _G["country"] + _G["view"] + _G["provenance"] + _G["refine"],
    "EXP-021": fixed.FEATURES,
    "EXP-022": [f for f in fixed.FEATURES if f not in _G["frequency"]],
}


#: Random thresholds a feature that extremely randomised trees choose from.
THRESHOLDS = 8


def _random_thresholds(rows: DataFrame, columns: Sequence[str], seed: int) -> list:
    """Stages that turn each feature into THRESHOLDS flags, whether it exceeds a threshold drawn between its extremes.

    Trees over a few random flags a node choose among random (feature, threshold) pairs, which is what makes trees
    extremely randomised; the thresholds are drawn for the forest and not for each node.
    """
    ends = rows.agg(*(f(c).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max)))).first()
    r = random.Random(seed)
    inputs, outputs, splits = [], [], []
    for i, c in enumerate(columns):
        lo, hi = ends[f"lo{i}"], ends[f"hi{i}"]
        for k in range(THRESHOLDS if lo is not None and hi > lo else 0):
            inputs.append(c)
            outputs.append(f"{c}__{k}")
            splits.append([-math.inf, r.uniform(lo, hi), math.inf])
    return [Bucketizer(inputCols=inputs, outputCols=outputs, splitsArray=splits), VectorAssembler(inputCols=outputs, outputCol="flags")] if inputs else []


def train(rows: DataFrame, model: str = "MODEL-003", columns: Sequence[str] = fixed.FEATURES, balanced: bool = False, seed: int = 42, trees: int = 100, depth: int | None = None) -> PipelineModel:
    """Fits one of MODELS (by id or name) on features and label. `trees` and `depth` bound the ensembles' work.

    The rows are worked out once, into as few partitions as the session has cores, since each iteration is a job.
    """
    kind = MODELS.get(model, model)
    if kind not in MODELS.values():
        raise ValueError(f"unknown model {model}")
    spark = rows.sparkSession
    used = rows.select(*columns, "label").coalesce(max(1, spark.sparkContext.defaultParallelism)).persist()
    try:
        counts = {r["label"]: r["n"] for r in used.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
        n = sum(counts.values())
        weights, data = {}, used
        if balanced:
            share = lambda label: F.lit(n / (2 * max(1, counts.get(label, 0))))
            data, weights = used.withColumn("weight", F.when(F.col("label") == 1, share(1)).otherwise(share(0))), {"weightCol": "weight"}
        assembled = VectorAssembler(inputCols=list(columns), outputCol="raw")
        common = {"labelCol": "label", "featuresCol": "raw", **weights}
        if kind == "logistic":
            scaled = StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True)
            stages = [assembled, scaled, LogisticRegression(**common | {"featuresCol": "scaled"}, regParam=1.0 / max(1, n), elasticNetParam=0.0, standardization=False, maxIter=1000, tol=1e-4)]
        elif kind == "random_forest":
            stages = [assembled, RandomForestClassifier(**common, numTrees=trees, maxDepth=depth or 14, minInstancesPerNode=5, seed=seed)]
        elif kind == "hist_gradient_boosting":
            stages = [assembled, GBTClassifier(**common, maxIter=trees, maxDepth=depth or 8, stepSize=0.1, minInstancesPerNode=20, seed=seed, cacheNodeIds=True)]
        else:
            flags = _random_thresholds(used, columns, seed)
            subset = {"featureSubsetStrategy": str(max(1, round(len(columns) ** 0.5)))} if flags else {}
            stages = [*flags, assembled, RandomForestClassifier(**common | {"featuresCol": "flags" if flags else "raw"}, numTrees=trees, maxDepth=depth or 14, minInstancesPerNode=5, bootstrap=False, seed=seed, **subset)]
        return Pipeline(stages=stages).fit(data)
    finally:
        used.unpersist()


def best_threshold(fitted: PipelineModel, rows: DataFrame, truth: DataFrame) -> DataFrame:
    """One row of the threshold sweep (threshold, macro_f05, …): the best one of a model over labelled rows."""
    scored = predict(fitted, rows).select(F.col("source1_entity_id").alias("s1_id"), F.col("target_entity_id").alias("target_id"), "label", "prob")
    return metrics.threshold_sweep(scored, truth).filter("is_best")


def run_ablations(rows: DataFrame, truth: DataFrame, kind: str = "MODEL-003", names: Sequence[str] | None = None) -> DataFrame:
    """experiment, n_features, threshold, macro_f05, macro_precision, macro_recall of models on subsets of the features."""
    out: DataFrame | None = None
    for name in names or list(ABLATIONS):
        columns = ABLATIONS[name]
        best = best_threshold(train(rows, kind, columns), rows, truth)
        row = best.select(F.lit(name).alias("experiment"), F.lit(len(columns)).alias("n_features"), "threshold", *(F.round(c, 4).alias(c) for c in ("macro_f05", "macro_precision", "macro_recall")))
        out = row if out is None else out.union(row)
    return out


def champion(fitted: dict[str, PipelineModel], rows: DataFrame, truth: DataFrame) -> tuple[str, float, list[dict]]:
    """(name, threshold, all results) of the model with the best macro F0.5 over rows; ties go to the first name."""
    found = [{"model": name} | best_threshold(m, rows, truth).first().asDict() for name, m in fitted.items()]
    best = min(found, key=lambda x: (-round(x["macro_f05"], 12), x["model"]))
    return best["model"], best["threshold"], found


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """rows with prob, the probability of a match."""
    out = model.transform(rows).withColumn("prob", vector_to_array("probability")[1])
    made = [c for stage in model.stages if isinstance(stage, Bucketizer) for c in stage.getOutputCols()]
    return out.drop("raw", "scaled", "flags", "rawPrediction", "probability", "prediction", *made)


def save(model: PipelineModel, path: str, columns: Sequence[str] = fixed.FEATURES, threshold: float = fixed.MATCH_THRESHOLD) -> None:
    model.write().overwrite().save(f"{path}/model")
    meta = {"feature_schema": "phase4-v1", "features": list(columns), "threshold": threshold}
    SparkSession.active().createDataFrame([(json.dumps(meta),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/metadata")


def load(path: str) -> tuple[PipelineModel, dict]:
    meta = json.loads(SparkSession.active().read.text(f"{path}/metadata").first()["value"])
    return PipelineModel.load(f"{path}/model"), meta
