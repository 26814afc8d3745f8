"""Runs over files: training, linking and checking, and their command line."""

from __future__ import annotations

import argparse
import logging
import sys
import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.functions import fixed
from kindred.operators import features, metrics, model, split, validate
from kindred.plans.pipeline import LinkageConfig, LinkagePipeline
from kindred.sources import sinks, tables


def step_log(name: str) -> Callable[[str], None]:
    """Logs a step with the seconds since the last one."""
    log, at = logging.getLogger(f"kindred.{name}"), [time.time()]

    def step(text: str) -> None:
        log.info("%s (%.1f s)", text, time.time() - at[0])
        at[0] = time.time()

    return step


def read_sources(spark: SparkSession, folder: str, prefix: str = "test", max_queries: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(anchors, targets) of {prefix}_source1.tsv to {prefix}_source3.tsv; at most the first max_queries anchors."""
    one, two, three = (tables.read_lines(spark, f"{folder}/{prefix}_source{i}.tsv") for i in (1, 2, 3))
    anchors = tables.numbered_in_order(one)
    if max_queries is not None:
        anchors = anchors.orderBy("seq").limit(max_queries)
    return anchors, tables.numbered_in_order(two.union(three))


def train_model(spark: SparkSession, folder: str, model_path: str, kind: str | Sequence[str] = "MODEL-003", prefix: str = "train", config: LinkageConfig | None = None, refit: bool = True) -> DataFrame:
    """Fits frequencies and models on the training share of the anchors, and returns the threshold sweep of the best one
    over the validation share.

    Of several kinds the champion is kept, by macro F0.5. refit: the model that is saved is fitted again on all anchors,
    with frequencies of all of them, at the threshold found before.
    """
    log = step_log("train")
    anchors, targets = read_sources(spark, folder, prefix)
    truth = tables.parse_truth(spark.read.option("sep", "\t").option("header", True).option("quote", "").csv(f"{folder}/{prefix}_ground_truth.tsv"))
    p = LinkagePipeline(anchors, targets, config)
    try:
        part = split.split_by_hash(truth.select(F.col("s1_id").alias("entity_id")))
        val = part.filter("is_validation").select(F.col("entity_id").alias("s1_id"))
        long = truth.select("s1_id", F.explode("targets").alias("target_id"))

        def rows_with(known: DataFrame, name: str) -> DataFrame:
            store = features.FrequencyStore(known)
            store.save(f"{model_path}/frequencies")
            rows = features.labelled(p.features(features.FrequencyStore.load(spark, f"{model_path}/frequencies")), long)
            rows.write.mode("overwrite").parquet(f"{model_path}/{name}")
            log(f"{name} written")
            return spark.read.parquet(f"{model_path}/{name}")

        rows = rows_with(p.anchors.join(part.filter("not is_validation"), "entity_id", "left_semi"), "rows")
        key = F.col("source1_entity_id") == F.col("s1_id")
        kinds = [kind] if isinstance(kind, str) else list(kind)
        held = rows.join(val, key, "left_semi")
        known = truth.join(val, "s1_id", "left_semi")
        fitted = {k: model.train(rows.join(val, key, "left_anti"), k) for k in kinds}
        name, threshold, _ = model.champion(fitted, held, known)
        log(f"champion {name} at {threshold}")
        scored = model.predict(fitted[name], held).withColumns({"s1_id": F.col("source1_entity_id"), "target_id": F.col("target_entity_id")})
        sweep = metrics.threshold_sweep(scored, known)
        final = model.train(rows_with(p.anchors, "rows_all"), name) if refit else fitted[name]
        model.save(final, model_path, threshold=threshold)
        return sweep
    finally:
        p.close()


def run_linkage(spark: SparkSession, folder: str, model_path: str, output: str, prefix: str = "test", max_queries: int | None = None, archive: bool = True) -> dict:
    """Writes candidate_pairs and matching_results, checks them, and returns counts. Raises ValueError if a check fails."""
    anchors, targets = read_sources(spark, folder, prefix, max_queries)
    fitted, meta = model.load(model_path)
    store = features.FrequencyStore.load(spark, f"{model_path}/frequencies")
    log = step_log("link")
    p = LinkagePipeline(anchors, targets, LinkageConfig(match_threshold=meta["threshold"]))
    p.candidates().write.mode("overwrite").parquet(f"{output}/candidates")  # both files come from one set of candidates
    pairs = spark.read.parquet(f"{output}/candidates")
    scored = model.predict(fitted, p.features(store, pairs)).filter(F.col("prob") >= meta["threshold"])
    matched = scored.select(F.col("source1_entity_id").alias("s1_id"), F.col("target_entity_id").alias("target_id"))
    from kindred.operators.refine import per_anchor

    files = {"candidate_pairs": ("candidate_entity_ids", pairs, sinks.write_candidate_pairs), "matching_results": ("matched_entity_ids", matched, sinks.write_matches)}
    for name, (column, rows, write) in files.items():
        write(per_anchor(p.anchors, rows, column), f"{output}/{name}")
        log(f"{name} written")
    bad = check_files(spark, output, p.anchors, p.targets)
    if bad:
        raise ValueError("; ".join(bad[:20]))
    out = metrics.candidate_diagnostics(p.anchors.select(F.col("entity_id").alias("s1_id")), pairs).first().asDict()
    p.close()
    if archive and output.startswith("/"):
        sinks.bundle([f"{output}/{n}" for n in files], f"{output}/results.zip")
    return out


def check_files(spark: SparkSession, output: str, source1: DataFrame, targets: DataFrame, limit: int = 1000) -> list[str]:
    """Messages of what is wrong with the two result files in a folder, at most `limit`; none if they are right."""
    read = lambda n: spark.read.option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(f"{output}/{n}")
    c, m = read("candidate_pairs"), read("matching_results")
    found = validate.check_headers(c, m)
    if found:
        return found
    # The writers leave one sorted file, which is read by one task here: ids number its lines.
    number = lambda df: df.coalesce(1).withColumn("line", F.monotonically_increasing_id())
    return [f"{r['rule']}: {r['s1_id']} {r['detail']}" for r in validate.violations(number(c), number(m), source1, targets).limit(limit).collect()]


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="kindred", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("train", "link", "check"):
        c = commands.add_parser(name)
        c.add_argument("--folder", required=True, help="source files")
        c.add_argument("--prefix", default="train" if name == "train" else "test")
        if name != "check":
            c.add_argument("--model-path", required=True)
        if name == "train":
            c.add_argument("--kind", nargs="+", default=["MODEL-003"], help="several: the champion is kept")
            c.add_argument("--no-refit", action="store_true", help="keep the model of the training share")
        else:
            c.add_argument("--output", required=True)
        if name == "link":
            c.add_argument("--max-queries", type=int)
            c.add_argument("--skip-zip", action="store_true")
    a = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    spark = SparkSession.builder.getOrCreate()
    if a.command == "train":
        train_model(spark, a.folder, a.model_path, a.kind, a.prefix, refit=not a.no_refit).show(19)
        return 0
    if a.command == "link":
        print(run_linkage(spark, a.folder, a.model_path, a.output, a.prefix, a.max_queries, not a.skip_zip))
        return 0
    bad = check_files(spark, a.output, *read_sources(spark, a.folder, a.prefix))
    print("\n".join(bad) or "right")
    return int(bool(bad))


if __name__ == "__main__":
    sys.exit(main())
