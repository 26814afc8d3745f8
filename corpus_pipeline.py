"""The corpus pipeline: language ID, near duplicates, decontamination, secrets, packing.

Each stage takes (spark, docs, sf_dir), works on every row that the stage before it kept, and returns a DataFrame that
is written and read again as the next one's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm.common import column_name, forget, stored
from kindred.llm.decontaminate import without_leaks
from kindred.llm.language_id import identify
from kindred.llm.ngram_join import jaccard_components
from kindred.llm.packing import pack
from kindred.llm.secret_scan import SecretFilter, redact, scan

#: SQL can't express these stages; tests/llm holds them against brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the operator puts into no language: those without a letter (und)."""
    own = column_name(docs, "row")
    judged = identify(docs.select("doc_id", "text", "lang", F.struct(*docs.columns).alias(own)))
    return judged.filter(F.col("lang_pred") != "und").select(f"{own}.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each component, and one of the rows that repeat a doc_id and its text.

    Documents without words are in no component and stay, as do rows with a null doc_id. Different texts with one
    doc_id are documents of their own: where any id repeats, rows are numbered and joined by their numbers. Of rows that
    repeat an id and its text the one whose other columns come first in order stays.
    """
    repeated = stored(docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1 and doc_id is not null").select("doc_id"), "repeated")
    if not repeated.isEmpty():
        row, whole = column_name(docs, "row"), column_name(docs, "whole")
        again = docs.join(repeated, "doc_id", "left_semi").select(*docs.columns)
        once = again.groupBy("doc_id", F.md5(F.col("text").cast("binary"))).agg(F.min(F.struct(*docs.columns)).alias(whole)).select(f"{whole}.*")
        others = docs.join(repeated, "doc_id", "left_anti").select(*docs.columns)
        numbered = stored(others.union(once).withColumn(row, F.monotonically_increasing_id()), "rows")
        # Rows with a null doc_id get a null row, so that they are in no component.
        asked = numbered.select(F.when(F.col("doc_id").isNotNull(), F.col(row)).alias(row), "doc_id", "text")
        labelled = jaccard_components(asked, id_col=row).filter("component_id is not null and n_shingles > 0")
        member = labelled.select(F.col("doc_id").alias(row), "component_id").join(numbered.select(row, F.col("doc_id").alias("id")), row)
        member = stored(member, "components")
        first = member.groupBy("component_id").agg(F.min(F.struct("id", row)).alias("f")).select(F.col(f"f.{row}").alias(row))
        return numbered.join(member.select(row).join(first, row, "left_anti"), row, "left_anti").select(*docs.columns)
    found = jaccard_components(docs).filter("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark. Each row is judged by its own text."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces confirmed secrets; every document stays. Findings belong to an id and its text."""
    findings = stored(scan(docs, SecretFilter.default(spark, docs)).filter("is_secret"), "secrets")
    return redact(docs, findings)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ranges of all documents with their places in sequences."""
    return pack(docs)


STAGES = [
    ("language_id", language),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminated),
    ("secret_scan", without_secrets),
    ("best_fit_packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stored(stage(spark, docs, sf_dir), name)
        if k:  # no later stage reads what the one before the last wrote
            forget(before)
    return docs
