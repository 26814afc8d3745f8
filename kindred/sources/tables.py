"""Readers: source and truth files, and the entity view of documents."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SOURCE_COLUMNS = ["entity_id", "business_name", "business_address", "country"]
TRUTH_COLUMNS = ["source1_entity_id", "matched_entity_ids"]
S1_ID, TARGET_ID = r"^S1-\d+$", r"^(S2|S3)-\d+$"


def read_source(spark: SparkSession, path: str, columns: Sequence[str] = SOURCE_COLUMNS, use: Sequence[str] | None = None, limit: int | None = None) -> DataFrame:
    """A tab-separated file with a header: all strings, empty fields as '', quotes taken literally ("NA" stays text)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").csv(path)
    df = df.select(*(F.coalesce(c, F.lit("")).alias(c) for c in (use or columns)))
    return df if limit is None else df.limit(limit)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """entity_id, business_name, business_address, country of lines with at least four fields; more are ignored."""
    parts = spark.read.text(path).select(F.split(F.rtrim(F.col("value"), F.lit("\r")), "\t", -1).alias("p")).filter(F.size("p") >= 4)
    return parts.select(*(F.col("p")[i].alias(c) for i, c in enumerate(SOURCE_COLUMNS))).filter(F.col("entity_id") != "entity_id")


def read_entity_ids(spark: SparkSession, path: str) -> DataFrame:
    """entity_id of every line but the header; a line without a tab is an id as a whole."""
    ids = spark.read.text(path).select(F.substring_index(F.rtrim(F.col("value"), F.lit("\r")), "\t", 1).alias("entity_id"))
    return ids.filter(F.col("entity_id") != "entity_id")


def count_rows(spark: SparkSession, path: str) -> int:
    return spark.read.option("header", True).option("sep", "\t").option("quote", "").csv(path).count()


def numbered_in_order(df: DataFrame) -> DataFrame:
    """Adds seq, which follows the order of the files and lines."""
    return df.withColumn("seq", F.monotonically_increasing_id())


def truth_violations(lines: DataFrame, s1_ids: DataFrame | None = None, target_ids: DataFrame | None = None) -> DataFrame:
    """rule, s1_id, detail for lines (source1_entity_id, matched_entity_ids) of a truth file that break a rule."""
    base = lines.withColumn("items", F.when(F.trim(F.coalesce("matched_entity_ids", F.lit(""))) == "", F.array().cast("array<string>")).otherwise(F.transform(F.split("matched_entity_ids", ","), lambda x: F.trim(x))))
    s1 = F.col("source1_entity_id")
    items = base.select(s1.alias("s1_id"), F.explode("items").alias("item"))
    row = lambda df, rule, s, d: df.select(F.lit(rule).alias("rule"), s.alias("s1_id"), d.alias("detail"))
    out = [
        row(base.filter(~F.coalesce(s1, F.lit("")).rlike(S1_ID)), "bad_s1_id", s1, s1),
        row(base.groupBy(s1).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "duplicate_s1_id", s1, F.col("n").cast("string")),
        row(items.filter("item = ''"), "empty_item", F.col("s1_id"), F.lit("")),
        row(items.filter((F.col("item") != "") & ~F.col("item").rlike(TARGET_ID)), "bad_target_id", F.col("s1_id"), F.col("item")),
        row(base.filter(F.size("items") != F.size(F.array_distinct("items"))), "duplicate_target", s1, F.col("matched_entity_ids")),
    ]
    if s1_ids is not None:
        out.append(row(base.join(s1_ids.select(F.col("entity_id").alias("source1_entity_id")), "source1_entity_id", "left_anti"), "unknown_s1_id", s1, s1))
    if target_ids is not None:
        out.append(row(items.join(target_ids.select(F.col("entity_id").alias("item")), "item", "left_anti"), "unknown_target", F.col("s1_id"), F.col("item")))
    result = out[0]
    for x in out[1:]:
        result = result.union(x)
    return result


def parse_truth(lines: DataFrame, s1_ids: DataFrame | None = None, target_ids: DataFrame | None = None, strict: bool = True) -> DataFrame:
    """s1_id, targets of a truth file. strict: raises ValueError with the first broken rule."""
    if lines.columns != TRUTH_COLUMNS:
        raise ValueError(f"the header must be {TRUTH_COLUMNS}")
    if strict:
        bad = truth_violations(lines, s1_ids, target_ids).orderBy("rule", "s1_id", "detail").first()
        if bad is not None:
            raise ValueError(f"{bad['rule']}: {bad['s1_id']} {bad['detail']}")
    items = F.filter(F.transform(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), lambda x: F.trim(x)), lambda x: x != "")
    return lines.select(F.col("source1_entity_id").alias("s1_id"), F.array_sort(F.array_distinct(items)).alias("targets"))


#: Lines of one document that ids tell apart.
LINES = 1 << 20


def document_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document as a record of one of three sources; a source has each line once.

    The first sentence of a line is the name; the line's length, in the place of a house number, and all the rest are the
    address. So every character of the texts is in a record. The first place of a line gives its id and country.
    """
    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    source = F.concat(F.lit("S"), (F.col("doc_id") % 3 + 1).cast("string"))
    lines = d.select(source.alias("source"), "doc_id", "lang", F.posexplode(F.split("text", "\n", -1)).alias("place", "line")).filter(F.trim("line") != "")
    once = lines.groupBy("source", "line").agg(F.min(F.struct("doc_id", "place", "lang")).alias("f"))
    seq = F.col("f.doc_id") * LINES + F.col("f.place")
    name = F.regexp_extract("line", r"^[^.]+", 0)
    return once.select(
        F.concat_ws("-", "source", seq.cast("string")).alias("entity_id"),
        "source",
        name.alias("business_name"),
        F.concat_ws(" ", F.length("line").cast("string"), F.substring("line", F.length(name) + 1, F.length("line"))).alias("business_address"),
        F.col("f.lang").alias("country"),
        seq.alias("seq"),
    )
