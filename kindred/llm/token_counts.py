"""Exact length histogram of encoded documents and what its suffix sums answer."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from kindred.llm.common import stored
from kindred.llm.tokenize import VOCABULARY, Encoder

#: Lengths per block of the two-level suffix sums.
BLOCK = 4096


def token_lengths(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY, into: str = "n_tokens") -> DataFrame:
    """Adds the number of ids of each whole text; a null text has none."""

    @F.pandas_udf("long")
    def lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = Encoder(vocabulary)
        for texts in batches:
            known: dict[str, int] = {}
            out = []
            for t in texts:
                if t is None:
                    out.append(0)
                    continue
                if t not in known:
                    known[t] = len(encoder.encode(t))
                out.append(known[t])
            yield pd.Series(out, dtype="int64")

    return docs.withColumn(into, lengths(F.col(text)))


def length_histogram(lengths: DataFrame, length: str = "n_tokens") -> DataFrame:
    """length, n_docs. Counting is partial before its shuffle, so a hot length costs one row a task."""
    return lengths.groupBy(F.col(length).cast("long").alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))


def limit_table(histogram: DataFrame) -> DataFrame:
    """One row for every length L that occurs, ascending, with all answers for the context limit L.

    docs_at_least, tokens_at_least: suffix sums over lengths >= L. truncated_tokens: the sum of min(length, L) over all
    documents, that is the tokens of shorter documents plus L for each in the suffix. docs_over, tokens_cut: documents
    longer than L and the tokens they lose. quantile: share of documents of at most L tokens. total_docs, total_tokens:
    of all documents. Between two lengths that occur, truncated_tokens is linear: see truncated_total().
    An empty histogram gives no rows. The histogram is read twice: pass a stored table.
    """
    h = histogram.withColumns({"block": F.floor(F.col("length") / BLOCK), "tokens": F.col("length") * F.col("n_docs")})
    blocks = h.groupBy("block").agg(F.sum("n_docs").alias("bd"), F.sum("tokens").alias("bt"))
    later = Window.orderBy(F.desc("block")).rowsBetween(Window.unboundedPreceding, -1)  # a row for each 4096 lengths
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    blocks = blocks.select(
        "block",
        F.coalesce(F.sum("bd").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("bt").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("bd").over(every).alias("total_docs"),
        F.sum("bt").over(every).alias("total_tokens"),
    )
    within = Window.partitionBy("block").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    s = h.join(blocks, "block").withColumns({"docs_at_least": F.sum("n_docs").over(within) + F.col("later_docs"), "tokens_at_least": F.sum("tokens").over(within) + F.col("later_tokens")})
    over = F.col("docs_at_least") - F.col("n_docs")
    truncated = F.col("total_tokens") - F.col("tokens_at_least") + F.col("length") * F.col("docs_at_least")
    return s.select(
        F.col("length").alias("context_limit"),
        "n_docs",
        "docs_at_least",
        "tokens_at_least",
        over.alias("docs_over"),
        truncated.alias("truncated_tokens"),
        (F.col("total_tokens") - truncated).alias("tokens_cut"),
        ((F.col("total_docs") - over) / F.col("total_docs")).alias("quantile"),
        "total_docs",
        "total_tokens",
    )


def truncated_total(table: DataFrame, limit: int) -> int:
    """The sum of min(length, limit) over all documents, for any limit, from the limit table."""
    row = table.filter(F.col("context_limit") >= limit).orderBy("context_limit").first()
    if row is None:
        total = table.first()
        return int(total["total_tokens"]) if total else 0
    shorter = row["total_tokens"] - row["tokens_at_least"]
    return int(shorter + limit * row["docs_at_least"])


def quantile_length(table: DataFrame, share: float) -> int | None:
    """The smallest length that at least this share of the documents does not exceed."""
    row = table.filter(F.col("quantile") >= share).orderBy("context_limit").first()
    return None if row is None else int(row["context_limit"])


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    return limit_table(stored(length_histogram(token_lengths(docs)), "histogram"))
