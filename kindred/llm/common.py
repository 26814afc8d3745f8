"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import functools
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

#: Buckets that a group is dealt over when its rows are numbered. A hot group is then read by that many tasks.
RANK_BUCKETS = 128


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see: what the session names in spark.checkpoint.dir.

    Where that is unset, a session on one machine gets a local folder; on a cluster nothing else is shared for sure, so
    it is an error there.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    held = spark.sparkContext.getCheckpointDir()
    if held:
        return held.rstrip("/")
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    spark.sparkContext.setCheckpointDir("file:///tmp/kindred-shared")
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{_own_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _own_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/kindred-{spark.sparkContext.applicationId}"


def sweep(spark: SparkSession) -> None:
    """Deletes all intermediate tables of this application; call it when no result is read any more."""
    _delete(spark, _own_dir(spark))


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it again: lineage ends there and lost executors cost no recomputation."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def forget(*tables: DataFrame) -> None:
    """Deletes the files of tables made by stored() that no later plan reads."""
    for df in tables:
        for file in df.inputFiles()[:1]:
            _delete(df.sparkSession, file.rpartition("/")[0])


def local_table(spark: SparkSession, rows: Iterable[tuple], schema: str) -> DataFrame:
    """rows of the driver as a DataFrame, by way of Arrow.

    From a list createDataFrame would take them through Python workers of another kind than those of UDFs, and each
    executor would keep a second daemon with its workers.
    """
    kind = StructType.fromDDL(schema)
    fields = to_arrow_schema(kind)
    columns = list(zip(*rows, strict=True)) or [()] * len(fields)
    return spark.createDataFrame(pa.table([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields), kind)


def freeing(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """work (batches to batches in a Python worker), and behind it the worker gives its free memory back to the system.

    Spark keeps workers for later tasks, and what one task has freed would stay theirs.
    """

    @functools.wraps(work)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return run


def buckets_for(rows: int) -> int:
    """Enough buckets for rows of one hot group to be read in parts of half a million."""
    return max(RANK_BUCKETS, rows // 500_000)


def numbered(df: DataFrame, groups: list[str], order: list[str], into: str, buckets: int = RANK_BUCKETS) -> DataFrame:
    """Adds a gapless number from 0 within each group, without ever gathering a group in one task.

    Rows are dealt by (group, bucket); bucket counts give each bucket its start. `order` should identify a row;
    rows that agree in it are numbered in any order among themselves. Groups must not be null. df is read twice: pass a
    stored table.
    """
    bucket, start, count = (column_name(df, c) for c in ("bucket", "start_of_bucket", "rows_of_bucket"))
    dealt = df.withColumn(bucket, F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    keys = [*groups, bucket]
    before = Window.partitionBy(*groups).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(*keys).agg(F.count(F.lit(1)).alias(count)).select(*keys, F.coalesce(F.sum(count).over(before), F.lit(0)).alias(start))
    within = Window.partitionBy(*keys).orderBy(*order)
    out = dealt.join(starts, keys).withColumn(into, F.col(start) + F.row_number().over(within) - 1)
    return out.drop(bucket, start)


def column_name(df: DataFrame, name: str) -> str:
    """`name`, or with underscores behind it if df has a column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
