"""Tables and files in the folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..session import shared_dir


_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Bytes of rows that go to a Python worker at once.
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches have at most BATCH_BYTES from now on, unless the cluster's settings name a size: Spark's own limit
    (256 MB, or 10,000 rows) is several times what a worker's share of an executor can hold with its copies."""
    if not spark.sparkContext.getConf().contains(_BATCH):
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def folder(spark: SparkSession, name: str) -> str:
    """A new path under spark.checkpoint.dir."""
    return f"{shared_dir(spark)}/llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and go on from the files: later steps neither compute it again nor need its executors."""
    small_batches(df.sparkSession)
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_ranges(df: DataFrame, *order: Column) -> DataFrame:
    """A table of `df` with `range`, the number of the range of rows by `order` that a row is in."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return table(df.repartitionByRange(parts, *order).withColumn("range", F.spark_partition_id()), "ranges")


def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """`df` and `number`, each row's place by `order` from 0 on. Rows are put in order in ranges, never all in one task."""
    ranged = in_ranges(df, *order)
    sizes = ranged.groupBy("range").agg(F.count("*").alias("n"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # one row for each range
    sizes = sizes.select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("range").orderBy(*order)) - 1
    rows = ranged.withColumn("number", place.cast("long")).join(F.broadcast(sizes), "range")
    return rows.withColumn("number", F.col("number") + F.col("before")).drop("range", "before")


def clear(spark: SparkSession) -> None:
    """Delete all that this application wrote by `table` and `folder`; their DataFrames can't be read any more."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder(spark, "x").rsplit("/", 1)[0])
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
