"""Scratch tables in the shared folder of the cluster.

Loops cut their lineage by writing each step to a table and reading it back.
Unlike a cached copy the table outlives a lost executor, and its file sizes
give the planner a measured size for the next join.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

LOCAL_SCRATCH = f"file://{tempfile.gettempdir()}/pagemill-scratch"


def scratch_root(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, else the context's checkpoint folder.

    A session of one process with neither gets a folder of its own machine,
    which is all of its cluster; any other session has to name one.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    active = spark.sparkContext.getCheckpointDir()
    if active:
        return active.rstrip("/")
    if re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        return LOCAL_SCRATCH
    raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch root, in a folder of the application that can go when it has ended."""
    return f"{scratch_root(spark)}/pagemill/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a scratch table and return a scan of it."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_scratch(*tables: DataFrame) -> None:
    """Delete scratch tables of which everything that is still needed has been written elsewhere."""
    for table in tables:
        spark = table.sparkSession
        root = scratch_root(spark).removeprefix("file:").lstrip("/")
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            if root not in folder:
                raise ValueError(f"{folder} is not below the scratch root")
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class BucketedTable:
    """A growing scratch table in hash buckets of one column.

    A join on ``key`` reads it where it lies: with as many buckets as the
    session has shuffle partitions, only the other side is shuffled. Each
    :meth:`append` adds a file a bucket.
    """

    def __init__(self, spark: SparkSession, label: str, key: str):
        self.spark, self.key = spark, key
        self.path = scratch_path(spark, label)
        self.name = f"pagemill_{uuid.uuid4().hex}"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def append(self, rows: DataFrame) -> DataFrame:
        """Add ``rows``; a scan of all rows so far."""
        dealt = rows.repartition(self.buckets, self.key).write.format("parquet").mode("append")
        dealt.bucketBy(self.buckets, self.key).sortBy(self.key).option("path", self.path).saveAsTable(self.name)
        return self.spark.table(self.name)

    def drop(self) -> None:
        """Delete the table and its files."""
        if self.spark.catalog.tableExists(self.name):
            drop_scratch(self.spark.table(self.name))
            self.spark.sql(f"DROP TABLE {self.name}")


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; for a plain scan, the bytes on disk."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def spread_small(df: DataFrame, *keys: str, per_task: int = 4 << 20) -> DataFrame:
    """Use all cores for a scan too small to be split by the file reader.

    One small parquet file is one task however costly its rows are to parse.
    A round-robin-free hash repartition on ``keys`` fixes that for inputs of
    at most ``per_task`` bytes a core. Larger scans are already split by
    ``spark.sql.files.maxPartitionBytes`` and are returned as they are, so no
    large corpus is ever shuffled here.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.isStreaming or plan_bytes(df) > per_task * cores:
        return df
    return df.repartition(cores, *keys)
