"""A table of the newest row of every key, kept up to date by a stream.

The table is cut into hash buckets. A batch reads and rewrites only the buckets
that it has keys of, into a folder of its own, and then says in a manifest which
folder holds each bucket. The folders of a manifest and of the one before it
stay, so a batch that is repeated after a failure starts from the same state
and changes nothing; older ones are deleted. So there are at most two folders a
bucket, however many batches have run, and a reader always sees a whole batch.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from pagemill.operators.ordering import null_safe_join

BUCKETS = 64
MANIFEST = "bucket int, folder string"


def _names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if there is no such folder."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []


def _delete(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def _manifests(spark: SparkSession, path: str) -> list[int]:
    """The batches that have been finished, in order."""
    return [int(n) for n in _names(spark, f"{path}/manifest") if "_SUCCESS" in _names(spark, f"{path}/manifest/{n}")]


def _manifest(spark: SparkSession, path: str, batch: int) -> dict[int, str]:
    rows = spark.read.schema(MANIFEST).json(f"{path}/manifest/{batch:012d}").collect()  # a row a bucket
    return {r["bucket"]: r["folder"] for r in rows}


def _read(spark: SparkSession, path: str, folders: Sequence[str], schema: T.StructType) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/data/{f}" for f in folders])


def read_state(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table after the last whole batch; no rows before the first one."""
    done = _manifests(spark, path)
    return _read(spark, path, list(_manifest(spark, path, done[-1]).values()) if done else [], schema)


def upsert(batch: DataFrame, batch_id: int, path: str, keys: Sequence[str], newest: Column | None = None, buckets: int = BUCKETS) -> None:
    """Put the rows of a batch in the place of those with the same key.

    Of several rows with a key in a batch the one with the greatest ``newest``
    stays, of equal ones any; null keys are keys. A row of the batch replaces
    an older one whatever its ``newest``.
    """
    spark, schema = batch.sparkSession, batch.schema
    before = [b for b in _manifests(spark, path) if b < batch_id]
    held = _manifest(spark, path, before[-1]) if before else {}
    order = newest if newest is not None else F.lit(0)
    chosen = batch.groupBy(*keys).agg(F.max_by(F.struct(*batch.columns), order).alias("_row")).select("_row.*")
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("_bucket")
    changed = chosen.select("*", bucket).persist()
    try:
        touched = sorted(r["_bucket"] for r in changed.select("_bucket").distinct().collect())  # at most ``buckets``
        old = _read(spark, path, [held[b] for b in touched if b in held], schema)
        kept = null_safe_join(old, changed.select(*keys), list(keys), "left_anti").select("*", bucket)
        folder = f"batch-{batch_id:012d}"
        merged = kept.unionByName(changed).repartition(max(1, len(touched)), "_bucket")
        merged.write.mode("overwrite").partitionBy("_bucket").parquet(f"{path}/data/{folder}")
    finally:
        changed.unpersist()
    now = held | {b: f"{folder}/_bucket={b}" for b in touched}
    rows = spark.createDataFrame(sorted(now.items()), MANIFEST).coalesce(1)
    rows.write.mode("overwrite").json(f"{path}/manifest/{batch_id:012d}")
    needed = {f for f in (*now.values(), *held.values())}
    for name in _names(spark, f"{path}/data"):
        if name > folder:
            continue
        own = [n for n in _names(spark, f"{path}/data/{name}") if n.startswith("_bucket=")]
        left = [n for n in own if f"{name}/{n}" in needed]
        for n in own if not left else set(own) - set(left):
            _delete(spark, f"{path}/data/{name}/{n}")
        if not left:
            _delete(spark, f"{path}/data/{name}")
    for b in before[:-1]:
        _delete(spark, f"{path}/manifest/{b:012d}")


def run_to_state(
    df: DataFrame, path: str, checkpoint: str, keys: Sequence[str], newest: Column | None = None, buckets: int = BUCKETS, mode: str = "update"
) -> StreamingQuery:
    """Keep the table at ``path`` up to date with all that arrives; run again, it goes on after the last whole batch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, batch_id, path, keys, newest, buckets)

    return df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
