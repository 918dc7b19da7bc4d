"""Stored label -> block index.

The index is one table, partitioned by level and *shard*, a hash of the bucket
``label div step``, and sorted by bucket and label inside: a lookup reads the
one folder that its bucket hashes to, and the row groups that hold the label.
Labels of one bucket stay together, as they do in the reference's bucket files, and a
label present in every block is many rows of one shard, not one row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ..operators import index
from . import ledger as led

SHARDS = 64


def folder(path: str, name: str) -> str:
    return f"{path}-index/{name}"


def _shard(bucket, shards: int):
    return F.pmod(F.xxhash64(bucket), F.lit(int(shards))).cast("int")


def _write(ledger: led.Ledger, df: DataFrame, path: str, name: str, kind: str, step: int, shards: int, order: list[str],
           args: dict | None) -> Row:
    levels = df if "level" in df.columns else df.withColumn("level", F.lit(0))
    out = levels.withColumn("shard", _shard(F.col("bucket"), shards))
    claimed = ledger.claim(name, 0, 1, kind, args=args, attrs={"kind": kind, "step": str(step), "shards": str(shards)})
    seen = Observation()
    (out.hint("rebalance", "level", "shard").observe(seen, F.count(F.lit(1)).alias("rows"), F.max("label").alias("top"))
        .sortWithinPartitions("level", "shard", "bucket", "label", *order)
        .write.mode("overwrite").partitionBy("level", "shard").parquet(folder(path, name)))
    return ledger.complete(claimed, max_id=seen.get["top"], rows=seen.get["rows"])


def write_index(ledger: led.Ledger, index_b: DataFrame, path: str, name: str, step: int = 1, shards: int = SHARDS,
                args: dict | None = None) -> Row:
    """store ``index_b(label, bucket, x0..z1[, level])``; buckets are ``label div step``."""
    return _write(ledger, index_b, path, name, "index", step, shards, ["z0", "y0", "x0"], args)


def write_records(ledger: led.Ledger, lists: DataFrame, path: str, name: str, step: int = 1, shards: int = SHARDS) -> Row:
    """Store per-label box lists as big-endian records of 48 bytes, in parts of bounded size."""
    rec = index.boxes_binary(lists).withColumn("bucket", index.bucket_of("label", step))
    return _write(ledger, rec, path, name, "records", step, shards, ["part"], None)


def open_index(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The whole stored index; refused while its write has not completed."""
    led.Ledger(spark, path).require_complete(name)
    return spark.read.parquet(folder(path, name)).drop("shard")


def lookup(spark: SparkSession, path: str, name: str, label: int, level: int | None = None) -> DataFrame:
    """the rows of one label.  The shard is a constant by the time the plan is made, so one folder a level is read."""
    row = led.Ledger(spark, path).require_complete(name)
    step, shards = int(row["attrs"]["step"]), int(row["attrs"]["shards"])
    bucket = abs(int(label)) // step * (1 if label >= 0 else -1)      # ``div`` cuts towards zero
    df = spark.read.parquet(folder(path, name))
    shard = spark.range(1).select(_shard(F.lit(bucket).cast("bigint"), shards)).first()[0]
    df = df.filter((F.col("shard") == shard) & (F.col("bucket") == bucket) & (F.col("label") == int(label)))
    if level is not None:
        df = df.filter(F.col("level") == int(level))
    return df.drop("shard")
