"""Voxel tables bucketed by block: joins and windows by block read them without a shuffle.

A bucketed copy of a volume is a catalogue table over Parquet files, dealt to
``buckets`` files by the hash of its block columns ``bx, by_, bz`` (which it
stores).  Its scan is already partitioned by block, so a window or an aggregate
whose keys hold the block moves no voxel.  The one exchange is paid at the
write.  A join on block and position does so too where the session allows keys
that are partitioned by a part of them (``join_in_buckets``); it is not the
default, since elsewhere a part of the keys may be skewed, and without it the join has the
same result and an exchange.  With ``reach`` a block also holds the voxels around it
(B13), so that neighbours outside a block are found inside its bucket.

The ledger of the store holds number of buckets, location and schema; a session
that does not know the table registers it from there.  Every version has its
own folder, so readers of the version before are not disturbed; it goes once
the next one is complete.

Two tables that are to be joined need the same number of buckets (otherwise
the smaller one is exchanged; the result is the same).  A block of 64^3 voxels
is a few MB, so a bucket is as even as blocks are; take about the volume's
stored bytes / 128 MB.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from ..functions.grid import AXES, BLOCK_COLS, block_position, halo_blocks
from .ledger import Ledger

KIND = "bucketed"
CO_PARTITION = "spark.sql.requireAllClusterKeysForCoPartition"


def join_in_buckets(spark: SparkSession) -> None:
    """Let the joins of this session use a partitioning by a part of their keys, such as the block's."""
    spark.conf.set(CO_PARTITION, "false")


def _location(path: str, dataset: str, level: int, version: int) -> str:
    return f"{path}-buckets/{dataset.replace('/', '%2F')}/level={int(level)}/version={int(version)}"


def _table(location: str) -> str:
    return "voxels_" + hashlib.sha256(location.encode()).hexdigest()[:32]


def _drop(spark: SparkSession, location: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_table(location)}")
    p = spark._jvm.org.apache.hadoop.fs.Path(location)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def write_bucketed(ledger: Ledger, vol: DataFrame, path: str, dataset: str, block_size, buckets: int | None = None,
                   level: int = 0, reach=None, dims=None, **claim) -> Row:
    """Write ``vol`` as a table bucketed by block under a claim; returns the ledger row.

    ``reach``: voxels per axis around a block that it holds as well.
    ``buckets`` defaults to the session's shuffle partitions.
    """
    spark = vol.sparkSession
    n = int(buckets or spark.conf.get("spark.sql.shuffle.partitions"))
    old = ledger.row(dataset, level)
    claimed = ledger.claim(dataset, level, block_size, "struct", dims, known=old, **claim)
    at = _location(path, dataset, level, claimed["version"])
    placed = block_position(vol, block_size) if reach is None else halo_blocks(vol, block_size, reach, dims)
    out = placed.select(*BLOCK_COLS, *vol.columns)
    seen = Observation()
    found = [F.count(F.lit(1)).alias("rows"), *[(F.max(a) + 1).cast("bigint").alias("n" + a) for a in AXES]]
    # one task a bucket, so one file a bucket
    (out.repartition(n, *BLOCK_COLS).observe(seen, *found).write.mode("overwrite").format("parquet").option("path", at)
        .bucketBy(n, *BLOCK_COLS).sortBy(*BLOCK_COLS, "z", "y", "x").saveAsTable(_table(at)))
    got = seen.get
    done = ledger.complete(claimed, dims or [got["n" + a] or 0 for a in AXES], rows=got["rows"], attrs={
        "kind": KIND, "buckets": n, "schema": ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema)})
    if old is not None and (old["attrs"] or {}).get("kind") == KIND:
        _drop(spark, _location(path, dataset, level, old["version"]))
    return done


def open_bucketed(spark: SparkSession, path: str, dataset: str, level: int = 0) -> DataFrame:
    """A complete bucketed table, with its block columns."""
    r = Ledger(spark, path).require_complete(dataset, level)
    if (r["attrs"] or {}).get("kind") != KIND:
        raise ValueError(f"dataset {dataset} is not bucketed")
    at = _location(path, dataset, level, r["version"])
    spark.sql(f"CREATE TABLE IF NOT EXISTS {_table(at)} ({r['attrs']['schema']}) USING parquet "
              f"CLUSTERED BY ({', '.join(BLOCK_COLS)}) INTO {int(r['attrs']['buckets'])} BUCKETS LOCATION '{at}'")
    return spark.table(_table(at))
