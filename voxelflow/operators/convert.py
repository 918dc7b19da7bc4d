"""Scalar labels -> label multisets, max id, re-blocking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grid import BLOCK_COLS, block_position


def to_multiset(labels: DataFrame) -> DataFrame:
    """Every voxel becomes the multiset {label: 1} (long form, no shuffle)."""
    return labels.select("x", "y", "z", "label", F.lit(1).cast("bigint").alias("n"))


def max_id(labels: DataFrame) -> DataFrame:
    """Largest label id (attribute ``maxId``); partial + final aggregate."""
    return labels.agg(F.max("label").alias("max_id"))


def reblock(df: DataFrame, block_size, num_partitions: int | None = None) -> DataFrame:
    """Assign voxels to blocks of another size and cluster rows by block.

    Range partitioning on the block key keeps neighbouring blocks together,
    which is what a block-addressed writer wants; the partition count comes
    from AQE when not given.
    """
    out = block_position(df, block_size)
    cols = [F.col(c) for c in ("bz", "by_", "bx")]
    return out.repartitionByRange(num_partitions, *cols) if num_partitions else \
        out.repartitionByRange(*cols)


__all__ = ["to_multiset", "max_id", "reblock", "BLOCK_COLS"]
