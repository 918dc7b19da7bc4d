"""Multiset downsampling and pyramids.

A downsampled cell is ``voxel div factor``; label counts add up.  The plan is a
hash aggregate on ``(cell, label)`` with map-side partial aggregation, so the
shuffle carries at most one row per (task, cell, label).  The optional cap on
entries is a ranking window on the already-reduced rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.grid import AXES, BLOCK_COLS, block_position, floor_div, triple


def downsample_multiset(ms: DataFrame, factor, max_entries: int = -1) -> DataFrame:
    """D1 + D2: counts of equal labels per cell add up; keep the ``max_entries``
    most frequent labels per cell (ties: smaller label first); ``< 1`` = no cap."""
    f = triple(factor)
    if any(int(v) < 1 for v in f):
        raise ValueError(f"factors must be >= 1: {f}")
    cells = (ms.select(*[floor_div(a, fi).alias(a) for a, fi in zip(AXES, f)], "label", "n")
               .groupBy(*AXES, "label").agg(F.sum("n").cast("bigint").alias("n")))
    return top_entries(cells, max_entries)


def top_entries(ms: DataFrame, max_entries: int) -> DataFrame:
    """Cap every voxel's multiset at its ``k`` most frequent entries."""
    if max_entries is None or int(max_entries) < 1:
        return ms
    w = Window.partitionBy(*AXES).orderBy(F.col("n").desc(), F.col("label").asc())
    return (ms.withColumn("_rk", F.row_number().over(w))
              .filter(F.col("_rk") <= int(max_entries)).drop("_rk"))


def normalise_pyramid_args(n_levels: int, factors, block_sizes=None, max_entries=None):
    """D3 defaults: missing block sizes repeat the last one (default 64); a
    missing cap inherits the previous level's (first default -1)."""
    factors = [triple(f) for f in factors][:n_levels]
    bs = list(block_sizes or [])
    caps = list(max_entries or [])
    out_b, out_k = [], []
    for i in range(n_levels):
        out_b.append(triple(bs[i]) if i < len(bs) else (out_b[-1] if out_b else (64, 64, 64)))
        out_k.append(int(caps[i]) if i < len(caps) else (out_k[-1] if out_k else -1))
    return factors, out_b, out_k


def multiset_pyramid(ms: DataFrame, factors, max_entries=None) -> list[DataFrame]:
    """D3: levels 1..n, each from the previous one with relative factors.

    Levels are lazy DataFrames; a pipeline writes each level (A3) and reads it
    back for the next, which bounds lineage and lets a lost executor recompute
    only its level.
    """
    factors, _, caps = normalise_pyramid_args(len(factors), factors, None, max_entries)
    levels = [ms]
    for f, k in zip(factors, caps):
        levels.append(downsample_multiset(levels[-1], f, k))
    return levels


def drop_empty_blocks(df: DataFrame, block_size, label_col: str = "label") -> DataFrame:
    """Keep only blocks that hold a non-zero label.

    Semi-join against the distinct block list: AQE turns it into a broadcast
    semi-join when the block list is small at run time, and a shuffled one
    otherwise; the big side is never collected.
    """
    with_blk = block_position(df, block_size)
    fg = with_blk.filter(F.col(label_col) != 0).select(*BLOCK_COLS).distinct()
    return with_blk.join(fg, list(BLOCK_COLS), "left_semi").drop(*BLOCK_COLS)


def multiset_as_map(ms: DataFrame) -> DataFrame:
    """Export form of capped levels: ``(x, y, z, entries array<struct<label, n>>)`` sorted by label.

    An array holds every entry of a cell: bounded by the level's entry cap, or by the cell's voxels where there is none.
    """
    return ms.groupBy(*AXES).agg(
        F.sort_array(F.collect_list(F.struct("label", "n"))).alias("entries"))


def add_background(cells: DataFrame, factor, source_dims) -> DataFrame:
    """Optional sparse-background rule for a downsampled level: the voxels of a
    cell that the sparse source did not list are background, so ``cell volume
    - sum(n)`` is added to label 0.  Ragged edge cells are clipped to
    ``source_dims``.  Only cells that hold some row are completed."""
    f = triple(factor)
    d = triple(source_dims)
    vol = None
    for a, fi, di in zip(AXES, f, d):
        lo = F.col(a) * int(fi)
        ext = F.least(lo + int(fi), F.lit(int(di))) - lo
        vol = ext if vol is None else vol * ext
    tot = cells.groupBy(*AXES).agg(F.sum("n").alias("_t"))
    missing = (tot.withColumn("_v", vol).filter(F.col("_t") < F.col("_v"))
                  .select(*AXES, F.lit(0).cast("bigint").alias("label"),
                          (F.col("_v") - F.col("_t")).cast("bigint").alias("n")))
    return (cells.unionByName(missing).groupBy(*AXES, "label")
                 .agg(F.sum("n").cast("bigint").alias("n")))
