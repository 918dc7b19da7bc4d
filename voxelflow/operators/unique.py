"""Unique labels per block and their pyramid.

Long form ``(bx, by_, bz, label)`` is the working form: ``distinct`` on it is a
hash aggregate with map-side partial aggregation, so each task ships at most
one row per (block, label) it saw.  Background label 0 is kept, as in the
reference; it is one row per block, so it cannot skew these plans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.grid import BLOCK_COLS, block_position, floor_div, triple, check_factors


def unique_labels(labels: DataFrame, block_size, include_background: bool = True) -> DataFrame:
    """Distinct labels per block; 0 included unless told otherwise."""
    if not include_background:
        labels = labels.filter(F.col("label") != 0)
    return (block_position(labels.select("x", "y", "z", "label"), block_size)
            .select(*BLOCK_COLS, "label").distinct())


def voxel_argmax(ms: DataFrame) -> DataFrame:
    """Most frequent label of each voxel of a multiset (ties: smallest label).

    ``max`` over a struct (n, ~label) is a plain hash aggregate: no sort and
    no window, so a voxel with many entries never forms a big group.
    """
    best = F.max(F.struct(F.col("n"), F.bitwise_not("label").alias("neg")))      # reverses the order of every long
    return (ms.groupBy("x", "y", "z").agg(best.alias("b"))
              .select("x", "y", "z", F.bitwise_not("b.neg").alias("label")))


def unique_labels_multiset(ms: DataFrame, block_size, mode: str = "argmax") -> DataFrame:
    """Unique labels per block of a multiset volume.

    ``argmax`` takes the representative (most frequent) label per voxel as the
    reference's iteration does; ``all`` takes every label in the multisets.
    """
    if mode == "argmax":
        vox = voxel_argmax(ms)
    elif mode == "all":
        vox = ms.select("x", "y", "z", "label")
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return unique_labels(vox, block_size)


def max_label(labels: DataFrame) -> DataFrame:
    """Largest label, floored at 0 (one row)."""
    return labels.agg(F.greatest(F.lit(0).cast("bigint"),
                                 F.coalesce(F.max("label"), F.lit(0).cast("bigint"))).alias("max_label"))


def downsample_unique_labels(u: DataFrame, factor, prev_block, cur_block) -> DataFrame:
    """Union of the source block lists covered by each target block.

    A target block of size ``Bcur`` at factor ``f`` covers ``Bcur*f/Bprev``
    source blocks per axis; the coarse key nests the fine one.
    """
    check_factors(factor, prev_block, cur_block)
    r = [int(bc) * int(f) // int(bp)
         for f, bp, bc in zip(triple(factor), triple(prev_block), triple(cur_block))]
    return u.select(*[floor_div(bc, ri).alias(bc) for bc, ri in zip(BLOCK_COLS, r)],
                    "label").distinct()


def unique_label_pyramid(u0: DataFrame, factors, block_sizes, b0) -> list[DataFrame]:
    """E5: levels 1..n of unique-label lists; each level built from the previous."""
    levels = [u0]
    prev_b = triple(b0)
    for f, b in zip(factors, block_sizes):
        levels.append(downsample_unique_labels(levels[-1], f, prev_b, b))
        prev_b = triple(b)
    return levels


def label_lists(u: DataFrame) -> DataFrame:
    """Export form of a fine level: one sorted ``array<bigint>`` per block.

    A list holds at most as many labels as the block has source voxels, which is a bound
    at level 0 only; ``label_sets`` is the form whose rows stay bounded at any level.
    """
    return u.groupBy(*BLOCK_COLS).agg(F.sort_array(F.collect_list("label")).alias("labels"))


def explode_label_lists(lists: DataFrame) -> DataFrame:
    return lists.select(*BLOCK_COLS, F.explode("labels").alias("label"))


# ---------------------------------------------------------------------------
# Label sets as bitmaps
# ---------------------------------------------------------------------------

def label_sets(u: DataFrame) -> DataFrame:
    """``(bx, by_, bz, bucket, bitmap)``: a block's labels as bitmaps of 32,768 labels (4 KB) each.

    However many labels a coarse block holds, a row has a fixed size, and sets of
    blocks unite by ``bitmap_or_agg`` without going back to single labels.
    """
    return (u.select(*BLOCK_COLS, F.bitmap_bucket_number("label").alias("bucket"), F.bitmap_bit_position("label").alias("at"))
             .groupBy(*BLOCK_COLS, "bucket").agg(F.bitmap_construct_agg("at").alias("bitmap")))


def downsample_label_sets(sets: DataFrame, factor, prev_block, cur_block) -> DataFrame:
    """E4 on label sets: the union of the sets that each target block covers."""
    check_factors(factor, prev_block, cur_block)
    r = [int(bc) * int(f) // int(bp) for f, bp, bc in zip(triple(factor), triple(prev_block), triple(cur_block))]
    up = sets.select(*[floor_div(bc, ri).alias(bc) for bc, ri in zip(BLOCK_COLS, r)], "bucket", "bitmap")
    return up.groupBy(*BLOCK_COLS, "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))


def labels_of_sets(sets: DataFrame) -> DataFrame:
    """``(bx, by_, bz, label)`` of label sets: one row per set bit."""
    keys = [c for c in sets.columns if c != "bitmap"]
    parts = sets.select(*keys, F.posexplode(F.split(F.hex("bitmap"), "(?<=\\G..)")).alias("byte", "h"))
    value = F.conv("h", 16, 10).cast("int")
    bits = parts.select(*keys, "byte", value.alias("v")).filter("v > 0").select(
        *keys, "byte", "v", F.explode(F.array(*[F.lit(i) for i in range(8)])).alias("bit"))
    at = (F.col("byte") * 8 + F.col("bit")).cast("bigint")
    label = F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * 32768 + at + 1).otherwise(F.col("bucket") * 32768 - at)
    return (bits.filter(F.expr("shiftright(v, bit)").bitwiseAND(1) == 1)
                .select(*[k for k in keys if k != "bucket"], label.cast("bigint").alias("label")))
