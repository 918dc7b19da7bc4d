"""Prediction mask.

An output block is 1 iff every input-mask voxel in its padded, world-mapped box
is non-zero and inside the input.  Sparse input: an absent voxel is 0, so the
test is ``count(non-zero voxels in box) == box volume``.

Counts come from a summed volume.  Box corners lie on a grid, one lower and one
upper coordinate per block and axis, so the volume is first cut at those
coordinates: every voxel finds the first corner at or above it on each axis
(three lookups in tables of the axis' length), and one aggregate counts voxels per
cell of the cut.  Three running sums, one per axis and each along lines of twice the
blocks of that axis, make the counts cumulative, and a box is the signed sum
of its eight corners.  No voxel meets a box, and the cost doesn't depend on how
far boxes overlap (the field of view).

A mask known only by its dims needs no counting: ``prediction_mask_dims``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.grid import AXES, BLOCK_COLS, triple
from ..sources.volume import block_grid_of


def block_input_boxes(blocks: DataFrame, in_res, out_res, in_off, out_off, pad) -> DataFrame:
    """Output box (voxels) -> world (scale, translate, pad) -> smallest
    containing input box ``lo_* .. hi_*``."""
    cols = {}
    for a, ri, ro, oi, oo, p in zip(AXES, triple(in_res), triple(out_res), triple(in_off),
                                    triple(out_off), triple(pad)):
        wmin = F.col(a + "0") * float(ro) + float(oo) - float(p)
        wmax = F.col(a + "1") * float(ro) + float(oo) + float(p)
        cols["lo_" + a] = F.floor((wmin - float(oi)) / float(ri)).cast("bigint")
        cols["hi_" + a] = F.ceil((wmax - float(oi)) / float(ri)).cast("bigint")
    return blocks.withColumns(cols)


def _axis_blocks(out_extent: DataFrame, axis: int, block, *world) -> DataFrame:
    """``(b, lo, hi)``: the input interval of every block of one axis."""
    a, bi = AXES[axis], int(triple(block)[axis])
    n = F.ceil(F.col("n" + a) / F.lit(bi)).cast("bigint")
    g = out_extent.select("n" + a, F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1)).alias("b"))
    own = g.select("b", (F.col("b") * bi).alias(a + "0"), F.least(F.col("b") * bi + (bi - 1), F.col("n" + a) - 1).alias(a + "1"),
                   *[F.lit(0).alias(o + e) for o in AXES if o != a for e in "01"])
    return block_input_boxes(own, *world).select("b", F.col("lo_" + a).alias("lo"), F.col("hi_" + a).alias("hi"))


def _corners(blocks: DataFrame) -> DataFrame:
    """``(c, i, since)``: the axis coordinates at which counts are needed, numbered, each with the one before."""
    w = Window.orderBy("c")     # twice the blocks of one axis
    c = blocks.select(F.explode(F.array(F.col("lo") - 1, "hi")).alias("c")).distinct()
    return c.select("c", (F.row_number().over(w) - 1).cast("bigint").alias("i"), F.lag("c").over(w).alias("since"))


def summed_volume(voxels: DataFrame, corners: list[DataFrame]) -> DataFrame:
    """``(i0, i1, i2, s)``: voxels at or below corner ``(i0, i1, i2)`` on every axis.

    The tables that are broadcast have one row per voxel of an axis, or per corner, whatever the volume holds.
    """
    cut = voxels.select(*AXES)
    for k, (a, c) in enumerate(zip(AXES, corners)):
        start = F.greatest(F.coalesce(F.col("since") + 1, F.lit(0)), F.lit(0)).cast("bigint")
        to = c.filter(F.col("c") >= start).select(F.explode(F.sequence(start, F.col("c"))).alias(a), F.col("i").alias(f"i{k}"))
        cut = cut.join(F.broadcast(to), a)
    ids = ["i0", "i1", "i2"]
    counts = cut.groupBy(*ids).agg(F.count(F.lit(1)).alias("n"))
    sizes = [c.agg(F.count(F.lit(1)).alias("k")).scalar() for c in corners]
    cells = voxels.sparkSession.range(1).select(
        *[F.sequence(F.lit(0).cast("bigint"), k - 1).alias(i) for i, k in zip(ids, sizes)])
    for i in ids:
        cells = cells.withColumn(i, F.explode(i))
    s = cells.join(counts, ids, "left").select(*ids, F.coalesce("n", F.lit(0).cast("bigint")).alias("s"))
    for i in ids:
        line = Window.partitionBy(*[o for o in ids if o != i]).orderBy(i).rowsBetween(Window.unboundedPreceding, 0)
        s = s.withColumn("s", F.sum("s").over(line))
    return s


def _and(conds) -> Column:
    return reduce(lambda a, b: a & b, conds)


def prediction_mask(mask: DataFrame, out_extent: DataFrame, block, in_res, out_res,
                    in_off=(0, 0, 0), out_off=(0, 0, 0), pad=(0, 0, 0)) -> DataFrame:
    """``(bx, by_, bz, x0..z1, m)`` per output block.

    ``out_extent`` is a one-row ``(nx, ny, nz)`` DataFrame of output dims.
    """
    world = (in_res, out_res, in_off, out_off, pad)
    own = [_axis_blocks(out_extent, k, block, *world) for k in range(3)]
    corners = [_corners(b) for b in own]
    s = summed_volume(mask.filter(F.col("m") != 0), corners)
    blocks = block_input_boxes(block_grid_of(out_extent, block), *world)
    boxes = blocks.select(*BLOCK_COLS, *["lo_" + a for a in AXES], *["hi_" + a for a in AXES])
    for k, (a, c) in enumerate(zip(AXES, corners)):
        for end, col in (("lo", F.col("lo_" + a) - 1), ("hi", F.col("hi_" + a))):
            at = c.select(F.col("c").alias("_c"), F.col("i").alias(f"{end}{k}"))
            boxes = boxes.join(F.broadcast(at), col == F.col("_c")).drop("_c")
    signs = [F.struct(*[F.col(("lo" if m >> k & 1 else "hi") + str(k)).alias(f"i{k}") for k in range(3)],
                      F.lit(-1 if bin(m).count("1") % 2 else 1).alias("sign")) for m in range(8)]
    hits = (boxes.select(*BLOCK_COLS, F.explode(F.array(*signs)).alias("k")).select(*BLOCK_COLS, "k.*")
                 .join(s, ["i0", "i1", "i2"]).groupBy(*BLOCK_COLS).agg(F.sum(F.col("sign") * F.col("s")).alias("nz")))
    vol = reduce(lambda a, b: a * b, [F.col("hi_" + a) - F.col("lo_" + a) + 1 for a in AXES])
    out = blocks.join(hits, list(BLOCK_COLS), "left")
    m = F.when(F.coalesce(F.col("nz"), F.lit(0)) == vol, F.lit(1)).otherwise(F.lit(0))
    return out.select(*BLOCK_COLS, *[a + s for s in "01" for a in AXES], m.alias("m"))


def prediction_mask_dims(in_extent: DataFrame, out_extent: DataFrame, block, in_res, out_res,
                         in_off=(0, 0, 0), out_off=(0, 0, 0), pad=(0, 0, 0)) -> DataFrame:
    """G5 for an input known only by its dims: 1 inside them, 0 outside, so a block's box has to lie inside."""
    blocks = block_input_boxes(block_grid_of(out_extent, block), in_res, out_res, in_off, out_off, pad)
    dims = [in_extent.select("n" + a).scalar() for a in AXES]
    ok = _and([(F.col("lo_" + a) >= 0) & (F.col("hi_" + a) < n) for a, n in zip(AXES, dims)])
    return blocks.select(*BLOCK_COLS, *[a + s for s in "01" for a in AXES], F.when(ok, F.lit(1)).otherwise(F.lit(0)).alias("m"))


def snapped_extent(in_extent: DataFrame, in_res, out_res, net_out_world) -> DataFrame:
    """Output dims of an input whose world size is snapped up to whole network outputs."""
    cols = [(F.ceil(F.col("n" + a) * float(ri) / float(net)) * (float(net) / float(ro))).cast("bigint").alias("n" + a)
            for a, ri, ro, net in zip(AXES, triple(in_res), triple(out_res), triple(net_out_world))]
    return in_extent.select(*cols)
