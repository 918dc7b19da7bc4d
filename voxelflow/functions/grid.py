"""Grid and geometry expressions.

All are Column expressions, so they stay inside whole-stage codegen.  Block
coordinates are named ``bx, by_, bz`` (``by`` is a SQL keyword).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AXES = ("x", "y", "z")
BLOCK_COLS = ("bx", "by_", "bz")


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def triple(v) -> tuple:
    """Scalar or sequence -> 3-tuple (a single value repeats)."""
    if isinstance(v, (int, float)):
        return (v, v, v)
    v = tuple(v)
    if len(v) == 1:
        return (v[0],) * 3
    if len(v) != 3:
        raise ValueError(f"expected 1 or 3 components, got {v}")
    return v


def floor_div(c, k: int) -> Column:
    """Floor division of an integer column by a positive constant (B2)."""
    k = int(k)
    if k <= 0:
        raise ValueError("divisor must be positive")
    if k == 1:
        return col_of(c).cast("bigint")
    c = col_of(c)
    return F.call_function("div", c - F.pmod(c, F.lit(k)), F.lit(k)).cast("bigint")     # integral: exact beyond 2^53


def block_position(df: DataFrame, block_size, axes=AXES) -> DataFrame:
    """Add ``bx, by_, bz`` = voxel position div block size (B2)."""
    b = triple(block_size)
    return df.withColumns({bc: floor_div(a, bi) for bc, a, bi in zip(BLOCK_COLS, axes, b)})


def block_box(block_size, dims, prefix: str = "") -> dict:
    """Columns ``x0..z1`` of the (clipped, inclusive) box of block ``bx, by_, bz``."""
    b = triple(block_size)
    d = triple(dims)
    out = {}
    for a, bc, bi, di in zip(AXES, BLOCK_COLS, b, d):
        lo = F.col(prefix + bc) * F.lit(int(bi))
        out[a + "0"] = lo.cast("bigint")
        out[a + "1"] = F.least(lo + F.lit(int(bi) - 1), F.lit(int(di) - 1)).cast("bigint")
    return out


def block_grid(spark: SparkSession, dims, block_size) -> DataFrame:
    """All blocks of a ``dims`` volume with their clipped boxes (B1).

    Generated with ``spark.range`` so the grid itself is distributed; the number
    of rows is the number of blocks (volume / block volume).
    """
    d = triple(dims)
    b = triple(block_size)
    n = [max(0, -(-int(di) // int(bi))) for di, bi in zip(d, b)]
    total = n[0] * n[1] * n[2]
    i = F.col("id")
    g = spark.range(total).select(
        (i % n[0]).alias("bx"),
        ((i / n[0]).cast("bigint") % n[1]).alias("by_"),
        (i / (n[0] * n[1])).cast("bigint").alias("bz"))
    return g.withColumns(block_box(b, d))


def downsampled_dims(dims, factors) -> tuple:
    """ceil(dim / f) per axis."""
    return tuple(int(math.ceil(int(d) / int(f))) for d, f in zip(triple(dims), triple(factors)))


def linear_index(dims, x="x", y="y", z="z") -> Column:
    """x + nx*(y + ny*z): row-major id with x fastest."""
    nx, ny, _ = triple(dims)
    return (col_of(x) + F.lit(int(nx)) * (col_of(y) + F.lit(int(ny)) * col_of(z))).cast("bigint")


def check_factors(factors: Sequence[int], prev_block, cur_block) -> None:
    """Factor >= 1 and block alignment (Bcur*f) % Bprev == 0."""
    f = triple(factors)
    if any(int(v) < 1 for v in f):
        raise ValueError(f"downsampling factors must be >= 1: {f}")
    for fi, bp, bc in zip(f, triple(prev_block), triple(cur_block)):
        if (int(bc) * int(fi)) % int(bp) != 0:
            raise ValueError(
                f"block size {bc} x factor {fi} is not a multiple of the previous block size {bp}")


def input_aligned_block(b_in, b_out) -> tuple:
    """Re-block size aligned to the input: max(round(Bin/Bout),1)*Bout."""
    return tuple(max(int(round(int(i) / int(o))), 1) * int(o)
                 for i, o in zip(triple(b_in), triple(b_out)))


def task_key(block_size, blocks_per_task, axes=AXES) -> dict:
    """Coarser grouping key for task / super-block grouping."""
    b = triple(block_size)
    t = triple(blocks_per_task)
    return {f"t{a}": floor_div(a, int(bi) * int(ti)) for a, bi, ti in zip(axes, b, t)}


def world_to_voxel(c, resolution: float, offset: float = 0.0, rounding: str = "floor") -> Column:
    """(world - offset) / resolution, floored or ceiled."""
    v = (col_of(c) - F.lit(float(offset))) / F.lit(float(resolution))
    return (F.floor(v) if rounding == "floor" else F.ceil(v)).cast("bigint")


def snap_up(n: int, block: int) -> int:
    """Smallest multiple of ``block`` >= n."""
    return -(-int(n) // int(block)) * int(block)


def halo_blocks(df: DataFrame, block_size, halo, dims=None) -> DataFrame:
    """Assign every voxel to each block whose box, expanded by ``halo``
    voxels per axis, contains it (``bx, by_, bz`` columns; a voxel near a face
    appears once per neighbouring block).  Used to give blocks context without
    a band join: rows grow by at most the halo's face fraction.  With ``dims``
    no block past the volume appears."""
    b = triple(block_size)
    h = triple(halo)
    out = df
    for i, (a, bc, bi, hi) in enumerate(zip(AXES, BLOCK_COLS, b, h)):
        lo = F.greatest(floor_div(F.col(a) - int(hi), bi), F.lit(0).cast("bigint"))
        up = floor_div(F.col(a) + int(hi), bi)
        if dims is not None:
            up = F.least(up, F.lit((int(triple(dims)[i]) - 1) // int(bi)).cast("bigint"))
        out = out.withColumn(bc, F.explode(F.sequence(lo, up)))
    return out


def expand_box(lo, hi, halo) -> tuple:
    """Inclusive box grown by ``halo`` voxels per axis."""
    return (tuple(int(l) - int(h) for l, h in zip(triple(lo), triple(halo))),
            tuple(int(u) + int(h) for u, h in zip(triple(hi), triple(halo))))


def aligned_block_cols(b_in, b_out) -> list[Column]:
    """``input_aligned_block`` of columns, one per axis."""
    return [(F.greatest(F.round(col_of(i) / col_of(o)), F.lit(1)).cast("bigint") * col_of(o)).cast("bigint")
            for i, o in zip(b_in, b_out)]


def factors_ok(factors, prev_block, cur_block) -> Column:
    """``check_factors`` as a predicate over columns."""
    ok = F.lit(True)
    for f, p, c in zip(factors, prev_block, cur_block):
        ok = ok & (col_of(f) >= 1) & (F.pmod(col_of(c) * col_of(f), col_of(p)) == 0)
    return ok


def task_boxes(extent: DataFrame, block_size, blocks_per_task, factors=1, halo=0) -> DataFrame:
    """Which stored blocks every task of a downsampling or halo step has to read.

    ``extent``: one row ``(nx, ny, nz)``, the source's dims.  A task is a box of ``blocks_per_task`` blocks of the
    target (dims divided by ``factors``).  One row per task and source block: the task ``tx, ty, tz``, its target box
    ``x0..z1`` (clipped to the target), the source box ``sx0..sz1`` that covers it (times the factors, grown by ``halo``
    voxels, clipped to the source), and ``bx, by_, bz`` of a source block that this box meets.
    """
    b, t, f, h = (triple(v) for v in (block_size, blocks_per_task, factors, halo))
    out = extent.select(*["n" + a for a in AXES])
    for a, bc, bi, ti, fi, hi in zip(AXES, BLOCK_COLS, b, t, f, h):
        n, size = F.col("n" + a), int(bi) * int(ti)
        target = F.ceil(n / F.lit(int(fi))).cast("bigint")
        last = floor_div(target + (size - 1), size) - 1
        out = out.withColumn("t" + a, F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
        at = F.col("t" + a)
        out = out.withColumns({a + "0": at * size, a + "1": F.least(at * size + (size - 1), target - 1)})
        out = out.withColumns({"s" + a + "0": F.greatest(F.col(a + "0") * int(fi) - int(hi), F.lit(0)).cast("bigint"),
                               "s" + a + "1": F.least((F.col(a + "1") + 1) * int(fi) - 1 + int(hi), n - 1).cast("bigint")})
    for a, bc, bi in zip(AXES, BLOCK_COLS, b):
        out = out.withColumn(bc, F.explode(F.sequence(floor_div("s" + a + "0", bi), floor_div("s" + a + "1", bi))))
    return out.drop(*["n" + a for a in AXES])
