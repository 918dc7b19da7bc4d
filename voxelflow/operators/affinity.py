"""Affinities and masks.

Affinity volume: ``(x, y, z, c, a)``; channel ``c`` is the edge between voxel
``p`` and ``p + offset[c]``.  Offsets are a parameter list (a handful of
channels), so they are inlined into expressions as literal arrays: no join and
no broadcast is needed to attach them to the voxels.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.grid import AXES, BLOCK_COLS, floor_div, triple

NAN = float("nan")


def offset_cols(offsets: Sequence[Sequence[int]], c: str = "c") -> list[Column]:
    """``dx, dy, dz`` of channel ``c`` as literal-array lookups (0-based channel)."""
    out = []
    for d in range(3):
        arr = F.array(*[F.lit(int(o[d])).cast("bigint") for o in offsets])
        out.append(F.element_at(arr, F.col(c).cast("int") + 1))
    return out


def shifted(cols=AXES, offs=None, sign: int = 1) -> list[Column]:
    return [(F.col(a) + sign * o).alias(a) for a, o in zip(cols, offs)]


def _is_finite(c: Column) -> Column:
    return ~F.isnan(c) & (F.abs(c) != F.lit(math.inf)) & c.isNotNull()


def inverted_glia(glia: DataFrame, gmin: float = 0.0, gmax: float = 1.0) -> DataFrame:
    """weight = max - clamp(g, min, max) per glia voxel."""
    g = F.least(F.lit(float(gmax)), F.greatest(F.lit(float(gmin)), F.col("g")))
    return glia.select(*AXES, (F.lit(float(gmax)) - g).alias("w"))


def glia_threshold(thr: float, gmin: float = 0.0, gmax: float = 1.0) -> float:
    """Threshold on the inverted weight; thr >= max -> never, <= min -> always."""
    if thr is None or math.isnan(thr):
        return NAN
    if thr >= gmax:
        return -math.inf
    if thr <= gmin:
        return math.inf
    return gmax - thr


def average_affinities(aff: DataFrame, offsets: Sequence[Sequence[int]],
                       mask: DataFrame | None = None, glia: DataFrame | None = None,
                       glia_min: float = 0.0, glia_max: float = 1.0,
                       glia_thr: float = NAN, nan_oob: bool = False, dims=None) -> DataFrame:
    """Averaged affinity per voxel ``(x, y, z, v)``.

    ``v(p) = 0.5/n * sum_c [a_c(p) ok(p) + a_c(p - o_c) ok(p - o_c)]``: every edge
    adds its value to both end voxels; the divisor is the constant ``2n``;
    non-finite values are skipped; contributions that leave the volume are
    dropped.  ``ok`` is the mask at the edge's source voxel (absent mask voxel
    = 0; no mask = every voxel valid).  With ``nan_oob`` a masked edge makes
    both end voxels NaN instead; given ``dims``, an edge whose source lies
    outside the volume (where the mask is 0) does so to its inside end.

    Plan: one ``explode`` of two contributions per edge and one hash aggregate
    on the target voxel (partial aggregation before the shuffle); the mask is
    a co-partitioned equi-join on the source voxel.  The output extent is the
    set of voxels present in ``aff``.
    """
    n = len(offsets)
    factor = 0.5 / n
    a = aff.select(*AXES, "c", "a")
    if mask is not None:
        m = mask.select(*AXES, F.col("m").alias("_m"))
        a = a.join(m, list(AXES), "left").withColumn(
            "_ok", F.coalesce(F.col("_m"), F.lit(0)) != 0).drop("_m")
    else:
        a = a.withColumn("_ok", F.lit(True))
    dx, dy, dz = offset_cols(offsets)
    fin = _is_finite(F.col("a"))
    val = F.when(F.col("_ok") & fin, F.col("a")).otherwise(F.lit(0.0))
    inv = (~F.col("_ok")).cast("int") if nan_oob else F.lit(0)
    own_inv = inv
    if nan_oob and mask is not None and dims is not None:
        out = F.lit(False)
        for ax, o, n_ax in zip(AXES, (dx, dy, dz), dims):
            out = out | (F.col(ax) - o < 0) | (F.col(ax) - o >= int(n_ax))
        own_inv = F.greatest(inv, out.cast("int"))
    contrib = F.array(
        F.struct(F.col("x").alias("x"), F.col("y").alias("y"), F.col("z").alias("z"),
                 val.alias("s"), own_inv.alias("inv"), F.lit(1).alias("own")),
        F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"),
                 (F.col("z") + dz).alias("z"), val.alias("s"), inv.alias("inv"),
                 F.lit(0).alias("own")))
    e = a.select(F.explode(contrib).alias("t")).select("t.*")
    g = (e.groupBy(*AXES).agg(F.sum("s").alias("s"), F.max("inv").alias("inv"),
                              F.max("own").alias("own"))
          .filter(F.col("own") == 1))
    v = F.when(F.col("inv") == 1, F.lit(NAN)).otherwise(F.col("s") * F.lit(factor))
    out = g.select(*AXES, v.alias("v"))
    return apply_glia(out, glia, glia_min, glia_max, glia_thr)


def apply_glia(avg: DataFrame, glia: DataFrame | None, gmin: float = 0.0, gmax: float = 1.0,
               thr: float = NAN) -> DataFrame:
    """G3 + G4: multiply by the inverted glia weight; cut where weight <= thr'."""
    if glia is None:
        return avg
    w = inverted_glia(glia, gmin, gmax)
    out = avg.join(w, list(AXES), "left").withColumn(
        "w", F.coalesce(F.col("w"), F.lit(float(gmax) - float(gmin))))
    v = F.col("v") * F.col("w")
    t = glia_threshold(thr, gmin, gmax)
    if not math.isnan(t):
        v = F.when(F.col("w") <= F.lit(t), F.lit(NAN)).otherwise(v)
    return out.select(*AXES, v.alias("v"))


def symmetric_affinities(aff: DataFrame, offsets: Sequence[Sequence[int]]) -> DataFrame:
    """Channels ``0..n-1`` as given plus ``n + (n-1-c)`` = channel ``c``
    mirrored to ``p + o_c`` with offset ``-o_c`` (order ABC CBA); a mirrored slot
    with no source inside the volume is NaN.

    One hash aggregate on ``(x, y, z, c)``: each edge row emits itself, the
    empty mirrored slot of its own voxel, and its mirrored copy; slots outside
    the volume have no own-row and are dropped.
    """
    n = len(offsets)
    dx, dy, dz = offset_cols(offsets)
    a = aff.select(*AXES, "c", "a")
    rows = F.array(
        F.struct("x", "y", "z", "c", F.col("a").alias("a"), F.lit(1).alias("own"),
                 F.lit(1).alias("has")),
        F.struct("x", "y", "z", (F.lit(2 * n - 1) - F.col("c")).alias("c"),
                 F.lit(None).cast("double").alias("a"), F.lit(1).alias("own"),
                 F.lit(0).alias("has")),
        F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"),
                 (F.col("z") + dz).alias("z"), (F.lit(2 * n - 1) - F.col("c")).alias("c"),
                 F.col("a").alias("a"), F.lit(0).alias("own"), F.lit(1).alias("has")))
    e = a.select(F.explode(rows).alias("t")).select("t.*")
    g = (e.groupBy(*AXES, "c")
          .agg(F.max("own").alias("own"), F.max("has").alias("has"),
               F.max(F.when(F.col("has") == 1, F.col("a"))).alias("a"))
          .filter(F.col("own") == 1))
    return g.select(*AXES, F.col("c").cast("bigint").alias("c"),
                    F.when(F.col("has") == 1, F.col("a")).otherwise(F.lit(NAN)).alias("a"))


def symmetric_offsets(offsets: Sequence[Sequence[int]]) -> list[tuple]:
    """Offsets of the ABC CBA channel order."""
    offs = [tuple(int(v) for v in o) for o in offsets]
    return offs + [tuple(-v for v in o) for o in reversed(offs)]


def invalidate_cross_block(aff: DataFrame, offsets: Sequence[Sequence[int]], block_size) -> DataFrame:
    """An edge whose target voxel lies in another block becomes NaN."""
    b = triple(block_size)
    dd = offset_cols(offsets)
    leaves = None
    for ax, d, bi in zip(AXES, dd, b):
        t = floor_div(F.col(ax) + d, bi) != floor_div(ax, bi)
        leaves = t if leaves is None else leaves | t
    return aff.select(*AXES, "c", F.when(leaves, F.lit(NAN)).otherwise(F.col("a")).alias("a"))


def voxel_weights(mask: DataFrame, glia: DataFrame | None = None) -> DataFrame:
    """``(x, y, z, m, gw)``: mask and ``1 - clamp01(glia)`` of every voxel that either holds."""
    if glia is None:
        glia = mask.select(*AXES, F.lit(0.0).alias("g"))
    return (mask.select(*AXES, "m").join(glia.select(*AXES, "g"), list(AXES), "full")
                .select(*AXES, F.coalesce("m", F.lit(0)).alias("m"),
                        (F.lit(1.0) - F.least(F.lit(1.0), F.greatest(F.lit(0.0),
                                                                    F.coalesce("g", F.lit(0.0)))))
                        .alias("gw")))


def weight_edges(aff: DataFrame, offsets: Sequence[Sequence[int]], mask: DataFrame | None = None,
                 glia: DataFrame | None = None) -> DataFrame:
    """NaN unless mask == 1 at both ends, else ``a (1-clamp01 g_from)(1-clamp01 g_to)``.

    Without a mask every voxel of ``aff`` is valid, without glia no edge is weakened.
    Mask and glia are first combined per voxel (one co-partitioned join), then
    attached to the edge's source voxel and to its target voxel (two equi-joins).
    """
    if mask is None and glia is None:
        return aff.select(*AXES, "c", "a")
    if mask is None:
        mask = aff.select(*AXES).distinct().withColumn("m", F.lit(1))
    return _weigh(aff, offsets, voxel_weights(mask, glia), [])


def weight_edges_by_block(aff: DataFrame, offsets: Sequence[Sequence[int]], weights: DataFrame) -> DataFrame:
    """G8 inside blocks: ``aff`` and ``weights`` (``voxel_weights``) carry their block columns, and a block of
    ``weights`` also holds the voxels that its edges reach (``reach``).  On bucketed tables no voxel moves.

    The joins merge: a stored volume's files are so much smaller than its rows that Spark would broadcast them.
    """
    return _weigh(aff, offsets, weights.hint("merge"), list(BLOCK_COLS))


def reach(offsets: Sequence[Sequence[int]]) -> tuple:
    """Voxels per axis that edges of ``offsets`` reach out of a block."""
    return tuple(max(abs(int(o[i])) for o in offsets) for i in range(3))


def _weigh(aff: DataFrame, offsets, mg: DataFrame, blk: list) -> DataFrame:
    dx, dy, dz = offset_cols(offsets)
    e = aff.select(*blk, *AXES, "c", "a", (F.col("x") + dx).alias("tx"), (F.col("y") + dy).alias("ty"),
                   (F.col("z") + dz).alias("tz"))
    src = mg.select(*blk, *AXES, F.col("m").alias("m1"), F.col("gw").alias("g1"))
    dst = mg.select(*blk, F.col("x").alias("tx"), F.col("y").alias("ty"), F.col("z").alias("tz"),
                    F.col("m").alias("m2"), F.col("gw").alias("g2"))
    j = e.join(src, [*blk, *AXES], "left").join(dst, [*blk, "tx", "ty", "tz"], "left")
    ok = (F.coalesce("m1", F.lit(0)) == 1) & (F.coalesce("m2", F.lit(0)) == 1)
    w = F.when(ok, F.col("a") * F.col("g1") * F.col("g2")).otherwise(F.lit(NAN))
    return j.select(*AXES, "c", w.alias("a"))


# ---------------------------------------------------------------------------
# Voxel-wise transforms
# ---------------------------------------------------------------------------

def replace_nan(df: DataFrame, col: str = "v", value: float = -math.inf) -> DataFrame:
    """NaN -> value (-inf for flooding, 0 for distance transforms)."""
    return df.withColumn(col, F.when(F.isnan(col), F.lit(float(value))).otherwise(F.col(col)))


def invert_channels(aff: DataFrame, n_channels: int) -> DataFrame:
    """Channel axis inversion ``c -> C-1-c``."""
    return aff.withColumn("c", (F.lit(int(n_channels) - 1) - F.col("c")).cast("bigint"))


def channel_slice(aff: DataFrame, c: int, value_col: str = "v") -> DataFrame:
    """One channel as a scalar volume."""
    return aff.filter(F.col("c") == int(c)).select(*AXES, F.col("a").alias(value_col))


def to_float32(df: DataFrame, col: str = "a") -> DataFrame:
    """Any real -> float32."""
    return df.withColumn(col, F.col(col).cast("float"))


def to_uint8(df: DataFrame, col: str = "label") -> DataFrame:
    """Any integer -> uint8 with wrap-around (stored as int)."""
    return df.withColumn(col, (F.col(col).cast("bigint").bitwiseAND(F.lit(255))).cast("int"))
