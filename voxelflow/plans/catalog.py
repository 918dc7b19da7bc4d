"""Query catalog: one registered query per operator of SURVEY §2.

Each query takes ``(spark, sf_dir)``, derives its volumes from the driver's
tables (``voxelflow.sources.fixtures``) and returns a DataFrame.  Next to it
sits the equivalent DuckDB SQL over the same tables, used as the oracle.
Every computed column is aliased identically on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import grid
from ..operators import convert, index, pyramid, unique
from ..sources import fixtures as fx
from ..sources.fixtures import A_SQL, M_SQL, V_SQL, with_sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


# Fixed parameters of the catalog's queries.
VB = 8                      # block size of V / M (8^3 blocks)
V_DIMS = fx.V_GRID          # (32, 128, 16)


def _blk_sql(b: int = VB, p: str = "") -> str:
    return f"{p}x // {b} AS bx, {p}y // {b} AS by_, {p}z // {b} AS bz"


# ---------------------------------------------------------------------------
# Step 1: grid functions and reads
# ---------------------------------------------------------------------------

@register("block_grid", with_sql(V_SQL) + f"""
, D AS (SELECT max(x) + 1 AS nx, max(y) + 1 AS ny, max(z) + 1 AS nz FROM V)
SELECT bx, by_, bz,
       bx * {VB} AS x0, by_ * {VB} AS y0, bz * {VB} AS z0,
       least(bx * {VB} + {VB - 1}, nx - 1) AS x1, least(by_ * {VB} + {VB - 1}, ny - 1) AS y1,
       least(bz * {VB} + {VB - 1}, nz - 1) AS z1
FROM D,
     (SELECT unnest(range(0, (SELECT CAST(ceil(nx / {VB}.0) AS BIGINT) FROM D))) AS bx) a,
     (SELECT unnest(range(0, (SELECT CAST(ceil(ny / {VB}.0) AS BIGINT) FROM D))) AS by_) b,
     (SELECT unnest(range(0, (SELECT CAST(ceil(nz / {VB}.0) AS BIGINT) FROM D))) AS bz) c
""")
def q_block_grid(spark, sf):
    """B1 over the extent of V (extent measured from the data)."""
    from ..sources.volume import extent, block_grid_of
    return block_grid_of(extent(fx.label_volume(spark, sf)), VB)


@register("block_position", with_sql(V_SQL) + f"""
SELECT x, y, z, label, {_blk_sql()},
       CAST(x + {V_DIMS[0]} * (y + {V_DIMS[1]} * z) AS BIGINT) AS lin
FROM V""")
def q_block_position(spark, sf):
    """B2 + B12: block position and linear voxel index."""
    v = grid.block_position(fx.label_volume(spark, sf), VB)
    return v.withColumn("lin", grid.linear_index(V_DIMS))


@register("region_read", with_sql(V_SQL) + """
SELECT x, y, z, label FROM V
WHERE x BETWEEN 4 AND 19 AND y BETWEEN 10 AND 70 AND z BETWEEN 2 AND 9""")
def q_region_read(spark, sf):
    """A2: restrict a volume to an inclusive box."""
    from ..sources.volume import read_region
    return read_region(fx.label_volume(spark, sf), (4, 10, 2), (19, 70, 9))


# ---------------------------------------------------------------------------
# Step 2: unique labels and the label index
# ---------------------------------------------------------------------------

@register("unique_labels", with_sql(V_SQL) + f"SELECT DISTINCT {_blk_sql()}, label FROM V")
def q_unique_labels(spark, sf):
    return unique.unique_labels(fx.label_volume(spark, sf), VB)


_ARGMAX_SQL = """MA AS (
  SELECT x, y, z, label FROM (
    SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY n DESC, label ASC) AS rk FROM M) t
  WHERE rk = 1)"""


@register("unique_labels_multiset_argmax",
          with_sql(M_SQL, _ARGMAX_SQL) + f"SELECT DISTINCT {_blk_sql()}, label FROM MA")
def q_unique_ms_argmax(spark, sf):
    return unique.unique_labels_multiset(fx.multiset_volume(spark, sf), VB, "argmax")


@register("unique_labels_multiset_all",
          with_sql(M_SQL) + f"SELECT DISTINCT {_blk_sql()}, label FROM M")
def q_unique_ms_all(spark, sf):
    return unique.unique_labels_multiset(fx.multiset_volume(spark, sf), VB, "all")


@register("unique_labels_max", with_sql(V_SQL) +
          "SELECT greatest(CAST(0 AS BIGINT), coalesce(max(label), 0)) AS max_label FROM V")
def q_unique_max(spark, sf):
    return unique.max_label(fx.label_volume(spark, sf))


_U_SQL = f"U AS (SELECT DISTINCT {_blk_sql()}, label FROM V)"


@register("unique_labels_down", with_sql(V_SQL, _U_SQL) +
          "SELECT DISTINCT bx // 2 AS bx, by_ // 2 AS by_, bz // 2 AS bz, label FROM U")
def q_unique_down(spark, sf):
    u = unique.unique_labels(fx.label_volume(spark, sf), VB)
    return unique.downsample_unique_labels(u, 2, VB, VB)


_UP_SQL = """U1 AS (SELECT DISTINCT bx // 2 AS bx, by_ // 2 AS by_, bz // 2 AS bz, label FROM U),
U2 AS (SELECT DISTINCT bx // 2 AS bx, by_ // 2 AS by_, bz // 2 AS bz, label FROM U1),
UP AS (SELECT 0 AS level, * FROM U UNION ALL SELECT 1, * FROM U1 UNION ALL SELECT 2, * FROM U2)"""


def _unique_pyramid(spark, sf):
    u = unique.unique_labels(fx.label_volume(spark, sf), VB)
    return unique.unique_label_pyramid(u, [2, 2], [VB, VB], VB)


@register("unique_labels_pyramid", with_sql(V_SQL, _U_SQL, _UP_SQL) +
          "SELECT level, bx, by_, bz, label FROM UP")
def q_unique_pyramid(spark, sf):
    levels = _unique_pyramid(spark, sf)
    out = None
    for i, u in enumerate(levels):
        u = u.select(F.lit(i).alias("level"), *grid.BLOCK_COLS, "label")
        out = u if out is None else out.unionByName(u)
    return out


def _box_sql(dims, b=VB, src="U"):
    nx, ny, nz = dims
    return f"""label, bx * {b} AS x0, by_ * {b} AS y0, bz * {b} AS z0,
       least(bx * {b} + {b - 1}, {nx - 1}) AS x1, least(by_ * {b} + {b - 1}, {ny - 1}) AS y1,
       least(bz * {b} + {b - 1}, {nz - 1}) AS z1"""


@register("label_to_blocks", with_sql(V_SQL, _U_SQL) + f"SELECT {_box_sql(V_DIMS)} FROM U")
def q_label_to_blocks(spark, sf):
    u = unique.unique_labels(fx.label_volume(spark, sf), VB)
    return index.label_to_blocks(u, V_DIMS, VB)


@register("label_to_blocks_bucketed", with_sql(V_SQL, _U_SQL) +
          f"SELECT {_box_sql(V_DIMS)}, label // 10 AS bucket FROM U")
def q_label_to_blocks_bucketed(spark, sf):
    u = unique.unique_labels(fx.label_volume(spark, sf), VB)
    return index.label_to_blocks_bucketed(u, V_DIMS, VB, step=10)


def _level_dims(i):
    return grid.downsampled_dims(V_DIMS, (2 ** i,) * 3)


@register("label_to_blocks_multiscale", with_sql(V_SQL, _U_SQL, _UP_SQL) + "\n UNION ALL ".join(
    f"SELECT {_box_sql(_level_dims(i))}, label // 10 AS bucket, {i} AS level FROM UP WHERE level = {i}"
    for i in range(3)))
def q_label_to_blocks_multiscale(spark, sf):
    levels = _unique_pyramid(spark, sf)
    return index.label_to_blocks_multiscale(levels, [_level_dims(i) for i in range(3)],
                                            [VB] * 3, step=10)


@register("blocks_of_label", with_sql(V_SQL, _U_SQL, _UP_SQL) + "\n UNION ALL ".join(
    f"SELECT {_box_sql(_level_dims(i))}, label // 10 AS bucket, {i} AS level FROM UP "
    f"WHERE level = {i} AND label = 209" for i in range(3)))
def q_blocks_of_label(spark, sf):
    """lookup of one label (the lookup is the feature) over every level."""
    levels = _unique_pyramid(spark, sf)
    idx = index.label_to_blocks_multiscale(levels, [_level_dims(i) for i in range(3)],
                                           [VB] * 3, step=10)
    return index.blocks_of(idx, 209, step=10)


# ---------------------------------------------------------------------------
# Step 3: conversion, multiset pyramid, sparse blocks
# ---------------------------------------------------------------------------

@register("to_multiset", with_sql(V_SQL) + "SELECT x, y, z, label, CAST(1 AS BIGINT) AS n FROM V")
def q_to_multiset(spark, sf):
    return convert.to_multiset(fx.label_volume(spark, sf))


@register("max_id", with_sql(V_SQL) + "SELECT max(label) AS max_id FROM V")
def q_max_id(spark, sf):
    return convert.max_id(fx.label_volume(spark, sf))


@register("reblock", with_sql(V_SQL) + f"SELECT x, y, z, label, {_blk_sql(16)} FROM V")
def q_reblock(spark, sf):
    return convert.reblock(fx.label_volume(spark, sf), 16)


@register("downsample_multiset", with_sql(M_SQL) + """
SELECT x // 2 AS x, y // 2 AS y, z // 2 AS z, label, CAST(sum(n) AS BIGINT) AS n
FROM M GROUP BY 1, 2, 3, 4""")
def q_downsample_multiset(spark, sf):
    return pyramid.downsample_multiset(fx.multiset_volume(spark, sf), 2)


def _topk_sql(src: str, k: int, f: tuple) -> str:
    return f"""SELECT x, y, z, label, n FROM (
  SELECT *, row_number() OVER (PARTITION BY x, y, z ORDER BY n DESC, label ASC) AS rk
  FROM (SELECT x // {f[0]} AS x, y // {f[1]} AS y, z // {f[2]} AS z, label,
               CAST(sum(n) AS BIGINT) AS n FROM {src} GROUP BY 1, 2, 3, 4) c) t
WHERE rk <= {k}"""


@register("downsample_topk", with_sql(M_SQL) + _topk_sql("M", 2, (2, 2, 1)))
def q_downsample_topk(spark, sf):
    return pyramid.downsample_multiset(fx.multiset_volume(spark, sf), (2, 2, 1), max_entries=2)


@register("pyramid_l2", with_sql(M_SQL, "L1 AS (" + _topk_sql("M", 3, (2, 2, 2)) + ")",
                                 "L2 AS (" + _topk_sql("L1", 3, (2, 2, 1)) + ")") + """
SELECT 1 AS level, * FROM L1 UNION ALL SELECT 2 AS level, * FROM L2""")
def q_pyramid_l2(spark, sf):
    """D3: two levels; the second level inherits the first level's cap."""
    levels = pyramid.multiset_pyramid(fx.multiset_volume(spark, sf), [2, (2, 2, 1)], [3])
    out = None
    for i, lv in enumerate(levels[1:], start=1):
        lv = lv.select(F.lit(i).alias("level"), "x", "y", "z", "label", "n")
        out = lv if out is None else out.unionByName(lv)
    return out


@register("drop_empty_blocks", with_sql(V_SQL) + """
SELECT x, y, z, label FROM V
WHERE (x // 4, y // 4, z // 4) IN (SELECT (x // 4, y // 4, z // 4) FROM V WHERE label <> 0)""")
def q_drop_empty_blocks(spark, sf):
    return pyramid.drop_empty_blocks(fx.label_volume(spark, sf), 4)


# ---------------------------------------------------------------------------
# Step 4: affinities and masks
# ---------------------------------------------------------------------------

from ..operators import affinity, mask as pmask  # noqa: E402
from ..sources import volume  # noqa: E402

OFFS = fx.AFFINITY_OFFSETS
AVG_FACTOR = 0.5 / len(OFFS)


def _avg_sql(masked: bool, nan_oob: bool) -> str:
    ok = "coalesce(k.m, 0) <> 0" if masked else "TRUE"
    join = "LEFT JOIN MASK k USING (x, y, z)" if masked else ""
    inv = "CASE WHEN ok THEN 0 ELSE 1 END" if nan_oob else "0"
    # an edge from outside the volume, where the mask is 0, reaches its inside end
    faces = """
      UNION ALL
      SELECT x, y, z, 0.0, 1, 0 FROM AFF JOIN OFFS USING (c),
             (SELECT max(x) AS mx, max(y) AS my, max(z) AS mz FROM MASK) m
      WHERE x - dx NOT BETWEEN 0 AND mx OR y - dy NOT BETWEEN 0 AND my OR z - dz NOT BETWEEN 0 AND mz""" if masked and nan_oob else ""
    return f"""E AS (SELECT x, y, z, c, a, dx, dy, dz, {ok} AS ok
       FROM AFF {join} JOIN OFFS USING (c)),
C AS (SELECT x, y, z, CASE WHEN ok AND isfinite(a) THEN a ELSE 0.0 END AS s, {inv} AS inv, 1 AS own FROM E
      UNION ALL
      SELECT x + dx, y + dy, z + dz, CASE WHEN ok AND isfinite(a) THEN a ELSE 0.0 END, {inv}, 0 FROM E{faces}),
AVG AS (SELECT x, y, z, CASE WHEN max(inv) = 1 THEN CAST('nan' AS DOUBLE)
                             ELSE sum(s) * {AVG_FACTOR!r} END AS v
        FROM C GROUP BY x, y, z HAVING max(own) = 1)"""


@register("average_affinities", with_sql(A_SQL, _avg_sql(False, False)) + "SELECT x, y, z, v FROM AVG")
def q_average_affinities(spark, sf):
    return affinity.average_affinities(fx.edge_affinities(spark, sf), OFFS)


@register("average_affinities_masked", with_sql(A_SQL, _avg_sql(True, False)) +
          "SELECT x, y, z, v FROM AVG")
def q_average_affinities_masked(spark, sf):
    return affinity.average_affinities(fx.edge_affinities(spark, sf), OFFS,
                                       mask=fx.mask_volume(spark, sf))


@register("average_affinities_nan", with_sql(A_SQL, _avg_sql(True, True)) +
          "SELECT x, y, z, v FROM AVG")
def q_average_affinities_nan(spark, sf):
    return affinity.average_affinities(fx.edge_affinities(spark, sf), OFFS,
                                       mask=fx.mask_volume(spark, sf), nan_oob=True,
                                       dims=volume.extent(fx.mask_volume(spark, sf)).first())


@register("glia_weight", with_sql(A_SQL, _avg_sql(False, False)) + """
SELECT x, y, z, CASE WHEN w <= 0.4 THEN CAST('nan' AS DOUBLE) ELSE v * w END AS v
FROM (SELECT AVG.x, AVG.y, AVG.z, AVG.v,
             coalesce(1.0 - least(1.0, greatest(0.0, g)), 1.0 - 0.0) AS w
      FROM AVG LEFT JOIN GLIA USING (x, y, z)) t""")
def q_glia_weight(spark, sf):
    """G3 + G4: inverted glia weight in [0, 1], cut at glia 0.6 (weight <= 0.4)."""
    return affinity.average_affinities(fx.edge_affinities(spark, sf), OFFS,
                                       glia=fx.glia_volume(spark, sf), glia_min=0.0,
                                       glia_max=1.0, glia_thr=0.6)


@register("symmetric_affinities", with_sql(A_SQL) + f"""
SELECT x, y, z, c, a FROM AFF
UNION ALL
SELECT t.x, t.y, t.z, CAST({2 * len(OFFS) - 1} - t.c AS BIGINT) AS c,
       coalesce(s.a, CAST('nan' AS DOUBLE)) AS a
FROM (AFF JOIN OFFS USING (c)) t
LEFT JOIN AFF s ON s.c = t.c AND s.x = t.x - t.dx AND s.y = t.y - t.dy AND s.z = t.z - t.dz""")
def q_symmetric_affinities(spark, sf):
    return affinity.symmetric_affinities(fx.edge_affinities(spark, sf), OFFS)


@register("invalidate_cross_block", with_sql(A_SQL) + """
SELECT x, y, z, c,
       CASE WHEN floor((x + dx) / 4.0) <> floor(x / 4.0) OR floor((y + dy) / 4.0) <> floor(y / 4.0)
                 OR floor((z + dz) / 4.0) <> floor(z / 4.0)
            THEN CAST('nan' AS DOUBLE) ELSE a END AS a
FROM AFF JOIN OFFS USING (c)""")
def q_invalidate_cross_block(spark, sf):
    return affinity.invalidate_cross_block(fx.edge_affinities(spark, sf), OFFS, 4)


@register("weight_edges", with_sql(A_SQL) + """
, MG AS (SELECT x, y, z, coalesce(m, 0) AS m,
                1.0 - least(1.0, greatest(0.0, coalesce(g, 0.0))) AS gw
         FROM MASK FULL JOIN GLIA USING (x, y, z))
SELECT e.x, e.y, e.z, e.c,
       CASE WHEN coalesce(s.m, 0) = 1 AND coalesce(t.m, 0) = 1 THEN e.a * s.gw * t.gw
            ELSE CAST('nan' AS DOUBLE) END AS a
FROM (AFF JOIN OFFS USING (c)) e
LEFT JOIN MG s ON s.x = e.x AND s.y = e.y AND s.z = e.z
LEFT JOIN MG t ON t.x = e.x + e.dx AND t.y = e.y + e.dy AND t.z = e.z + e.dz""")
def q_weight_edges(spark, sf):
    return affinity.weight_edges(fx.edge_affinities(spark, sf), OFFS,
                                 fx.mask_volume(spark, sf), fx.glia_volume(spark, sf))


# G5 parameters: dyadic resolutions so world <-> voxel maps are exact.
PM = dict(block=(2, 2, 2), in_res=(4, 4, 4), out_res=(8, 8, 8), in_off=(0, 0, 0),
          out_off=(4, 4, 4), pad=(4, 4, 4))


def _pm_box_sql():
    b = PM["block"][0]
    return f"""B AS (
  SELECT bx, by_, bz, bx * {b} AS x0, by_ * {b} AS y0, bz * {b} AS z0,
         least(bx * {b} + {b - 1}, nx - 1) AS x1, least(by_ * {b} + {b - 1}, ny - 1) AS y1,
         least(bz * {b} + {b - 1}, nz - 1) AS z1
  FROM OD,
       (SELECT unnest(range(0, (SELECT CAST(ceil(nx / {b}.0) AS BIGINT) FROM OD))) AS bx) a,
       (SELECT unnest(range(0, (SELECT CAST(ceil(ny / {b}.0) AS BIGINT) FROM OD))) AS by_) b,
       (SELECT unnest(range(0, (SELECT CAST(ceil(nz / {b}.0) AS BIGINT) FROM OD))) AS bz) c),
BI AS (SELECT *, CAST(floor((x0 * 8.0 + 4.0 - 4.0 - 0.0) / 4.0) AS BIGINT) AS lo_x,
                 CAST(floor((y0 * 8.0 + 4.0 - 4.0 - 0.0) / 4.0) AS BIGINT) AS lo_y,
                 CAST(floor((z0 * 8.0 + 4.0 - 4.0 - 0.0) / 4.0) AS BIGINT) AS lo_z,
                 CAST(ceil((x1 * 8.0 + 4.0 + 4.0 - 0.0) / 4.0) AS BIGINT) AS hi_x,
                 CAST(ceil((y1 * 8.0 + 4.0 + 4.0 - 0.0) / 4.0) AS BIGINT) AS hi_y,
                 CAST(ceil((z1 * 8.0 + 4.0 + 4.0 - 0.0) / 4.0) AS BIGINT) AS hi_z FROM B)"""


@register("prediction_mask", with_sql(A_SQL) + """
, OD AS (SELECT CAST(ceil((max(x) + 1) * 4.0 / 8.0) AS BIGINT) AS nx,
                CAST(ceil((max(y) + 1) * 4.0 / 8.0) AS BIGINT) AS ny,
                CAST(ceil((max(z) + 1) * 4.0 / 8.0) AS BIGINT) AS nz FROM MASK),
""" + _pm_box_sql() + """
SELECT bx, by_, bz, x0, y0, z0, x1, y1, z1,
       CASE WHEN (SELECT count(*) FROM MASK k WHERE k.m <> 0
                  AND k.x BETWEEN lo_x AND hi_x AND k.y BETWEEN lo_y AND hi_y
                  AND k.z BETWEEN lo_z AND hi_z)
                 = (hi_x - lo_x + 1) * (hi_y - lo_y + 1) * (hi_z - lo_z + 1)
            THEN 1 ELSE 0 END AS m
FROM BI""")
def q_prediction_mask(spark, sf):
    m = fx.mask_volume(spark, sf)
    ext = volume.extent(m)
    ratio = PM["in_res"][0] / PM["out_res"][0]
    out_ext = ext.select(*[F.ceil(F.col("n" + a) * ratio).cast("bigint").alias("n" + a)
                           for a in grid.AXES])
    return pmask.prediction_mask(m, out_ext, PM["block"], PM["in_res"], PM["out_res"],
                                 PM["in_off"], PM["out_off"], PM["pad"])


@register("extend_read", with_sql(A_SQL) + """
SELECT q.x, q.y, q.z, coalesce(r.v, 0.0) AS v
FROM RELIEF q LEFT JOIN RELIEF r ON r.x = q.x + 1 AND r.y = q.y AND r.z = q.z + 2""")
def q_extend_read(spark, sf):
    """A5: a volume read through a voxel shift (world offset / resolution),
    constant 0 outside the stored voxels."""
    rel = fx.relief_volume(spark, sf)
    shift = volume.world_shift((4.0, 0.0, 8.0), (4.0, 4.0, 4.0))
    return volume.extend(rel, rel.select(*grid.AXES), "v", 0.0, shift)


@register("nan_replace", with_sql(A_SQL, _avg_sql(True, True)) + """
SELECT x, y, z, CASE WHEN isnan(v) THEN CAST('-inf' AS DOUBLE) ELSE v END AS v FROM AVG""")
def q_nan_replace(spark, sf):
    """NaN -> -inf before flooding."""
    avg = affinity.average_affinities(fx.edge_affinities(spark, sf), OFFS,
                                      mask=fx.mask_volume(spark, sf), nan_oob=True,
                                      dims=volume.extent(fx.mask_volume(spark, sf)).first())
    return affinity.replace_nan(avg, "v", float("-inf"))


@register("channel_invert", with_sql(A_SQL) + "SELECT x, y, z, CAST(3 - c AS BIGINT) AS c, a FROM A")
def q_channel_invert(spark, sf):
    """Channel-axis inversion c -> C-1-c over all four channels."""
    a = fx.affinity_volume(spark, sf).select("x", "y", "z", "c", "a")
    return affinity.invert_channels(a, 4)


@register("voxel_cast", with_sql(V_SQL) +
          "SELECT x, y, z, CAST(label & 255 AS INTEGER) AS label FROM V")
def q_voxel_cast(spark, sf):
    """Integer labels to uint8 (wrap-around)."""
    return affinity.to_uint8(fx.label_volume(spark, sf), "label")


# ---------------------------------------------------------------------------
# Step 5/6: stitching
# ---------------------------------------------------------------------------

from ..operators import graph, stitch  # noqa: E402

SB = 4                       # block size for the seg volume


def _dense_sql(src: str, b: int, name: str, dims_sql: str | None = None) -> str:
    """J3 in SQL: consecutive ids per block, blocks in (bz, by_, bx) order."""
    return f"""{name}_FR AS (SELECT DISTINCT x // {b} AS bx, y // {b} AS by_, z // {b} AS bz, label
                 FROM {src} WHERE label <> 0),
{name}_RK AS (SELECT *, row_number() OVER (PARTITION BY bx, by_, bz ORDER BY label) AS rk FROM {name}_FR),
{name}_CN AS (SELECT bx, by_, bz, count(*) AS n FROM {name}_FR GROUP BY bx, by_, bz),
{name}_OF AS (SELECT bx, by_, bz, n, CAST(1 + sum(n) OVER (ORDER BY bz, by_, bx
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS BIGINT) AS first
              FROM {name}_CN),
{name} AS (SELECT s.x, s.y, s.z, CAST(coalesce(o.first + r.rk - 1, 0) AS BIGINT) AS label
           FROM {src} s
           LEFT JOIN {name}_RK r ON r.bx = s.x // {b} AND r.by_ = s.y // {b} AND r.bz = s.z // {b}
                                AND r.label = s.label
           LEFT JOIN {name}_OF o ON o.bx = r.bx AND o.by_ = r.by_ AND o.bz = r.bz)"""


def _seg_grid_dims(spark, sf):
    emb = fx.table(spark, sf, "embeddings")
    n = emb.count()   # one scalar: number of vectors fixes the z extent
    return (16, 20, -(-n // 20))


def _seg_dense(spark, sf):
    seg = fx.seg_volume(spark, sf)
    return stitch.relabel_dense(seg, SB, _seg_grid_dims(spark, sf))


def _face_sql(src: str, b: int, with_values: bool, val: str = "RELIEF") -> str:
    parts = []
    for d, (dx, dy, dz) in enumerate(((1, 0, 0), (0, 1, 0), (0, 0, 1))):
        ax = "xyz"[d]
        vals = ", vp.v AS v1, vq.v AS v2" if with_values else ""
        vj = (f" LEFT JOIN {val} vp ON vp.x = p.x AND vp.y = p.y AND vp.z = p.z"
              f" LEFT JOIN {val} vq ON vq.x = q.x AND vq.y = q.y AND vq.z = q.z") if with_values else ""
        parts.append(
            f"SELECT p.x // {b} AS bx, p.y // {b} AS by_, p.z // {b} AS bz, {d} AS axis, "
            f"p.label AS l1, q.label AS l2{vals} FROM {src} p JOIN {src} q "
            f"ON q.x = p.x + {dx} AND q.y = p.y + {dy} AND q.z = p.z + {dz}{vj} "
            f"WHERE p.{ax} % {b} = {b - 1} AND p.label <> 0 AND q.label <> 0")
    return "\nUNION ALL\n".join(parts)


@register("block_offsets", with_sql(V_SQL) + f"""
, CN AS (SELECT x // {VB} AS bx, y // {VB} AS by_, z // {VB} AS bz, count(DISTINCT label) AS n
         FROM V WHERE label <> 0 GROUP BY 1, 2, 3)
SELECT bx, by_, bz, n, CAST(1 + sum(n) OVER (ORDER BY bz, by_, bx
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS BIGINT) AS first FROM CN""")
def q_block_offsets(spark, sf):
    counts = stitch.block_label_counts(fx.label_volume(spark, sf), VB)
    return stitch.block_offsets(counts, V_DIMS, VB, start=1, segment=16)


_LOCAL_SQL = f"""L AS (SELECT x, y, z, CASE WHEN label = 0 THEN 0 ELSE
       dense_rank() OVER (PARTITION BY x // {VB}, y // {VB}, z // {VB}, label <> 0 ORDER BY label) END AS label
     FROM V)"""


def _local_ids(spark, sf):
    """Block-local ids 1..n (what a block-wise segmentation writes)."""
    from pyspark.sql import Window
    v = grid.block_position(fx.label_volume(spark, sf), VB)
    w = Window.partitionBy(*grid.BLOCK_COLS, F.col("label") != 0).orderBy("label")
    return v.select("x", "y", "z", F.when(F.col("label") == 0, F.lit(0))
                    .otherwise(F.dense_rank().over(w)).cast("bigint").alias("label"))


@register("relabel_offset", with_sql(V_SQL, _LOCAL_SQL) + f"""
, CN AS (SELECT x // {VB} AS bx, y // {VB} AS by_, z // {VB} AS bz, max(label) AS n
         FROM L WHERE label <> 0 GROUP BY 1, 2, 3),
OF AS (SELECT bx, by_, bz, CAST(1 + sum(n) OVER (ORDER BY bz, by_, bx
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - n AS BIGINT) AS first FROM CN)
SELECT L.x, L.y, L.z, CAST(CASE WHEN L.label <> 0 THEN L.label + o.first ELSE 0 END AS BIGINT) AS label
FROM L LEFT JOIN OF o ON o.bx = L.x // {VB} AND o.by_ = L.y // {VB} AND o.bz = L.z // {VB}""")
def q_relabel_offset(spark, sf):
    loc = _local_ids(spark, sf)
    counts = stitch.block_label_counts(loc, VB, how="max")
    offs = stitch.block_offsets(counts, V_DIMS, VB, start=1, segment=16)
    return stitch.relabel_offset(loc, VB, offs)


@register("relabel_dense", with_sql(V_SQL, _dense_sql("V", VB, "DV")) + "SELECT x, y, z, label FROM DV")
def q_relabel_dense(spark, sf):
    return stitch.relabel_dense(fx.label_volume(spark, sf), VB, V_DIMS, segment=16)


@register("max_label_id", with_sql(V_SQL, _dense_sql("V", VB, "DV")) +
          "SELECT coalesce(max(label), 0) AS max_id FROM DV")
def q_max_label_id(spark, sf):
    return stitch.max_label_id(stitch.relabel_dense(fx.label_volume(spark, sf), VB, V_DIMS))


@register("drop_singletons", with_sql(V_SQL) + f"""
SELECT x, y, z, CASE WHEN count(*) OVER (PARTITION BY x // {VB}, y // {VB}, z // {VB}, label) < 2
                     THEN CAST(0 AS BIGINT) ELSE label END AS label FROM V""")
def q_drop_singletons(spark, sf):
    return stitch.drop_singletons(fx.label_volume(spark, sf), VB)


@register("size_filter", with_sql(V_SQL) + f"""
SELECT x, y, z, CASE WHEN count(*) OVER (PARTITION BY x // {VB}, y // {VB}, z // {VB}, label) < 3
                     THEN CAST(0 AS BIGINT) ELSE label END AS label FROM V""")
def q_size_filter(spark, sf):
    return stitch.size_filter(fx.label_volume(spark, sf), VB, 3)


@register("same_label_check", with_sql(V_SQL) + "SELECT count(*) AS violations FROM (" +
          _face_sql("V", VB, False) + ") f WHERE l1 = l2")
def q_same_label_check(spark, sf):
    """J8 on the raw label volume (ids are not block-unique there, so > 0)."""
    return stitch.same_label_violations(fx.label_volume(spark, sf), VB)


_SEGD = _dense_sql("SEG", SB, "SD")


@register("face_pairs", with_sql(A_SQL, _SEGD) + "SELECT DISTINCT * FROM (" +
          _face_sql("SD", SB, False) + ") f")
def q_face_pairs(spark, sf):
    return stitch.face_pairs(_seg_dense(spark, sf), SB)


_MED_SQL = "MED AS (SELECT bx, by_, bz, axis, e1, e2, list_sort(list(a))[len(list(a)) // 2 + 1] AS med " \
    "FROM (SELECT bx, by_, bz, axis, least(l1, l2) AS e1, greatest(l1, l2) AS e2, unnest([v1, v2]) AS a " \
    "FROM FC WHERE l1 <> l2) t WHERE a IS NOT NULL AND NOT isnan(a) " \
    "GROUP BY bx, by_, bz, axis, e1, e2)"


@register("median_edges", with_sql(A_SQL, _SEGD, "FC AS (" + _face_sql("SD", SB, True) + ")", _MED_SQL)
          + "SELECT * FROM MED WHERE med > 0.5")
def q_median_edges(spark, sf):
    return stitch.merge_edges_median(_seg_dense(spark, sf), fx.relief_volume(spark, sf), SB, 0.5)


_ARGMAX_EDGES_SQL = """CN AS (SELECT bx, by_, bz, axis, l1, l2, count(*) AS n FROM FC GROUP BY ALL),
BEST AS (SELECT * FROM (SELECT *,
    row_number() OVER (PARTITION BY bx, by_, bz, axis, l1 ORDER BY n DESC, l2) AS r1,
    row_number() OVER (PARTITION BY bx, by_, bz, axis, l2 ORDER BY n DESC, l1) AS r2 FROM CN) t
  WHERE r1 = 1 AND r2 = 1)"""


@register("mutual_argmax_edges", with_sql(A_SQL, _SEGD, "FC AS (" + _face_sql("SD", SB, False) + ")",
                                          _ARGMAX_EDGES_SQL)
          + "SELECT bx, by_, bz, axis, l1 AS e1, l2 AS e2 FROM BEST")
def q_mutual_argmax_edges(spark, sf):
    return stitch.merge_edges_mutual_argmax(_seg_dense(spark, sf), SB)


_CC_SQL = """UE AS (SELECT e1 AS a, e2 AS b FROM EDGES WHERE e1 <> e2
             UNION SELECT e2, e1 FROM EDGES WHERE e1 <> e2),
CC AS (WITH RECURSIVE cc(node, root) USING KEY (node) AS (
    SELECT a, least(a, min(b)) FROM UE GROUP BY a
    UNION
    SELECT u.a, min(c.root) FROM cc c JOIN UE u ON u.b = c.node JOIN recurring.cc r ON r.node = u.a
    GROUP BY u.a, r.root HAVING min(c.root) < r.root)
  SELECT node AS label, root FROM cc)"""


@register("connected_components", with_sql(
    A_SQL, _SEGD, "FC AS (" + _face_sql("SD", SB, False) + ")", _ARGMAX_EDGES_SQL,
    "EDGES AS (SELECT l1 AS e1, l2 AS e2 FROM BEST)", _CC_SQL) + "SELECT label, root FROM CC")
def q_connected_components(spark, sf):
    """J5 over the mutual-argmax face edges of the block-wise seg volume."""
    e = stitch.merge_edges_mutual_argmax(_seg_dense(spark, sf), SB)
    return graph.connected_components(e, "e1", "e2")


@register("apply_mapping", with_sql(
    A_SQL, _SEGD, "FC AS (" + _face_sql("SD", SB, False) + ")", _ARGMAX_EDGES_SQL,
    "EDGES AS (SELECT l1 AS e1, l2 AS e2 FROM BEST)", _CC_SQL) + """
SELECT SD.x, SD.y, SD.z, coalesce(CC.root, SD.label) AS label FROM SD LEFT JOIN CC USING (label)""")
def q_apply_mapping(spark, sf):
    """Stitched seg volume (mutual-argmax rule, unmapped labels kept)."""
    dense = _seg_dense(spark, sf)
    e = stitch.merge_edges_mutual_argmax(dense, SB)
    return stitch.apply_mapping(dense, graph.connected_components(e, "e1", "e2"), True)


def _block_contacts_sql(src: str, b: int) -> str:
    parts = []
    for d, (dx, dy, dz) in enumerate(((1, 0, 0), (0, 1, 0), (0, 0, 1))):
        parts.append(
            f"SELECT p.x // {b} AS bx, p.y // {b} AS by_, p.z // {b} AS bz, least(p.label, q.label) AS e1, "
            f"greatest(p.label, q.label) AS e2, vp.v AS v1, vq.v AS v2 FROM {src} p JOIN {src} q "
            f"ON q.x = p.x + {dx} AND q.y = p.y + {dy} AND q.z = p.z + {dz} "
            f"LEFT JOIN RELIEF vp ON vp.x = p.x AND vp.y = p.y AND vp.z = p.z "
            f"LEFT JOIN RELIEF vq ON vq.x = q.x AND vq.y = q.y AND vq.z = q.z "
            f"WHERE p.x // {b} = q.x // {b} AND p.y // {b} = q.y // {b} AND p.z // {b} = q.z // {b} "
            f"AND p.label <> 0 AND q.label <> 0 AND p.label <> q.label")
    return "\nUNION ALL\n".join(parts)


@register("median_fragments", with_sql(A_SQL, "BC AS (" + _block_contacts_sql("SEG", 8) + ")") + """
SELECT bx, by_, bz, e1, e2, med FROM (
  SELECT bx, by_, bz, e1, e2, list_sort(list(a))[len(list(a)) // 2 + 1] AS med
  FROM (SELECT bx, by_, bz, e1, e2, unnest([v1, v2]) AS a FROM BC) t
  WHERE a IS NOT NULL AND NOT isnan(a) GROUP BY ALL) m WHERE med > 0.5""")
def q_median_fragments(spark, sf):
    """I5 on the seg volume (labels 1..9 are fragments inside 8^3 blocks)."""
    return stitch.merge_fragments_median(fx.seg_volume(spark, sf), fx.relief_volume(spark, sf), 8, 0.5)


@register("min_fragments", with_sql(A_SQL, "BC AS (" + _block_contacts_sql("SEG", 8) + ")") + """
SELECT DISTINCT bx, by_, bz, e1, e2 FROM BC WHERE least(v1, v2) > 0.55""")
def q_min_fragments(spark, sf):
    return stitch.merge_fragments_min(fx.seg_volume(spark, sf), fx.relief_volume(spark, sf), 8, 0.55)


# ---------------------------------------------------------------------------
# Step 7: seeds, extrema, distance transforms (H1-H6)
# ---------------------------------------------------------------------------

from ..operators import distance, extrema  # noqa: E402

HB = 8                                   # block size for relief-based operators
DT_RES = (1.0, 1.0, 2.0)                 # anisotropic resolution for H5/H6
DT_W5 = tuple(r * r for r in DT_RES)     # H5 weights = resolution^2
DT_W6 = distance.sampled_weights(DT_RES, 0.01)


def _extent_tuple(df) -> tuple:
    """(nx, ny, nz) of a volume: one aggregate row, used as a plan parameter."""
    r = volume.extent(df).collect()[0]
    return (int(r[0]), int(r[1]), int(r[2]))


def _nbr_sql(p: str, q: str, b: int | None, plane_axis: int | None = None) -> str:
    conds = [f"{q}.{a} BETWEEN {p}.{a} - 1 AND {p}.{a} + 1" for a in "xyz"]
    conds.append(f"NOT ({q}.x = {p}.x AND {q}.y = {p}.y AND {q}.z = {p}.z)")
    if b:
        conds += [f"{q}.{a} // {b} = {p}.{a} // {b}" for a in "xyz"]
    if plane_axis is not None:
        a = "xyz"[plane_axis]
        conds.append(f"{q}.{a} = {p}.{a}")
    return " AND ".join(conds)


@register("local_maxima", with_sql(A_SQL) + f"""
SELECT p.x, p.y, p.z, p.v FROM RELIEF p
WHERE NOT isnan(p.v) AND p.v >= 0.5 AND NOT EXISTS (
  SELECT 1 FROM RELIEF q WHERE {_nbr_sql('p', 'q', HB)} AND NOT isnan(q.v) AND q.v > p.v)""")
def q_local_maxima(spark, sf):
    return extrema.local_maxima(fx.relief_volume(spark, sf), 0.5, HB)


def _edge_max_sql():
    parts = []
    for d, a in enumerate("xyz"):
        for cond in (f"p.{a} % {HB} = 0", f"(p.{a} % {HB} = {HB - 1} OR p.{a} = n{a} - 1)"):
            qcond = cond.replace("p.", "q.")
            parts.append(f"""SELECT p.x, p.y, p.z, p.v FROM RELIEF p, EXT
WHERE {cond} AND NOT isnan(p.v) AND NOT EXISTS (
  SELECT 1 FROM RELIEF q WHERE {_nbr_sql('p', 'q', HB, d)} AND {qcond}
  AND NOT isnan(q.v) AND q.v > p.v)""")
    return "SELECT DISTINCT * FROM (\n" + "\nUNION ALL\n".join(parts) + ") t"


@register("edge_maxima", with_sql(A_SQL) +
          ", EXT AS (SELECT max(x) + 1 AS nx, max(y) + 1 AS ny, max(z) + 1 AS nz FROM RELIEF)\n"
          + _edge_max_sql())
def q_edge_maxima(spark, sf):
    rel = fx.relief_volume(spark, sf)
    return extrema.edge_only_maxima(rel, HB, _extent_tuple(rel))


@register("seed_ids", with_sql(A_SQL) + f"""
SELECT x, y, z, x // {HB} AS bx, y // {HB} AS by_, z // {HB} AS bz,
       row_number() OVER (PARTITION BY x // {HB}, y // {HB}, z // {HB} ORDER BY z, y, x) AS seed
FROM (SELECT p.x, p.y, p.z FROM RELIEF p
      WHERE NOT isnan(p.v) AND p.v >= 0.5 AND NOT EXISTS (
        SELECT 1 FROM RELIEF q WHERE {_nbr_sql('p', 'q', HB)} AND NOT isnan(q.v) AND q.v > p.v)) s""")
def q_seed_ids(spark, sf):
    m = extrema.local_maxima(fx.relief_volume(spark, sf), 0.5, HB)
    return extrema.seed_ids(m, HB)


@register("boundary_seeds", with_sql(A_SQL) + """
SELECT p.x, p.y, p.z, CAST(CASE WHEN EXISTS (
    SELECT 1 FROM SEG q WHERE q.label = 0 AND abs(q.x - p.x) + abs(q.y - p.y) + abs(q.z - p.z) = 1)
  THEN 1 ELSE 0 END AS INTEGER) AS m
FROM SEG p WHERE p.label <> 0""")
def q_boundary_seeds(spark, sf):
    """H4 on the sparse form: background voxels aren't stored."""
    seg = fx.seg_volume(spark, sf)
    return extrema.boundary_seeds(seg.filter(F.col("label") != 0), dims=_extent_tuple(seg))


def _dt_sql(src_f: str, w) -> str:
    """Minimum over every voxel and over the nearest voxel outside each face, axis by axis."""
    sql = [f"""EXT AS (SELECT max(x) + 1 AS nx, max(y) + 1 AS ny, max(z) + 1 AS nz FROM RELIEF),
D0 AS ({src_f})"""]
    for i, (a, wi) in enumerate(zip("xyz", w)):
        o = [c for c in "xyz" if c != a]
        sql.append(f"""D{i + 1} AS (
  SELECT p.x, p.y, p.z, any_value(p.v) AS v,
         least(min(q.f + {wi!r} * (p.{a} - q.{a}) * (p.{a} - q.{a})),
               any_value({wi!r} * (p.{a} + 1) * (p.{a} + 1)), any_value({wi!r} * (n{a} - p.{a}) * (n{a} - p.{a}))) AS f
  FROM D{i} p JOIN D{i} q ON {' AND '.join(f'q.{c} = p.{c}' for c in o)}, EXT
  GROUP BY p.x, p.y, p.z)""")
    return ",\n".join(sql) + """
SELECT x, y, z, CASE WHEN isnan(v) THEN CAST('nan' AS DOUBLE) ELSE sqrt(f) END AS v FROM D3"""


@register("distance_binary", with_sql(A_SQL, _dt_sql(
    "SELECT x, y, z, v, CASE WHEN isnan(v) OR v < 0.5 THEN 0.0 ELSE CAST('inf' AS DOUBLE) END AS f FROM RELIEF", DT_W5)))
def q_distance_binary(spark, sf):
    """H5 on the relief thresholded at 0.5, resolution (1, 1, 2)."""
    rel = fx.relief_volume(spark, sf)
    return distance.distance_transform_binary(rel, 0.5, _extent_tuple(rel), DT_W5)


@register("distance_sampled", with_sql(A_SQL, _dt_sql(
    "SELECT x, y, z, v, CASE WHEN isnan(v) THEN 0.0 ELSE v * v END AS f FROM RELIEF", DT_W6)))
def q_distance_sampled(spark, sf):
    """H6 on the relief, weight 0.01, resolution (1, 1, 2)."""
    rel = fx.relief_volume(spark, sf)
    return distance.distance_transform_sampled(rel, _extent_tuple(rel), DT_W6)


# ---------------------------------------------------------------------------
# Steps 8/9: segmentation loops
# ---------------------------------------------------------------------------

from ..operators import segment  # noqa: E402

SYM_OFFS = affinity.symmetric_offsets(OFFS)      # ABC CBA
WB = 8                                           # watershed block size
RAIN_THR = 0.55


def _aff_extent(spark, sf):
    return _extent_tuple(fx.edge_affinities(spark, sf))


def _rain_inputs(spark, sf):
    aff = fx.edge_affinities(spark, sf)
    dims = _aff_extent(spark, sf)
    sym = affinity.symmetric_affinities(aff, OFFS)
    edges = segment.voxel_edges(sym, SYM_OFFS, dims, WB)
    nodes = aff.select(grid.linear_index(dims).alias("node")).distinct()
    return nodes, edges, dims


_SYM_SQL = f"""SYMA AS (
  SELECT x, y, z, c, a FROM AFF
  UNION ALL
  SELECT t.x, t.y, t.z, CAST(5 - t.c AS BIGINT) AS c, coalesce(s.a, CAST('nan' AS DOUBLE)) AS a
  FROM (AFF JOIN OFFS USING (c)) t
  LEFT JOIN AFF s ON s.c = t.c AND s.x = t.x - t.dx AND s.y = t.y - t.dy AND s.z = t.z - t.dz),
SOFFS AS (SELECT * FROM (VALUES {', '.join(f'({i}, {o[0]}, {o[1]}, {o[2]})' for i, o in enumerate(SYM_OFFS))}) o(c, dx, dy, dz)),
EXT AS (SELECT max(x) + 1 AS nx, max(y) + 1 AS ny, max(z) + 1 AS nz FROM AFF),
ED AS (SELECT x + nx * (y + ny * z) AS n1, (x + dx) + nx * ((y + dy) + ny * (z + dz)) AS n2, a
       FROM SYMA JOIN SOFFS USING (c), EXT
       WHERE NOT isnan(a) AND x + dx BETWEEN 0 AND nx - 1 AND y + dy BETWEEN 0 AND ny - 1
         AND z + dz BETWEEN 0 AND nz - 1 AND floor((x + dx) / {WB}.0) = floor(x / {WB}.0)
         AND floor((y + dy) / {WB}.0) = floor(y / {WB}.0) AND floor((z + dz) / {WB}.0) = floor(z / {WB}.0)),
NODES AS (SELECT DISTINCT x + nx * (y + ny * z) AS node FROM AFF, EXT),
BEST AS (SELECT n1 AS node, n2 AS parent FROM (
           SELECT *, row_number() OVER (PARTITION BY n1 ORDER BY a DESC, n2 ASC) AS rk FROM ED) t
         WHERE rk = 1),
PAR0 AS (SELECT NODES.node, coalesce(BEST.parent, NODES.node) AS parent FROM NODES LEFT JOIN BEST USING (node)),
PAR AS (SELECT p.node, CASE WHEN q.parent = p.node AND p.node < p.parent THEN p.node ELSE p.parent END AS parent
        FROM PAR0 p LEFT JOIN PAR0 q ON q.node = p.parent),
RAIN AS (WITH RECURSIVE r(node, root) USING KEY (node) AS (
           SELECT node, parent FROM PAR
           UNION
           SELECT r.node, p.parent FROM r JOIN PAR p ON p.node = r.root WHERE p.parent <> r.root)
         SELECT node, root FROM r)"""

_XYZ_SQL = "node % nx AS x, (node // nx) % ny AS y, node // (nx * ny) AS z"


@register("steepest_ascent", with_sql(A_SQL, _SYM_SQL) + f"SELECT {_XYZ_SQL}, root FROM RAIN, EXT")
def q_steepest_ascent(spark, sf):
    """I1 on symmetric affinities, 8^3 blocks (edges leaving a block invalid)."""
    nodes, edges, dims = _rain_inputs(spark, sf)
    return segment._node_to_xyz(segment.steepest_ascent(nodes, edges), dims)


@register("basin_merge", with_sql(A_SQL, _SYM_SQL) + f"""
, BE AS (SELECT DISTINCT r1.root AS e1, r2.root AS e2 FROM ED
         JOIN RAIN r1 ON r1.node = ED.n1 JOIN RAIN r2 ON r2.node = ED.n2
         WHERE ED.a >= {RAIN_THR} AND r1.root <> r2.root),
UE AS (SELECT e1 AS a, e2 AS b FROM BE UNION SELECT e2, e1 FROM BE),
CC AS (WITH RECURSIVE cc(node, root) USING KEY (node) AS (
    SELECT a, least(a, min(b)) FROM UE GROUP BY a
    UNION
    SELECT u.a, min(c.root) FROM cc c JOIN UE u ON u.b = c.node JOIN recurring.cc r ON r.node = u.a
    GROUP BY u.a, r.root HAVING min(c.root) < r.root)
  SELECT node AS label, root FROM cc)
SELECT {_XYZ_SQL}, coalesce(CC.root, RAIN.root) AS root
FROM RAIN LEFT JOIN CC ON CC.label = RAIN.root, EXT""")
def q_basin_merge(spark, sf):
    """Basins of I1 joined across edges with affinity >= 0.55."""
    nodes, edges, dims = _rain_inputs(spark, sf)
    basins = segment.steepest_ascent(nodes, edges)
    return segment._node_to_xyz(segment.merge_basins(basins, edges, RAIN_THR), dims)


def _seeds(spark, sf):
    m = extrema.local_maxima(fx.relief_volume(spark, sf), 0.5, HB)
    return extrema.seed_ids(m, HB)


_SEEDS_SQL = f"""SEEDS AS (SELECT p.x, p.y, p.z FROM RELIEF p
      WHERE NOT isnan(p.v) AND p.v >= 0.5 AND NOT EXISTS (
        SELECT 1 FROM RELIEF q WHERE {_nbr_sql('p', 'q', HB)} AND NOT isnan(q.v) AND q.v > p.v)),
NB6 AS (SELECT * FROM (VALUES (1, 0, 0), (-1, 0, 0), (0, 1, 0), (0, -1, 0), (0, 0, 1), (0, 0, -1)) n(dx, dy, dz)),
FH AS (WITH RECURSIVE h(x, y, z, h) USING KEY (x, y, z) AS (
    SELECT x, y, z, CAST('inf' AS DOUBLE) FROM SEEDS
    UNION
    SELECT q.x, q.y, q.z, max(least(h.h, q.v)) AS h
    FROM h JOIN NB6 ON TRUE
    JOIN RELIEF q ON q.x = h.x + dx AND q.y = h.y + dy AND q.z = h.z + dz
    LEFT JOIN recurring.h cur ON cur.x = q.x AND cur.y = q.y AND cur.z = q.z
    WHERE NOT isnan(q.v) AND q.x // {HB} = h.x // {HB} AND q.y // {HB} = h.y // {HB} AND q.z // {HB} = h.z // {HB}
    GROUP BY q.x, q.y, q.z, cur.h
    HAVING cur.h IS NULL OR max(least(h.h, q.v)) > cur.h)
  SELECT * FROM h)"""


@register("seeded_watershed_height", with_sql(A_SQL, _SEEDS_SQL) + "SELECT x, y, z, h FROM FH")
def q_seeded_watershed_height(spark, sf):
    """I3 checked through its bottleneck heights: seeds = local maxima of the
    relief (8^3 blocks), flood inside each block."""
    rel = fx.relief_volume(spark, sf)
    return segment.flood_heights(rel, _seeds(spark, sf), _extent_tuple(rel), HB)


def _grow_sql() -> str:
    """Sequential growth: in every block, step by step, the strongest edge that
    leaves the marked set passes its marker on.  NODES(node, blk, marker) and
    undirected EDGES(n1, n2, blk, w, t); the edge order is total."""
    return """BOTH_ENDS AS (SELECT n1, n2, blk, w, t, least(n1, n2) AS lo, greatest(n1, n2) AS hi FROM EDGES
      UNION ALL SELECT n2, n1, blk, w, t, least(n1, n2), greatest(n1, n2) FROM EDGES),
GROWN AS (WITH RECURSIVE g(node, blk, marker) USING KEY (node) AS (
    SELECT node, blk, marker FROM NODES WHERE marker <> 0
    UNION
    SELECT node, blk, marker FROM (
      SELECT e.n2 AS node, e.blk, r.marker,
             row_number() OVER (PARTITION BY e.blk ORDER BY e.w DESC, e.t DESC, e.lo DESC, e.hi DESC) AS rk
      FROM (SELECT DISTINCT blk FROM g) live JOIN recurring.g r ON r.blk = live.blk
      JOIN BOTH_ENDS e ON e.n1 = r.node
      WHERE NOT EXISTS (SELECT 1 FROM recurring.g s WHERE s.node = e.n2)) q
    WHERE rk = 1)
  SELECT node, marker FROM g)
SELECT NODES.x, NODES.y, NODES.z, CAST(coalesce(GROWN.marker, 0) AS BIGINT) AS label
FROM NODES LEFT JOIN GROWN USING (node)"""


def _block_no(p: str = "", b: int = 8) -> str:
    return f"({p}x // {b}) * 1000000000000 + ({p}y // {b}) * 1000000 + {p}z // {b}"


@register("seeded_watershed", with_sql(A_SQL, f"""EXT AS (SELECT max(x) + 1 AS nx, max(y) + 1 AS ny FROM RELIEF),
SEEDS AS (SELECT x, y, z, row_number() OVER (PARTITION BY x // {HB}, y // {HB}, z // {HB} ORDER BY z, y, x) AS seed
  FROM (SELECT p.x, p.y, p.z FROM RELIEF p
        WHERE NOT isnan(p.v) AND p.v >= 0.5 AND NOT EXISTS (
          SELECT 1 FROM RELIEF q WHERE {_nbr_sql('p', 'q', HB)} AND NOT isnan(q.v) AND q.v > p.v)) t),
NODES AS (SELECT x, y, z, x + nx * (y + ny * z) AS node, {_block_no(b=HB)} AS blk, coalesce(seed, 0) AS marker,
                 CASE WHEN seed IS NULL THEN v ELSE CAST('inf' AS DOUBLE) END AS v
          FROM RELIEF LEFT JOIN SEEDS USING (x, y, z), EXT WHERE NOT isnan(v)),
EDGES AS (SELECT p.node AS n1, q.node AS n2, p.blk, least(p.v, q.v) AS w, greatest(p.v, q.v) AS t
          FROM NODES p JOIN (VALUES (1, 0, 0), (0, 1, 0), (0, 0, 1)) o(dx, dy, dz) ON TRUE
          JOIN NODES q ON q.x = p.x + dx AND q.y = p.y + dy AND q.z = p.z + dz AND q.blk = p.blk)""", _grow_sql()))
def q_seeded_watershed(spark, sf):
    """I3 labels (marker-rooted maximum spanning forest)."""
    rel = fx.relief_volume(spark, sf)
    return segment.seeded_watershed(rel, _seeds(spark, sf), _extent_tuple(rel), HB)


@register("affinity_growth", with_sql(A_SQL, f"""EXT AS (SELECT max(x) + 1 AS nx, max(y) + 1 AS ny FROM AFF),
NODES AS (SELECT x, y, z, x + nx * (y + ny * z) AS node, {_block_no(b=8)} AS blk, label AS marker FROM SEG, EXT),
EDGES AS (SELECT p.node AS n1, q.node AS n2, p.blk, a AS w, 0.0 AS t
          FROM AFF JOIN OFFS USING (c) JOIN NODES p ON p.x = AFF.x AND p.y = AFF.y AND p.z = AFF.z
          JOIN NODES q ON q.x = p.x + dx AND q.y = p.y + dy AND q.z = p.z + dz AND q.blk = p.blk
          WHERE NOT isnan(a))""", _grow_sql()))
def q_affinity_growth(spark, sf):
    """I4: seg labels grown into their 0-voxels along affinity edges (8^3 blocks)."""
    aff = fx.edge_affinities(spark, sf)
    dims = _extent_tuple(aff)
    return segment.seeded_growth(fx.seg_volume(spark, sf), aff, OFFS, dims, WB)


LONG_OFFS = OFFS + ((0, -3, 0),)       # channel 3 of A read as a long-range edge


@register("edge_sampling", with_sql(A_SQL) + f"""
SELECT x, y, z, c, a FROM A
WHERE c < 3 OR CAST('0x' || substr(md5(concat_ws(',', x, y, z, c)), 1, 13) AS BIGINT) < {int(0.01 * (1 << 52))}""")
def q_edge_sampling(spark, sf):
    """I8: short edges kept, long-range ones sampled at 1% by a position hash."""
    a = fx.affinity_volume(spark, sf).select("x", "y", "z", "c", "a")
    norms = [sum(v * v for v in o) for o in LONG_OFFS]
    short = F.element_at(F.array(*[F.lit(n <= 1) for n in norms]), F.col("c").cast("int") + 1)
    return a.filter(short | segment.sample_mask(0.01))


# ---------------------------------------------------------------------------
# Metadata of a derived pyramid
# ---------------------------------------------------------------------------

from ..functions import attrs  # noqa: E402

_FACTOR_STRINGS = ("1", "2", "2,2,1")


@register("volume_meta", with_sql(
    M_SQL, "L1 AS (" + _topk_sql("M", 3, (2, 2, 2)) + ")", "L2 AS (" + _topk_sql("L1", 3, (2, 2, 1)) + ")",
    f"U AS (SELECT DISTINCT {_blk_sql()}, label FROM M)") + """
, META AS (
  SELECT 's0' AS dataset, '1' AS fs, max(x) + 1 AS nx, max(y) + 1 AS ny, max(z) + 1 AS nz FROM M
  UNION ALL SELECT 's1', '2', max(x) + 1, max(y) + 1, max(z) + 1 FROM L1
  UNION ALL SELECT 's2', '2,2,1', max(x) + 1, max(y) + 1, max(z) + 1 FROM L2
  UNION ALL SELECT 'unique-labels', '1', max(bx) + 1, max(by_) + 1, max(bz) + 1 FROM U)
SELECT dataset, CAST(regexp_extract(dataset, '^s(\\d+)$', 1) AS INTEGER) AS scale, nx, ny, nz,
       list_reverse([nx, ny, nz])[1] AS rx, list_reverse([nx, ny, nz])[2] AS ry,
       list_reverse([nx, ny, nz])[3] AS rz,
       CAST(string_split(fs, ',')[1] AS BIGINT) AS fx,
       CAST(coalesce(string_split(fs, ',')[2], string_split(fs, ',')[-1]) AS BIGINT) AS fy,
       CAST(coalesce(string_split(fs, ',')[3], string_split(fs, ',')[-1]) AS BIGINT) AS fz
FROM META WHERE regexp_matches(dataset, '^s\\d+$')""")
def q_volume_meta(spark, sf):
    """Metadata rows of the multiset pyramid (extents measured from each
    level): scale-name filter and index (A9), reversed dims (A11), parsed
    factor strings (B8)."""
    ms = fx.multiset_volume(spark, sf)
    levels = pyramid.multiset_pyramid(ms, [2, (2, 2, 1)], [3])
    rows = [lv.agg(*[(F.max(a) + 1).cast("bigint").alias("n" + a) for a in grid.AXES])
              .select(F.lit(f"s{i}").alias("dataset"), F.lit(_FACTOR_STRINGS[i]).alias("fs"), "nx", "ny", "nz")
            for i, lv in enumerate(levels)]
    u = unique.unique_labels(ms.select("x", "y", "z", "label"), VB)
    rows.append(u.agg(*[(F.max(b) + 1).cast("bigint").alias("n" + a) for a, b in zip(grid.AXES, grid.BLOCK_COLS)])
                 .select(F.lit("unique-labels").alias("dataset"), F.lit("1").alias("fs"), "nx", "ny", "nz"))
    meta = rows[0]
    for r in rows[1:]:
        meta = meta.unionByName(r)
    rev = attrs.reverse_array(F.array("nx", "ny", "nz"))
    fac = attrs.parse_factors_col("fs")
    return (meta.filter(attrs.is_scale_name("dataset"))
                .select("dataset", attrs.scale_index("dataset").alias("scale"), "nx", "ny", "nz",
                        rev[0].alias("rx"), rev[1].alias("ry"), rev[2].alias("rz"),
                        fac[0].alias("fx"), fac[1].alias("fy"), fac[2].alias("fz")))


# ---------------------------------------------------------------------------
# Tools (P1, P8) end to end
# ---------------------------------------------------------------------------

@register("average_channels", with_sql(A_SQL) + """
, O2 AS (SELECT * FROM (VALUES (0, -1, 0, 0), (2, 0, 0, -1)) o(c, dx, dy, dz)),
C AS (SELECT x, y, z, CASE WHEN isfinite(a) THEN a ELSE 0.0 END AS s, 1 AS own FROM AFF JOIN O2 USING (c)
      UNION ALL
      SELECT x + dx, y + dy, z + dz, CASE WHEN isfinite(a) THEN a ELSE 0.0 END, 0 FROM AFF JOIN O2 USING (c))
SELECT x, y, z, sum(s) * 0.25 AS v FROM C GROUP BY x, y, z HAVING max(own) = 1""")
def q_average_channels(spark, sf):
    """P8 with two named channels: the divisor counts the named offsets only."""
    from . import tools
    return tools.average_affinities_tool(fx.edge_affinities(spark, sf), ("-1,0,0:0", "0,0,-1:2"))["averaged"]


def _written(spark, outputs, block, names, **how):
    """Outputs of a tool, written to the shared folder and read back."""
    from . import stages, tools
    path = stages.new_store(spark, "volumes")
    tools.write_outputs(outputs, path, block, **how)
    return [volume.read_volume(spark, path, n) for n in names]


@register("convert_written", with_sql(V_SQL) + """
SELECT x, y, z, label, CAST(1 AS BIGINT) AS n FROM V
WHERE (x // 8, y // 8, z // 8) IN (SELECT (x // 8, y // 8, z // 8) FROM V WHERE label <> 0)""")
def q_convert_written(spark, sf):
    """Converted, empty blocks dropped, written block-addressed and read back."""
    from . import tools
    out = _written(spark, tools.convert_tool(fx.label_volume(spark, sf), VB), VB, ["multiset"])[0]
    return out.select("x", "y", "z", "label", F.col("n").cast("bigint").alias("n"))


@register("index_lists", with_sql(V_SQL) + f"""
, U AS (SELECT DISTINCT {_blk_sql()}, label FROM V)
SELECT label, count(*) AS blocks, CAST(sum(bx * 1000000 + by_ * 1000 + bz) AS BIGINT) AS place FROM U GROUP BY label""")
def q_index_lists(spark, sf):
    """F1 as lists per label: the lists' lengths and the blocks they name."""
    u = unique.unique_labels(fx.label_volume(spark, sf), VB)
    lists = index.box_lists(index.label_to_blocks(u, V_DIMS, VB), V_DIMS, VB)
    box = lists.select("label", F.explode("boxes").alias("b"))
    return box.groupBy("label").agg(
        F.count(F.lit(1)).alias("blocks"),
        F.sum(F.expr(f"(b.x0 div {VB}) * 1000000 + (b.y0 div {VB}) * 1000 + b.z0 div {VB}")).alias("place"))


# stored volumes, indices and the staged tools register themselves
from . import catalog_store, catalog_tools  # noqa: E402, F401
