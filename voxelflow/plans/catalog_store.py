"""Queries of stored volumes and indices: ledger, Morton-ordered regions, block replacement, written pyramids, task boxes."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import grid
from ..operators import affinity, index, stitch, unique
from ..sources import bucketed
from ..sources import fixtures as fx
from ..sources import index_store as istore
from ..sources import ledger as led
from ..sources import volume
from ..sources.fixtures import A_SQL, M_SQL, V_SQL, with_sql
from . import stages, tools
from .catalog import ORACLES, OFFS, _U_SQL, _UP_SQL, PM, V_DIMS, VB, _box_sql, _dense_sql, _face_sql, _level_dims, _pm_box_sql, _topk_sql, register
from .stages import new_store

SMALL_CELLS = 1         # cells of 2^3 blocks, so that a small volume has many


@register("region_read_stored", with_sql(V_SQL) + """
SELECT x, y, z, label FROM V WHERE x BETWEEN 4 AND 12 AND y BETWEEN 10 AND 40 AND z BETWEEN 2 AND 6""")
def q_region_read_stored(spark, sf):
    """A1, A2, A3: V written in Morton order, a box read back; block size and cells come from the ledger."""
    path = new_store(spark, "volumes")
    led.write_volume(led.Ledger(spark, path), fx.label_volume(spark, sf), path, "labels", 0, VB, cell_bits=SMALL_CELLS)
    return led.open_volume(spark, path, "labels", 0, (4, 10, 2), (12, 40, 6))


@register("rewrite_blocks", with_sql(V_SQL) + f"""
SELECT x, y, z, label FROM V WHERE x // {VB} <> 1
UNION ALL SELECT x, y, z, label + 1000 FROM V WHERE x // {VB} = 1 AND (y // {VB}) % 3 <> 0 AND label % 2 = 0""")
def q_rewrite_blocks(spark, sf):
    """A3, A4: the blocks of one x layer replaced; a third of them have no rows any more and disappear."""
    path = new_store(spark, "volumes")
    ledger = led.Ledger(spark, path)
    v = fx.label_volume(spark, sf)
    led.write_volume(ledger, v, path, "labels", 0, VB, cell_bits=SMALL_CELLS)
    layer = grid.block_position(v, VB).filter("bx = 1")
    new = layer.filter("by_ % 3 <> 0 AND label % 2 = 0").select("x", "y", "z", (F.col("label") + 1000).alias("label"))
    led.write_volume(ledger, new, path, "labels", 0, VB, whole=False, blocks=layer.select("bx", "by_", "bz").distinct(),
                     cell_bits=SMALL_CELLS)
    return led.open_volume(spark, path, "labels")


@register("ledger_state", with_sql(V_SQL) + f"""
, KEPT AS (SELECT * FROM V WHERE (x // {VB}, y // {VB}, z // {VB}) IN
             (SELECT (x // {VB}, y // {VB}, z // {VB}) FROM V WHERE label <> 0))
SELECT 'labels' AS dataset, 0 AS level, 'complete' AS status, CAST(1 AS BIGINT) AS version, max(x) + 1 AS nx, max(y) + 1 AS ny,
       max(z) + 1 AS nz, {VB} AS block, 'bigint' AS dtype, max(label) AS max_id, count(*) AS rows, 'V' AS source, '8.0' AS unit FROM V
UNION ALL
SELECT 'multiset', 0, 'complete', 2, max(x) + 1, max(y) + 1, max(z) + 1, {VB}, 'bigint', max(label), count(*), 'V', '8.0' FROM KEPT
UNION ALL SELECT 'lost', 0, 'running', 1, 0, 0, 0, 16, 'double', NULL, NULL, 'V', '1.0'""")
def q_ledger_state(spark, sf):
    """States after two writes, one of them repeated with copied attributes, and a job that died."""
    path = new_store(spark, "volumes")
    ledger, v = led.Ledger(spark, path), fx.label_volume(spark, sf)
    led.write_volume(ledger, v, path, "labels", 0, VB, args={"source": "V"}, resolution=(8, 8, 8), attrs={"unit": "nm"})
    stored = led.open_volume(spark, path, "labels")
    for _ in range(2):
        tools.write_outputs(tools.convert_tool(stored, VB), path, VB, resolution=(8, 8, 8), copy_from=("labels", 0))
    ledger.claim("lost", 0, 16, "double", args={"source": "V"})
    return ledger.latest().select(
        "dataset", "level", "status", "version", *[F.col("dims")[i].alias("n" + a) for i, a in enumerate("xyz")],
        F.col("block_size")[0].alias("block"), "dtype", "max_id", "rows", F.col("attrs")["source"].alias("source"),
        F.col("resolution")[0].cast("string").alias("unit"))


def _kept_sql(src: str, b: int) -> str:
    return f"SELECT * FROM {src} WHERE (x // {b}, y // {b}, z // {b}) IN (SELECT (x // {b}, y // {b}, z // {b}) FROM {src} WHERE label <> 0)"


@register("pyramid_written", with_sql(
    M_SQL, "T1 AS (" + _topk_sql("M", 3, (2, 2, 2)) + ")", "L1 AS (" + _kept_sql("T1", VB) + ")",
    "T2 AS (" + _topk_sql("L1", 3, (2, 2, 1)) + ")", "L2 AS (" + _kept_sql("T2", VB) + ")") + """
SELECT 0 AS level, x, y, z, label, n, 1.0::DOUBLE AS fx, 1.0::DOUBLE AS fz, 'true' AS tag, NULL AS cap FROM M
UNION ALL SELECT 1, x, y, z, label, n, 2.0, 2.0, 'true', '3' FROM L1
UNION ALL SELECT 2, x, y, z, label, n, 4.0, 2.0, 'true', '3' FROM L2""")
def q_pyramid_written(spark, sf):
    """Levels written one from the stored other, with accumulated factors, entry cap and multiscale tag."""
    path = new_store(spark, "volumes")
    tools.write_pyramid(fx.multiset_volume(spark, sf), path, ("2", "2,2,1"), (VB, VB), [3], VB, "pyramid")
    out = None
    for i in range(3):
        row = led.Ledger(spark, path).require_complete(f"pyramid/s{i}")
        f = row["factors"] or [1.0] * 3
        lv = led.open_volume(spark, path, f"pyramid/s{i}").select(
            F.lit(i).alias("level"), "x", "y", "z", "label", "n", F.lit(f[0]).alias("fx"), F.lit(f[2]).alias("fz"),
            F.lit(row["attrs"]["multiScale"]).alias("tag"), F.lit(row["attrs"].get("maxNumEntries")).cast("string").alias("cap"))
        out = lv if out is None else out.unionByName(lv)
    return out


def _faces_sql(src: str) -> str:
    return f"SELECT count(*) FROM ({_face_sql(src, VB, False)}) f WHERE l1 = l2"


@register("faces_written", with_sql(V_SQL, _dense_sql("V", VB, "DV")) + f"""
SELECT 'labels' AS dataset, 'complete' AS status, count(*) AS rows, max(label) AS max_id, ({_faces_sql('V')}) AS violations FROM V
UNION ALL SELECT 'dense', 'complete', count(*), max(label), ({_faces_sql('DV')}) FROM DV
UNION ALL SELECT 'refused', 'running', NULL, NULL, NULL""")
def q_faces_written(spark, sf):
    """Largest id and face violations are measured by the write itself; where ids must be unique to
    their block, a level with violations stays running."""
    path = new_store(spark, "volumes")
    ledger, v = led.Ledger(spark, path), fx.label_volume(spark, sf)
    led.write_volume(ledger, v, path, "labels", 0, VB, unique_ids="count")
    stored = led.open_volume(spark, path, "labels")
    led.write_volume(ledger, stitch.relabel_dense(stored, VB, V_DIMS), path, "dense", 0, VB, unique_ids=True)
    try:
        led.write_volume(ledger, stored, path, "refused", 0, VB, unique_ids=True)
    except ValueError:
        pass        # V's ids are not unique to a block
    return ledger.latest().select("dataset", "status", "rows", "max_id", F.col("attrs")["violations"].cast("bigint").alias("violations"))


BUCKETS = 8


@register("relabel_dense_bucketed", ORACLES["relabel_dense"])
def q_relabel_dense_bucketed(spark, sf):
    """J3 on a bucketed volume: no voxel is exchanged after the write."""
    path = new_store(spark, "volumes")
    bucketed.write_bucketed(led.Ledger(spark, path), fx.label_volume(spark, sf), path, "labels", VB, BUCKETS)
    return stitch.relabel_dense(bucketed.open_bucketed(spark, path, "labels"), VB, V_DIMS, segment=16)


@register("weight_edges_bucketed", ORACLES["weight_edges"])
def q_weight_edges_bucketed(spark, sf):
    """G8 on bucketed edges and weights with their reach: both joins run inside the buckets."""
    path = new_store(spark, "volumes")
    ledger = led.Ledger(spark, path)
    bucketed.write_bucketed(ledger, fx.edge_affinities(spark, sf), path, "edges", VB, BUCKETS)
    weights = affinity.voxel_weights(fx.mask_volume(spark, sf), fx.glia_volume(spark, sf))
    bucketed.write_bucketed(ledger, weights, path, "weights", VB, BUCKETS, reach=affinity.reach(OFFS))
    return affinity.weight_edges_by_block(bucketed.open_bucketed(spark, path, "edges"), OFFS,
                                          bucketed.open_bucketed(spark, path, "weights"))


_DIMS_SQL = """
, ID AS (SELECT max(x) + 1 AS nx, max(y) + 1 AS ny, max(z) + 1 AS nz FROM MASK),
"""


@register("prediction_mask_dims", with_sql(A_SQL) + _DIMS_SQL + """OD AS (
  SELECT CAST(ceil(nx * 4.0 / 16.0) * 2 AS BIGINT) AS nx, CAST(ceil(ny * 4.0 / 16.0) * 2 AS BIGINT) AS ny,
         CAST(ceil(nz * 4.0 / 16.0) * 2 AS BIGINT) AS nz FROM ID),
""" + _pm_box_sql() + """
SELECT bx, by_, bz, x0, y0, z0, x1, y1, z1,
       CASE WHEN lo_x >= 0 AND hi_x < ID.nx AND lo_y >= 0 AND hi_y < ID.ny AND lo_z >= 0 AND hi_z < ID.nz THEN 1 ELSE 0 END AS m
FROM BI, ID""")
def q_prediction_mask_dims(spark, sf):
    """P7 from the input's dims only, output extent snapped up to whole network outputs."""
    ext = volume.extent(fx.mask_volume(spark, sf))
    net = tuple(b * r for b, r in zip(PM["block"], PM["out_res"]))
    return tools.prediction_mask_tool(None, None, net, PM["in_res"], PM["out_res"], PM["in_off"], PM["out_off"],
                                      tuple(n + 2 * p for n, p in zip(net, PM["pad"])), in_extent=ext)["mask"]


# ---------------------------------------------------------------------------
# Unique labels and index on disk
# ---------------------------------------------------------------------------

STEP = 10


def _unique_levels(spark, sf, path):
    """P3 and P4, every level written and the next one made from the stored one; returns the levels' block lists."""
    ledger = led.Ledger(spark, path)
    out = tools.extract_unique_labels_tool(fx.label_volume(spark, sf), VB)
    stages.write_output(ledger, out["unique-labels"], path, "unique-labels/s0", VB)
    levels = [stages.read_output(spark, path, "unique-labels/s0")]
    for i in (1, 2):
        stages.write_output(ledger, unique.downsample_unique_labels(levels[-1], 2, VB, VB), path, f"unique-labels/s{i}", VB,
                            factors=(2, 2, 2), copy_from=("unique-labels/s0", 0))
        levels.append(stages.read_output(spark, path, f"unique-labels/s{i}"))
    return levels


@register("unique_pyramid_written", with_sql(V_SQL, _U_SQL, _UP_SQL) + "SELECT level, bx, by_, bz, label FROM UP")
def q_unique_pyramid_written(spark, sf):
    """Unique labels per block, and two coarser levels made from the stored ones."""
    out = None
    for i, u in enumerate(_unique_levels(spark, sf, new_store(spark, "labels"))):
        u = u.select(F.lit(i).alias("level"), *grid.BLOCK_COLS, "label")
        out = u if out is None else out.unionByName(u)
    return out


def _stored_index(spark, sf):
    path = new_store(spark, "labels")
    levels = _unique_levels(spark, sf, path)
    idx = tools.label_to_block_mapping_tool(levels, V_DIMS, [VB] * 3, [2, 2], STEP)["label-to-block-mapping"]
    istore.write_index(led.Ledger(spark, path), idx, path, "label-to-block-mapping", STEP, 8)
    return path


@register("index_written", with_sql(V_SQL, _U_SQL, _UP_SQL) + "\n UNION ALL ".join(
    f"SELECT {_box_sql(_level_dims(i))}, label // {STEP} AS bucket, {i} AS level FROM UP WHERE level = {i}" for i in range(3)))
def q_index_written(spark, sf):
    """The index of all levels, made from stored levels, stored by shard and read back."""
    return istore.open_index(spark, _stored_index(spark, sf), "label-to-block-mapping")


@register("index_lookup_stored", with_sql(V_SQL, _U_SQL, _UP_SQL) + "\n UNION ALL ".join(
    f"SELECT {_box_sql(_level_dims(i))}, label // {STEP} AS bucket, {i} AS level FROM UP WHERE level = {i} AND label = 209"
    for i in range(3)))
def q_index_lookup_stored(spark, sf):
    """F4 on the stored index (the lookup is the feature): one shard of each level is read."""
    return istore.lookup(spark, _stored_index(spark, sf), "label-to-block-mapping", 209)


PARTS = 16              # blocks per part of a box list

_LISTS_SQL = f"""BX AS (SELECT label, bx * {VB} AS x0, by_ * {VB} AS y0, bz * {VB} AS z0,
       least(bx * {VB} + {VB - 1}, {V_DIMS[0] - 1}) AS x1, least(by_ * {VB} + {VB - 1}, {V_DIMS[1] - 1}) AS y1,
       least(bz * {VB} + {VB - 1}, {V_DIMS[2] - 1}) AS z1,
       (bx + {V_DIMS[0] // VB} * (by_ + {V_DIMS[1] // VB} * bz)) // {PARTS} AS part FROM U)"""


def _lists(spark, sf):
    u = unique.unique_labels(fx.label_volume(spark, sf), VB)
    return index.label_to_blocks_bucketed(u, V_DIMS, VB, STEP)


@register("box_records", with_sql(V_SQL, _U_SQL, _LISTS_SQL) + """
SELECT label, part, string_agg(concat(""" + ", ".join(f"lpad(to_hex({c}), 16, '0')" for c in ("x0", "y0", "z0", "x1", "y1", "z1")) + """),
       '' ORDER BY x0, y0, z0, x1, y1, z1) AS records FROM BX GROUP BY label, part""")
def q_box_records(spark, sf):
    """Every label's sorted box list, in parts, as stored big-endian records; the records as text."""
    path = new_store(spark, "labels")
    istore.write_records(led.Ledger(spark, path), index.box_lists(_lists(spark, sf), V_DIMS, VB, PARTS), path, "boxes", STEP, 8)
    return istore.open_index(spark, path, "boxes").select("label", "part", F.hex("data").alias("records"))


@register("box_records_read", with_sql(V_SQL, _U_SQL, _LISTS_SQL) + "SELECT label, x0, y0, z0, x1, y1, z1 FROM BX")
def q_box_records_read(spark, sf):
    """A15 read back: the boxes that the stored records hold."""
    path = new_store(spark, "labels")
    istore.write_records(led.Ledger(spark, path), index.box_lists(_lists(spark, sf), V_DIMS, VB, PARTS), path, "boxes", STEP, 8)
    return index.boxes_from_binary(istore.open_index(spark, path, "boxes"))


@register("bucket_maps", with_sql(V_SQL, _U_SQL, _LISTS_SQL) + f"""
SELECT label // {STEP} AS bucket, part, label, string_agg(concat_ws(',', x0, y0, z0, x1, y1, z1), ';' ORDER BY x0, y0, z0) AS boxes
FROM BX GROUP BY label, part""")
def q_bucket_maps(spark, sf):
    """maps from label to box list per bucket and part; entries as text."""
    maps = index.bucket_maps(_lists(spark, sf), V_DIMS, VB, PARTS)
    e = maps.select("bucket", "part", F.explode("blocks").alias("label", "list"))
    text = F.array_join(F.transform("list", lambda b: F.concat_ws(",", *[b[c].cast("string") for c in index.BOX_COLS])), ";")
    return e.select("bucket", "part", "label", text.alias("boxes"))


@register("label_sets_pyramid", with_sql(V_SQL, _U_SQL, _UP_SQL) + "SELECT level, bx, by_, bz, label FROM UP")
def q_label_sets_pyramid(spark, sf):
    """E4, E5 on bitmaps: coarse levels unite bitmaps of bounded size; their labels."""
    sets = unique.label_sets(unique.unique_labels(fx.label_volume(spark, sf), VB))
    out = None
    for i in range(3):
        lv = unique.labels_of_sets(sets).select(F.lit(i).alias("level"), *grid.BLOCK_COLS, "label")
        out = lv if out is None else out.unionByName(lv)
        sets = unique.downsample_label_sets(sets, 2, VB, VB)
    return out


# ---------------------------------------------------------------------------
# Task boxes, alignment, preconditions
# ---------------------------------------------------------------------------

TASK = dict(block_size=(4, 8, 4), blocks_per_task=(2, 1, 3), factors=(2, 3, 1), halo=(1, 5, 0))


def _task_sql() -> str:
    ext = "EXT AS (SELECT max(x) + 1 AS nx, max(y) + 1 AS ny, max(z) + 1 AS nz FROM V)"
    axes = []
    for a, bc, b, t, f, h in zip("xyz", ("bx", "by_", "bz"), *TASK.values()):
        n, size = f"(SELECT n{a} FROM EXT)", b * t
        target = f"CAST(ceil({n} / {f}.0) AS BIGINT)"
        axes.append(f"""T{a} AS (SELECT *, unnest(range(s{a}0 // {b}, s{a}1 // {b} + 1)) AS {bc} FROM (
  SELECT *, greatest({a}0 * {f} - {h}, 0) AS s{a}0, least(({a}1 + 1) * {f} - 1 + {h}, {n} - 1) AS s{a}1 FROM (
    SELECT t{a}, t{a} * {size} AS {a}0, least(t{a} * {size} + {size - 1}, {target} - 1) AS {a}1
    FROM (SELECT unnest(range(0, ({target} + {size - 1}) // {size})) AS t{a}) q) r) s)""")
    return with_sql(V_SQL, ext, *axes) + "SELECT * FROM Tx, Ty, Tz"


@register("task_boxes", _task_sql())
def q_task_boxes(spark, sf):
    """Target box, source box with halo, and the source blocks that each task meets."""
    return grid.task_boxes(volume.extent(fx.label_volume(spark, sf)), **TASK)


@register("aligned_blocks", with_sql(V_SQL) + """
, EXT AS (SELECT max(x) + 1 AS nx, max(y) + 1 AS ny, max(z) + 1 AS nz FROM V)
SELECT f, b, CAST(greatest(round(nx / b), 1) AS BIGINT) * b AS ax, CAST(greatest(round(ny / b), 1) AS BIGINT) * b AS ay,
       CAST(greatest(round(nz / b), 1) AS BIGINT) * b AS az, (b * f) % 4 = 0 AS fits
FROM EXT, (SELECT unnest(range(1, 5)) AS f) q, (SELECT unnest(range(3, 13)) AS b) r""")
def q_aligned_blocks(spark, sf):
    """Re-block sizes aligned to the volume's extent, and which factors fit previous blocks of 4."""
    e = volume.extent(fx.label_volume(spark, sf))
    e = e.withColumn("f", F.explode(F.sequence(F.lit(1).cast("bigint"), F.lit(4).cast("bigint"))))
    e = e.withColumn("b", F.explode(F.sequence(F.lit(3).cast("bigint"), F.lit(12).cast("bigint"))))
    cols = grid.aligned_block_cols(("nx", "ny", "nz"), ("b", "b", "b"))
    return e.select("f", "b", *[c.alias("a" + a) for c, a in zip(cols, "xyz")],
                    grid.factors_ok(("f",) * 3, (F.lit(4),) * 3, ("b",) * 3).alias("fits"))


@register("preconditions", with_sql(V_SQL) + """
SELECT * FROM (VALUES ('same name', 'ValueError'), ('no name', 'ValueError'), ('float labels', 'TypeError'), ('block size', 'ValueError'),
                      ('unfinished', 'RuntimeError'), ('fits', NULL)) t(kind, refused), (SELECT count(*) AS voxels FROM V) n""")
def q_preconditions(spark, sf):
    """What is refused before a job runs, against a stored volume."""
    path = new_store(spark, "volumes")
    ledger, v = led.Ledger(spark, path), fx.label_volume(spark, sf)
    stored = led.write_volume(ledger, v, path, "labels", 0, VB)
    ledger.claim("unfinished", 0, VB, "bigint")
    checks = {"same name": lambda: volume.check_preconditions("labels", "labels", v), "no name": lambda: volume.check_preconditions(None, "x", v),
              "float labels": lambda: volume.check_preconditions("a", "b", v.withColumn("label", F.col("label") * 0.5)),
              "block size": lambda: ledger.claim("labels", 0, VB * 2, "bigint"), "unfinished": lambda: ledger.require_complete("unfinished"),
              "fits": lambda: volume.check_preconditions("labels", "multiset", v)}
    rows = []
    for kind, check in checks.items():
        try:
            check()
            rows.append((kind, None, stored["rows"]))
        except (ValueError, TypeError, RuntimeError) as e:
            rows.append((kind, type(e).__name__, stored["rows"]))
    return spark.createDataFrame(rows, "kind string, refused string, voxels bigint")
