"""Metadata helpers (A10, A12-A14, B10, B13, D5) and the invariants of SURVEY §5."""

import os

import pytest
from pyspark.sql import functions as F

from voxelflow.functions import grid
from voxelflow.operators import graph, index, pyramid, stitch, unique
from voxelflow.sources import fixtures as fx
from voxelflow.sources import volume

SF = "/root/testdata/sf0.001"


def test_metadata_helpers(spark):
    m = volume.meta_row(spark, "s0", 0, (4, 3, 2), (3, 2, 2), "uint64", attrs={"a": "1"})
    m = m.withColumn("src_attrs", F.create_map(F.lit("dimensions"), F.lit("x"), F.lit("units"), F.lit("nm")))
    got = volume.copy_attributes(m).collect()[0].attrs
    assert got == {"a": "1", "units": "nm"}
    m2 = volume.set_status(m.drop("src_attrs"), "s0", "complete")
    assert not volume.should_run(m2, "s0") and volume.should_run(m2, "s0", overwrite=True)
    volume.require_complete(m2, "s0")
    with pytest.raises(RuntimeError):
        volume.require_complete(volume.set_status(m2, "s0", "running"), "s0")
    p = volume.with_provenance(m2, {"threshold": 0.9}).collect()[0]
    assert p.attrs["threshold"] == "0.9" and list(p.resolution) == [1.0, 1.0, 1.0]
    volume.check_block_size(m2, (3, 2, 2))
    with pytest.raises(ValueError):
        volume.check_block_size(m2, (4, 4, 4))
    tagged = volume.tag_multiscale(m2, "s").collect()[0].attrs
    assert tagged["multiScale"] == "true"


def test_task_key_and_halo(spark):
    df = spark.createDataFrame([(0, 0, 0), (7, 0, 0), (8, 0, 0)], "x bigint, y bigint, z bigint")
    keys = [r.tx for r in df.select(grid.task_key(4, 2)["tx"].alias("tx")).collect()]
    assert keys == [0, 0, 1]
    h = grid.halo_blocks(df, 8, 1).filter("by_ = 0 AND bz = 0")
    got = sorted((r.x, r.bx) for r in h.collect())
    assert got == [(0, 0), (7, 0), (7, 1), (8, 0), (8, 1)]
    assert grid.expand_box((2, 2, 2), (5, 5, 5), 1) == ((1, 1, 1), (6, 6, 6))


needs_data = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


@needs_data
def test_counts_preserved_without_cap(spark):
    ms = fx.multiset_volume(spark, SF)
    d = pyramid.downsample_multiset(ms, (2, 3, 2))
    assert ms.agg(F.sum("n")).collect()[0][0] == d.agg(F.sum("n")).collect()[0][0]


@needs_data
def test_unique_pyramid_equals_coarse_blocks(spark):
    v = fx.label_volume(spark, SF)
    u8 = unique.unique_labels(v, 8)
    down = unique.downsample_unique_labels(u8, 2, 8, 8)
    direct = unique.unique_labels(v, 16)
    assert down.exceptAll(direct).count() == 0 and direct.exceptAll(down).count() == 0


@needs_data
def test_index_inverts_unique_labels(spark):
    v = fx.label_volume(spark, SF)
    u = unique.unique_labels(v, 8)
    idx = index.label_to_blocks(u, fx.V_GRID, 8)
    back = idx.select((F.col("x0") / 8).cast("bigint").alias("bx"), (F.col("y0") / 8).cast("bigint").alias("by_"),
                      (F.col("z0") / 8).cast("bigint").alias("bz"), "label")
    assert back.exceptAll(u).count() == 0 and u.exceptAll(back).count() == 0


@needs_data
def test_components_idempotent_and_dense_ids(spark):
    v = fx.label_volume(spark, SF)
    dense = stitch.relabel_dense(v, 8, fx.V_GRID)
    ids = sorted(r.label for r in dense.filter("label <> 0").select("label").distinct().collect())
    assert ids == list(range(1, len(ids) + 1))
    e = stitch.merge_edges_mutual_argmax(dense, 8)
    cc = graph.connected_components(e, "e1", "e2")
    roots = cc.select(F.col("root").alias("e1"), F.col("root").alias("e2"))
    again = graph.connected_components(cc.select(F.col("label").alias("e1"), F.col("root").alias("e2")))
    assert {(r.label, r.root) for r in again.collect()} == {(r.label, r.root) for r in cc.collect()}
    assert roots.count() == cc.count()
