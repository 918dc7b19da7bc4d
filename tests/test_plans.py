"""Plan-shape guards for scale: no nested-loop or cartesian joins and no
Python evaluation in any non-iterative query; region reads reach the scan."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from voxelflow.plans.catalog import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")

# queries that run actions while being built (iterative loops, data-derived parameters)
LOOPS = {"steepest_ascent", "basin_merge", "seeded_watershed_height", "seeded_watershed",
         "affinity_growth", "mutex_watershed", "watershed_stitched", "connected_components",
         "apply_mapping", "convert_written", "rain_pipeline", "mutex_pipeline", "dt_watershed_binary",
         "rain_pipeline_sized", "dt_watershed_sampled", "dt_watershed_faces", "mutex_pipeline_shifted"}
BAD = ("BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - LOOPS))
def test_no_nested_loops_or_python(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not [b for b in BAD if b in plan], name


def test_region_read_pushdown(spark, tmp_path):
    from voxelflow.sources import fixtures as fx
    from voxelflow.sources import volume
    volume.write_volume(fx.label_volume(spark, SF), str(tmp_path / "v"), "labels", 0, 8)
    r = volume.read_volume(spark, str(tmp_path / "v"), "labels", 0, (4, 10, 2), (19, 70, 5), 8)
    plan = r._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(x)" in plan or "GreaterThanOrEqual(x,4)" in plan
    assert "bz" in plan.split("PartitionFilters")[1].split("]")[0]


@pytest.mark.parametrize("name,scans", [("local_maxima", 1), ("edge_maxima", 1), ("distance_binary", 1), ("distance_sampled", 1)])
def test_one_scan(spark, name, scans):
    from voxelflow.plans import catalog
    dims = catalog._extent_tuple
    catalog._extent_tuple = lambda df: (16, 20, 50)     # the extent is an aggregate of its own
    try:
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    finally:
        catalog._extent_tuple = dims
    assert plan.count("FileScan") == scans, plan


def exchanged(df):
    """The columns that the exchanges of a plan move, one list per exchange."""
    text = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    nodes = [n for n in text.split("\n\n") if n.lstrip().split("\n")[0].endswith("Exchange")]
    return [n.split("[", 2)[2].split("]")[0] for n in nodes]


@pytest.mark.parametrize("name,most", [("weight_edges_bucketed", 0), ("relabel_dense_bucketed", None)])
def test_bucketed_volumes_exchange_no_voxel(spark, name, most):
    from voxelflow.sources import bucketed
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", bucketed.CO_PARTITION)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    bucketed.join_in_buckets(spark)
    try:
        moved = exchanged(QUERIES[name](spark, SF))
        plain = exchanged(QUERIES[name.removesuffix("_bucketed")](spark, SF))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert any("x#" in m.replace("bx#", "") for m in plain)
    assert not any("x#" in m.replace("bx#", "") for m in moved), moved
    assert most is None or len(moved) <= most, moved


def test_stored_weights_are_not_broadcast(spark):
    plan = QUERIES["weight_edges_bucketed"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and plan.count("SortMergeJoin") == 2, plan
