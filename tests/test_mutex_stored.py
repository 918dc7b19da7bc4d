"""The mutex tool on stored volumes: their voxels are not broadcast, blocks are finished block by block."""

import random
import re

import pytest
from pyspark.sql import functions as F

from test_segment import grid_graph, seq_mutex
from voxelflow.functions.grid import floor_div
from voxelflow.operators import segment, stitch
from voxelflow.sources import ledger as led


def joins(df):
    """``(operator, first key)`` of every join of a plan as Spark first makes it."""
    return re.findall(r"(\w+Join) \[(\w+)#", df._jdf.queryExecution().executedPlan().toString())


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """A label volume of 6^3 voxels at resolution 2 and the ledger of its store."""
    rng = random.Random(3)
    v = spark.createDataFrame([(x, y, z, rng.randrange(4)) for x in range(6) for y in range(6) for z in range(6)],
                              "x bigint, y bigint, z bigint, label bigint")
    path = str(tmp_path_factory.mktemp("mutex") / "v")
    ledger = led.Ledger(spark, path)
    led.write_volume(ledger, v, path, "labels", 0, 2, resolution=(2, 2, 2))
    return path, ledger


def test_joins_of_stored_voxels_merge(spark, store):
    path, ledger = store
    v = led.open_volume(spark, path, "labels")
    like = ledger.row("labels").asDict() | {"resolution": [1.0] * 3}
    fine = v.select(*[(F.col(a) * 2 + i).alias(a) for i, a in enumerate("xyz")])
    aligned = led.open_aligned(spark, path, "labels", fine, like, "label", 0)
    for df in (aligned, stitch.drop_singletons(v, 2), stitch.merge_edges_mutual_argmax(v, 2)):
        assert {op for op, _ in joins(df)} == {"SortMergeJoin"}, joins(df)
    # per-block counts may be broadcast, voxels join by their block
    assert ("SortMergeJoin", "bx") in joins(stitch.relabel_dense(v, 2, (6, 6, 6)))
    assert {k for op, k in joins(stitch.relabel_dense(v, 2, (6, 6, 6))) if op == "BroadcastHashJoin"} <= {"seg"}
    stored = {(r.x, r.y, r.z): r.label for r in v.collect()}
    got = {(r.x, r.y, r.z): r.label for r in aligned.collect()}
    assert got == {(2 * x, 2 * y + 1, 2 * z + 2): stored.get((x, y, z + 1), 0) for x, y, z in stored}


def test_mutex_blocks_are_finished_block_by_block(spark, monkeypatch):
    rng = random.Random(17)
    blocks = [grid_graph(rng, 6, 6) for _ in range(5)]
    blocks[3] = [(u, v, s, False) for u, v, s, _ in blocks[3]]
    edges = [(u + 36 * b, v + 36 * b, s, att) for b, g in enumerate(blocks) for u, v, s, att in g]
    most = max(map(len, blocks))
    nodes = spark.createDataFrame([(i,) for i in range(180)], "node bigint")
    e = spark.createDataFrame(edges, "n1 bigint, n2 bigint, s double, att boolean")
    want = seq_mutex(180, edges)

    def clustered(size, n=most):
        return {r.node: r.label for r in segment.mutex_watershed(nodes, e, n, lambda c: floor_div(c, size)).collect()}
    assert clustered(36, most - 1) == want      # a block is too large at first: rounds, then blocks
    assert clustered(25) == want                # edges that leave their part: rounds
    monkeypatch.setattr(segment, "pointer_jump", lambda *a, **k: pytest.fail("a round over all blocks"))
    assert clustered(36) == want
    none = e.withColumn("att", F.lit(False))
    assert {r.node: r.label for r in segment.mutex_watershed(nodes, none, 0).collect()} == {i: i for i in range(180)}


def test_mutex_tool_hands_its_blocks_on(spark, monkeypatch):
    whole = segment.mutex_watershed
    monkeypatch.setattr(segment, "mutex_watershed", lambda n, e, **k: whole(n, e, 600, **k))
    monkeypatch.setattr(segment, "pointer_jump", lambda *a, **k: pytest.fail("a round over all blocks"))
    rng = random.Random(5)
    offs = ((-1, 0, 0), (0, -1, 0), (0, 0, -1))
    aff = {(x, y, z, c): rng.random() for x in range(8) for y in range(8) for z in range(8) for c in range(3)}
    df = spark.createDataFrame([(*k, a) for k, a in aff.items()], "x bigint, y bigint, z bigint, c bigint, a double")
    out = {(r.x, r.y, r.z): r.label for r in segment.mutex_segmentation(df, offs, (8, 8, 8), 4, 0.5).collect()}
    edges = []
    for (x, y, z, c), a in aff.items():
        q = tuple(i + o for i, o in zip((x, y, z), offs[c]))
        if all(i // 4 == j // 4 for i, j in zip((x, y, z), q)):
            edges.append((x + 8 * (y + 8 * z), q[0] + 8 * (q[1] + 8 * q[2]), a if a >= 0.5 else 1 - a, a >= 0.5))
    want = seq_mutex(512, edges)
    assert out == {(x, y, z): want[x + 8 * (y + 8 * z)] + 1 for x in range(8) for y in range(8) for z in range(8)}
