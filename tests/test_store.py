"""Stored volumes: Morton order and pruning, block-level replacement, the ledger, staged execution."""

import os
import random

import pytest
from pyspark.sql import functions as F

from voxelflow.functions import grid, morton
from voxelflow.operators import graph, mask, segment
from voxelflow.plans import stages, tools
from voxelflow.plans.stages import Stage
from voxelflow.sources import ledger as led
from voxelflow.sources import volume

LABELS = "x bigint, y bigint, z bigint, label bigint"


def cube(spark, n, label=lambda x, y, z: 1 + x // 2 + 10 * (y // 2) + 100 * (z // 2)):
    return spark.createDataFrame([(x, y, z, label(x, y, z)) for x in range(n) for y in range(n) for z in range(n)], LABELS)


def got(df):
    return sorted((r.x, r.y, r.z, r.label) for r in df.collect())


def files(path):
    return {os.path.relpath(os.path.join(d, f), path): os.stat(os.path.join(d, f)).st_mtime_ns
            for d, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")}


# ---------------------------------------------------------------- keys and ranges

def test_keys_order_cubes_together(spark):
    rng = random.Random(1)
    at = [tuple(rng.randrange(1 << rng.randrange(1, 22)) for _ in range(3)) for _ in range(300)] + [((1 << 21) - 1,) * 3, (0, 0, 0)]
    df = spark.createDataFrame(at, "bx bigint, by_ bigint, bz bigint")
    rows = df.select("*", morton.key().alias("k"), morton.cell(morton.key(), 2).alias("c")).collect()
    for r in rows:
        assert r.k == morton.key_of(r.bx, r.by_, r.bz) and r.c == morton.key_of(r.bx >> 2, r.by_ >> 2, r.bz >> 2)
    with pytest.raises(Exception, match="block position"):
        spark.createDataFrame([(-1, 0, 0)], "bx bigint, by_ bigint, bz bigint").select(morton.key()).collect()


def test_ranges_cover_the_box_and_little_more():
    rng = random.Random(2)
    for _ in range(200):
        lo = [rng.randrange(20) for _ in range(3)]
        hi = [v + rng.randrange(9) for v in lo]
        bits = rng.randrange(3)
        inside = {morton.key_of(x, y, z) >> 3 * bits for x in range(lo[0], hi[0] + 1) for y in range(lo[1], hi[1] + 1)
                  for z in range(lo[2], hi[2] + 1)}
        exact = {k for a, b in morton.ranges(lo, hi, bits, 10 ** 6) for k in range(a, b + 1)}
        assert exact == inside
        few = morton.ranges(lo, hi, bits, 3)
        assert len(few) <= 3 and inside <= {k for a, b in few for k in range(a, b + 1)}
    assert morton.ranges((3, 0, 0), (1, 5, 5)) == [] and morton.ranges((0, 0, 0), (-1, 0, 0)) == []


def test_region_prunes_all_axes(spark, tmp_path):
    path = str(tmp_path / "v")
    v = cube(spark, 16)
    led.write_volume(led.Ledger(spark, path), v, path, "labels", 0, 2, cell_bits=1)
    for lo, hi in (((0, 0, 0), (3, 3, 3)), ((5, 1, 9), (6, 15, 9)), ((12, 12, 12), (40, 40, 40)), ((30, 0, 0), (40, 1, 1))):
        r = led.open_volume(spark, path, "labels", 0, lo, hi)
        rows = r.collect()
        want = [(x, y, z) for x in range(16) for y in range(16) for z in range(16) if all(a <= c <= b for a, c, b in zip(lo, (x, y, z), hi))]
        assert sorted((q.x, q.y, q.z) for q in rows) == want
        plan = r._jdf.queryExecution().executedPlan()
        leaf = plan.collectLeaves().apply(0)
        if want and leaf.metrics().contains("numPartitions"):
            read = leaf.metrics().apply("numPartitions").value()
            cells = {(x // 4, y // 4, z // 4, z // 2) for x, y, z in want}
            assert read == len(cells), (lo, hi, read)
    text = led.open_volume(spark, path, "labels", 0, (0, 0, 0), (3, 3, 3))._jdf.queryExecution().executedPlan().toString()
    assert "(cell" in text.split("PartitionFilters")[1] and "BroadcastNestedLoop" not in text


# ---------------------------------------------------------------- block-level replacement

def test_rerun_of_one_block_leaves_other_files_alone(spark, tmp_path):
    path = str(tmp_path / "v")
    ledger = led.Ledger(spark, path)
    led.write_volume(ledger, cube(spark, 8), path, "labels", 0, 2, cell_bits=1)
    before = files(path)
    block = [(x, y, z, 999) for x in (4, 5) for y in (0, 1) for z in (2, 3)]
    row = led.write_volume(ledger, spark.createDataFrame(block, LABELS), path, "labels", 0, 2, whole=False, cell_bits=1)
    after = files(path)
    met = f"cell={morton.key_of(1, 0, 0)}/bz=1/"
    assert {f for f in before if after.get(f) != before[f]} == {f for f in before if met in f}
    want = [(x, y, z, 999 if (x // 2, y // 2, z // 2) == (2, 0, 1) else lab) for x, y, z, lab in got(cube(spark, 8))]
    assert got(led.open_volume(spark, path, "labels")) == sorted(want)
    assert (row["version"], row["status"], list(row["dims"]), row["max_id"]) == (2, "complete", [8, 8, 8], 999)


def test_emptied_blocks_and_partitions_disappear(spark, tmp_path):
    path = str(tmp_path / "v")
    volume.write_volume(cube(spark, 8), path, "labels", 0, 2, cell_bits=1)
    gone = spark.createDataFrame([(bx, by, 0) for bx in (0, 1) for by in (0, 1)] + [(3, 3, 3), (50, 50, 50)], "bx bigint, by_ bigint, bz bigint")
    volume.write_volume(cube(spark, 1).filter("false"), path, "labels", 0, 2, blocks=gone, cell_bits=1)
    left = got(volume.read_volume(spark, path, "labels"))
    dropped = {(0, 0, 0), (0, 1, 0), (1, 0, 0), (1, 1, 0), (3, 3, 3)}
    assert left == [r for r in got(cube(spark, 8)) if (r[0] // 2, r[1] // 2, r[2] // 2) not in dropped]
    assert not [f for f in files(path) if "cell=0/bz=0/" in f]
    # a whole write drops what it doesn't hold
    volume.write_volume(cube(spark, 2), path, "labels", 0, 2, whole=True, cell_bits=1)
    assert got(volume.read_volume(spark, path, "labels")) == got(cube(spark, 2))


# ---------------------------------------------------------------- the ledger

def test_failed_write_stays_running_and_a_rerun_resumes(spark, tmp_path):
    path = str(tmp_path / "v")
    v = cube(spark, 4)
    bad = v.withColumn("label", F.when(F.col("x") == 3, F.raise_error(F.lit("lost")).cast("bigint")).otherwise(F.col("label")))
    with pytest.raises(Exception, match="lost"):
        led.write_volume(led.Ledger(spark, path), bad, path, "labels", 0, 2, args={"a": 1})
    ledger = led.Ledger(spark, path)
    assert ledger.row("labels")["status"] == "running" and ledger.should_run("labels")
    for read in (lambda: ledger.require_complete("labels"), lambda: led.open_volume(spark, path, "labels")):
        with pytest.raises(RuntimeError, match="not marked complete"):
            read()
    led.write_volume(ledger, v, path, "labels", 0, 2, args={"a": 1})
    r = led.Ledger(spark, path).require_complete("labels")
    assert (r["version"], list(r["dims"]), list(r["block_size"]), r["dtype"], r["max_id"], r["rows"], r["attrs"]["a"]) == \
        (2, [4, 4, 4], [2, 2, 2], "bigint", 112, 64, "1")
    assert not ledger.should_run("labels") and ledger.should_run("labels", overwrite=True)
    with pytest.raises(RuntimeError, match="not in the store"):
        ledger.require_complete("other")
    assert ledger.history().count() == 3 and ledger.latest().count() == 1


def test_claims(spark, tmp_path):
    ledger, other = (led.Ledger(spark, str(tmp_path / "v")) for _ in range(2))
    first = ledger.claim("a", 0, 8, "bigint", offset=(4, 0, 2), attrs={"unit": "nm", "blockSize": "8"})
    assert list(first["offset"]) == [4.0, 0.0, 2.0] and list(first["resolution"]) == [1.0, 1.0, 1.0]
    second = other.claim("a", 0, 16, "bigint")       # the first never completed
    with pytest.raises(RuntimeError, match="claimed by another run"):
        ledger.complete(first)
    other.complete(second, dims=(1, 2, 3))
    with pytest.raises(ValueError, match="block size"):
        ledger.claim("a", 0, 8, "bigint")
    ledger.complete(ledger.claim("src", 0, 8, "bigint", attrs={"unit": "nm", "blockSize": "8"}))
    copy = ledger.claim("b", 1, 8, "bigint", copy_from=("src", 0))
    assert copy["attrs"] == {"unit": "nm"}
    ledger.complete(ledger.claim("g/s0", 0, 8, "bigint"))
    ledger.complete(ledger.claim("g/s1", 0, 8, "bigint"))
    ledger.tag_multiscale("g")
    tags = {r["dataset"]: (r["attrs"] or {}).get("multiScale") for r in ledger.latest().collect()}
    assert tags == {"a": None, "src": None, "b": None, "g/s0": "true", "g/s1": "true"}


def test_datasets_of_different_columns_share_a_store(spark, tmp_path):
    path = str(tmp_path / "v")
    ledger = led.Ledger(spark, path)
    led.write_volume(ledger, cube(spark, 2), path, "g/labels", 0, 2)
    led.write_volume(ledger, cube(spark, 2).select("x", "y", "z", F.lit(0.5).alias("v")), path, "relief", 3, 2)
    led.write_volume(ledger, cube(spark, 2).filter("false"), path, "none", 0, 2)
    assert got(led.open_volume(spark, path, "g/labels")) == got(cube(spark, 2))
    assert led.open_volume(spark, path, "relief", 3).columns == ["x", "y", "z", "v"]
    empty = led.open_volume(spark, path, "none")
    assert empty.count() == 0 and empty.dtypes == cube(spark, 1).dtypes


# ---------------------------------------------------------------- stages

def test_second_run_starts_after_the_last_complete_stage(spark, tmp_path):
    path, built = str(tmp_path / "v"), []

    def plan(fail=None, factor=2):
        def make(name, fn):
            def build(*frames):
                built.append(name)
                if name == fail:
                    raise RuntimeError("killed")
                return fn(*frames)
            return build
        return [Stage("one", ("input",), make("one", lambda v: v.withColumn("label", F.col("label") + 1))),
                Stage("two", ("one",), make("two", lambda v: v.withColumn("label", F.col("label") * factor)), {"factor": factor}),
                Stage("pairs", ("one", "two"), make("pairs", lambda a, b: a.select(F.col("label").alias("k")).distinct())),
                Stage("three", ("two", "pairs"), make("three", lambda v, p: v.join(p.withColumnRenamed("k", "label"), "label", "left_semi")
                                                                           .select("x", "y", "z", "label")))]
    given = {"input": cube(spark, 4)}
    with pytest.raises(RuntimeError, match="killed"):
        stages.run(spark, path, plan("pairs"), given, 2)
    assert built == ["one", "two", "pairs"]
    before = files(path)
    built.clear()
    out = stages.run(spark, path, plan(), given, 2)
    assert built == ["pairs", "three"] and {f: t for f, t in files(path).items() if f in before} == before
    lazy = stages.compose(plan(), given)
    assert got(out["three"]) == got(lazy["three"])
    built.clear()
    assert got(stages.run(spark, path, plan(), given, 2)["three"]) == got(lazy["three"]) and built == []
    stages.run(spark, path, plan(factor=3), given, 2)
    assert built == ["two", "pairs", "three"]
    built.clear()
    stages.run(spark, path, plan(factor=3), given, 2, args={"input": "other"})
    assert built == ["one", "two", "pairs", "three"]
    built.clear()
    stages.run(spark, str(tmp_path / "w"), plan(), given, 2, wanted=("two",))
    assert built == ["one", "two"]


def test_staged_watersheds_equal_the_lazy_ones(spark, tmp_path):
    rng = random.Random(4)
    rel = spark.createDataFrame([(x, y, z, rng.random()) for x in range(6) for y in range(6) for z in range(4)],
                                "x bigint, y bigint, z bigint, v double")
    plan = tools.stitched_stages((6, 6, 4), 4, 0.5, 0.5, 0.5)
    out = stages.run(spark, str(tmp_path / "v"), plan, {"relief": rel}, 4, (6, 6, 4))
    lazy = tools.stitched_watersheds(rel, (6, 6, 4), 4, 0.5, 0.5, 0.5)
    assert got(out["block-merged"]) == got(lazy["block-merged"])
    assert led.Ledger(spark, str(tmp_path / "v")).require_complete("block-merged")["max_id"] == lazy["max_id"].first()[0]


# ---------------------------------------------------------------- loops that end in one task

def test_distributed_rounds_equal_the_local_end(spark):
    rng = random.Random(6)
    edges = {(rng.randrange(60), rng.randrange(60)) for _ in range(55)}
    e = spark.createDataFrame([(a, b) for a, b in edges], "e1 bigint, e2 bigint")
    s = e.select(F.struct(F.lit(1).alias("k"), F.col("e1").alias("n")).alias("e1"), F.struct(F.lit(1).alias("k"), F.col("e2").alias("n")).alias("e2"))
    want = sorted(map(tuple, graph.connected_components(e, local_edges=0).collect()))
    assert sorted(map(tuple, graph.connected_components(e).collect())) == want
    assert sorted((r.label.n, r.root.n) for r in graph.connected_components(s).collect()) == want
    nodes = spark.createDataFrame([(i, i if i % 9 == 0 else 0) for i in range(60)], "node bigint, marker bigint")
    w = spark.createDataFrame([(a, b, rng.randrange(8) / 8, 0.0) for a, b in edges], "n1 bigint, n2 bigint, w double, t double")
    assert sorted(map(tuple, segment.marker_forest(nodes, w, 0).collect())) == sorted(map(tuple, segment.marker_forest(nodes, w).collect()))
    m = spark.createDataFrame([(a, b, rng.randrange(50) / 50, rng.random() < 0.6) for a, b in edges], "n1 bigint, n2 bigint, s double, att boolean")
    n = nodes.select("node")
    assert sorted(map(tuple, segment.mutex_watershed(n, m, 0).collect())) == sorted(map(tuple, segment.mutex_watershed(n, m).collect()))


# ---------------------------------------------------------------- summed volume

def test_mask_counts_equal_brute_force(spark):
    rng = random.Random(7)
    for k in range(3):
        n = (rng.randrange(5, 12), rng.randrange(5, 12), rng.randrange(5, 12))
        vox = {(x, y, z) for x in range(n[0]) for y in range(n[1]) for z in range(n[2]) if rng.random() < 0.97}
        m = spark.createDataFrame([(*v, 1) for v in vox] + [(0, 0, 0, 0)] * ((0, 0, 0) not in vox), "x bigint, y bigint, z bigint, m int")
        ext = spark.createDataFrame([tuple(-(-v // 2) for v in n)], "nx bigint, ny bigint, nz bigint")
        off, pad = (0, 2, 4)[k], (0, 4, 8)[k]
        rows = mask.prediction_mask(m, ext, 2, 4, 8, 0, off, pad).collect()
        assert len(rows) == len({(r.bx, r.by_, r.bz) for r in rows})
        for r in rows:
            ax = [((r[f"{a}0"] * 8 + off - pad) // 4, -(-(r[f"{a}1"] * 8 + off + pad) // 4)) for a in "xyz"]
            full = all((x, y, z) in vox for x in range(ax[0][0], ax[0][1] + 1) for y in range(ax[1][0], ax[1][1] + 1)
                       for z in range(ax[2][0], ax[2][1] + 1))
            assert r.m == int(full), r
        dims = spark.createDataFrame([n], "nx bigint, ny bigint, nz bigint")
        inside = {(r.bx, r.by_, r.bz): r.m for r in mask.prediction_mask_dims(dims, ext, 2, 4, 8, 0, off, pad).collect()}
        every = spark.createDataFrame([(x, y, z, 1) for x in range(n[0]) for y in range(n[1]) for z in range(n[2])], "x bigint, y bigint, z bigint, m int")
        assert inside == {(r.bx, r.by_, r.bz): r.m for r in mask.prediction_mask(every, ext, 2, 4, 8, 0, off, pad).collect()}
    assert grid.snap_up(9, 4) == 12
    snapped = mask.snapped_extent(spark.createDataFrame([(10, 11, 12)], "nx bigint, ny bigint, nz bigint"), 4, 8, 32).first()
    assert tuple(snapped) == (8, 8, 8)
