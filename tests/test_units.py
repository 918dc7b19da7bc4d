"""Hand-made unit inputs (FIXTURES.md §4) for operators without an oracle."""

import math

import pytest

from voxelflow.functions import attrs, grid
from voxelflow.operators import affinity, extrema, index, pyramid, stitch, unique
from voxelflow.plans import tools
from voxelflow.sources import volume


def df3(spark, rows, cols="x bigint, y bigint, z bigint, v double"):
    return spark.createDataFrame(rows, cols)


def test_parse_factors_and_offsets():
    assert attrs.parse_factors("2") == [2, 2, 2]
    assert attrs.parse_factors("2,2,1") == [2, 2, 1]
    assert attrs.parse_offset("-1,0,0") == ((-1, 0, 0), None)
    assert attrs.parse_offset("-1,0,0:2") == ((-1, 0, 0), 2)
    assert attrs.enumerate_offsets(["-1,0,0", "0,-1,0"]) == [(0, (-1, 0, 0)), (1, (0, -1, 0))]
    with pytest.raises(ValueError):
        attrs.enumerate_offsets(["-1,0,0:1", "0,-1,0"])


def test_parse_columns(spark):
    df = spark.createDataFrame([("2",), ("2,2,1",), ("3,1",)], "s string")
    got = [r.f for r in df.select(attrs.parse_factors_col("s").alias("f")).collect()]
    assert got == [[2, 2, 2], [2, 2, 1], [3, 1, 1]]
    o = spark.createDataFrame([("-1,0,0",), ("0,0,-2:5",)], "s string")
    rows = o.select(attrs.parse_offset_col("s").alias("o")).collect()
    assert tuple(rows[0].o) == (-1, 0, 0, None) and tuple(rows[1].o) == (0, 0, -2, 5)


@pytest.mark.parametrize("n", range(6))
def test_reverse_array(spark, n):
    a = list(range(n))
    df = spark.createDataFrame([(a,)], "a array<bigint>")
    assert df.select(attrs.reverse_array("a").alias("r")).collect()[0].r == a[::-1]


def test_scales_and_accumulation():
    assert attrs.sort_scales(["s10", "s2", "labels", "s0", "s1x"]) == ["s0", "s2", "s10"]
    assert attrs.accumulate_factors(None, [2, 2, 1]) == [2, 2, 1]
    assert attrs.accumulate_factors([2, 2, 1], [2, 2, 2]) == [4, 4, 2]


def test_factor_checks():
    grid.check_factors((2, 2, 2), 64, 64)
    with pytest.raises(ValueError):
        grid.check_factors((0, 1, 1), 64, 64)
    with pytest.raises(ValueError):
        grid.check_factors((3, 3, 3), 64, 32)
    assert grid.input_aligned_block((100, 64, 30), (64, 64, 64)) == (128, 64, 64)


def test_ragged_downsample_counts(spark):
    # 5x3x1, factor 2: edge cells hold fewer counts; totals preserved
    rows = [(x, y, 0, (x + y) % 2, 1) for x in range(5) for y in range(3)]
    ms = spark.createDataFrame(rows, "x bigint, y bigint, z bigint, label bigint, n bigint")
    d = pyramid.downsample_multiset(ms, 2)
    assert sum(r.n for r in d.collect()) == 15
    cell = {(r.x, r.y, r.label): r.n for r in d.collect()}
    assert cell[(2, 1, 0)] + cell.get((2, 1, 1), 0) == 1
    full = pyramid.add_background(d.filter("label = 1"), 2, (5, 3, 1))
    tot = {}
    for r in full.collect():
        tot[(r.x, r.y)] = tot.get((r.x, r.y), 0) + r.n
    # only cells holding some row are completed; cell (2, 1) holds label 0 only
    assert tot[(0, 0)] == 4 and tot[(2, 0)] == 2 and (2, 1) not in tot


def test_nan_and_masked_average(spark):
    # 3x3x3 affinities, one NaN, one masked voxel (FIXTURES §4)
    offs = [(-1, 0, 0), (0, -1, 0), (0, 0, -1)]
    rows = []
    for x in range(3):
        for y in range(3):
            for z in range(3):
                for c in range(3):
                    a = 0.5
                    if (x, y, z, c) == (1, 1, 1, 0):
                        a = float("nan")
                    rows.append((x, y, z, c, a))
    aff = spark.createDataFrame(rows, "x bigint, y bigint, z bigint, c bigint, a double")
    m = spark.createDataFrame([(x, y, z, 0 if (x, y, z) == (2, 2, 2) else 1)
                               for x in range(3) for y in range(3) for z in range(3)],
                              "x bigint, y bigint, z bigint, m int")
    plain = {(r.x, r.y, r.z): r.v for r in affinity.average_affinities(aff, offs).collect()}
    # corner (2,2,2): own 3 edges + 0 incoming from outside -> 3*0.5/6
    assert plain[(2, 2, 2)] == pytest.approx(3 * 0.5 / 6)
    # (1,1,1): NaN edge skipped, 2 own + 3 incoming from (2,1,1),(1,2,1),(1,1,2)
    assert plain[(1, 1, 1)] == pytest.approx(5 * 0.5 / 6)
    # (0,1,1) receives the NaN edge of (1,1,1): skipped
    assert plain[(0, 1, 1)] == pytest.approx((3 + 2) * 0.5 / 6)
    nan = {(r.x, r.y, r.z): r.v for r in
           affinity.average_affinities(aff, offs, mask=m, nan_oob=True).collect()}
    assert math.isnan(nan[(2, 2, 2)]) and math.isnan(nan[(1, 2, 2)])
    assert not math.isnan(nan[(0, 0, 0)])
    skip = {(r.x, r.y, r.z): r.v for r in affinity.average_affinities(aff, offs, mask=m).collect()}
    assert skip[(2, 2, 2)] == pytest.approx(0.0)


def test_cross_block_offset_two(spark):
    # 6x1x1, block 3, offset -2: targets outside the block become NaN
    aff = spark.createDataFrame([(x, 0, 0, 0, 1.0) for x in range(6)],
                                "x bigint, y bigint, z bigint, c bigint, a double")
    out = {r.x: r.a for r in affinity.invalidate_cross_block(aff, [(-2, 0, 0)], 3).collect()}
    assert [math.isnan(out[x]) for x in range(6)] == [True, True, False, True, True, False]


def test_plateau_maxima(spark):
    rel = df3(spark, [(x, y, 0, 1.0) for x in range(3) for y in range(3)])
    assert extrema.local_maxima(rel).count() == 9


def test_face_seeds(spark):
    # 3x3x3 with one maximum on each face plane of the single block
    vals = {(x, y, z): 0.0 for x in range(3) for y in range(3) for z in range(3)}
    for p in [(0, 1, 1), (2, 1, 1), (1, 0, 1), (1, 2, 1), (1, 1, 0), (1, 1, 2)]:
        vals[p] = 1.0
    rel = df3(spark, [(*k, v) for k, v in vals.items()])
    got = {(r.x, r.y, r.z) for r in extrema.edge_only_maxima(rel, 3, (3, 3, 3)).filter("v = 1.0").collect()}
    assert got == {(0, 1, 1), (2, 1, 1), (1, 0, 1), (1, 2, 1), (1, 1, 0), (1, 1, 2)}


def test_prediction_mask_zero_voxel(spark):
    # 8^3 mask with one zero voxel, block 4, dyadic resolution, pad 0 and 1
    rows = [(x, y, z, 0 if (x, y, z) == (5, 5, 5) else 1) for x in range(8) for y in range(8) for z in range(8)]
    m = spark.createDataFrame(rows, "x bigint, y bigint, z bigint, m int")
    ext = volume.extent(m)
    from voxelflow.operators import mask
    got0 = {(r.bx, r.by_, r.bz): r.m for r in mask.prediction_mask(m, ext, 4, 1, 1, pad=0).collect()}
    assert got0[(1, 1, 1)] == 0 and sum(got0.values()) == 7
    got1 = {(r.bx, r.by_, r.bz): r.m for r in mask.prediction_mask(m, ext, 4, 1, 1, pad=1).collect()}
    # padding reaches outside the mask for every block -> all 0
    assert sum(got1.values()) == 0


def test_relabel_dense_and_offsets(spark):
    lab = spark.createDataFrame([(0, 0, 0, 5), (1, 0, 0, 7), (2, 0, 0, 7), (3, 0, 0, 0), (4, 0, 0, 9)],
                                "x bigint, y bigint, z bigint, label bigint")
    d = {r.x: r.label for r in stitch.relabel_dense(lab, (2, 1, 1), (5, 1, 1), segment=1).collect()}
    assert d == {0: 1, 1: 2, 2: 3, 3: 0, 4: 4}


def test_upper_median(spark):
    df = spark.createDataFrame([([3.0, 1.0, 2.0, 4.0],), ([5.0],)], "vals array<double>")
    assert [r.m for r in df.select(stitch.upper_median("vals").alias("m")).collect()] == [3.0, 5.0]


def test_convert_tool_and_preconditions(spark):
    lab = spark.createDataFrame([(0, 0, 0, 0), (5, 0, 0, 3)], "x bigint, y bigint, z bigint, label bigint")
    out = tools.convert_tool(lab, 4)
    assert {tuple(r) for r in out["multiset"].collect()} == {(5, 0, 0, 3, 1)}
    with pytest.raises(ValueError):
        volume.check_preconditions("a", "a")
    flt = spark.createDataFrame([(0, 0, 0, 1.0)], "x bigint, y bigint, z bigint, label double")
    with pytest.raises(TypeError):
        volume.check_preconditions("a", "b", flt)


def test_write_read_volume_roundtrip(spark, tmp_path):
    lab = spark.createDataFrame([(x, 0, z, x + z) for x in range(4) for z in range(4)],
                                "x bigint, y bigint, z bigint, label bigint")
    p = str(tmp_path / "vol")
    volume.write_volume(lab, p, "labels", 0, 2)
    back = volume.read_volume(spark, p, "labels", 0)
    assert sorted(map(tuple, back.select("x", "y", "z", "label").collect())) == \
        sorted(map(tuple, lab.collect()))
    # rerun replaces only the written slabs
    volume.write_volume(lab.filter("z < 2").withColumn("label", lab.label * 0), p, "labels", 0, 2)
    back = volume.read_volume(spark, p, "labels", 0)
    assert back.filter("z < 2 AND label <> 0").count() == 0 and back.filter("z >= 2").count() == 8
    region = volume.read_region(back, (0, 0, 2), (1, 0, 3))
    assert region.count() == 4


def test_lines_stepped_together_equal_the_single_envelope(monkeypatch):
    import random

    import numpy as np

    from voxelflow.operators import distance
    rng = random.Random(5)
    for near in (128, 4):
        monkeypatch.setattr(distance, "NEAR", near)
        pos, f, cuts = [], [], [0]
        for _ in range(40):
            n = rng.choice([1, 2, 9, 30])
            own = sorted(rng.sample(range(30), n)) if rng.random() < 0.3 else list(range(30 - n, 30))
            kind = rng.random()
            pos += own
            f += [float("inf") if kind < 0.3 or rng.random() < 0.5 else rng.choice([0.0, rng.random() * 50]) for _ in own]
            cuts.append(len(pos))
        for w in (1.0, 0.04, 0.0):
            got = distance.envelopes(np.array(pos), np.array(f), cuts, w, 30)
            want = [v for a, b in zip(cuts, cuts[1:]) for v in distance.lower_envelope(pos[a:b], f[a:b], w, 30)]
            assert got.tolist() == want


def test_entry_without_the_text_operators(monkeypatch):
    import builtins

    import __spark_entry__ as E
    real = builtins.__import__

    def missing(name, *args, **kw):
        if name == "voxelflow.llm.queries":
            raise ImportError("a library is missing")
        return real(name, *args, **kw)
    monkeypatch.setattr(builtins, "__import__", missing)
    from voxelflow.plans.catalog import QUERIES
    assert set(E.queries()) == set(QUERIES) and set(E.oracle_sql()) <= set(QUERIES)
