"""The reference's only correctness test: unique labels per block, then the
label -> blocks index, on a 4x3x2 volume with 3x2x2 blocks (FIXTURES.md §1)."""

from voxelflow.operators import index, unique

DIMS = (4, 3, 2)
BLOCK = (3, 2, 2)
# The golden label volume, x fastest, rows y = 0..2 per z slice.
Z0 = ["1 1 1 1", "1 1 2 2", "1 2 2 2"]
Z1 = ["1 1 2 4", "3 3 2 2", "3 3 3 2"]


def golden(spark):
    data = []
    for z, sl in enumerate((Z0, Z1)):
        for y, line in enumerate(sl):
            for x, v in enumerate(line.split()):
                data.append((x, y, z, int(v)))
    return spark.createDataFrame(data, "x bigint, y bigint, z bigint, label bigint")


def test_unique_labels_per_block(spark):
    u = unique.unique_labels(golden(spark), BLOCK)
    got = {}
    for r in u.collect():
        got.setdefault((r.bx, r.by_, r.bz), set()).add(r.label)
    assert got == {(0, 0, 0): {1, 2, 3}, (1, 0, 0): {1, 2, 4},
                   (0, 1, 0): {1, 2, 3}, (1, 1, 0): {2}}


def test_label_to_boxes(spark):
    u = unique.unique_labels(golden(spark), BLOCK)
    idx = index.label_to_blocks(u, DIMS, BLOCK)
    got = {}
    for r in idx.collect():
        got.setdefault(r.label, set()).add((r.x0, r.y0, r.z0, r.x1, r.y1, r.z1))
    a = (0, 0, 0, 2, 1, 1)
    b = (3, 0, 0, 3, 1, 1)
    c = (0, 2, 0, 2, 2, 1)
    d = (3, 2, 0, 3, 2, 1)
    assert got == {1: {a, b, c}, 2: {a, b, c, d}, 3: {a, c}, 4: {b}}


def test_box_lists_and_binary(spark):
    u = unique.unique_labels(golden(spark), BLOCK)
    idx = index.label_to_blocks(u, DIMS, BLOCK)
    lists = index.box_lists(idx, DIMS, BLOCK)
    by_label = {r.label: r.boxes for r in lists.collect()}
    assert sorted(by_label) == [1, 2, 3, 4]
    assert len(by_label[2]) == 4
    bins = {r.label: r.data for r in index.boxes_binary(lists).collect()}
    # one record of 6 big-endian int64 per box
    assert all(len(v) % 48 == 0 for v in bins.values())
    assert len(bins[4]) == 48
    import struct
    assert struct.unpack(">6q", bytes(bins[4])) == (3, 0, 0, 3, 1, 1)


def test_bucketed_lookup(spark):
    u = unique.unique_labels(golden(spark), BLOCK)
    idx = index.label_to_blocks_bucketed(u, DIMS, BLOCK, step=2)
    assert {r.bucket for r in idx.filter("label = 3").collect()} == {1}
    got = index.blocks_of(idx, 3, step=2)
    assert got.count() == 2
    maps = {r.bucket: r.blocks for r in index.bucket_maps(idx, DIMS, BLOCK).collect()}
    assert set(maps[0]) == {1} and set(maps[1]) == {2, 3} and set(maps[2]) == {4}
