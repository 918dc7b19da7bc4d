"""Cross-block stitching.

Block-wise segmentations carry ids that are unique inside a block only.
Stitching gives them global ids (prefix sums over per-block counts), finds
label pairs that touch across block faces, scores those contacts, merges the
accepted pairs with connected components and applies the mapping.

Scale notes
* Per-block tables (counts, offsets) have one row per block.  The prefix sum
  over them is two-level: running sums inside segments of ``segment`` blocks
  (windows partitioned by segment) plus a running sum over segment totals, so
  no window ever runs over all blocks in one task.
* Face contacts only involve voxels on block faces, a ``6/B`` fraction of the
  volume; background 0 is filtered before any pairing so the hottest key never
  enters a join.
* Ordered statistics (upper median) are per (block, face, pair) group, whose
  size is bounded by the face area.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.grid import AXES, BLOCK_COLS, block_position, floor_div, triple

BLK = list(BLOCK_COLS)


# ---------------------------------------------------------------------------
# Block id counts, offsets, relabelling
# ---------------------------------------------------------------------------

def block_label_counts(labels: DataFrame, block_size, how: str = "distinct") -> DataFrame:
    """Per block: number of distinct non-zero labels (``distinct``) or the
    largest label (``max``, for block-local ids 1..n)."""
    v = block_position(labels.filter(F.col("label") != 0), block_size)
    if how == "distinct":
        agg = F.countDistinct("label")
    elif how == "max":
        agg = F.max("label")
    else:
        raise ValueError(how)
    return v.groupBy(*BLK).agg(agg.cast("bigint").alias("n"))


def block_offsets(counts: DataFrame, dims, block_size, start: int = 1,
                  segment: int = 4096) -> DataFrame:
    """First id of every block = ``start`` + counts of all earlier blocks
    in (bz, by_, bx) order; output ``(bx, by_, bz, n, first)``.

    Two-level prefix sum: ``seg = lin div segment``; running sum inside each
    segment (window partitioned by ``seg``) plus the exclusive running sum of
    segment totals (one row per segment).
    """
    b = triple(block_size)
    d = triple(dims)
    nb = [-(-int(di) // int(bi)) for di, bi in zip(d, b)]
    lin = (F.col("bx") + F.lit(nb[0]) * (F.col("by_") + F.lit(nb[1]) * F.col("bz"))).cast("bigint")
    c = counts.withColumn("lin", lin).withColumn("seg", floor_div("lin", segment))
    w_in = Window.partitionBy("seg").orderBy("lin").rowsBetween(Window.unboundedPreceding, 0)
    c = c.withColumn("run", F.sum("n").over(w_in))
    seg_tot = c.groupBy("seg").agg(F.sum("n").alias("tot"))
    w_seg = Window.orderBy("seg").rowsBetween(Window.unboundedPreceding, -1)
    seg_off = seg_tot.select("seg", F.coalesce(F.sum("tot").over(w_seg), F.lit(0)).alias("segoff"))
    out = c.join(seg_off, "seg")
    first = (F.lit(int(start)) + F.col("segoff") + F.col("run") - F.col("n")).cast("bigint")
    return out.select(*BLK, "n", first.alias("first"))


def relabel_offset(labels: DataFrame, block_size, offsets: DataFrame) -> DataFrame:
    """Non-zero label + its block's offset (block-local ids become global)."""
    v = block_position(labels, block_size)
    j = v.join(offsets.select(*BLK, "first"), BLK, "left")
    lab = F.when(F.col("label") != 0, F.col("label") + F.col("first")).otherwise(F.lit(0))
    return j.select(*AXES, lab.cast("bigint").alias("label"))


def relabel_dense(labels: DataFrame, block_size, dims, start: int = 1,
                  segment: int = 4096) -> DataFrame:
    """Consecutive global ids; inside a block in label order, blocks in
    (bz, by_, bx) order, 0 stays 0.

    One window partitioned by block ranks the labels (voxels are shuffled
    once, by block); the per-block counts are an aggregate over the same
    partitioning, and the offsets join back on the block key, so only the
    small per-block table moves again.  Labels that carry their block columns
    (``sources.bucketed``) are taken as placed, so no voxel moves at all.  The
    join merges rows that the window has dealt and sorted by block; by the size of
    a stored volume's files Spark would broadcast its voxels.
    """
    if set(BLK) <= set(labels.columns):
        v = labels.select(*BLK, *AXES, "label")
    else:
        v = block_position(labels.select(*AXES, "label"), block_size)
    wb = Window.partitionBy(*BLK)
    rk = F.dense_rank().over(wb.orderBy("label"))
    has0 = F.max((F.col("label") == 0).cast("int")).over(wb)
    v = v.withColumn("rk", (rk - has0).cast("bigint"))
    counts = v.groupBy(*BLK).agg(F.max("rk").alias("n"))
    offs = block_offsets(counts, dims, block_size, start, segment)
    out = v.join(offs.select(*BLK, "first").hint("merge"), BLK)
    lab = F.when(F.col("label") != 0, F.col("first") + F.col("rk") - 1).otherwise(F.lit(0))
    return out.select(*AXES, lab.cast("bigint").alias("label"))


def max_label_id(labels: DataFrame) -> DataFrame:
    """Exact largest id after relabel/merge."""
    return labels.agg(F.coalesce(F.max("label"), F.lit(0).cast("bigint")).alias("max_id"))


# ---------------------------------------------------------------------------
# Fragment size filters
# ---------------------------------------------------------------------------

def size_filter(labels: DataFrame, block_size, min_size: int) -> DataFrame:
    """I10 (and I9 with ``min_size=2``): labels with fewer than ``min_size``
    voxels inside their block become 0; ``min_size <= 0`` is off."""
    if min_size is None or int(min_size) <= 0:
        return labels.select(*AXES, "label")
    v = block_position(labels, block_size)
    sizes = v.groupBy(*BLK, "label").agg(F.count(F.lit(1)).alias("_n"))
    j = v.join(sizes.hint("merge"), BLK + ["label"])    # by a stored volume's files Spark would broadcast its voxels
    lab = F.when(F.col("_n") < int(min_size), F.lit(0).cast("bigint")).otherwise(F.col("label"))
    return j.select(*AXES, lab.alias("label"))


def drop_singletons(labels: DataFrame, block_size) -> DataFrame:
    """Single-voxel fragments -> 0."""
    return size_filter(labels, block_size, 2)


# ---------------------------------------------------------------------------
# Face contacts and their scores
# ---------------------------------------------------------------------------

_UNIT = {0: (1, 0, 0), 1: (0, 1, 0), 2: (0, 0, 1)}


def face_contacts(labels: DataFrame, block_size, value: DataFrame | None = None,
                  value_col: str = "v", ignore=(0,)) -> DataFrame:
    """Voxel pairs across the max face of each block, per axis.

    For axis ``d`` a voxel ``p`` with ``p_d % B_d == B_d - 1`` touches
    ``q = p + e_d`` in the next block.  Output: ``bx, by_, bz, axis, l1, l2``
    (labels of p and q, ignored labels dropped on either side) and, with a
    ``value`` volume, ``v1, v2`` (its values at p and q).  A face at the
    volume's end has no ``q`` row and drops out of the equi-join.

    Plan: the (face) voxels are read once; each emits one row per axis on
    which it is a last-slice voxel (keyed by its neighbour ``p + e_d``) and
    one per axis on which it is a first-slice voxel (keyed by itself); a
    single equi-join on ``(x, y, z, axis)`` pairs them, and merges, since by the
    size of a stored volume's files Spark would broadcast one side.
    """
    b = triple(block_size)
    lab = labels.select(*AXES, "label")
    if ignore:
        lab = lab.filter(~F.col("label").isin(*[int(i) for i in ignore]))
    on_face = None
    for ax, bi in zip(AXES, b):
        r = F.pmod(F.col(ax), F.lit(int(bi)))
        t = (r == int(bi) - 1) | (r == 0)
        on_face = t if on_face is None else on_face | t
    lab = lab.filter(on_face)      # only face voxels (a 6/B fraction) go further
    if value is not None:
        lab = lab.join(value.select(*AXES, F.col(value_col).alias("_v")).hint("merge"), list(AXES), "left")
    else:
        lab = lab.withColumn("_v", F.lit(None).cast("double"))
    last, first = [], []
    for d, (ax, bi) in enumerate(zip(AXES, b)):
        e = _UNIT[d]
        r = F.pmod(F.col(ax), F.lit(int(bi)))
        last.append(F.when(r == int(bi) - 1, F.struct(
            *[(F.col(a) + e[i]).alias(a) for i, a in enumerate(AXES)], F.lit(d).alias("axis"))))
        first.append(F.when(r == 0, F.struct(*[F.col(a).alias(a) for a in AXES],
                                             F.lit(d).alias("axis"))))
    p = (lab.select(*[F.col(a).alias("p" + a) for a in AXES], F.col("label").alias("l1"),
                    F.col("_v").alias("v1"), F.explode(F.array(*last)).alias("k"))
            .filter(F.col("k").isNotNull()).select("k.*", "px", "py", "pz", "l1", "v1"))
    q = (lab.select(F.col("label").alias("l2"), F.col("_v").alias("v2"),
                    F.explode(F.array(*first)).alias("k"))
            .filter(F.col("k").isNotNull()).select("k.*", "l2", "v2"))
    j = p.join(q.hint("merge"), list(AXES) + ["axis"])
    return j.select(*[floor_div("p" + a, bi).alias(bc) for a, bc, bi in zip(AXES, BLOCK_COLS, b)],
                    "axis", "l1", "l2", *(["v1", "v2"] if value is not None else []))


def face_pairs(labels: DataFrame, block_size, ignore=(0,)) -> DataFrame:
    """Distinct (block, axis, l1, l2) across block faces."""
    return face_contacts(labels, block_size, ignore=ignore).distinct()


def same_label_violations(labels: DataFrame, block_size) -> DataFrame:
    """Number of face contacts with the same non-zero id on both sides
    (must be 0 for block-wise unique ids)."""
    c = face_contacts(labels, block_size)
    return c.filter(F.col("l1") == F.col("l2")).agg(F.count(F.lit(1)).alias("violations"))


def with_same_neighbours(labels: DataFrame, block_size) -> DataFrame:
    """J8 per voxel: ``labels`` and ``same``, the number of voxels before it across a block face (0 to 3)
    that carry its own non-zero id; the sum of ``same`` is ``same_label_violations``.

    Last-slice voxels (a ``3/B`` fraction) are sent to their neighbours; one hash aggregate by position
    meets them, so a write can sum ``same`` in its own pass.
    """
    b = triple(block_size)
    nothing = F.lit(None).cast("bigint")
    own = F.struct(*[F.col(a).alias(a) for a in AXES], F.col("label").alias("label"), *[nothing.alias(f"n{d}") for d in range(3)])
    sent = [own]
    for d, (ax, bi) in enumerate(zip(AXES, b)):
        last = (F.pmod(F.col(ax), F.lit(int(bi))) == int(bi) - 1) & (F.col("label") != 0)
        sent.append(F.when(last, F.struct(
            *[(F.col(a) + _UNIT[d][i]).alias(a) for i, a in enumerate(AXES)], nothing.alias("label"),
            *[(F.col("label") if i == d else nothing).alias(f"n{i}") for i in range(3)])))
    met = (labels.select(*AXES, F.col("label").cast("bigint").alias("label"))
                 .select(F.explode(F.array(*sent)).alias("v")).filter(F.col("v").isNotNull()).select("v.*")
                 .groupBy(*AXES).agg(F.max("label").alias("label"), *[F.max(f"n{d}").alias(f"n{d}") for d in range(3)])
                 .filter(F.col("label").isNotNull()))
    same = sum((F.coalesce(F.col(f"n{d}") == F.col("label"), F.lit(False)).cast("int") for d in range(3)), F.lit(0))
    return met.select(*AXES, "label", same.alias("same"))


def assert_unique_across_faces(labels: DataFrame, block_size) -> None:
    n = same_label_violations(labels, block_size).collect()[0][0]
    if n:
        raise ValueError(f"{n} face contacts carry the same id on both sides")


def upper_median(values_col: str = "vals") -> F.Column:
    """sorted[n div 2] of a bounded list (the reference's median rule)."""
    s = F.sort_array(F.col(values_col))
    return F.element_at(s, (F.floor(F.size(s) / 2) + 1).cast("int"))


def merge_edges_median(labels: DataFrame, relief: DataFrame, block_size, thr: float,
                       ignore=(0,)) -> DataFrame:
    """Per (block, axis, e1 < e2) the relief values on both sides of every
    contact (NaN dropped); the pair merges if their upper median > thr.

    Output ``(bx, by_, bz, axis, e1, e2, med)`` of accepted pairs.
    """
    c = face_contacts(labels, block_size, relief, "v", ignore)
    c = c.filter(F.col("l1") != F.col("l2"))
    c = c.select(*BLK, "axis", F.least("l1", "l2").alias("e1"), F.greatest("l1", "l2").alias("e2"),
                 F.explode(F.array("v1", "v2")).alias("a"))
    c = c.filter(F.col("a").isNotNull() & ~F.isnan("a"))
    g = c.groupBy(*BLK, "axis", "e1", "e2").agg(F.collect_list("a").alias("vals"))
    return (g.select(*BLK, "axis", "e1", "e2", upper_median("vals").alias("med"))
             .filter(F.col("med") > F.lit(float(thr))))


def merge_edges_mutual_argmax(labels: DataFrame, block_size, ignore=(0,)) -> DataFrame:
    """Across each face, l1 <-> l2 if each is the other's most frequent
    contact (ties: smaller label).  Output ``(bx, by_, bz, axis, e1, e2)``."""
    c = face_contacts(labels, block_size, ignore=ignore)
    cnt = c.groupBy(*BLK, "axis", "l1", "l2").agg(F.count(F.lit(1)).alias("n"))
    w1 = Window.partitionBy(*BLK, "axis", "l1").orderBy(F.col("n").desc(), F.col("l2").asc())
    w2 = Window.partitionBy(*BLK, "axis", "l2").orderBy(F.col("n").desc(), F.col("l1").asc())
    best = (cnt.withColumn("r1", F.row_number().over(w1))
               .withColumn("r2", F.row_number().over(w2))
               .filter((F.col("r1") == 1) & (F.col("r2") == 1)))
    return best.select(*BLK, "axis", F.col("l1").alias("e1"), F.col("l2").alias("e2"))


# ---------------------------------------------------------------------------
# Applying a mapping
# ---------------------------------------------------------------------------

def apply_mapping(labels: DataFrame, mapping: DataFrame, keep_unmapped: bool = True,
                  background: int | None = 0) -> DataFrame:
    """Replace labels by their root; unmapped labels are kept (mutex) or
    become 0 (watersheds).

    Background voxels (the hottest key: it can hold a large share of a
    volume) bypass the join, so no join partition receives them; the rest
    joins the mapping, which AQE broadcasts when it is small at run time.
    """
    lab = labels.select(*AXES, "label")
    m = mapping.select("label", "root")
    if background is None:
        rest, bg = lab, None
    else:
        rest = lab.filter(F.col("label") != int(background))
        bg = lab.filter(F.col("label") == int(background))
        m = m.filter(F.col("label") != int(background))
    j = rest.join(m, "label", "left")
    other = F.col("label") if keep_unmapped else F.lit(0).cast("bigint")
    out = j.select(*AXES, F.coalesce(F.col("root"), other).alias("label"))
    return out if bg is None else out.unionByName(bg)


# ---------------------------------------------------------------------------
# Fragment merge rules inside a block
# ---------------------------------------------------------------------------

def block_contacts(labels: DataFrame, relief: DataFrame, block_size, ignore=(0,)) -> DataFrame:
    """6-neighbour contacts between different labels inside one block:
    ``(bx, by_, bz, e1, e2, v1, v2)`` with values of both touching voxels.

    Each voxel is read once and sent to its three forward neighbours inside
    its block; one equi-join on the target voxel pairs them."""
    b = triple(block_size)
    lab = labels.select(*AXES, "label")
    if ignore:
        lab = lab.filter(~F.col("label").isin(*[int(i) for i in ignore]))
    # a stored volume's files are so much smaller than its rows that Spark would broadcast them
    lab = lab.join(relief.select(*AXES, "v").hint("merge"), list(AXES), "left")
    fwd = []
    for d, (ax, bi) in enumerate(zip(AXES, b)):
        e = _UNIT[d]
        same = F.pmod(F.col(ax), F.lit(int(bi))) != int(bi) - 1
        fwd.append(F.when(same, F.struct(*[(F.col(a) + e[i]).alias(a) for i, a in enumerate(AXES)])))
    p = (lab.select(F.col("label").alias("l1"), F.col("v").alias("v1"),
                    *[floor_div(a, bi).alias(bc) for a, bc, bi in zip(AXES, BLOCK_COLS, b)],
                    F.explode(F.array(*fwd)).alias("k"))
            .filter(F.col("k").isNotNull()).select("k.*", *BLK, "l1", "v1"))
    q = lab.select(*AXES, F.col("label").alias("l2"), F.col("v").alias("v2"))
    j = p.join(q, list(AXES)).filter(F.col("l1") != F.col("l2"))
    return j.select(*BLK, F.least("l1", "l2").alias("e1"), F.greatest("l1", "l2").alias("e2"),
                    "v1", "v2")


def merge_fragments_median(labels: DataFrame, relief: DataFrame, block_size, thr: float,
                           ignore=(0,)) -> DataFrame:
    """Per (block, e1 < e2) upper median of the values on both sides of
    every contact (NaN dropped); keep pairs with median > thr.

    Exact ranking by window (row number and count per pair) instead of one
    array per pair, so a long contact surface never forms a large row."""
    c = block_contacts(labels, relief, block_size, ignore)
    vals = c.select(*BLK, "e1", "e2", F.explode(F.array("v1", "v2")).alias("a"))
    vals = vals.filter(F.col("a").isNotNull() & ~F.isnan("a"))
    key = BLK + ["e1", "e2"]
    w = Window.partitionBy(*key).orderBy("a")
    ranked = (vals.withColumn("rn", F.row_number().over(w))
                  .withColumn("cnt", F.count(F.lit(1)).over(Window.partitionBy(*key))))
    med = ranked.filter(F.col("rn") == F.floor(F.col("cnt") / 2) + 1)
    return med.select(*key, F.col("a").alias("med")).filter(F.col("med") > F.lit(float(thr)))


def merge_fragments_min(labels: DataFrame, relief: DataFrame, block_size, thr: float,
                        ignore=(0,)) -> DataFrame:
    """Pairs with a contact whose two voxel values are both > thr."""
    c = block_contacts(labels, relief, block_size, ignore)
    return (c.filter(F.least("v1", "v2") > F.lit(float(thr)))
             .select(*BLK, "e1", "e2").distinct())


def merge_pairs_within_blocks(labels: DataFrame, pairs: DataFrame, block_size) -> DataFrame:
    """Apply block-local merges (I5/I6 output) to a block-wise segmentation.

    The block is the part of the graph that a pair lies in, so components never
    cross blocks; the root is the smallest label of the component.
    """
    from .graph import components_in_parts
    v = block_position(labels, triple(block_size))
    cc = components_in_parts(pairs.select(F.struct(*BLK).alias("blk"), "e1", "e2"), "blk")
    m = cc.select("blk.*", "label", F.col("root").alias("newlab"))
    out = v.join(m, BLK + ["label"], "left")
    return out.select(*AXES, F.coalesce("newlab", "label").alias("label"))
