"""Label -> block index.

The working form is long: one row ``(label, x0, y0, z0, x1, y1, z1)`` per block
that holds the label.  It needs no shuffle at all beyond the distinct that
produced the unique-label table.  The reference's per-label box list is an
export form; because a single label (background) can sit in every block of a
100 TB volume, the export splits each label's list into parts of at most
``max_boxes`` boxes instead of collecting one unbounded array per label.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grid import BLOCK_COLS, block_box, linear_index, triple

BOX_COLS = ("x0", "y0", "z0", "x1", "y1", "z1")


def label_to_blocks(u: DataFrame, dims, block_size) -> DataFrame:
    """F1 long form: every (label, clipped box) pair."""
    box = block_box(block_size, dims)
    return u.select("label", *[box[k].alias(k) for k in BOX_COLS])


def box_lists(index: DataFrame, dims, block_size, max_boxes: int = 65536,
              keys: tuple = ()) -> DataFrame:
    """F1 export: ``(label, part, boxes array<struct>)``, boxes sorted.

    ``part`` = linear block index div ``max_boxes`` bounds every array (a label
    present in every block would otherwise produce one array per volume).
    """
    b = triple(block_size)
    d = triple(dims)
    nb = [-(-int(di) // int(bi)) for di, bi in zip(d, b)]
    blk = linear_index(nb, F.col("x0") / b[0], F.col("y0") / b[1], F.col("z0") / b[2])
    box = F.struct(*[F.col(c) for c in BOX_COLS])
    return (index.withColumn("part", (blk / F.lit(int(max_boxes))).cast("bigint"))
                 .groupBy(*keys, "label", "part")
                 .agg(F.sort_array(F.collect_list(box)).alias("boxes")))


def boxes_binary(lists: DataFrame) -> DataFrame:
    """A15 sink form: boxes as big-endian int64 records of 48 bytes (min xyz, max xyz)."""
    enc = F.transform("boxes", lambda s: F.concat(*[
        F.unhex(F.lpad(F.hex(s[c]), 16, "0")) for c in BOX_COLS]))
    return lists.select("label", "part",
                        F.aggregate(enc, F.lit(b"").cast("binary"), lambda acc, v: F.concat(acc, v))
                        .alias("data"))


def boxes_from_binary(records: DataFrame) -> DataFrame:
    """The boxes of A15 records: ``(label, x0..z1)``, one row per box."""
    at = F.explode(F.sequence(F.lit(0), (F.length("data") / 48).cast("int") - 1)).alias("at")
    word = [F.conv(F.hex(F.substring("data", F.col("at") * 48 + 8 * i + 1, F.lit(8))), 16, -10).cast("bigint").alias(c)
            for i, c in enumerate(BOX_COLS)]
    return records.filter(F.length("data") > 0).select("label", "data", at).select("label", *word)


def bucket_of(label_col="label", step: int = 1):
    if int(step) < 1:
        raise ValueError("step must be >= 1")
    return F.expr(f"{label_col} div {int(step)}") if isinstance(label_col, str) else \
        F.call_function("div", label_col, F.lit(int(step)))


def label_to_blocks_bucketed(u: DataFrame, dims, block_size, step: int = 1) -> DataFrame:
    """F2 long form: the index plus ``bucket = label div step`` (lookup key)."""
    return label_to_blocks(u, dims, block_size).withColumn("bucket", bucket_of("label", step))


def bucket_maps(index_b: DataFrame, dims, block_size, max_boxes: int = 65536) -> DataFrame:
    """F2 export: ``(bucket, part, blocks map<label, boxes>)``.

    Lists are split by block part as in ``box_lists``, so a row holds at most
    ``step * max_boxes`` boxes however many blocks a label covers.
    """
    lists = box_lists(index_b, dims, block_size, max_boxes, keys=("bucket",))
    return lists.groupBy("bucket", "part").agg(
        F.map_from_entries(F.collect_list(F.struct("label", "boxes"))).alias("blocks"))


def label_to_blocks_multiscale(levels: list[DataFrame], dims_per_level, block_per_level,
                               step: int = 1) -> DataFrame:
    """one index over all levels, ``level`` in the key (one job, not one per scale)."""
    parts = [label_to_blocks_bucketed(u, d, b, step).withColumn("level", F.lit(i))
             for i, (u, d, b) in enumerate(zip(levels, dims_per_level, block_per_level))]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def blocks_of(index_b: DataFrame, label: int, step: int = 1, level: int | None = None) -> DataFrame:
    """boxes of one label; the bucket predicate prunes partitions when the
    index is stored partitioned/bucketed by ``bucket``."""
    cond = (F.col("bucket") == F.lit(int(label) // int(step) if label >= 0 else -((-int(label)) // int(step)))) \
        & (F.col("label") == F.lit(int(label)))
    if level is not None:
        cond = cond & (F.col("level") == F.lit(int(level)))
    return index_b.filter(cond)
