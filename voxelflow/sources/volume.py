"""Volume storage: voxel tables in Parquet plus a ``volumes_meta`` table.

A volume is a Parquet dataset of one row per (sparse) voxel; an absent voxel is
background.  Blocks are stored in bit-interleaved (Morton) order
(``functions.morton``): a level's rows are partitioned by ``cell``, a cube of
``2^cell_bits`` blocks per axis, and by ``bz`` inside it, and sorted by the
block's key.

* Writes are block-addressed (A3): the blocks of a write are replaced, other
  blocks of the partitions it meets are carried over in the same write, other
  partitions keep their files.
* Region reads (A2) turn the box into a few ranges of cells, which prune
  partitions on all three axes, and of block keys, which prune row groups; the exact
  ``x, y, z`` bounds reach the scan as well.

The durable metadata of a store is its ledger, see ``sources.ledger``.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import morton
from ..functions.grid import AXES, BLOCK_COLS, block_box, floor_div, triple

META_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType(), False),
    T.StructField("level", T.IntegerType(), False),
    T.StructField("dims", T.ArrayType(T.LongType()), True),
    T.StructField("block_size", T.ArrayType(T.IntegerType()), True),
    T.StructField("dtype", T.StringType(), True),
    T.StructField("resolution", T.ArrayType(T.DoubleType()), True),
    T.StructField("offset", T.ArrayType(T.DoubleType()), True),
    T.StructField("factors", T.ArrayType(T.DoubleType()), True),
    T.StructField("max_id", T.LongType(), True),
    T.StructField("status", T.StringType(), True),
    T.StructField("attrs", T.MapType(T.StringType(), T.StringType()), True),
])

STRUCTURAL_ATTRS = ("dimensions", "blockSize", "dataType", "compression")


# ---------------------------------------------------------------------------
# Extents and grids derived from data
# ---------------------------------------------------------------------------

def extent(vol: DataFrame) -> DataFrame:
    """One row ``(nx, ny, nz)`` = max coordinate + 1 (a global partial/final max)."""
    return vol.agg(*[(F.max(a) + 1).cast("bigint").alias("n" + a) for a in AXES])


def block_grid_of(ext: DataFrame, block_size) -> DataFrame:
    """B1 over an extent row: every block with its clipped box.

    The block lists are generated by ``sequence``/``explode`` on executors; no
    count is brought to the driver.
    """
    b = triple(block_size)
    g = ext
    for a, bc, bi in zip(AXES, BLOCK_COLS, b):
        nblk = F.ceil(F.col("n" + a) / F.lit(int(bi))).cast("bigint")
        g = g.withColumn(bc, F.explode(F.sequence(F.lit(0).cast("bigint"), nblk - 1)))
    out = {}
    for a, bc, bi in zip(AXES, BLOCK_COLS, b):
        lo = F.col(bc) * F.lit(int(bi))
        out[a + "0"] = lo.cast("bigint")
        out[a + "1"] = F.least(lo + F.lit(int(bi) - 1), F.col("n" + a) - 1).cast("bigint")
    return g.select(*BLOCK_COLS, *[v.alias(k) for k, v in out.items()])


def read_region(vol: DataFrame, lo, hi) -> DataFrame:
    """A2: voxels inside the inclusive box [lo, hi]; pushed to the Parquet scan."""
    cond = None
    for a, l, h in zip(AXES, triple(lo), triple(hi)):
        c = F.col(a).between(int(l), int(h))
        cond = c if cond is None else cond & c
    return vol.filter(cond)


def extend(vol: DataFrame, coords: DataFrame, value_col: str, constant=0.0,
           shift=(0, 0, 0)) -> DataFrame:
    """A5: read ``vol`` at requested coordinates, shifted by ``shift`` voxels,
    with ``constant`` (0, NaN, ...) outside the stored voxels.

    ``coords`` holds the wanted ``x, y, z``; a left join keeps every request.
    """
    s = triple(shift)
    src = vol.select(*[(F.col(a) - int(si)).alias(a) for a, si in zip(AXES, s)],
                     F.col(value_col).alias("_v"))
    out = coords.join(src, list(AXES), "left")
    return out.withColumn(value_col, F.coalesce(F.col("_v"), F.lit(constant))).drop("_v")


def align(vol: DataFrame, coords: DataFrame, value_col: str, constant=0.0, from_res=(1, 1, 1), from_off=(0, 0, 0),
          to_res=(1, 1, 1), to_off=(0, 0, 0)) -> DataFrame:
    """``vol`` of one resolution and offset on the voxels ``coords`` of another, ``constant`` outside.

    A voxel takes the value of the source voxel that holds its world position (resolution times index plus offset).
    One equi-join on the source index; a source voxel serves the voxels of its own extent only.  The join merges:
    a stored volume's files are so much smaller than its rows that Spark would broadcast them.
    """
    at = [F.floor((F.col(a) * float(r) + float(o) - float(p)) / float(q)).cast("bigint").alias("_" + a)
          for a, r, o, q, p in zip(AXES, triple(to_res), triple(to_off), triple(from_res), triple(from_off))]
    src = vol.select(*[F.col(a).alias("_" + a) for a in AXES], F.col(value_col).alias("_v"))
    out = coords.select(*AXES, *at).join(src.hint("merge"), ["_" + a for a in AXES], "left")
    return out.select(*AXES, F.coalesce("_v", F.lit(constant).cast(vol.schema[value_col].dataType)).alias(value_col))


def world_shift(offset, resolution) -> tuple:
    """Integer voxel shift = world offset / resolution."""
    return tuple(int(round(float(o) / float(r))) for o, r in zip(triple(offset), triple(resolution)))


# ---------------------------------------------------------------------------
# Parquet I/O (A1, A3)
# ---------------------------------------------------------------------------

#: A cell is a cube of 2^CELL_BITS blocks per axis.
CELL_BITS = 3
PLACE = ("cell", "bz")


def level_path(path: str, dataset: str, level: int) -> str:
    return f"{path}/dataset={dataset.replace('/', '%2F')}/level={int(level)}"


def _placed(vol: DataFrame, block_size, cell_bits: int) -> DataFrame:
    """``vol`` with its block, the block's key, and its cell."""
    out = vol.withColumns({bc: floor_div(a, bi) for a, bc, bi in zip(AXES, BLOCK_COLS, triple(block_size))})
    out = out.withColumn("key", morton.key())
    return out.withColumn("cell", morton.cell(F.col("key"), cell_bits))


def write_volume(vol: DataFrame, path: str, dataset: str, level: int, block_size, mode: str = "overwrite", whole: bool = False,
                 blocks: DataFrame | None = None, cell_bits: int = CELL_BITS, measures: dict | None = None, drop: tuple = ()) -> dict:
    """A3: block-addressed write of one dataset level; returns metrics of the rows written.

    The blocks of ``blocks(bx, by_, bz)`` (default: those that ``vol`` has rows in) are
    replaced; a block without rows any more disappears.  Their partitions
    are rewritten with the other blocks carried over, in one job; all others are left alone.
    With ``whole`` the rows are the whole level: partitions of an earlier run that get no
    rows any more are deleted after the write.

    Metrics (``DataFrame.observe``, so no second scan): ``rows``, the extent ``nx, ny, nz``,
    and ``max_label`` where the volume has labels; ``measures`` are further aggregates over the rows
    of a whole write, ``drop`` the columns that only they need.
    """
    if (measures or drop) and not whole:
        raise ValueError("measures need a whole write")
    spark = vol.sparkSession
    out = _placed(vol, block_size, cell_bits)
    stored = _partitions(spark, path, dataset, level)
    met = stored
    if stored and not whole:
        own = _placed_blocks(blocks, cell_bits) if blocks is not None else out.select(*BLOCK_COLS, "cell").distinct()
        # one row per partition that the write meets, of those that exist
        hit = {(r[0], r[1]) for r in own.select("cell", "bz").distinct().collect()}
        met = {k: v for k, v in stored.items() if k in hit}
        if met:
            old = _open(spark, path, dataset, level).filter(F.col("cell").isin(sorted({c for c, _ in met})))
            old = old.withColumns({bc: floor_div(a, bi) for a, bc, bi in zip(AXES, BLOCK_COLS, triple(block_size))})
            kept = (old.join(F.broadcast(own.select("cell", "bz").distinct()), ["cell", "bz"], "left_semi")
                       .join(own.select(*BLOCK_COLS), list(BLOCK_COLS), "left_anti"))
            out = out.unionByName(kept.select(out.columns))
    seen = Observation()
    found = [F.count(F.lit(1)).alias("rows"), *[(F.max(a) + 1).cast("bigint").alias("n" + a) for a in AXES]]
    if "label" in vol.columns:
        found.append(F.max("label").alias("max_label"))
    found += [c.alias(k) for k, c in (measures or {}).items()]
    out = (out.drop("bx", "by_").withColumn("dataset", F.lit(dataset)).withColumn("level", F.lit(int(level)))
              .hint("rebalance", "cell", "bz").observe(seen, *found).drop(*drop).sortWithinPartitions("cell", "bz", "key", "z", "y", "x"))
    (out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .partitionBy("dataset", "level", *PLACE).parquet(path))
    for fs, folder, names in met.values():
        # a partition that was written anew has other files than those listed before
        if fs.exists(folder) and _names(fs, folder) == names:
            fs.delete(folder, True)
    return seen.get


def _placed_blocks(blocks: DataFrame, cell_bits: int) -> DataFrame:
    return blocks.select(*BLOCK_COLS, morton.cell(morton.key(), cell_bits).alias("cell")).distinct()


def _names(fs, folder) -> tuple:
    return tuple(sorted(f.getPath().getName() for f in fs.listStatus(folder)))


def _partitions(spark: SparkSession, path: str, dataset: str, level: int) -> dict:
    """``{(cell, bz): (file system, folder, file names)}`` of every stored partition of a dataset level."""
    p = spark._jvm.org.apache.hadoop.fs.Path(level_path(path, dataset, level))
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return {}
    out = {}
    for s in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(p, "cell=*/bz=*")):
        f = s.getPath()
        at = tuple(int(n.split("=")[1]) for n in (f.getParent().getName(), f.getName()))
        out[at] = (fs, f, _names(fs, f))
    return out


def _open(spark: SparkSession, path: str, dataset: str, level: int) -> DataFrame:
    """The stored rows of one dataset level; only its folder is listed, and its files give the schema."""
    df = spark.read.option("basePath", path).parquet(level_path(path, dataset, level))
    return df.filter((F.col("dataset") == dataset) & (F.col("level") == int(level)))


def read_volume(spark: SparkSession, path: str, dataset: str, level: int = 0,
                lo=None, hi=None, block_size=None, cell_bits: int = CELL_BITS) -> DataFrame:
    """A1 (+ A2): open one dataset level; partition filters prune the other datasets.

    With a region ``[lo, hi]`` and the stored block size, ``bz`` and the ranges of
    cells that the box meets prune partitions (``PartitionFilters``), ranges of
    block keys and the x/y/z bounds are pushed into the Parquet scan.
    ``sources.ledger.open_volume`` takes block size and cell size from the store.
    """
    df = _open(spark, path, dataset, level)
    if lo is not None and hi is not None:
        if block_size is not None:
            b = triple(block_size)
            first = [int(l) // int(bi) for l, bi in zip(triple(lo), b)]
            last = [int(h) // int(bi) for h, bi in zip(triple(hi), b)]
            df = df.filter(F.col("bz").between(first[2], last[2]))
            df = df.filter(morton.in_ranges("cell", morton.ranges(first, last, cell_bits)))
            df = df.filter(morton.in_ranges("key", morton.ranges(first, last)))
        df = read_region(df, lo, hi)
    return df.drop("dataset", "level", "key", *PLACE)


# ---------------------------------------------------------------------------
# Metadata (A9-A14)
# ---------------------------------------------------------------------------

def meta_row(spark: SparkSession, dataset: str, level: int, dims, block_size, dtype: str,
             resolution=(1.0, 1.0, 1.0), offset=(0.0, 0.0, 0.0), factors=None,
             max_id=None, status: str | None = None, attrs: dict | None = None) -> DataFrame:
    return spark.createDataFrame([(
        dataset, int(level), [int(v) for v in triple(dims)], [int(v) for v in triple(block_size)],
        dtype, [float(v) for v in triple(resolution)], [float(v) for v in triple(offset)],
        None if factors is None else [float(v) for v in triple(factors)],
        None if max_id is None else int(max_id), status, dict(attrs or {}))], META_SCHEMA)


def check_preconditions(in_name: str | None, out_name: str | None, df: DataFrame | None = None,
                        label_col: str = "label") -> None:
    """Null names, input == output, float labels."""
    if not in_name or not out_name:
        raise ValueError("input and output dataset names are required")
    if in_name == out_name:
        raise ValueError(f"input and output are the same dataset: {in_name}")
    if df is not None:
        t = df.schema[label_col].dataType
        if isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType)):
            raise TypeError(f"label column must be integral, got {t.simpleString()}")


def check_block_size(existing: DataFrame | None, block_size, dataset: str | None = None,
                     level: int | None = None) -> None:
    """Refuse to overwrite a dataset level with another block size."""
    if existing is None:
        return
    if dataset is not None:
        existing = existing.filter(F.col("dataset") == dataset)
    if level is not None:
        existing = existing.filter(F.col("level") == int(level))
    rows = existing.select("block_size").limit(1).collect()
    if rows and rows[0][0] is not None and list(rows[0][0]) != [int(v) for v in triple(block_size)]:
        raise ValueError(f"block size {triple(block_size)} differs from stored {rows[0][0]}")


def copy_attributes(meta: DataFrame, source_attrs_col: str = "src_attrs") -> DataFrame:
    """A10: add the source's non-structural attributes to ``attrs``; attributes that are there already stay."""
    own = F.coalesce(F.col("attrs"), F.create_map().cast("map<string,string>"))
    keep = F.map_filter(F.col(source_attrs_col), lambda k, v: ~k.isin(*STRUCTURAL_ATTRS) & ~F.map_contains_key(own, k))
    return meta.withColumn("attrs", F.map_concat(own, keep))


def should_run(meta: DataFrame, dataset: str, overwrite: bool = False) -> bool:
    """Skip a job whose output is already complete, unless overwriting."""
    if overwrite:
        return True
    done = (meta.filter((F.col("dataset") == dataset) & (F.col("status") == "complete"))
                .limit(1).count())
    return done == 0


def require_complete(meta: DataFrame, dataset: str) -> None:
    """Refuse to read an upstream dataset whose job did not finish."""
    bad = (meta.filter((F.col("dataset") == dataset) &
                       (F.coalesce(F.col("status"), F.lit("")) != "complete")).limit(1).count())
    if bad:
        raise RuntimeError(f"upstream dataset {dataset} is not marked complete")


def set_status(meta: DataFrame, dataset: str, status: str) -> DataFrame:
    """Mark a dataset 'running' before and 'complete' after a job."""
    return meta.withColumn("status", F.when(F.col("dataset") == dataset, F.lit(status))
                           .otherwise(F.col("status")))


def with_provenance(meta: DataFrame, args: dict) -> DataFrame:
    """Arguments recorded in ``attrs``; resolution/offset default 1/0."""
    kv = F.create_map(*[x for k, v in sorted(args.items()) for x in (F.lit(str(k)), F.lit(str(v)))])
    old = F.map_filter(F.coalesce(F.col("attrs"), F.create_map().cast("map<string,string>")), lambda k, v: ~k.isin(*[str(k) for k in args]))
    return (meta.withColumn("attrs", F.map_concat(old, kv) if args else old)
                .withColumn("resolution", F.coalesce(F.col("resolution"), F.array(*[F.lit(1.0)] * 3)))
                .withColumn("offset", F.coalesce(F.col("offset"), F.array(*[F.lit(0.0)] * 3))))


def tag_multiscale(meta: DataFrame, group: str) -> DataFrame:
    """Mark a group of scale levels as a multiscale pyramid."""
    return meta.withColumn("attrs", F.when(
        (F.col("dataset") == group) | F.col("dataset").startswith(group.rstrip("/") + "/")
        | F.regexp_like(F.regexp_replace("dataset", F.lit("[0-9]+$"), F.lit("#")), F.lit("^" + re.escape(group) + "#$")),
        F.map_concat(F.coalesce(F.col("attrs"), F.create_map()),
                     F.create_map(F.lit("multiScale"), F.lit("true")))).otherwise(F.col("attrs")))
