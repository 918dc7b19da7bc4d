"""Durable metadata of a store of volumes.

The ledger is an append-only Parquet table beside the volumes, one row per
event: *running* when a write is claimed, *complete* once it has succeeded,
and rows that add attributes.  The state of a dataset level is its latest row
(``max_by`` over version and step).  So a job that dies leaves *running*
behind, readers refuse it, and a rerun claims the next version.

Rows are one per dataset, level and event: what comes to the driver is the row of
one dataset level.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.grid import triple
from ..operators.stitch import with_same_neighbours
from . import volume

SCHEMA = T.StructType([*volume.META_SCHEMA.fields,
                       T.StructField("version", T.LongType(), False),
                       T.StructField("step", T.IntegerType(), False),
                       T.StructField("run", T.StringType(), False),
                       T.StructField("cell_bits", T.IntegerType(), True),
                       T.StructField("rows", T.LongType(), True)])
KEY = ("dataset", "level")
#: Attributes that say how a dataset is stored; they are not copied to another.
OWN = ("kind", "schema", "args", "step", "shards", "multiScale", "buckets", "violations")


class Ledger:
    """The ledger of the store at ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.run = spark, f"{path}-ledger", uuid.uuid4().hex

    # -- reading

    def history(self) -> DataFrame:
        """Every event."""
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        if not p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).parquet(self.path)

    def latest(self) -> DataFrame:
        """The latest row of every dataset level."""
        rest = [f.name for f in SCHEMA.fields if f.name not in KEY]
        return (self.history().groupBy(*KEY)
                    .agg(F.max_by(F.struct(*rest), F.struct("version", "step", "run")).alias("row"))
                    .select(*KEY, "row.*"))

    def row(self, dataset: str, level: int = 0) -> Row | None:
        """The latest row of one dataset level."""
        return self.history().filter((F.col("dataset") == dataset) & (F.col("level") == int(level))).orderBy(
            F.desc("version"), F.desc("step"), F.desc("run")).first()

    def is_complete(self, dataset: str, level: int = 0) -> bool:
        r = self.row(dataset, level)
        return r is not None and r["status"] == "complete"

    def should_run(self, dataset: str, level: int = 0, overwrite: bool = False) -> bool:
        """A complete output is skipped unless it is to be overwritten."""
        return overwrite or not self.is_complete(dataset, level)

    def require_complete(self, dataset: str, level: int = 0) -> Row:
        """The row of an upstream dataset level; refused where its job did not finish."""
        r = self.row(dataset, level)
        if r is None:
            raise RuntimeError(f"dataset {dataset}, level {level} is not in the store")
        if r["status"] != "complete":
            raise RuntimeError(f"upstream dataset {dataset} is not marked complete")
        return r

    # -- writing

    def _append(self, rows) -> None:
        if not isinstance(rows, DataFrame):
            rows = self.spark.createDataFrame([[r[f.name] for f in SCHEMA.fields] for r in rows], SCHEMA)
        rows.select(*[F.col(f.name).cast(f.dataType) for f in SCHEMA.fields]).coalesce(1).write.mode("append").parquet(self.path)

    def claim(self, dataset: str, level: int, block_size, dtype: str, dims=None, resolution=None, offset=None, factors=None,
              args: dict | None = None, attrs: dict | None = None, copy_from: tuple | None = None,
              cell_bits: int = volume.CELL_BITS, part: bool = False, known: Row | str | None = "?") -> Row:
        """Store *running* under the next version, before the write.

        ``known``: the latest row, where the caller has just read it (None: there is none).

        Another block size than the stored one is refused for a write of parts (``part``) and while the
        stored version is complete.  ``copy_from``: dataset and level whose
        attributes are copied (A10).  Resolution and offset default to 1 and 0.
        """
        old = self.row(dataset, level) if known == "?" else known
        b = [int(v) for v in triple(block_size)]
        if old is not None and old["block_size"] is not None and list(old["block_size"]) != b and (part or old["status"] == "complete"):
            raise ValueError(f"block size {tuple(b)} differs from stored {old['block_size']}")
        meta = volume.meta_row(self.spark, dataset, level, dims or (0, 0, 0), b, dtype, resolution or (1.0,) * 3,
                               offset or (0.0,) * 3, factors, attrs=attrs)
        if copy_from is not None:
            src = self.row(*copy_from)
            told = {} if src is None else {k: v for k, v in (src["attrs"] or {}).items() if k not in OWN and not k.startswith("from:")}
            pairs = [F.lit(v) for kv in told.items() for v in kv]
            given = F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")
            meta = volume.copy_attributes(meta.withColumn("src_attrs", given)).drop("src_attrs")
        meta = volume.with_provenance(volume.set_status(meta, dataset, "running"), args or {})
        claimed = meta.withColumns({"version": F.lit(old["version"] + 1 if old is not None else 1).cast("bigint"), "step": F.lit(0),
                                    "run": F.lit(self.run), "cell_bits": F.lit(cell_bits),
                                    "rows": F.lit(None).cast("bigint")}).first()
        self._append([claimed])
        return claimed

    def complete(self, claimed: Row, dims=None, max_id: int | None = None, rows: int | None = None,
                 attrs: dict | None = None) -> Row:
        """Store *complete* for a claim, with what the write measured; refused where another run has claimed since."""
        now = self.row(claimed["dataset"], claimed["level"])
        if (now["version"], now["run"]) != (claimed["version"], claimed["run"]):
            raise RuntimeError(f"{claimed['dataset']} was claimed by another run")
        new = claimed.asDict() | {"status": "complete", "step": 1, "max_id": max_id, "rows": rows,
                                  "attrs": {**(claimed["attrs"] or {}), **{k: str(v) for k, v in (attrs or {}).items()}}}
        if dims is not None:
            new["dims"] = [int(v or 0) for v in dims]
        done = Row(*new)(*new.values())
        self._append([done])
        return done

    def tag_multiscale(self, group: str) -> None:
        """Mark the levels of a pyramid as one multiscale group."""
        now = self.latest()
        tagged = volume.tag_multiscale(now, group)
        changed = tagged.filter(F.coalesce(F.element_at("attrs", "multiScale"), F.lit("")) == "true")
        self._append(changed.withColumns({"step": F.col("step") + 1, "run": F.lit(self.run)}))


def no_rows(spark: SparkSession, row: Row) -> DataFrame:
    """A volume that was written without a voxel: no file holds its schema, its row does."""
    return spark.createDataFrame([], T._parse_datatype_string(row["attrs"]["schema"]))


def open_volume(spark: SparkSession, path: str, dataset: str, level: int = 0, lo=None, hi=None) -> DataFrame:
    """A1 (+ A2): a complete dataset level, with block size, cells and extent taken from the ledger.

    A region is clipped to the stored extent, so a box outside reads nothing.
    """
    r = Ledger(spark, path).require_complete(dataset, level)
    if r["rows"] == 0:
        return no_rows(spark, r)
    if lo is not None and hi is not None:
        lo = [max(0, int(v)) for v in triple(lo)]
        hi = [min(int(n) - 1, int(v)) for n, v in zip(r["dims"], triple(hi))]
    return volume.read_volume(spark, path, dataset, level, lo, hi, list(r["block_size"]), r["cell_bits"])


def open_aligned(spark: SparkSession, path: str, dataset: str, coords: DataFrame, like: Row, value_col: str, constant=0,
                 level: int = 0) -> DataFrame:
    """A5: a stored volume on the voxels ``coords`` of the dataset whose ledger row is ``like``; resolutions and offsets
    come from the ledger."""
    r = Ledger(spark, path).require_complete(dataset, level)
    return volume.align(open_volume(spark, path, dataset, level), coords, value_col, constant, r["resolution"], r["offset"],
                        like["resolution"], like["offset"])


def write_volume(ledger: Ledger, vol: DataFrame, path: str, dataset: str, level: int, block_size, dims=None, whole: bool = True,
                 blocks: DataFrame | None = None, cell_bits: int = volume.CELL_BITS, attrs: dict | None = None, unique_ids: bool = False,
                 **claim) -> Row:
    """A write of one dataset level under a claim: *running* before, *complete* with the write's own metrics after.

    ``unique_ids`` (whole writes): labels that touch themselves across a block face are counted in the
    write's own pass (J8), stored as ``violations``, and refused, so that the level stays *running*;
    with ``"count"`` they are only counted.
    """
    value = [c for c in vol.columns if c not in ("x", "y", "z")]
    kind = vol.schema[value[0]].dataType.simpleString() if value else "boolean"
    old = None if whole else ledger.row(dataset, level)
    claimed = ledger.claim(dataset, level, block_size, kind, dims, cell_bits=cell_bits, part=not whole, **claim)
    counted = with_same_neighbours(vol, block_size) if unique_ids else vol
    measures = {"violations": F.coalesce(F.sum("same"), F.lit(0))} if unique_ids else {}
    got = volume.write_volume(counted, path, dataset, level, block_size, whole=whole, blocks=blocks, cell_bits=cell_bits,
                              measures=measures, drop=("same",) if unique_ids else ())
    if unique_ids and unique_ids != "count" and got["violations"]:
        raise ValueError(f"{got['violations']} face contacts of {dataset} carry the same id on both sides")
    top, own = got.get("max_label"), dims or [got["n" + a] or 0 for a in "xyz"]
    if old is not None:
        # a write of parts measures the partitions it met
        own = [max(int(a), int(b)) for a, b in zip(own, old["dims"])]
        top = max((v for v in (top, old["max_id"]) if v is not None), default=None)
    told = (attrs or {}) | {"schema": ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vol.schema)}
    told |= {k: got[k] for k in measures}
    return ledger.complete(claimed, own, top, None if old is not None else got["rows"], told)
