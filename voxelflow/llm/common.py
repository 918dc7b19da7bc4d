"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ..session import ensure_checkpoint_dir

#: Bytes of text that a task's Python code handles at once.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, kind: str) -> str:
    """A new folder below the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that nothing reads any more."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def slices(batch: pa.RecordBatch, col: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in row slices of about ``limit`` bytes of ``col`` (one row at least)."""
    n = batch.num_rows
    if n == 0:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_pylist()
    start, total = 0, 0
    for i, s in enumerate(sizes):
        if total and total + s > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += s
    yield batch.slice(start)


def arrow_schema(ddl: str) -> pa.Schema:
    """Arrow schema of a DDL string; needs the driver's session."""
    return to_arrow_schema(StructType.fromDDL(ddl))


def map_rows(df: DataFrame, schema: str, fn: Callable[[pa.RecordBatch], dict[str, list]],
             col: str = "text", keeps: str = "", clear: Callable[[], None] | None = None) -> DataFrame:
    """``fn`` over row slices of ``df``; it returns the columns of ``schema`` by name.

    Workers live on: what ``fn`` keeps under the name ``keeps`` serves its next
    partitions, and is freed by ``clear`` before another operator's first one.
    """
    arrow = arrow_schema(schema)

    def run(batches):
        _enter(keeps, clear)
        for b in batches:
            for s in slices(b, col):
                out = fn(s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[f.name], f.type) for f in arrow], schema=arrow)
        pa.default_memory_pool().release_unused()
    return df.mapInArrow(run, schema)


def doc_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, text)``: the two columns an operator needs, whatever else the table holds."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))


def row_key(cols: list[str]) -> list[Column]:
    """Two 64-bit hashes of a row's ``cols``, named ``a`` and ``b``; which columns are null is part of both."""
    nulls = F.concat(*[F.isnull(c).cast("int").cast("string") for c in cols])
    return [F.xxhash64(nulls, *cols).alias("a"), F.xxhash64(F.lit(1), nulls, *cols).alias("b")]


def keyed_rows(df: DataFrame, *cols: str) -> DataFrame:
    """``(row, a, b, *cols)``: the whole row as a struct, its key, and the columns an operator reads.

    The row's own columns are fields of ``row``, so no name of theirs can clash.
    """
    hashed = [f.name for f in df.schema if "map<" not in f.dataType.simpleString()]
    return df.select(F.struct(*df.columns).alias("row"), *row_key(hashed), *cols)


#: What this worker process keeps, by name.
_kept: dict[str, Callable[[], None]] = {}


def _enter(name: str, clear: Callable[[], None] | None) -> None:
    """A task of operator ``name`` starts: what others have kept goes."""
    for other in [k for k in _kept if k != name]:
        _kept.pop(other)()
    if clear is not None:
        _kept[name] = clear


class Kept:
    """A bounded table of results by key, in two generations.

    Once the young generation holds ``limit`` estimated bytes it becomes the
    old one and the previous old one goes, so keys that keep coming stay.
    """

    def __init__(self, limit: int):
        self.limit, self.size = limit, 0
        self.young: dict = {}
        self.old: dict = {}

    def look(self, keys, make, longest: int) -> list:
        """The value of every key; ``make`` gives those not kept.  Keys of over ``longest`` aren't kept."""
        young, old = self.young, self.old
        found = list(map(young.get, keys))
        if None in found:
            size = 0
            for i, f in enumerate(found):
                if f is None:
                    k = keys[i]
                    f = young.get(k)
                    if f is None:
                        f = old.get(k)
                        if f is None:
                            f = make(k)
                        if len(k) <= longest:
                            young[k] = f
                            # dictionary slot and the headers of both objects
                            size += 180 + len(k) + len(f)
                            if size > 1 << 18:
                                self.grown(size)
                                young, old, size = self.young, self.old, 0
                    found[i] = f
            self.grown(size)
        return found

    def grown(self, size: int) -> None:
        self.size += size
        if self.size > self.limit:
            self.old, self.young, self.size = self.young, {}, 0

    def clear(self) -> None:
        self.young, self.old, self.size = {}, {}, 0
