"""Connected components of a label graph.

The reference collects all edges to the driver and runs union-find there.  Here
the edges stay distributed and are *contracted*: in every round each vertex
points at its neighbour of lowest priority, a fixed hash of the id (or stays, as
a local minimum), the pointers are doubled once, and the edges are rewritten to the
pointed-at vertices.  Edges inside one target vanish.  The per-round maps are
composed at the end.

No vertex is a hot task: the minimum over neighbours is a hash aggregate with
map-side combine, and the joins that rewrite edge ends go through
``skew.join_unique``, which deals the edges of high-degree vertices over salts.
The edge table shrinks every round; superseded checkpoints are deleted.  Once it
holds at most ``LOCAL_EDGES`` edges (a fixed bound, a few MB), one task finishes by
union-find: the last rounds would cost more in scheduling than in work.  Edges that
stay inside blocks are a graph per block: once no block holds more than
``LOCAL_EDGES``, all blocks are finished at once, each in a group of its own.

Root of a component = its smallest label.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from ..session import cut_lineage, drop_checkpoint
from .skew import join_unique

#: Edges that one task may finish by itself.
LOCAL_EDGES = 1 << 15


def _orient(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Undirected edges as ``(u, v)`` with ``u > v``; self loops and duplicates dropped."""
    return (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                 .filter(F.col("u") != F.col("v")).distinct())


def _pointers(e: DataFrame) -> DataFrame:
    """``(k, p, n)``: each vertex, the vertex it points at, its degree."""
    def prio(c):
        return F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("id"))
    d = e.select(F.col("u").alias("k"), F.col("v").alias("nb")).unionByName(
        e.select(F.col("v").alias("k"), F.col("u").alias("nb")))
    return (d.groupBy("k").agg(F.min(prio("nb")).alias("m"), F.count(F.lit(1)).alias("n"))
             .select("k", F.least(F.col("m"), prio("k"))["id"].alias("p"), "n"))


def _jump(ptr: DataFrame) -> DataFrame:
    """One pointer doubling: ``(k, p(p(k)), n)``."""
    nxt = ptr.select(F.col("k").alias("p"), F.col("p").alias("pp"))
    return join_unique(ptr, nxt, "p", n="c").select("k", F.coalesce("pp", "p").alias("p"), "n")


class Forest:
    """Union-find over hashable keys."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, k):
        p = self.parent
        p.setdefault(k, k)
        while p[k] != k:
            p[k] = p[p[k]]
            k = p[k]
        return k


def finish_here(e: DataFrame, schema: str, rows) -> DataFrame:
    """``rows(list of dicts)`` over all of ``e`` in one task; for tables within ``LOCAL_EDGES`` only."""
    out = e.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(out)

    def run(batches):
        found = rows([r for b in batches for r in b.to_pylist()])
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)
    return e.coalesce(1).mapInArrow(run, out)


def most_in_a_part(e: DataFrame, part: str = "part") -> int:
    """The rows of the largest part."""
    return e.groupBy(part).count().agg(F.max("count")).first()[0] or 0


def finish_parts(e: DataFrame, schema: str, rows, part: str = "part") -> DataFrame:
    """``rows(list of dicts)`` over the rows of every part; for parts within ``LOCAL_EDGES`` only."""
    out = e.sparkSession.createDataFrame([], schema).schema
    arrow = to_arrow_schema(out)

    def run(t):
        found = rows(t.drop_columns([part]).to_pylist())
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)] if found else
                                    [pa.array([], f.type) for f in arrow], schema=arrow)
    return e.groupBy(part).applyInArrow(run, out)


def _union(rows: list[dict]) -> list[tuple]:
    """``(k, p)`` of the components of edges ``(u, v)``; keys may be structs."""
    names = list(rows[0]["u"]) if rows and isinstance(rows[0]["u"], dict) else None
    f = Forest()
    for r in rows:
        u, v = (tuple(r[c].values()) if names else r[c] for c in "uv")
        u, v = f.find(u), f.find(v)
        f.parent[max(u, v)] = min(u, v)
    out = [(k, f.find(k)) for k in f.parent]
    return [tuple(dict(zip(names, x)) for x in kp) for kp in out] if names else out


def components_in_parts(edges: DataFrame, part: str, a: str = "e1", b: str = "e2", local_edges: int = LOCAL_EDGES) -> DataFrame:
    """``connected_components`` of edges between numbers that never leave their ``part``: ``(part, label, root)``."""
    e = cut_lineage(edges.select(part, F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    kind = e.schema[part].dataType.simpleString()
    if most_in_a_part(e, part) <= local_edges:
        # the part's column is the key of the group, so its value stands beside the rows found
        named = e.withColumn("_part", F.col(part)).withColumnRenamed("u", "_u").withColumnRenamed("v", "_v")
        out = finish_parts(named, f"`{part}` {kind}, label bigint, root bigint", _union_of_part, part)
    else:
        node = lambda c: F.struct(F.col(part).alias("p"), F.col(c).alias("l"))
        cc = connected_components(e.select(node("u").alias("e1"), node("v").alias("e2")), local_edges=local_edges)
        out = cc.select(F.col("label.p").alias(part), F.col("label.l").alias("label"), F.col("root.l").alias("root"))
    out = cut_lineage(out)
    drop_checkpoint(e)
    return out


def _union_of_part(rows: list[dict]) -> list[tuple]:
    """``_union`` of one part."""
    at = rows[0]["_part"]
    return [(at, k, p) for k, p in _union([{"u": r["_u"], "v": r["_v"]} for r in rows])]


def connected_components(edges: DataFrame, a: str = "e1", b: str = "e2", local_edges: int = LOCAL_EDGES) -> DataFrame:
    """``(label, root)`` for every label that appears in ``edges``; ``edges`` are read once."""
    every = cut_lineage(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    e = first = every.filter(F.col("u") != F.col("v"))
    own = e.select(F.col("u").alias("label")).unionByName(e.select(F.col("v").alias("label"))).distinct()
    maps = []
    while left := e.count():
        if left <= local_edges:
            kind = e.schema["u"].dataType.simpleString()
            maps.append(cut_lineage(finish_here(e, f"k {kind}, p {kind}", _union)))
            break
        one = cut_lineage(_pointers(e))
        ptr = cut_lineage(_jump(one))
        drop_checkpoint(one)
        maps.append(ptr)
        to = ptr.select("k", "p")
        deg = ptr.select("k", "n")
        x = join_unique(e.withColumnRenamed("u", "k"), to, "k", deg).select(F.col("p").alias("u"), "v")
        x = join_unique(x.withColumnRenamed("v", "k"), to, "k", deg).select("u", F.col("p").alias("v"))
        new = cut_lineage(_orient(x, "u", "v"))
        if e is not first:
            drop_checkpoint(e)
        e = new
    roots = own.select("label", F.col("label").alias("root"))
    held = [every, e]
    if maps:
        total = maps[-1].select("k", "p")
        for m in reversed(maps[:-1]):
            nxt = total.select(F.col("k").alias("p"), F.col("p").alias("pp"))
            total = cut_lineage(join_unique(m.select("k", "p"), nxt, "p")
                                .select("k", F.coalesce("pp", "p").alias("p")))
            drop_checkpoint(m)
        reps = total.select(F.col("k").alias("label"), F.col("p").alias("r"))
        low = cut_lineage(reps.groupBy("r").agg(F.min("label").alias("root"), F.count(F.lit(1)).alias("n")))
        roots = join_unique(reps, low.select("r", "root"), "r", low.select("r", "n")).select("label", "root")
        held += [total, low]
    loops = every.filter(F.col("u") == F.col("v")).select(F.col("u").alias("label"))
    alone = loops.join(own, "label", "left_anti").select("label", F.col("label").alias("root"))
    out = cut_lineage(roots.unionByName(alone))
    for m in held:
        drop_checkpoint(m)
    return out
