"""Document fingerprints as threshold-scaled sketches.

A text's shingles (runs of five words, A-Z lower-cased) are hashed by XXH64;
the sketch keeps *every* hash below a fixed fraction of the hash range, so its
size follows the text's, sketches of parts merge by set union, and the share
of one sketch found in another estimates containment however unequal the texts
are.  Where no hash lies below the fraction the smallest one is kept, so a text
with a word never has an empty sketch; a minimum merges as well.

``in_turn`` brings every text together with the next one in descending id order with
one exchange of the texts: a bounded sample of order keys gives range
bounds, the first row of each range (found on slim rows) is dealt to the range before
it as well, and a task streams over its sorted ranges holding two texts at a time.

Nulls, blanks: a null text is empty; a text without words has an empty sketch.
Fewer words than the shingle: the whole sequence is the one shingle.  Two empty
sketches are alike (1), an empty and another one are not (0).  Null ids come
last in descending order; equal ids are ordered by a key of id and text, and rows
that repeat id and text stand once in the order and all get the same values.
After the last document comes the first; a single document is next to itself.
An empty table gives an empty result.  Other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_unique
from ..session import cut_lineage
from . import common

SEED = 42
SHINGLE = 5
#: One hash in so many is kept.
SCALE = 8
#: Text bytes of a range, and sampled order keys per range.
RANGE_BYTES, SAMPLED = 8 << 20, 64


# ---------------------------------------------------------------- sketches

def sketch(text: str | None, shingle: int = SHINGLE, scale: int = SCALE) -> np.ndarray:
    """Rising distinct hashes (uint64) below 2^64 / scale, and the smallest one."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h, joined = xxhash.xxh64_digest, b" ".join(words)
    if len(words) <= shingle:
        raw = h(joined, SEED)
    else:
        starts = list(accumulate([len(w) + 1 for w in words], initial=0))
        raw = b"".join([h(joined[a:b - 1], SEED) for a, b in zip(starts, starts[shingle:])])
    hashes = np.frombuffer(raw, ">u8").astype(np.uint64)
    low = hashes[hashes < np.uint64((1 << 64) // scale)]
    return np.unique(low) if len(low) else hashes.min(keepdims=True)


def merge(a: np.ndarray, b: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """Sketch of two texts' shingles together."""
    both = np.union1d(a, b)
    low = both[both < np.uint64((1 << 64) // scale)]
    return low if len(low) else both[:1]


def likeness(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """(containment, resemblance): estimated share of the smaller text's shingles that the larger one
    holds, and shared shingles as a part of all."""
    n, m = len(a), len(b)
    if not n or not m:
        return float(n == m), float(n == m)
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / min(n, m), both / (n + m - both)


def sketches(docs: DataFrame, shingle: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """``(doc_id, hashes)`` of every row; hashes as signed longs, rising as unsigned ones."""
    d = common.doc_text(docs)
    kind = d.schema["doc_id"].dataType.simpleString()

    def run(b: pa.RecordBatch) -> dict:
        return {"doc_id": b.column("doc_id"),
                "hashes": [sketch(t, shingle, scale).view(np.int64) for t in b.column("text").to_pylist()]}
    return common.map_rows(d, f"doc_id {kind}, hashes array<bigint>", run)


def merged(sketched: DataFrame, *by: str, scale: int = SCALE) -> DataFrame:
    """``(*by, hash)``: the union sketch of each group in long form, so no group is one row or one task.

    A group's smallest hash stays where nothing lies below the fraction.
    """
    unsigned = F.col("hash").bitwiseXOR(F.lit(-1 << 63))      # signed order of this is unsigned order of hash
    limit = F.lit((1 << 64) // scale - (1 << 63))
    hashes = sketched.select(*by, F.explode("hashes").alias("hash"))
    low = hashes.filter(unsigned < limit).distinct()
    least = hashes.groupBy(*by).agg(F.min(unsigned).alias("m")).filter(F.col("m") >= limit)
    return low.unionByName(least.select(*by, F.col("m").bitwiseXOR(F.lit(-1 << 63)).alias("hash")))


def contained(a: Column | str, b: Column | str) -> Column:
    """Containment of two ``hashes`` columns of equal scale, as a SQL expression (empty: as there)."""
    n = F.least(F.size(a), F.size(b))
    return F.when(n > 0, F.size(F.array_intersect(a, b)) / n).otherwise((F.size(a) == F.size(b)).cast("double"))


def name(s: np.ndarray) -> str:
    """The whole sketch as text: its hashes, rising, as base64 of little-endian 64-bit numbers."""
    return base64.b64encode(s.astype("<u8").tobytes()).decode()


def from_name(text: str) -> np.ndarray:
    return np.frombuffer(base64.b64decode(text), "<u8").astype(np.uint64)


# ---------------------------------------------------------------- the next document

def _order(r) -> tuple:
    """Sort key of descending id, nulls last, then the row key."""
    return (r["doc_id"] is None, ~(r["doc_id"] or 0), r["a"], r["b"])


def in_turn(docs: DataFrame, fn, schema: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``(doc_id, *schema)``: ``fn(text, next_text, carried)`` of every row, in descending id order.

    ``fn`` returns ``(values, carried)``: one output row (a tuple in the order of ``schema``) and what it
    knows of the *next* text, handed to the following call, so nothing is computed twice.  ``doc_id`` is an integer.
    """
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    keyed = common.doc_text(docs).withColumn("text", F.coalesce("text", F.lit("")))
    keyed = keyed.select("doc_id", "text", *common.row_key(["doc_id", "text"]))
    slim = cut_lineage(keyed.select("doc_id", "a", "b", F.octet_length("text").cast("bigint").alias("size"))
                       .groupBy("doc_id", "a", "b").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n")))
    total = slim.agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"), F.max("n").alias("n")).first()
    if not total["rows"]:
        return spark.createDataFrame([], f"doc_id {kind}, {schema}")
    rows = keyed.select("doc_id", F.struct("a", "b").alias("key"))
    again = slim.filter("n > 1")
    if total["n"] > 1:
        keyed = keyed.join(again, ["a", "b"], "left_anti").unionByName(
            keyed.join(again, ["a", "b"], "left_semi").dropDuplicates(["a", "b"])).select("doc_id", "text", "a", "b")
    # range bounds from a sample of at most about SAMPLED keys a range, chosen by the row key; ranges of equal bytes
    n = int(total["bytes"] // range_bytes) + 1
    share = min(1.0, SAMPLED * n / total["rows"])
    sampled = slim.filter(F.pmod("a", F.lit(1 << 20)) < int(share * (1 << 20)) + 1).collect() if n > 1 else []
    sampled.sort(key=_order)
    reach = np.cumsum([r["size"] + 1 for r in sampled])
    bounds = [_order(sampled[i]) for i in sorted(set(np.searchsorted(reach, reach[-1] * np.arange(1, n) / n)))] if sampled else []
    held = spark.sparkContext.broadcast(bounds)

    def place(batches):
        for b in batches:
            rows = b.select(["doc_id", "a", "b"]).to_pylist()
            at = [bisect.bisect_right(held.value, _order(r)) for r in rows]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at, pa.int32())], names=[*b.schema.names, "part"])
    key = F.struct(F.isnull("doc_id").alias("missing"), F.bitwise_not(F.coalesce("doc_id", F.lit(0))).alias("down"), "a", "b")
    ranges = slim.select("doc_id", "a", "b").mapInArrow(place, f"doc_id {kind}, a bigint, b bigint, part int")
    # one row per range: bounded by the number of ranges
    firsts = sorted(ranges.groupBy("part").agg(F.min(key).alias("k")).collect(), key=lambda r: r["part"])
    before = {(r["k"]["a"], r["k"]["b"]): firsts[i - 1]["part"] for i, r in enumerate(firsts)}
    also = spark.sparkContext.broadcast(before)

    def deal(batches):
        # a range's first row stands behind the last one of the range before, the very first behind the very last
        for b in place(batches):
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.zeros(b.num_rows, bool))], names=[*b.schema.names, "copy"])
            a, k = b.column("a").to_pylist(), b.column("b").to_pylist()
            hit = [i for i, x in enumerate(zip(a, k)) if x in also.value]
            if hit:
                own = b.take(pa.array(hit))
                parts = pa.array([also.value[a[i], k[i]] for i in hit], pa.int32())
                yield pa.RecordBatch.from_arrays([*own.columns[:-1], parts, pa.array(np.ones(len(hit), bool))],
                                                 names=[*own.schema.names, "copy"])
    dealt = (keyed.mapInArrow(deal, f"doc_id {kind}, text string, a bigint, b bigint, part int, copy boolean")
                  .repartition(n, "part")
                  .sortWithinPartitions("part", "copy", F.isnull("doc_id"), F.desc("doc_id"), "a", "b"))
    full = f"doc_id {kind}, a bigint, b bigint, {schema}"
    arrow = common.arrow_schema(full)

    def walk(batches):
        last, carried = None, None
        for b in batches:
            for s in common.slices(b):
                out = []
                for r in s.select(["doc_id", "part", "text", "a", "b"]).to_pylist():
                    if last is not None and last["part"] == r["part"]:
                        values, carried = fn(last["text"], r["text"], carried)
                        out.append((last["doc_id"], last["a"], last["b"], *values))
                    else:
                        carried = None
                    last = r
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), arrow)], schema=arrow)
    got = dealt.mapInArrow(walk, full)
    if total["n"] == 1:
        return got.drop("a", "b")
    # rows that repeat take the values of the one that stood in the order
    got = cut_lineage(got)
    twins = again.select(F.struct("a", "b").alias("key"), "n")
    values = got.join(again.select("a", "b"), ["a", "b"], "left_semi").select(F.struct("a", "b").alias("key"), *got.columns[3:])
    more = join_unique(rows.join(twins.select("key"), "key", "left_semi").select("doc_id", "key"), values, "key", twins)
    return got.join(again, ["a", "b"], "left_anti").drop("a", "b").unionByName(more.drop("key"))


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by as many first characters (or all) of the following one."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


FOUND = ("n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, "
         "near_next double, n_hashes bigint, jaccard_edited double, jaccard_next double")


def compare_next(docs: DataFrame, shingle: int = SHINGLE, scale: int = SCALE) -> DataFrame:
    """``(doc_id, ...)`` of every row: its sketch, that of its edited text, and containment against that and the next text."""
    def one(text, following, own):
        own = sketch(text, shingle, scale) if own is None else own
        nxt = sketch(following, shingle, scale)
        new = edited(text, following)
        changed = sketch(new, shingle, scale)
        to_new, to_next = likeness(own, changed), likeness(own, nxt)
        return (len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), name(own), name(changed),
                to_new[0], to_next[0], len(own), to_new[1], to_next[1]), nxt
    return in_turn(docs, one, FOUND)
