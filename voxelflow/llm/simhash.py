"""SimHash near-duplicates by bit-sliced comparison.

Fingerprint: majority of the bits of the XXH64 values (seed 42) of a text's
word shingles.  Two texts link when their fingerprints differ in at most
``radius`` bits; a component is everything reachable over links.

* Equal fingerprints collapse first (hash aggregate with map-side combine), so
  a huge group of copies is one row from there on.
* Candidates by pigeonhole: the 64 bits are cut into ``2 * radius`` blocks; two
  fingerprints within the radius agree in at least ``radius`` of them, so they
  meet under one of the C(2r, r) keys made of r blocks (20 keys for radius 3).
* Rows are dealt by key and sorted; a task streams over its key groups.  Inside
  a group the fingerprints are stored *vertically*, one bit plane per bit.
  A comparison XORs planes and adds them up for many lanes at once with
  carry-save counters; a block of lanes is abandoned as soon as every lane is
  over the radius.
* A group with more than ``SPLIT`` members is dealt again, over a second
  exchange, by the same rule over the bits that its key leaves open: no task
  holds a hot key.  What is still large is cut once more inside its task,
  so the quadratic part stays below 2^16 members whatever the group holds.
* A group emits a spanning forest of its links, not its pairs.  Components of
  the forests are found by distributed contraction.

Nulls, blanks: a null or wordless text has fingerprint zero and links like any
other.  Fewer words than the shingle: the whole sequence is the one shingle.
A null ``doc_id`` keeps its row; it takes part in links but is never the
smallest id.  Repeated rows give repeated result rows.  An empty table gives an
empty result.  Other columns are ignored.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.graph import connected_components
from ..operators.skew import join_unique
from ..session import cut_lineage
from . import common

SEED = 42
SMALL = 64      # groups up to this size are compared by shifting the planes
SPLIT = 8192    # larger groups are cut again by their open bits


# ---------------------------------------------------------------- fingerprints

def fingerprint(text: str | None, shingle: int = 3) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    h = xxhash.xxh64_digest
    joined = b" ".join(words)
    if len(words) <= shingle:
        digests = h(joined, SEED)
    else:
        lens = list(map(len, words))
        starts = list(accumulate([n + 1 for n in lens], initial=0))
        digests = b"".join([h(joined[a:b - 1], SEED)
                            for a, b in zip(starts, starts[shingle:])])
    n = len(digests) // 8
    ones = np.zeros(64, np.int64)
    bits = np.frombuffer(digests, np.uint8).reshape(n, 8)
    for lo in range(0, n, 1 << 15):
        ones += np.unpackbits(bits[lo:lo + (1 << 15)], axis=1).sum(0, dtype=np.uint16)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(doc_id, fp)``; fp is the 64 bits as a signed long."""
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp bigint"

    def run(b: pa.RecordBatch) -> dict:
        fps = [fingerprint(t, shingle) for t in b.column("text").to_pylist()]
        return {"doc_id": b.column("doc_id"), "fp": np.array(fps, np.uint64).view(np.int64)}
    return common.map_rows(docs.select("doc_id", "text"), schema, run)


# ------------------------------------------------------------ bit-sliced blocks

def _planes(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    """Bit planes: row b holds bit ``bits[b]`` of every lane, packed into 64-bit words."""
    words = (len(fps) + 63) // 64
    out = np.zeros((len(bits), words * 8), np.uint8)
    for k, b in enumerate(bits):
        p = np.packbits(((fps >> np.uint64(b)) & np.uint64(1)).astype(np.uint8), bitorder="little")
        out[k, :len(p)] = p
    return out.view(np.uint64)


def _within(diffs, radius: int, shape) -> np.ndarray:
    """Lanes (packed) in which at most ``radius`` of the difference planes are set.

    Carry-save counters: ``c[i]`` holds bit i of every lane's count.  After each
    eight planes the lanes already over the radius are known, and when all are,
    the block is abandoned.
    """
    depth = radius.bit_length()
    c = [np.zeros(shape, np.uint64) for _ in range(depth)]
    over = np.zeros(shape, np.uint64)

    def exceeded():
        # count > radius, compared bit by bit from the top
        gt, eq = np.zeros(shape, np.uint64), ~np.zeros(shape, np.uint64)
        for i in reversed(range(depth)):
            if radius >> i & 1:
                eq = eq & c[i]
            else:
                gt, eq = gt | (eq & c[i]), eq & ~c[i]
        return over | gt
    for k, d in enumerate(diffs):
        carry = d
        for i in range(depth):
            carry, c[i] = carry & c[i], c[i] ^ carry
        over |= carry
        if k % 8 == 7 and not (~exceeded()).any():
            return np.zeros(shape, np.uint64)
    return ~exceeded()


def _lanes(packed: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(packed).view(np.uint8), axis=-1, bitorder="little")[..., :n]


def _link_small(fps, starts, sizes, radius):
    """Links inside many small groups at once: lane i against lane i+s, s = 1, 2, ..."""
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    idx = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    left = np.repeat(sizes, sizes) - (np.arange(len(idx)) - np.repeat(np.cumsum(sizes) - sizes, sizes))
    planes = _planes(fps[idx], range(64))
    out = []
    for s in range(1, int(sizes[0]) if len(sizes) else 0):
        n = int(sizes[sizes > s].sum())
        w = (n + 63) // 64
        nxt = np.zeros((64, w + 1), np.uint64)
        have = min(w + 1, planes.shape[1])
        nxt[:, :have] = planes[:, :have]
        shifted = (nxt[:, :w] >> np.uint64(s)) | (nxt[:, 1:] << np.uint64(64 - s))
        near = _lanes(_within((planes[b, :w] ^ shifted[b] for b in range(64)), radius, (w,)), n)
        at = np.flatnonzero(near.astype(bool) & (left[:n] > s))
        out.append((idx[at], idx[at + s]))
    return out


def _link_large(fps, start, size, radius):
    """Links inside one group: 64 queries at a time against all lanes."""
    own = fps[start:start + size]
    planes = _planes(own, range(64))
    parent = np.arange(size)
    for q in range(0, size, 64):
        qs = own[q:q + 64]
        flip = [(np.uint64(0) - ((qs >> np.uint64(b)) & np.uint64(1)))[:, None] for b in range(64)]
        near = _within((planes[b][None, :] ^ flip[b] for b in range(64)), radius, (len(qs), planes.shape[1]))
        for i in np.flatnonzero(near.any(axis=1)):
            nb = np.flatnonzero(_lanes(near[i], size))
            if len(nb) > 1:
                r = parent[nb]
                while (parent[r] != r).any():
                    r = parent[r]
                r = np.unique(r)
                parent[r] = r[0]
    while (parent[parent] != parent).any():
        parent = parent[parent]
    leaf = np.flatnonzero(parent != np.arange(size))
    return [(start + leaf, start + parent[leaf])]


def _blocks(bits: list[int], n: int) -> list[list[int]]:
    return [list(map(int, x)) for x in np.array_split(np.array(bits), n)]


def _extract(fps: np.ndarray, bits: list[int]) -> np.ndarray:
    mask = np.uint64(sum(1 << b for b in bits))
    return fps & mask


def key_masks(radius: int) -> list[int]:
    """One mask per key: the bits of ``radius`` out of ``2 * radius`` blocks."""
    blocks = _blocks(range(64), 2 * radius)
    return [sum(1 << b for x in pick for b in x) for pick in combinations(blocks, radius)]


def link_groups(keys: np.ndarray, fps: np.ndarray, radius: int, masks: list[int] | None = None):
    """Spanning links (arrays of positions) of the groups of equal ``keys`` (sorted)."""
    cut = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    sizes = np.diff(np.concatenate([cut, [len(keys)]]))
    small = (sizes > 1) & (sizes <= SMALL)
    out = _link_small(fps, cut[small], sizes[small], radius) if small.any() else []
    for start, size in zip(cut[sizes > SMALL], sizes[sizes > SMALL]):
        own = fps[start:start + size]
        fixed = int(np.bitwise_and.reduce(own) | ~np.bitwise_or.reduce(own))
        free = [b for b in range(64) if not fixed >> b & 1]
        if size <= SPLIT or len(free) <= 16:
            out += _link_large(fps, start, size, radius)
            continue
        for pick in combinations(_blocks(free, 2 * radius), radius):
            sub = _extract(own, [b for x in pick for b in x])
            order = np.argsort(sub, kind="stable")
            out += [(start + order[a], start + order[b])
                    for a, b in link_groups(sub[order], own[order], radius)]
    return out


def _forest(n: int, links) -> tuple[np.ndarray, np.ndarray]:
    """Reduce links among n positions to (member, root) pairs."""
    if not links:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    a = np.concatenate([x for x, _ in links])
    b = np.concatenate([y for _, y in links])
    lab = np.arange(n)
    while len(a):
        la, lb = lab[a], lab[b]
        live = la != lb
        if not live.any():
            break
        a, b, la, lb = a[live], b[live], la[live], lb[live]
        np.minimum.at(lab, np.maximum(la, lb), np.minimum(la, lb))
        while (lab[lab] != lab).any():
            lab = lab[lab]
    leaf = np.flatnonzero(lab != np.arange(n))
    return leaf, lab[leaf]


def _linked(batches, keys: list[str], radius: int, split: int | None):
    """Links ``(a, b)`` of the sorted groups of ``keys``; members ``a`` of groups over ``split`` go out with their key instead.

    Only the last, open group is held, and of a group that is put off at most ``split`` members and a batch.
    """
    def emit(parts):
        *key, f = (np.concatenate(x) for x in zip(*parts))
        if not len(f):
            return
        new = np.zeros(len(f), np.int64)
        for a in key:
            new[1:] |= a[1:] != a[:-1]
        leaf, root = _forest(len(f), link_groups(np.cumsum(new), f.view(np.uint64), radius))
        none = pa.nulls(len(leaf), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(f[leaf]), pa.array(f[root]), none, none], names=["a", "b", "k", "v"])

    def put_off(parts):
        k, v, f = (np.concatenate(x) for x in zip(*parts))
        yield pa.RecordBatch.from_arrays([pa.array(f), pa.nulls(len(f), pa.int64()), pa.array(k), pa.array(v)],
                                         names=["a", "b", "k", "v"])
    held, own, late = [], None, False
    for batch in batches:
        rows = [batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in (*keys, "fp")]
        n = len(rows[-1])
        if not n:
            continue
        new = np.zeros(n, bool)
        for a in rows[:-1]:
            new[1:] |= a[1:] != a[:-1]
        new[0] = own is None or any(a[0] != o for a, o in zip(rows, own))
        starts = np.flatnonzero(new)
        if late:
            head = int(starts[0]) if len(starts) else n
            if head:
                yield from put_off([[a[:head] for a in rows]])
            if head == n:
                continue
            rows, starts, late = [a[head:] for a in rows], starts - head, False
        held.append(rows)
        if len(starts):
            last = int(starts[-1])
            yield from emit([*held[:-1], [a[:last] for a in rows]])
            held, own = [[a[last:] for a in rows]], tuple(a[last] for a in rows[:-1])
        if split is not None and sum(len(r[-1]) for r in held) > split:
            yield from put_off(held)
            held, late = [], True
    if held:
        yield from emit(held)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def link_forest(fps: DataFrame, radius: int = 3, split: int = SPLIT) -> DataFrame:
    """``(a, b)``: spanning links per key group over the distinct ``fp`` of ``fps``.

    A key with more than ``split`` members is no task of its own: its members are dealt once
    more, by the same rule over the bits that the key leaves open.  Fingerprints are distinct and at most
    17 bits stay open then, so no group of the second exchange passes 2^17 members.
    """
    masks = key_masks(radius)
    keyed = fps.select("fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(_signed(m))) for m in masks])).alias("k", "v"))
    out = "a bigint, b bigint, k bigint, v bigint"
    first = cut_lineage(keyed.repartition("k", "v").sortWithinPartitions("k", "v").select("k", "v", "fp")
                             .mapInArrow(lambda bs: _linked(bs, ["k", "v"], radius, split), out))
    links = first.filter("k IS NULL").select("a", "b")
    late = first.filter("k IS NOT NULL").select("k", "v", F.col("a").alias("fp"))
    # the second masks of every key, a fixed list of lists
    again = F.array(*[F.array(*[F.lit(_signed(sum(1 << b for x in pick for b in x))) for pick in combinations(
        _blocks([b for b in range(64) if not m >> b & 1], 2 * radius), radius)]) for m in masks])
    dealt = (late.select("k", "v", "fp", F.posexplode(F.transform(F.get(again, F.col("k").cast("int")),
                                                                  lambda m: F.col("fp").bitwiseAND(m))).alias("k2", "v2"))
                 .repartition("k", "v", "k2", "v2").sortWithinPartitions("k", "v", "k2", "v2"))
    more = (dealt.select("k", "v", "k2", "v2", "fp").mapInArrow(lambda bs: _linked(bs, ["k", "v", "k2", "v2"], radius, None), out)
                 .select("a", "b"))
    return links.unionByName(more).distinct()


def near_duplicates(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)`` of every row of ``docs(doc_id, text)``."""
    fp = cut_lineage(fingerprints(common.doc_text(docs), shingle))
    distinct = cut_lineage(fp.groupBy("fp").agg(F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("n")))
    comp = connected_components(link_forest(distinct.select("fp"), radius), "a", "b", local_edges=0)
    rooted = (distinct.join(comp.withColumnRenamed("label", "fp"), "fp", "left")
                      .withColumn("root", F.coalesce("root", "fp")))
    lows = rooted.groupBy("root").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("n"))
    named = cut_lineage(join_unique(rooted.select("fp", "root"), lows.select("root", "component_id"), "root",
                                    lows.select("root", "n")).select("fp", "component_id"))
    return join_unique(fp, named, "fp", distinct.select("fp", "n"))


def digest(result: DataFrame) -> DataFrame:
    """The result with the fingerprint as 16 lowercase hex digits."""
    return result.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with exactly one row per component: that of the smallest id (nulls last), then of the smallest row key.

    Components are told apart by their chosen row, not by an id, so repeated
    or null ids lose no text.  The choice is made on slim rows; the texts meet
    only the keys of the rows that go.  Rows that are equal in every column
    count as one.
    """
    keyed = common.keyed_rows(docs, "doc_id", "text")
    name = F.struct(F.isnull("doc_id").alias("missing"), F.col("doc_id").alias("id"), "a", "b")
    found = cut_lineage(near_duplicates(keyed.select(name.alias("doc_id"), "text"), shingle, radius)
                        .select("doc_id.a", "doc_id.b", (F.col("doc_id") == F.col("component_id")).alias("stays")))
    left = keyed.select("row", "a", "b").join(found.filter(~F.col("stays")).select("a", "b").distinct(), ["a", "b"], "left_anti")
    again = cut_lineage(found.filter("stays").groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))
                        .filter("n > 1").select("a", "b"))
    if not again.isEmpty():
        left = left.join(again, ["a", "b"], "left_anti").unionByName(
            left.join(again, ["a", "b"], "left_semi").dropDuplicates(["a", "b"]))
    return left.select("row.*")
