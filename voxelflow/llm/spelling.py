"""Spelling variant grouping by Bloom-guided neighbourhoods.

1. Words and their counts: runs of letters of every text, counted with
   map-side combine.
2. Blocked Bloom filters over the vocabulary, one set of 512-bit blocks per
   word length: a word sets bits of one block only.  Filters are built in
   Spark, a segment of blocks per group, and their total size is known from
   the word counts before they are collected and broadcast.  Where it exceeds
   ``most_bytes`` the lengths (and parts of a long one) are taken in several
   rounds, each with filters within the bound.
3. Every word generates its edits as hash values only: all deletions, probed
   against the length below, and replacements by a greater letter, probed
   against its own length.  An insertion is some other word's deletion and a smaller
   letter some other word's greater one, so each near pair comes up once.
   The hash is a polynomial, so an edit's hash follows from the word's prefix
   values without building the string.
4. Only edits that a filter lets through become strings and shuffle to an exact
   join with the vocabulary, which removes the false positives.
5. A word's form is its most frequent near word, when that is at least
   ``times`` as frequent; forms are followed to the last by pointer doubling.
   Frequencies at least double along a chain, so there are few rounds.

Nulls, blanks: a null text, or one without letters, has no words.  A null id
enters a word's deletion test as the empty string.  Repeated rows count as
often as they occur.  Ties of frequency go to the smallest word in code-point
order.  Very long words are compared only with words of their length or one less, and
only where such words exist.  An empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.skew import join_unique
from ..session import cut_lineage, drop_checkpoint
from . import common

RUN = "[A-Za-z\\u00C0-\\u00FF]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Filter bits per word, and bits a word sets in its block of 512.
BITS, PROBES = 16, 5
#: Blocks of a filter segment (64 KB): what one task builds at once.
SEGMENT = 1024
MOST_BYTES = 64 << 20
#: Edits held at once by a task.
EDITS = 1 << 20

MULT = np.uint64(0x9E3779B97F4A7C15)        # odd, so it has an inverse modulo 2^64
INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


# ---------------------------------------------------------------- hashes

def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _value(codes: np.ndarray) -> np.ndarray:
    """A code point's term, before its place's power."""
    return _mix(codes.astype(np.uint64) + np.uint64(0x632BE59BD9B4E019))


@lru_cache(maxsize=64)
def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n, MULT)]))


def codes(words: list[str]) -> np.ndarray:
    """Code points of words of equal length, one row a word."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def hashes(c: np.ndarray) -> np.ndarray:
    return (_value(c) * _powers(c.shape[1])[:-1]).sum(1, dtype=np.uint64)


# ---------------------------------------------------------------- blocked filters

def blocks_for(words: int) -> int:
    """Blocks of the filter of so many words."""
    return max(1, -(-words * BITS // 512))


def _probes(h: np.ndarray, blocks: int):
    """Block, and the ``PROBES`` bits in it, of each hash."""
    m = _mix(h)
    block = ((m >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
    bits = m * np.uint64(0x9FB21C651E98DF25)
    return block.astype(np.int64), [((bits >> np.uint64(9 * i)) & np.uint64(511)).astype(np.int64) for i in range(1, 1 + PROBES)]


def build(h: np.ndarray, blocks: int, first: int = 0, count: int | None = None) -> np.ndarray:
    """Words of ``count`` blocks from block ``first`` on, with the bits of ``h`` (all of those blocks)."""
    out = np.zeros((blocks if count is None else count) * 8, np.uint64)
    block, bits = _probes(h, blocks)
    for b in bits:
        np.bitwise_or.at(out, (block - first) * 8 + (b >> 6), np.uint64(1) << (b & 63).astype(np.uint64))
    return out


def probe(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Positions of ``h`` that the filter lets through."""
    block, bits = _probes(h, len(filter_) // 8)
    at = np.arange(len(h))
    for b in bits:
        own = b[at]
        hit = (filter_[block[at] * 8 + (own >> 6)] >> (own & 63).astype(np.uint64)) & np.uint64(1)
        at = at[hit.astype(bool)]
        if not len(at):
            break
    return at


# ---------------------------------------------------------------- edits

def candidates(words: list[str], filters: dict, letters: np.ndarray):
    """``(word, edit)`` of the edits of words of equal length that their filters let through.

    ``filters[(length, part)] = (parts, filter)``: an edit belongs to the part that its hash names.
    """
    length = len(words[0])
    below = [(p, n, f) for (k, p), (n, f) in filters.items() if k == length - 1]
    same = [(p, n, f) for (k, p), (n, f) in filters.items() if k == length]
    width = length * (1 + (len(letters) if same else 0))
    step = max(1, EDITS // width)
    places = max(1, EDITS // (1 + len(letters)))
    power = _powers(length)
    for start in range(0, len(words), step):
        own = words[start:start + step]
        c = codes(own)
        term = _value(c) * power[:-1]
        prefix = np.concatenate([np.zeros((len(own), 1), np.uint64), np.cumsum(term, axis=1, dtype=np.uint64)], axis=1)
        total = prefix[:, -1]
        # a word alone may have more edits than a task should hold: its places are taken in turn
        for lo in range(0, length, places):
            hi = min(length, lo + places)
            if below:
                h = prefix[:, lo:hi] + (total[:, None] - prefix[:, lo + 1:hi + 1]) * INVERSE
                # of equal letters in a row, one deletion
                new = np.ones((len(own), hi - lo), bool)
                new[:, (1 if lo == 0 else 0):] = c[:, max(lo, 1):hi] != c[:, max(lo, 1) - 1:hi - 1]
                row, col = np.nonzero(new)
                for at in _through(h[row, col], below):
                    for i in at:
                        w, k = own[row[i]], lo + col[i]
                        yield w, w[:k] + w[k + 1:]
            if same:
                row, col, let = np.nonzero(letters[None, None, :] > c[:, lo:hi, None])
                k = lo + col
                h = total[row] + (_value(letters)[let] * power[k] - term[row, k])
                for at in _through(h, same):
                    for i in at:
                        w = own[row[i]]
                        yield w, w[:k[i]] + chr(letters[let[i]]) + w[k[i] + 1:]


def _through(h: np.ndarray, filters):
    for part, parts, f in filters:
        at = np.arange(len(h)) if parts == 1 else np.flatnonzero(h % np.uint64(parts) == part)
        if len(at):
            yield at[probe(f, h[at])]


# ---------------------------------------------------------------- vocabulary

def observed(docs: DataFrame, drop_every: int = 97) -> DataFrame:
    """``(word, n)`` over all texts; a letter goes from runs whose CRC-32 with the id ``drop_every`` divides (0: none)."""
    d = common.doc_text(docs)
    runs = d.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
                    F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0))).alias("run"))
    if drop_every:
        h = F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "utf-8"))
        at = F.pmod(F.col("h"), F.length("run").cast("bigint")).cast("int")
        cut = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
        runs = runs.withColumn("h", h).withColumn("run", F.when(F.col("h") % drop_every == 0, cut).otherwise(F.col("run")))
    return runs.groupBy(F.col("run").alias("word")).agg(F.count(F.lit(1)).alias("n"))


def vocabulary(docs: DataFrame, least_length: int = 5, least_count: int = 3, drop_every: int = 97) -> DataFrame:
    """``(word, n)`` of the words long and frequent enough."""
    return observed(docs, drop_every).filter((F.length("word") >= least_length) & (F.col("n") >= least_count))


def shards(words: DataFrame, most_bytes: int) -> list[list[tuple[int, int, int, int]]]:
    """Rounds of ``(length, part, parts, words in the part)`` whose filters take ``most_bytes`` at most together.

    One row per word length comes to the driver.
    """
    counts = words.groupBy(F.length("word").alias("k")).agg(F.count(F.lit(1)).alias("n")).collect()
    rounds: list[list] = []
    room = 0
    for r in sorted(counts, key=lambda r: r["k"]):
        size = blocks_for(r["n"]) * 64
        parts = -(-size // most_bytes)
        for p in range(parts):
            own = -(-r["n"] // parts)
            if not rounds or room < blocks_for(own) * 64:
                rounds.append([])
                room = max(most_bytes, blocks_for(own) * 64)
            rounds[-1].append((r["k"], p, parts, own))
            room -= blocks_for(own) * 64
    return rounds


def filters(words: DataFrame, wanted: list[tuple[int, int, int, int]]) -> dict:
    """``{(length, part): (parts, filter)}``, built a segment per group and collected; its size is that of ``wanted``."""
    parts = {k: n for k, _, n, _ in wanted}
    blocks = {(k, p): blocks_for(n) for k, p, _, n in wanted}
    arrow = common.arrow_schema("k int, p int, s int, bits binary")

    def place(batches):
        for b in batches:
            ws = b.column("word").to_pylist()
            by: dict[int, list[str]] = {}
            for w in ws:
                by.setdefault(len(w), []).append(w)
            for k, own in by.items():
                for lo in range(0, len(own), max(1, EDITS // k)):
                    h = hashes(codes(own[lo:lo + max(1, EDITS // k)]))
                    part = (h % np.uint64(parts[k])).astype(np.int64)
                    for p in np.unique(part):
                        if (k, int(p)) in blocks:
                            x = h[part == p]
                            seg = _probes(x, blocks[k, int(p)])[0] // SEGMENT
                            yield pa.RecordBatch.from_arrays(
                                [pa.array(np.full(len(x), k, np.int32)), pa.array(np.full(len(x), p, np.int32)),
                                 pa.array(seg.astype(np.int32)), pa.array(x.view(np.int64))], names=["k", "p", "s", "h"])

    def fill(t: pa.Table) -> pa.Table:
        k, p, s = (t.column(c)[0].as_py() for c in ("k", "p", "s"))
        n = blocks[k, p]
        bits = build(t.column("h").to_numpy().view(np.uint64), n, s * SEGMENT, min(SEGMENT, n - s * SEGMENT))
        return pa.Table.from_pylist([{"k": k, "p": p, "s": s, "bits": bits.tobytes()}], schema=arrow)
    own = words.filter(F.length("word").isin(list(parts))).select("word")
    rows = (own.mapInArrow(place, "k int, p int, s int, h bigint").groupBy("k", "p", "s")
               .applyInArrow(fill, "k int, p int, s int, bits binary").collect())
    out = {key: np.zeros(n * 8, np.uint64) for key, n in blocks.items()}
    for r in rows:
        f = np.frombuffer(r["bits"], np.uint64)
        out[r["k"], r["p"]][r["s"] * SEGMENT * 8:r["s"] * SEGMENT * 8 + len(f)] = f
    return {key: (parts[key[0]], f) for key, f in out.items()}


# ---------------------------------------------------------------- near words and forms

def near_pairs(words: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """``(word, n, other, m)``: each pair of ``words(word, n)`` one edit apart once, with both counts.

    ``words`` is read several times: pass a cut frame.
    """
    spark = words.sparkSession
    letters = words.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).distinct().collect()
    letters = np.sort(np.array([ord(r["c"]) for r in letters if r["c"]], np.uint32))
    out = None
    for wanted in shards(words, most_bytes):
        held = spark.sparkContext.broadcast((filters(words, wanted), letters))
        lengths = sorted({k for k, *_ in wanted} | {k + 1 for k, *_ in wanted})

        def run(batches):
            fs, abc = held.value
            for b in batches:
                by: dict[int, list[tuple[str, int]]] = {}
                count = dict(zip(b.column("word").to_pylist(), b.column("n").to_pylist()))
                for w in count:
                    by.setdefault(len(w), []).append(w)
                rows: list[tuple] = []
                for own in by.values():
                    for w, e in candidates(own, fs, abc):
                        rows.append((w, count[w], e))
                        if len(rows) == 1 << 16:
                            yield _pairs(rows)
                            rows = []
                if rows:
                    yield _pairs(rows)
        # words alone of their length have no replacement, and no deletion where the length below is empty
        found = words.filter(F.length("word").isin(lengths)).mapInArrow(run, "word string, n bigint, other string")
        out = found if out is None else out.unionByName(found)
    if out is None:
        return words.select("word", "n", F.col("word").alias("other"), F.col("n").alias("m")).limit(0)
    return out.join(words.select(F.col("word").alias("other"), F.col("n").alias("m")), "other").select("word", "n", "other", "m")


def _pairs(rows: list[tuple]) -> pa.RecordBatch:
    w, n, e = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(w, pa.string()), pa.array(n, pa.int64()), pa.array(e, pa.string())],
                                      names=["word", "n", "other"])


def forms(words: DataFrame, pairs: DataFrame, times: int = 2) -> DataFrame:
    """``(word, n, n_near, form, form_n)`` of every word."""
    # each pair once from the join, then in both directions
    both = pairs.select(F.inline(F.array(F.struct("word", "n", "other", "m"), F.struct(
        F.col("other").alias("word"), F.col("m").alias("n"), F.col("word").alias("other"), F.col("n").alias("m")))))
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("m")).alias("down"), "other")).alias("b"))
    ok = -F.col("b.down") >= times * F.col("n")
    return words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(ok, F.col("b.other")).alias("form"), F.when(ok, -F.col("b.down")).alias("form_n"))


def roots(formed: DataFrame) -> DataFrame:
    """``(word, root)`` of the words of ``formed(word, form)`` that have a form."""
    ptr = cut_lineage(formed.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")))
    while True:
        nxt = ptr.select(F.col("word").alias("root"), F.col("root").alias("further"))
        new = cut_lineage(join_unique(ptr, nxt, "root").select("word", F.coalesce("further", "root").alias("root"),
                                                               F.col("further").isNotNull().alias("moved")))
        drop_checkpoint(ptr)
        ptr = new
        if ptr.filter("moved").isEmpty():
            return ptr.select("word", "root")


def variants(docs: DataFrame, least_length: int = 5, least_count: int = 3, drop_every: int = 97, times: int = 2,
             most_bytes: int = MOST_BYTES) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of every word of ``docs(doc_id, text)``."""
    words = cut_lineage(vocabulary(docs, least_length, least_count, drop_every))
    formed = cut_lineage(forms(words, near_pairs(words, most_bytes), times))
    return (formed.join(roots(formed), "word", "left")
                  .select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root")))
