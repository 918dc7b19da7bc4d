"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may occur in a document with up to k edits.  The
item is split into k + 1 pieces; k edits leave one piece untouched, so every
occurrence holds an exact hit of a piece.  Piece hits come from one automaton
over all pieces of a block of items; each hit names a window of the document
which is verified with Myers' bit-parallel edit distance of the whole item
against any substring of the window.

Texts and items are compared in lower case with white space runs as one space,
so line breaks and case don't hide a copy.  The error budget grows with the
item: one edit per ``chars_per_error`` characters, which keeps the pieces at
about that length.

Items are matched in blocks of at most ``block_bytes`` of text.  A block is
what a task holds in memory; more items mean more blocks, never fewer matches.
Every document is scanned whole.  Windows of hits that agree are merged before
they are verified, so a repeated piece costs one verification.

Nulls, blanks: null and empty texts match nothing.  Items that are null, or
shorter than ``least_chars`` after normalising, are too short to tell a copy
from chance and are left out.  A null ``doc_id`` is reported as it is.
Repeated document rows give repeated results, repeated items one result per
item row id.  Empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def myers(masks: dict[str, int], m: int, text: str, most: int) -> tuple[int, int]:
    """(smallest distance of the pattern to a substring of ``text``, its end), or (most + 1, -1).

    ``masks``: bit i of a character's mask is set where the pattern holds it at i.
    """
    full, top = (1 << m) - 1, 1 << (m - 1)
    vp, vn, score = full, 0, m
    best, end = most + 1, -1
    get = masks.get
    for j, c in enumerate(text):
        eq = get(c, 0)
        x = eq | vn
        d0 = (((x & vp) + vp) ^ vp) | x
        hn = vp & d0
        hp = vn | (full & ~(vp | d0))
        if hp & top:
            score += 1
        elif hn & top:
            score -= 1
        hp = hp << 1 & full
        hn = hn << 1 & full
        vn = hp & d0
        vp = hn | (full & ~(hp | d0))
        if score < best:
            best, end = score, j + 1
    return best, end


class Matcher:
    """Pieces and patterns of one block of items."""

    def __init__(self, items: list[tuple[int, str]], chars_per_error: int, least_chars: int):
        self.items = []
        self.auto = ahocorasick.Automaton()
        pieces: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            t = normal(text)
            if len(t) < least_chars:
                continue
            k = len(t) // chars_per_error
            masks: dict[str, int] = {}
            for i, c in enumerate(t):
                masks[c] = masks.get(c, 0) | 1 << i
            n = len(self.items)
            self.items.append((item_id, t, k, masks))
            cuts = [len(t) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                pieces.setdefault(t[a:b], []).append((n, a))
        for p, where in pieces.items():
            self.auto.add_word(p, (len(p), where))
        self.auto.make_automaton()
        self.empty = not pieces

    def find(self, text: str | None) -> list[tuple[int, int, int, int]]:
        """(item id, edits, start, end in the normalised text) of the best occurrence of each item."""
        t = normal(text)
        if self.empty or not t:
            return []
        windows: dict[int, list[list[int]]] = {}
        for end, (n, where) in self.auto.iter(t):
            begin = end + 1 - n
            for i, at in where:
                k, m = self.items[i][2], len(self.items[i][1])
                a, b = max(0, begin - at - k), min(len(t), begin - at + m + k)
                own = windows.setdefault(i, [])
                # hits come in order of their ends: windows of one alignment follow each other
                if own and a <= own[-1][0] + 2 * k and b <= own[-1][1] + 2 * k:
                    own[-1][0], own[-1][1] = min(a, own[-1][0]), max(b, own[-1][1])
                else:
                    own.append([a, b])
        out = []
        for i, own in windows.items():
            item_id, pattern, k, masks = self.items[i]
            best = (k + 1, 0, 0)
            for a, b in own:
                w = t[a:b]
                at = w.find(pattern)
                d, end = (0, at + len(pattern)) if at >= 0 else myers(masks, len(pattern), w, k)
                best = min(best, (d, max(0, a + end - len(pattern)), a + end))
                if d == 0:
                    break
            if best[0] <= k:
                out.append((item_id, *best))
        return out


def blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """The items in blocks of about ``block_bytes`` of text, each read by itself."""
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(total // block_bytes) + 1
    for b in range(n):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == b)
        yield [(r[0], r[1]) for r in own.collect()]


def matches(docs: DataFrame, items: DataFrame, chars_per_error: int = 16, least_chars: int = 48,
            block_bytes: int = 8 << 20) -> DataFrame:
    """``(doc_id, item_id, edits, start, end)``: the best occurrence of every item in every document."""
    d = common.doc_text(docs)
    items = items.select("item_id", "text").filter(F.col("text").isNotNull())
    kind = d.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, item_id {items.schema['item_id'].dataType.simpleString()}, " \
             "edits int, start bigint, end bigint"
    spark, out = docs.sparkSession, None
    for part in blocks(items, block_bytes):
        held = spark.sparkContext.broadcast(part)
        one = d.mapInArrow(_scan(held, chars_per_error, least_chars, common.arrow_schema(schema)), schema)
        out = one if out is None else out.unionByName(one)
    return out


def _scan(held, chars_per_error: int, least_chars: int, arrow: pa.Schema):
    def run(batches):
        m = Matcher(held.value, chars_per_error, least_chars)
        for b in batches:
            rows = [(i, *hit) for i, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist())
                    for hit in m.find(t)]
            cols = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow)], schema=arrow)
    return run


def drop_matched(docs: DataFrame, items: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that hold no item; rows are told apart by a key of the whole row, so ids may be null or repeat."""
    keyed = common.keyed_rows(docs, "text")
    found = matches(keyed.select(F.struct("a", "b").alias("doc_id"), "text"), items, **how).select("doc_id.a", "doc_id.b").distinct()
    return keyed.select("row", "a", "b").join(found, ["a", "b"], "left_anti").select("row.*")
