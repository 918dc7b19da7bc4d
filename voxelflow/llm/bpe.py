"""Byte-level BPE encoding and decoding with a two-tier lookup.

Tier one: a minimal perfect hash over the vocabulary (hash and displace)
resolves a pre-token that is itself a vocabulary entry with one probe and one
comparison.  Tier two: a pre-token that misses is merged from its bytes with a
heap of candidate merges over a doubly linked list, O(n log n) in its length,
so a pre-token of a million bytes is no worse per byte than a short one.

Texts are first cut at single spaces between two non-space characters.  No
match of the split pattern runs across such a place (a word takes the one space
before it along), so the pieces can be encoded one by one and the ids of a
frequent piece can be kept.  The table of kept pieces is bounded.

The vocabulary is read from ``path`` in each Python worker; its size bounds
the memory.  The path must exist on the executors.

Nulls, blanks: a null text is encoded as the empty text, which has no ids.
Rows with a null id, repeated rows and very long texts are encoded like any
other; an empty table gives an empty result; other columns are ignored.
Unpaired surrogates can't occur in a Spark string.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from . import common

#: A space that starts a new piece: its neighbours are no white space.
PIECE = re.compile(r" (?=\S)(?<=\S )")
KEPT_PIECES = 48 << 20      # bytes, each of two generations
KEPT_TOKENS = 64            # pre-tokens of one piece that are kept by themselves
KEPT_LENGTH = 64


class PerfectHash:
    """Minimal perfect hash of byte strings: key i sits in slot ``slot(key)`` of n slots."""

    def __init__(self, keys: list[bytes], load: float = 4.0):
        n = len(keys)
        self.n, self.buckets = n, max(1, int(n / load))
        h = np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64)
        bucket = (h % np.uint64(self.buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        cut = np.searchsorted(bucket[order], np.arange(self.buckets + 1))
        self.shift = np.zeros(self.buckets, np.int64)
        taken = np.zeros(n, bool)
        sizes = np.diff(cut)
        for b in np.argsort(-sizes, kind="stable"):
            if sizes[b] < 2:
                break
            own, d = h[order[cut[b]:cut[b + 1]]], 0
            while True:
                # many displacements at once: the first that puts all keys of the bucket on free slots
                at = np.sort(self._place(own, np.arange(d, d + 256)), axis=1)
                ok = ~taken[at].any(axis=1) & (at[:, 1:] != at[:, :-1]).all(axis=1)
                if ok.any():
                    break
                d += 256
            taken[at[ok.argmax()]] = True
            self.shift[b] = d + ok.argmax()
        # a bucket of one key names its slot itself
        alone = np.flatnonzero(sizes == 1)
        self.shift[alone] = -1 - np.flatnonzero(~taken)[:len(alone)]
        self.shift = self.shift.tolist()

    def _place(self, h: np.ndarray, d: np.ndarray) -> np.ndarray:
        x = (h ^ (d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))[:, None]) * np.uint64(0xD6E8FEB86659FD93)
        return ((x >> np.uint64(32)) % np.uint64(self.n)).astype(np.int64)

    def slot(self, key: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(key)
        d = self.shift[h % self.buckets]
        if d < 0:
            return -1 - d
        x = (h ^ (d * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)) * 0xD6E8FEB86659FD93 & 0xFFFFFFFFFFFFFFFF
        return (x >> 32) % self.n


class Codec:
    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            pairs = [line.split() for line in f if line.strip()]
        tokens = [base64.b64decode(a) for a, _ in pairs]
        ranks = [int(b) for _, b in pairs]
        self.pattern = regex.compile(pattern)
        self.hash = PerfectHash(tokens)
        self.keys: list[bytes] = [b""] * len(tokens)
        self.ids = [0] * len(tokens)
        for t, r in zip(tokens, ranks):
            s = self.hash.slot(t)
            self.keys[s], self.ids[s] = t, r
        self.token = dict(zip(ranks, tokens))
        self.name = {r: str(r) for r in ranks}
        self.type = np.dtype("<u2" if max(ranks) < 1 << 16 else "<u4")
        self.packed = [np.array([i], self.type).tobytes() for i in range(max(ranks) + 1)]
        self.kept = common.Kept(KEPT_PIECES)
        # by left part: right part -> entry, for every way to put an entry together from two
        rank = dict(zip(tokens, ranks))
        self.byte = [rank.get(bytes((x,)), -1) for x in range(256)]
        none: dict[int, int] = {}
        self.pairs = [none] * (max(ranks) + 1)
        for t, r in rank.items():
            for i in range(1, len(t)):
                left, right = rank.get(t[:i]), rank.get(t[i:])
                if left is not None and right is not None:
                    if self.pairs[left] is none:
                        self.pairs[left] = {}
                    self.pairs[left][right] = r

    def rank(self, token: bytes) -> int:
        """Rank of a vocabulary entry, -1 for anything else."""
        s = self.hash.slot(token)
        return self.ids[s] if self.keys[s] == token else -1

    def merge(self, b: bytes) -> list[int]:
        """Ids of a pre-token that isn't in the vocabulary: lowest rank first, leftmost on ties.

        Symbols are linked by position; the heap holds (rank, position) as one number.
        An entry is stale when its position is gone or now starts another pair.
        """
        n, pairs = len(b), self.pairs
        pop, push = heapq.heappop, heapq.heappush
        sym = [self.byte[x] for x in b]
        heap = []
        for i in range(n - 1):
            r = pairs[sym[i]].get(sym[i + 1])
            if r is not None:
                heap.append(r << 32 | i)
        heapq.heapify(heap)
        # one more position ends the list; no pair holds its symbol
        nxt, prv = list(range(1, n + 1)), list(range(-1, n))
        sym.append(-1)
        while heap:
            top = pop(heap)
            i = top & 0xFFFFFFFF
            s, r, j = sym[i], top >> 32, nxt[i]
            if s < 0 or pairs[s].get(sym[j]) != r:
                continue
            sym[i], sym[j] = r, -1
            j = nxt[i] = nxt[j]
            prv[j] = i
            q = pairs[r].get(sym[j])
            if q is not None:
                push(heap, q << 32 | i)
            h = prv[i]
            if h >= 0:
                q = pairs[sym[h]].get(r)
                if q is not None:
                    push(heap, q << 32 | h)
        return [x for x in sym if x >= 0]

    def pretoken(self, m: str) -> bytes:
        """Packed ids of one pre-token: the perfect hash, or the merge of what it misses."""
        t = m.encode("utf-8")
        r = self.rank(t)
        return self.packed[r] if r >= 0 else b"".join(map(self.packed.__getitem__, self.merge(t)))

    def piece(self, s: str) -> bytes:
        tokens = self.pattern.findall(s)
        if len(tokens) == 1:
            return self.pretoken(tokens[0])
        kept = self.kept
        young, old, out = kept.young, kept.old, []
        for n, m in enumerate(tokens):
            # a pre-token that ends in no white space is a piece by itself, so one table serves both
            ids = young.get(m)
            if ids is None:
                ids = old.get(m) or self.pretoken(m)
                if n < KEPT_TOKENS and len(m) <= KEPT_LENGTH and not m[-1].isspace():
                    young[m] = ids
                    kept.size += 180 + len(m) + len(ids)
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> list[int]:
        parts = PIECE.split(text)
        parts[1:] = [" " + p for p in parts[1:]]
        self.kept.limit = KEPT_PIECES
        return np.frombuffer(b"".join(self.kept.look(parts, self.piece, KEPT_LENGTH)), self.type).tolist()

    def clear(self) -> None:
        self.kept.clear()

    def decode(self, ids) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@lru_cache(maxsize=2)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


def encode(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids)`` of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(b: pa.RecordBatch) -> dict:
        c = codec(path, pattern)
        ids = [c.encode(t or "") for t in b.column("text").to_pylist()]
        return {"doc_id": b.column("doc_id"), "n_tokens": list(map(len, ids)), "ids": ids}
    return common.map_rows(common.doc_text(docs), f"doc_id {kind}, n_tokens bigint, ids array<int>", run,
                           keeps="bpe", clear=lambda: codec(path, pattern).clear())


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, bytes)``: the text bytes of every row of ``encoded(doc_id, ids)``; null ids: empty."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def run(batches):
        c = codec(path, pattern)
        for b in batches:
            out = [c.decode(i or ()) for i in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, pa.binary())],
                                             names=["doc_id", "bytes"])
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, bytes binary")


def round_trip(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)``: ids, and what they decode to, as digests."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(b: pa.RecordBatch) -> dict:
        c = codec(path, pattern)
        n, ids_sha, out_sha = [], [], []
        for t in b.column("text").to_pylist():
            ids = c.encode(t or "")
            n.append(len(ids))
            ids_sha.append(hashlib.sha256(",".join(map(c.name.__getitem__, ids)).encode()).hexdigest())
            out_sha.append(hashlib.sha256(c.decode(ids)).hexdigest())
        return {"doc_id": b.column("doc_id"), "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": out_sha}
    return common.map_rows(common.doc_text(docs),
                           f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string", run,
                           keeps="bpe", clear=lambda: codec(path, pattern).clear())
