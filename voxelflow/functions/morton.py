"""Bit-interleaved block keys: storage order and partition ranges of stored volumes.

``key`` interleaves the bits of ``bx, by_, bz`` (x lowest), so blocks that lie close
together in space lie close together in key order, and a cube of ``2^s`` blocks
per axis is one contiguous key range: its *cell* is ``key >> 3 s``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .grid import BLOCK_COLS, col_of

#: Bits per axis: block positions 0 .. 2^21 - 1.
AXIS_BITS = 21


def _spread(c: Column) -> Column:
    """The bits of ``c`` two places apart: each step moves the upper half of every group of bits away."""
    for shift, mask in ((32, 0x001F00000000FFFF), (16, 0x001F0000FF0000FF), (8, 0x100F00F00F00F00F),
                        (4, 0x10C30C30C30C30C3), (2, 0x1249249249249249)):
        c = c.bitwiseOR(F.shiftleft(c, shift)).bitwiseAND(F.lit(mask))
    return c


def key(cols=BLOCK_COLS) -> Column:
    """Key of a block; a position outside ``0 .. 2^21 - 1`` is an error, not a wrong place."""
    x, y, z = (col_of(c).cast("bigint") for c in cols)
    bad = None
    for c in (x, y, z):
        t = (c < 0) | (c >= 1 << AXIS_BITS)
        bad = t if bad is None else bad | t
    k = _spread(x).bitwiseOR(F.shiftleft(_spread(y), 1)).bitwiseOR(F.shiftleft(_spread(z), 2))
    return F.when(bad, F.raise_error(F.lit("block position outside 0 .. 2^21 - 1")).cast("bigint")).otherwise(k)


def cell(k: Column, bits: int) -> Column:
    return F.shiftright(k, 3 * int(bits))


def key_of(bx: int, by: int, bz: int) -> int:
    """``key`` of one block, on the driver."""
    return sum(((v >> i) & 1) << (3 * i + a) for a, v in enumerate((bx, by, bz)) for i in range(AXIS_BITS))


def ranges(lo, hi, bits: int = 0, most: int = 32) -> list[tuple[int, int]]:
    """Inclusive ranges of cell numbers (``bits`` as in ``cell``) that cover the block box ``lo .. hi``.

    An octree descent: a cube inside the box is one range, a cube outside none.
    More than ``most`` ranges are joined across their smallest gaps, so the list
    may cover more than the box, never less.
    """
    lo, hi = [max(0, int(v) >> bits) for v in lo], [min((1 << AXIS_BITS) - 1, int(v)) >> bits for v in hi]
    if any(a > b for a, b in zip(lo, hi)):
        return []
    found: list[list[int]] = []
    # no cube is cut below this size once it would make more ranges than could be told apart
    finest = max(0, max(b - a for a, b in zip(lo, hi)).bit_length() - 4)
    top = max(hi).bit_length()
    stack = [(0, 0, 0, top)]
    while stack:
        x, y, z, s = stack.pop()
        edge = (1 << s) - 1
        if any(p > b or p + edge < a for p, a, b in zip((x, y, z), lo, hi)):
            continue
        if s <= finest or all(p >= a and p + edge <= b for p, a, b in zip((x, y, z), lo, hi)):
            first = key_of(x, y, z)
            found.append([first, first + (1 << 3 * s) - 1])
            continue
        half = 1 << (s - 1)
        stack += [(x + half * (i & 1), y + half * (i >> 1 & 1), z + half * (i >> 2), s - 1) for i in range(8)]
    found.sort()
    out = [found[0]]
    for a, b in found[1:]:
        if a == out[-1][1] + 1:
            out[-1][1] = b
        else:
            out.append([a, b])
    while len(out) > most:
        i = min(range(1, len(out)), key=lambda j: out[j][0] - out[j - 1][1])
        out[i - 1:i + 1] = [[out[i - 1][0], out[i][1]]]
    return [tuple(r) for r in out]


def in_ranges(c, rs: list[tuple[int, int]]) -> Column:
    """Predicate that reaches partition pruning and the Parquet scan: a few comparisons, no function."""
    cond = None
    for a, b in rs:
        t = (col_of(c) == a) if a == b else col_of(c).between(a, b)
        cond = t if cond is None else cond | t
    return F.lit(False) if cond is None else cond
