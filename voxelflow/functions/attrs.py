"""Dataset attribute functions.

Each is available both as a Column expression (for metadata tables) and as a
plain Python helper (for driver-side parameter normalisation).
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

SCALE_PATTERN = r"^s\d+$"


# --- A9: multiscale groups -------------------------------------------------

def is_scale_name(name_col) -> Column:
    return F.col(name_col).rlike(SCALE_PATTERN) if isinstance(name_col, str) else name_col.rlike(SCALE_PATTERN)


def scale_index(name_col) -> Column:
    c = F.col(name_col) if isinstance(name_col, str) else name_col
    return F.regexp_extract(c, r"^s(\d+)$", 1).try_cast("int")


def sort_scales(names) -> list[str]:
    """Existing scale datasets ``s0, s1, ...`` in numeric order."""
    return sorted((n for n in names if re.match(SCALE_PATTERN, n)), key=lambda n: int(n[1:]))


# --- A11: array reversal ---------------------------------------------------

def reverse_array(col) -> Column:
    return F.reverse(F.col(col) if isinstance(col, str) else col)


# --- B6: accumulated factors -----------------------------------------------

def accumulate_factors(prev, cur) -> list:
    """Element-wise product of the previous accumulated factors (default 1)."""
    if prev is None:
        prev = [1] * len(cur)
    return [p * c for p, c in zip(prev, cur)]


def accumulate_factors_col(prev_col, cur_col) -> Column:
    prev = F.col(prev_col) if isinstance(prev_col, str) else prev_col
    cur = F.col(cur_col) if isinstance(cur_col, str) else cur_col
    prev = F.coalesce(prev, F.transform(cur, lambda v: v * 0 + 1))
    return F.zip_with(prev, cur, lambda a, b: a * b)


# --- B8: factor strings "f" or "fx,fy,fz" ----------------------------------

def parse_factors(s: str, n: int = 3) -> list[int]:
    """``"2"`` -> [2, 2, 2]; ``"2,2,1"`` -> [2, 2, 1]; short lists repeat the last."""
    parts = [int(p) for p in str(s).split(",") if p.strip() != ""]
    if not parts:
        raise ValueError(f"empty factor string {s!r}")
    return (parts + [parts[-1]] * n)[:n]


def parse_factors_col(col, n: int = 3) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    a = F.transform(F.split(c, ","), lambda v: F.trim(v).cast("bigint"))
    pad = F.array_repeat(F.element_at(a, -1), F.greatest(F.lit(0), F.lit(n) - F.size(a)))
    return F.slice(F.concat(a, pad), 1, n)


# --- B9: offsets "x,y,z[:channel]" -----------------------------------------

def parse_offset(s: str) -> tuple[tuple[int, int, int], int | None]:
    """``"-1,0,0"`` -> ((-1, 0, 0), None); ``"-1,0,0:2"`` -> ((-1, 0, 0), 2)."""
    s = str(s)
    ch = None
    if ":" in s:
        s, c = s.split(":", 1)
        ch = int(c)
    parts = [int(p) for p in s.split(",")]
    if len(parts) != 3:
        raise ValueError(f"offset needs three components: {s!r}")
    return (parts[0], parts[1], parts[2]), ch


def enumerate_offsets(specs) -> list[tuple[int, tuple[int, int, int]]]:
    """Channels for a list of offset strings: an unset channel is its ordinal;
    either all offsets name a channel or none does."""
    parsed = [parse_offset(s) for s in specs]
    named = [c is not None for _, c in parsed]
    if any(named) and not all(named):
        raise ValueError("either all offsets specify a channel or none does")
    return [(c if c is not None else i, o) for i, (o, c) in enumerate(parsed)]


def parse_offset_col(col) -> Column:
    """Struct ``(dx, dy, dz, channel)``; channel null when not given."""
    c = F.col(col) if isinstance(col, str) else col
    head = F.split(c, ":").getItem(0)
    ch = F.when(F.instr(c, ":") > 0, F.split(c, ":").getItem(1).cast("int"))
    xyz = F.split(head, ",")
    return F.struct(xyz.getItem(0).cast("bigint").alias("dx"), xyz.getItem(1).cast("bigint").alias("dy"),
                    xyz.getItem(2).cast("bigint").alias("dz"), ch.alias("channel"))
