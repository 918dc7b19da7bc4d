"""Distance transforms.

``D(p) = min_q f(q) + sum_d w_d (p_d - q_d)^2`` over all voxels ``q``, then
``sqrt``.  The minimum separates into three 1-D passes, each the lower envelope
of parabolas along the lines of one axis (Felzenszwalb and Huttenlocher,
"Distance Transforms of Sampled Functions", 2012): no search
radius and no join.  A pass deals the voxels by line, sorts each partition, and
streams over the lines; a line is bounded by the volume's extent.  The input value
travels along, so the whole transform is one scan and three exchanges.

The envelope is the one step here that runs in Arrow batches.  The lines of a
batch are stepped together: every array operation compares all voxels with the parabolas
``d`` voxels away, and a line is done once ``w d^2`` exceeds its largest value.
Lines that are not after ``NEAR`` steps (far from any boundary), and lines with
gaps, go through the stack of running intersections, O(n) per line.

Outside the volume's extent every voxel counts as boundary (H5: NaN outside)
or as ``f = 0`` (H6: zero outside): parabolas of height 0 at positions ``-1``
and ``n`` of every line.  Inputs are dense inside their extent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.grid import AXES, triple

INF = float("inf")
#: Steps that the lines of a batch take together.
NEAR = 128


def lower_envelope(pos: list[int], f: list[float], w: float, n: int) -> list[float]:
    """``min_q f(q) + w (p - q)^2`` at every ``p`` of ``pos`` (ascending), with zeros at -1 and n."""
    if w <= 0:
        low = min(0.0, min(f))
        return [low] * len(pos)
    qs, fs, starts = [-1], [0.0], [-INF]
    for q, h in zip([*pos, n], [*f, 0.0]):
        if h == INF:
            continue
        while True:
            # where the parabola at q falls below the last one of the envelope
            x = ((h / w + q * q) - (fs[-1] / w + qs[-1] * qs[-1])) / (2 * (q - qs[-1]))
            if x > starts[-1] or len(qs) == 1:
                break
            qs.pop()
            fs.pop()
            starts.pop()
        qs.append(q)
        fs.append(h)
        starts.append(x)
    out, k, last = [], 0, len(qs) - 1
    for p in pos:
        while k < last and starts[k + 1] < p:
            k += 1
        d = float(p - qs[k])
        best = fs[k] + w * d * d
        # rounding of an intersection can hide an equal or slightly smaller neighbour
        if k < last:
            d = float(p - qs[k + 1])
            best = min(best, fs[k + 1] + w * d * d)
        if k:
            d = float(p - qs[k - 1])
            best = min(best, fs[k - 1] + w * d * d)
        out.append(best)
    return out


def envelopes(pos: np.ndarray, f: np.ndarray, cuts: list[int], w: float, n: int) -> np.ndarray:
    """``lower_envelope`` of all lines; line k is ``cuts[k] .. cuts[k + 1]``.  ``f`` is not negative."""
    out = np.empty(len(f))
    starts, sizes = np.array(cuts[:-1]), np.diff(cuts)
    whole = pos[starts + sizes - 1] - pos[starts] + 1 == sizes
    alone = list(np.flatnonzero(~whole | (w <= 0)))
    for size in np.unique(sizes[whole]) if w > 0 else ():
        lines = np.flatnonzero(whole & (sizes == size))
        at = starts[lines][:, None] + np.arange(size)
        own, p = f[at], pos[at].astype(float)
        best = np.minimum(own, np.minimum(w * (p + 1) * (p + 1), w * (n - p) * (n - p)))
        for d in range(1, int(size)):
            c = w * d * d
            if d % 8 == 1:
                # lines that nothing so far away can lower are done
                left = best.max(1) > c
                if not left.all():
                    out[at[~left]] = best[~left]
                    lines, at, own, best = lines[left], at[left], own[left], best[left]
                if not len(lines):
                    break
                if d > NEAR:
                    alone += list(lines)
                    break
            np.minimum(best[:, d:], own[:, :-d] + c, out=best[:, d:])
            np.minimum(best[:, :-d], own[:, d:] + c, out=best[:, :-d])
        else:
            out[at] = best
    for k in alone:
        a, b = cuts[k], cuts[k + 1]
        out[a:b] = lower_envelope(pos[a:b].tolist(), f[a:b].tolist(), w, n)
    return out


def separable_pass(f: DataFrame, ax: str, w: float, n: int) -> DataFrame:
    """One 1-D pass along ``ax`` over ``f(x, y, z, v, f)``; ``v`` is carried along."""
    others = [a for a in AXES if a != ax]
    lines = f.select(*AXES, "v", "f").repartition(*others).sortWithinPartitions(*others, ax)

    def run(batches):
        rest = None
        for b in batches:
            b = pa.Table.from_batches([b])
            if rest is not None:
                b = pa.concat_tables([rest, b])
            if not b.num_rows:
                continue
            o1, o2 = (b[a].to_numpy() for a in others)
            cut = np.flatnonzero((o1[1:] != o1[:-1]) | (o2[1:] != o2[:-1])) + 1
            end = int(cut[-1]) if len(cut) else 0      # the last line may go on in the next batch
            if end:
                yield done(b.slice(0, end), [0, *cut[:-1], end])
            rest = b.slice(end)
        if rest is not None:
            yield done(rest, [0, rest.num_rows])

    def done(t, cuts):
        out = envelopes(t[ax].to_numpy(), t["f"].to_numpy(), [int(c) for c in cuts], w, n)
        t = t.set_column(t.schema.get_field_index("f"), "f", pa.array(out, pa.float64()))
        return t.combine_chunks().to_batches()[0]
    return lines.mapInArrow(run, lines.schema)


def _transform(relief: DataFrame, f: F.Column, dims, weights) -> DataFrame:
    g = relief.select(*AXES, F.col("v").cast("double").alias("v"), f.alias("f"))
    for ax, wi, ni in zip(AXES, triple(weights), triple(dims)):
        g = separable_pass(g, ax, float(wi), int(ni))
    return g.select(*AXES, F.when(F.isnan("v"), F.lit(float("nan"))).otherwise(F.sqrt("f")).alias("v"))


def distance_transform_binary(relief: DataFrame, thr: float, dims, weights=(1.0, 1.0, 1.0)) -> DataFrame:
    """H5: Euclidean distance (weights = resolution^2) to the nearest voxel with
    ``not (v >= thr)`` (below threshold, NaN, or outside the volume), however far."""
    inside = ~F.isnan("v") & (F.col("v") >= F.lit(float(thr)))   # NaN sorts high in Spark
    return _transform(relief, F.when(inside, F.lit(INF)).otherwise(F.lit(0.0)), dims, weights)


def sampled_weights(resolution=(1.0, 1.0, 1.0), weight: float = 0.01) -> tuple:
    """H6 weights: ``w * (res / min res)^2``."""
    res = triple(resolution)
    m = min(float(r) for r in res)
    return tuple(float(weight) * (float(r) / m) ** 2 for r in res)


def distance_transform_sampled(relief: DataFrame, dims, weights=(0.01, 0.01, 0.01)) -> DataFrame:
    """H6: ``sqrt(min_q a(q)^2 + sum_d w_d (p_d - q_d)^2)``; NaN counts as 0
    for the transform (and stays NaN in the output); outside is 0."""
    a = F.when(F.isnan("v"), F.lit(0.0)).otherwise(F.col("v"))
    return _transform(relief, (a * a).cast("double"), dims, weights)
