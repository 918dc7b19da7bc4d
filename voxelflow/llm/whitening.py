"""Embedding whitening by incremental eigendecomposition.

1. A partition streams over its vectors and keeps a spectrum: count, mean,
   eigenvalues and eigenvectors of its scatter matrix about the mean.  Vectors
   are taken in batches; a batch is centred on its own mean and brought to
   triangular form (``X^T X = R^T R``), and the rows of ``R``, with the step
   between the two means, go into the spectrum as symmetric rank-one updates.
   An update rotates equal eigenvalues together, deflates what the new
   direction doesn't touch, solves the secular equation for all other roots at
   once, and takes eigenvectors from the weights that the roots found imply,
   so they stay orthogonal.
2. Spectra are combined pairwise, the one's eigenpairs entering the other as
   successive rank-one updates, by a tree of ``FAN`` spectra per task.
3. Rayleigh-Ritz: the basis found is broadcast (d x d numbers), a second pass
   sums the projection of the exactly centred vectors onto it, and the small
   symmetric problem of size d gives the components to double precision.
4. A third pass measures the covariance of the whitened vectors; the last one
   writes them.

Entries become ``floor(64 c) + 1000000``; counts, sums and deviations of these
integers are exact, and a centred vector is ``(n x - S) / n`` with an exact
numerator.

Memory: a task holds a batch and one or two spectra of d x d numbers, the driver one.

Nulls: rows whose vector is null, empty, or holds a null or non-finite entry
(or one of 2^40 / 64 and more) drop out, as do vectors whose length is not that
of most remaining rows (ties: the longer one).  A null or repeated id is a row like any other.
Repeated vectors count as often as they occur.  Components whose eigenvalue is
zero to rounding (constant directions, fewer rows than entries) have no whitened value
and are not returned, so one vector alone, or an empty table, gives an empty
result.  Equal eigenvalues: some orthonormal basis, the same for all rows.  A
deviation too large for a long is null.  Other columns are ignored.
"""

from __future__ import annotations

from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage, drop_checkpoint
from . import common

SCALE, SHIFT = 64, 1_000_000
LARGEST = 1 << 40
BATCH = 4096
FAN = 16
EPS = np.finfo(float).eps
PARTIAL = ("at bigint, n bigint, sums array<decimal(38,0)>, mean array<double>, spread array<double>, matrix array<double>")


# ------------------------------------------------------------- rank-one updates

def secular_roots(poles: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Differences ``poles[i] - root[j]`` for the roots of ``1 + sum(weights / (poles - t))``.

    ``poles`` rise strictly and ``weights`` are positive.  Every root is kept as a step from
    its nearer pole, so its distance to both neighbours is accurate.  Steps come from
    the rational interpolation through both neighbouring poles, bisection guards them.
    """
    k = len(poles)
    ends = np.append(poles[1:], poles[-1] + weights.sum())
    gap = ends - poles
    mid = 1 + (weights[:, None] / (poles[:, None] - (poles + gap / 2)[None, :])).sum(0)
    left = mid >= 0
    left[-1] = True
    origin = np.where(left, poles, ends)
    lo = np.where(left, 0.0, -gap / 2)
    hi = np.where(left, gap / 2, 0.0)
    hi[-1] = gap[-1] if mid[-1] < 0 else gap[-1] / 2
    base = poles[:, None] - origin[None, :]
    to_right = ends - origin
    below = np.arange(k)[:, None] <= np.arange(k)[None, :]
    w = weights[:, None]
    step = (lo + hi) / 2
    for _ in range(80):
        delta = base - step
        part = w / delta
        slope = part / delta
        f = 1 + part.sum(0)
        settled = np.abs(f) <= 4 * EPS * (1 + np.abs(part).sum(0))
        lo, hi = np.where(f < 0, step, lo), np.where(f < 0, hi, step)
        settled |= np.abs(hi - lo) <= 2 * EPS * np.maximum(np.abs(lo), np.abs(hi))
        if settled.all():
            break
        d1, d2 = np.diagonal(delta), to_right - step
        low = np.where(below, slope, 0).sum(0)
        all_ = slope.sum(0)
        c = f - d1 * low - d2 * (all_ - low)
        a = (d1 + d2) * f - d1 * d2 * all_
        b = d1 * d2 * f
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            eta = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            new = step + eta
            # half way, by magnitude where the bracket leaves out zero
            halves = np.where((lo > 0) | (hi < 0), np.sign(lo + hi) * np.sqrt(np.abs(lo)) * np.sqrt(np.abs(hi)), (lo + hi) / 2)
            halves = np.where((lo == 0) & (hi > 0), hi / 16, np.where((hi == 0) & (lo < 0), lo / 16, halves))
        new = np.where(np.isfinite(new) & (new > lo) & (new < hi), new, halves)
        step = np.where(settled, step, new)
    return base - step


def rank_one(values: np.ndarray, basis: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and eigenvectors of ``basis diag(values) basis^T + v v^T``."""
    z = basis.T @ v
    size = float(z @ z)
    if size == 0:
        return values, basis
    tol = 8 * EPS * max(float(values[-1]), size)
    # equal eigenvalues: turn their vectors so that one of them takes all of the new direction
    cuts = np.flatnonzero(np.diff(values) > tol) + 1
    if len(cuts) < len(values) - 1:
        basis = basis.copy()
        for own in np.split(np.arange(len(values)), cuts):
            if len(own) > 1:
                zc = z[own]
                r = np.sqrt(zc @ zc)
                if r > 0:
                    u = zc.copy()
                    u[-1] += r if u[-1] >= 0 else -r
                    u /= np.sqrt(u @ u)
                    z[own] = zc - 2 * u * (u @ zc)
                    z[own[:-1]] = 0
                    basis[:, own] -= 2 * np.outer(basis[:, own] @ u, u)
    live = np.flatnonzero(np.abs(z) * np.sqrt(size) > tol)
    if not len(live):
        return values, basis
    poles, zl = values[live], z[live]
    delta = secular_roots(poles, zl * zl)
    # the weights for which the roots found are exact
    apart = poles[:, None] - poles[None, :]
    np.fill_diagonal(apart, 1.0)
    zhat = np.sqrt(np.prod(np.abs(delta / apart), axis=1)) * np.where(zl < 0, -1.0, 1.0)
    u = zhat[:, None] / delta
    u /= np.sqrt((u * u).sum(0))
    out, turned = values.copy(), basis.copy()
    out[live] = poles - np.diagonal(delta)
    turned[:, live] = basis[:, live] @ u
    order = np.argsort(out, kind="stable")
    return np.maximum(out[order], 0), turned[:, order]


class Spectrum:
    """Count, mean, and eigenpairs of the scatter matrix of vectors seen so far."""

    def __init__(self, n: int, mean: np.ndarray, values: np.ndarray, basis: np.ndarray):
        self.n, self.mean, self.values, self.basis = n, mean, values, basis

    @classmethod
    def empty(cls, d: int) -> "Spectrum":
        return cls(0, np.zeros(d), np.zeros(d), np.eye(d))

    def _take(self, n: int, mean: np.ndarray, directions) -> None:
        for v in directions:
            self.values, self.basis = rank_one(self.values, self.basis, v)
        if self.n and n:
            step = (mean - self.mean) * np.sqrt(self.n / (self.n + n) * n)
            self.values, self.basis = rank_one(self.values, self.basis, step)
        self.mean = self.mean + (mean - self.mean) * (n / max(self.n + n, 1))
        self.n += n

    def add(self, x: np.ndarray) -> None:
        """Take the rows of ``x`` in."""
        mean = x.mean(0)
        self._take(len(x), mean, np.linalg.qr(x - mean, mode="r"))

    def merge(self, other: "Spectrum") -> None:
        pairs = [np.sqrt(e) * q for e, q in zip(other.values, other.basis.T) if e > 0]
        self._take(other.n, other.mean, pairs)


# ------------------------------------------------------------- vectors and partials

def _finite(vec: str):
    def ok(e):
        c = e.cast("double")
        return c.isNotNull() & ~F.isnan(c) & (F.abs(F.floor(c * SCALE)) < LARGEST)
    return F.col(vec).isNotNull() & (F.size(vec) > 0) & F.forall(vec, ok)


def fit_list(df: DataFrame, vec: str) -> tuple[DataFrame, int]:
    """The rows whose vector takes part, and their length (0: none)."""
    good = df.filter(_finite(vec))
    most = good.groupBy(F.size(vec).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = most["d"] if most else 0
    return good.filter(F.size(vec) == d), d


def _entries(col: pa.Array, d: int) -> np.ndarray:
    """Rows of ``floor(64 c)`` as int64."""
    flat = col.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    return np.floor(flat.reshape(-1, d) * SCALE).astype(np.int64)


def _batches(batches, d: int, rows: int = BATCH):
    """``(id column or None, entries)`` in slices of at most ``rows`` rows."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            s = b.slice(at, rows)
            yield s, _entries(s.column("vec"), d)


def _row(at, n, sums=None, mean=None, spread=None, matrix=None) -> dict:
    return {"at": at, "n": n, "sums": None if sums is None else [Decimal(int(s)) for s in sums],
            "mean": None if mean is None else mean.tolist(), "spread": None if spread is None else spread.tolist(),
            "matrix": None if matrix is None else matrix.ravel().tolist()}


def _spectrum(r: dict) -> Spectrum:
    d = len(r["mean"])
    return Spectrum(r["n"], np.array(r["mean"]), np.array(r["spread"]), np.array(r["matrix"]).reshape(d, d))


def _merge_spectra(a: dict, b: dict) -> dict:
    s = _spectrum(a)
    s.merge(_spectrum(b))
    return _row(a["at"], s.n, [x + y for x, y in zip(a["sums"], b["sums"])], s.mean, s.values, s.basis)


def _merge_scatter(a: dict, b: dict) -> dict:
    """Scatter matrices about the means of both sides."""
    n, ma, mb = a["n"] + b["n"], np.array(a["mean"]), np.array(b["mean"])
    step = mb - ma
    m = np.array(a["matrix"]) + np.array(b["matrix"]) + np.outer(step, step).ravel() * (a["n"] / n * b["n"])
    return _row(a["at"], n, mean=ma + step * (b["n"] / n), matrix=m)


def tree(partials: DataFrame, merge) -> dict | None:
    """One row from ``partials``, ``FAN`` rows per task and level; None for no rows."""
    arrow = common.arrow_schema(PARTIAL)

    def combine(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["at"])
        out = rows[0]
        for r in rows[1:]:
            out = merge(out, r)
        return pa.Table.from_pylist([out | {"at": rows[0]["at"] // FAN}], schema=arrow)
    held = cut_lineage(partials)
    top = held.agg(F.max("at")).first()[0]
    while top:
        nxt = cut_lineage(held.groupBy(F.floor(F.col("at") / FAN).alias("group")).applyInArrow(combine, PARTIAL))
        drop_checkpoint(held)
        held, top = nxt, top // FAN
    got = held.first()
    drop_checkpoint(held)
    return got.asDict() if got else None


def spectra(vectors: DataFrame, d: int) -> DataFrame:
    """One row of exact sums and spectrum per partition of ``vectors(vec)``."""
    arrow = common.arrow_schema(PARTIAL)

    def run(batches):
        s, sums = Spectrum.empty(d), [0] * d
        for _, x in _batches(batches, d, max(BATCH, 16 * d)):
            sums = [a + int(b) for a, b in zip(sums, x.sum(0))]
            s.add(x.astype(float))
        if s.n:
            yield from pa.Table.from_pylist([_row(TaskContext.get().partitionId(), s.n, sums, s.mean, s.values, s.basis)],
                                            schema=arrow).to_batches()
    return vectors.select("vec").mapInArrow(run, PARTIAL)


def _exact(n: int, sums: list[int], x: np.ndarray) -> np.ndarray:
    """``n x - S``, in Python numbers where 64 bits could overflow."""
    if n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _deviation(c: np.ndarray) -> list[int | None]:
    top = int(np.abs(c).max(initial=0))
    if c.dtype != object and top * top * c.shape[1] < 1 << 63:
        return (c * c).sum(1).tolist()
    return [s if s < 1 << 63 else None for s in (sum(int(v) ** 2 for v in r) for r in c)]


def scatter(vectors: DataFrame, d: int, n: int, sums: list[int], basis: np.ndarray) -> DataFrame:
    """Scatter of the centred vectors projected on ``basis``, one row per partition."""
    arrow = common.arrow_schema(PARTIAL)
    held = vectors.sparkSession.sparkContext.broadcast(basis)

    def run(batches):
        out = None
        for _, x in _batches(batches, d):
            y = (_exact(n, sums, x) / n).astype(float) @ held.value
            mean = y.mean(0)
            y -= mean
            one = _row(TaskContext.get().partitionId(), len(x), mean=mean, matrix=y.T @ y)
            out = one if out is None else _merge_scatter(out, one)
        if out is not None:
            yield from pa.Table.from_pylist([out], schema=arrow).to_batches()
    return vectors.select("vec").mapInArrow(run, PARTIAL)


class Whitening:
    """What ``fit`` finds: count, exact sums, ``directions`` (columns), eigenvalues, trace."""

    def __init__(self, n, sums, directions, values, trace):
        self.n, self.sums, self.directions, self.values, self.trace = n, sums, directions, values, trace


def fit(vectors: DataFrame, d: int, components: int = 32) -> Whitening | None:
    """Whitening of ``vectors(vec)``, all of length ``d``; None without rows."""
    found = tree(spectra(vectors, d), _merge_spectra) if d else None
    if found is None:
        return None
    n, sums = found["n"], [int(s) for s in found["sums"]]
    basis = np.linalg.qr(_spectrum(found).basis)[0]
    ritz = tree(scatter(vectors, d, n, sums, basis), _merge_scatter)
    h = np.array(ritz["matrix"]).reshape(d, d) / n
    values, turn = np.linalg.eigh((h + h.T) / 2)
    values, q = values[::-1], (basis @ turn)[:, ::-1]
    keep = int((values[:components] > 64 * d * EPS * max(values[0], 0)).sum())
    q = q[:, :keep] * np.sign(q[np.abs(q).argmax(0), np.arange(d)])[:keep]
    return Whitening(n, sums, q, values[:keep].copy(), float(np.trace(h)))


def whiten(df: DataFrame, components: int = 32, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` of every row that takes part."""
    kind = df.schema[id_col].dataType.simpleString()
    schema = (f"vec_id {kind}, component int, n bigint, deviation bigint, whitened double, explained double, "
              "identity_error double")
    good, d = fit_list(df.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec")), "vec")
    model = fit(good, d, components)
    spark = df.sparkSession
    if model is None or not len(model.values):
        return spark.createDataFrame([], schema)
    n, sums, k = model.n, model.sums, len(model.values)
    by = model.directions / np.sqrt(model.values)
    seen = tree(scatter(good, d, n, sums, by), _merge_scatter)
    error = float(np.abs(np.array(seen["matrix"]).reshape(k, k) / n - np.eye(k)).max())
    held = spark.sparkContext.broadcast((by, model.values / model.trace))
    arrow = common.arrow_schema(schema)

    def run(batches):
        project, explained = held.value
        for b, x in _batches(batches, d):
            c, m = _exact(n, sums, x), len(x)
            w = (c / n).astype(float) @ project
            at = pa.array(np.repeat(np.arange(m), k))
            cols = [b.column("id").take(at), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                    pa.array(np.full(m * k, n, np.int64)), pa.array(_deviation(c), pa.int64()).take(at), pa.array(w.ravel()),
                    pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))]
            yield pa.RecordBatch.from_arrays([pc.cast(v, f.type) for v, f in zip(cols, arrow)], schema=arrow)
    return good.mapInArrow(run, schema)
