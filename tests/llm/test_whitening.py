import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxelflow.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<float>"


def brute(rows, components=32):
    """(x, n, deviation per row, components, eigenvalues, trace) by a dense solver on exact integers."""
    x = np.array([[math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v] for _, v in rows], dtype=object)
    n, s = len(x), x.sum(0)
    c = n * x - s
    dev = [int(sum(int(v) ** 2 for v in r)) for r in c]
    y = (c / n).astype(float)
    cov = y.T @ y / n
    e, q = np.linalg.eigh(cov)
    return y, n, dev, q[:, ::-1][:, :components], e[::-1][:components], np.trace(cov)


def check(df, rows, components=32):
    y, n, dev, q, e, trace = brute(rows, components)
    keep = int((e > 1e-11 * e[0]).sum())
    w = y @ q[:, :keep] / np.sqrt(e[:keep])
    got = {}
    for r in df.collect():
        got.setdefault(r.vec_id, {})[r.component] = r
        assert r.identity_error < 1e-9
    assert sorted(got) == sorted(i for i, _ in rows)
    sign = {}
    for k, (i, _) in enumerate(rows):
        assert sorted(got[i]) == list(range(1, keep + 1))
        for j in range(keep):
            r = got[i][j + 1]
            assert (r.n, r.deviation) == (n, dev[k])
            assert abs(r.explained - e[j] / trace) < 1e-9
            if abs(w[k, j]) > 1e-3:
                sign.setdefault(j, round(r.whitened / w[k, j]))
            assert abs(abs(r.whitened) - abs(w[k, j])) < 1e-6 and abs(r.whitened - sign.get(j, 1) * w[k, j]) < 1e-6


def vectors(m, d, seed, decay=1.5):
    rng = np.random.default_rng(seed)
    v = rng.normal(size=(m, d)) * np.logspace(0, -decay, d) @ np.linalg.qr(rng.normal(size=(d, d)))[0]
    return [(i, [float(c) for c in row.astype(np.float32)]) for i, row in enumerate(v)]


@pytest.mark.parametrize("m,d,parts", [(300, 8, 1), (500, 8, 40), (900, 40, 7), (12, 33, 3)])
def test_against_dense_solver(spark, m, d, parts):
    rows = vectors(m, d, m + d)
    check(whitening.whiten(spark.createDataFrame(rows, SCHEMA).repartition(parts)), rows)


def test_rows_that_drop_out(spark):
    rows = vectors(60, 5, 1)
    odd = [(100, None), (101, [1.0, None, 2.0, 3.0, 4.0]), (102, [float("nan")] + [1.0] * 4), (103, [1.0] * 4 + [float("inf")]),
           (104, []), (105, [1.0] * 4), (106, [3e38] * 5)]
    more = [(200, rows[0][1]), (201, rows[0][1])]        # repeated vectors count twice
    docs = spark.createDataFrame(rows + odd + more, SCHEMA).withColumns({c: F.lit(7) for c in ("id", "vec", "n", "component", "at")})
    check(whitening.whiten(docs), rows + more)
    some_null = spark.createDataFrame([(None, rows[0][1])] + rows, SCHEMA)
    assert whitening.whiten(some_null).filter("vec_id is null").count() == 5
    as_double = spark.createDataFrame(rows, SCHEMA).withColumn("embedding", F.col("embedding").cast("array<double>"))
    check(whitening.whiten(as_double), rows)


def test_few_equal_or_constant(spark):
    assert whitening.whiten(spark.createDataFrame([], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, None)], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA)).count() == 0
    assert whitening.whiten(spark.createDataFrame([(i, [1.0, 2.0]) for i in range(9)], SCHEMA)).count() == 0
    # equal eigenvalues: any basis, whitened rows keep their inner products
    rows = [(2 * k + s, [float((1 - 2 * s) * (j == k)) for j in range(6)]) for k in range(6) for s in range(2)]
    got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).toPandas().pivot(index="vec_id", columns="component", values="whitened")
    w = got.sort_index().to_numpy()
    assert np.allclose(w @ w.T, 6 * np.array([[(a // 2 == b // 2) * (1 - 2 * ((a + b) % 2)) for b in range(12)] for a in range(12)]), atol=1e-9)


def test_rank_one_updates_with_deflation():
    rng = np.random.default_rng(9)
    for d in (1, 2, 7, 30):
        values = np.sort(np.concatenate([np.zeros(d // 3), np.repeat(2.5, d // 3), rng.exponential(size=d - 2 * (d // 3)) * 10.0 ** rng.integers(-9, 4)]))
        basis = np.linalg.qr(rng.normal(size=(d, d)))[0]
        for v in (rng.normal(size=d), basis[:, 0] * 3, basis[:, -1] * 1e-9, np.zeros(d), basis[:, d // 2] + 1e-13 * rng.normal(size=d)):
            a = basis * values @ basis.T + np.outer(v, v)
            e, q = whitening.rank_one(values, basis, v)
            top = max(np.abs(a).max(), 1e-300)
            assert np.abs(q * e @ q.T - a).max() < 1e-13 * top * d and np.abs(q.T @ q - np.eye(d)).max() < 1e-13 * d
            assert (np.diff(e) >= 0).all()


def test_deviation_beyond_64_bits():
    c = np.array([[3, 4], [1 << 40, 1 << 40]], np.int64)
    assert whitening._deviation(c) == [25, None]
    assert whitening._exact(1 << 40, [5, -5], np.array([[1 << 39, 1]])).tolist() == [[(1 << 79) - 5, (1 << 40) + 5]]


def test_query(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding").collect()
    check(queries.QUERIES["op12_whitening"](spark, "/root/testdata/sf0.001"), [(r[0], list(r[1])) for r in rows])
