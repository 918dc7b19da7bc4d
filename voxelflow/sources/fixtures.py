"""Volumes derived from the driver's tables.

The driver ships TPC-H-like tables, not microscopy volumes, so the engine's
inputs are derived from them with plain relational code (see FIXTURES.md §3):

* ``V`` label volume ``(x, y, z, label)`` from ``lineitem``;
* ``M`` label multiset ``(x, y, z, label, n)`` from ``lineitem``;
* ``A`` dense affinity volume ``(x, y, z, c, a, seg)`` from ``embeddings``.

Each derivation exists twice: as a DataFrame builder (used by the queries) and
as a SQL text (used by the DuckDB oracles).  Both must stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

# Fixed parameters of the derived volumes (FIXTURES.md §3).
V_GRID = (32, 128, 16)          # x = orderkey % 32, y = partkey % 128, z = suppkey % 16
V_REGION = (5, 6, 4)            # label boxes
A_SHAPE_XY = (16, 20)           # A is 16 x 20 x ceil(N/20)
A_CHANNELS = 4
AFFINITY_OFFSETS = ((-1, 0, 0), (0, -1, 0), (0, 0, -1))   # channels 0..2
GLIA_CHANNEL = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def label_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """V: sparse label volume, background 0, box-shaped regions plus noise."""
    li = table(spark, sf_dir, "lineitem")
    g = (li.select((F.col("l_orderkey") % 32).alias("x"),
                   (F.col("l_partkey") % 128).alias("y"),
                   (F.col("l_suppkey") % 16).alias("z"),
                   F.col("l_linenumber"))
           .groupBy("x", "y", "z").agg(F.sum("l_linenumber").alias("s")))
    s = F.col("s")
    region = (F.lit(1) + F.floor(F.col("x") / 5) + F.floor(F.col("y") / 6) * 7
              + F.floor(F.col("z") / 4) * 200)
    label = (F.when(s % 7 == 0, F.lit(0))
             .otherwise(region + F.when(s % 7 == 1, 1).otherwise(0)))
    return g.select(F.col("x").cast("bigint").alias("x"), F.col("y").cast("bigint").alias("y"),
                    F.col("z").cast("bigint").alias("z"), label.cast("bigint").alias("label"))


def multiset_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M: label multiset in long form, several lineitems fall into one voxel."""
    li = table(spark, sf_dir, "lineitem")
    return (li.select((F.col("l_orderkey") % 32).cast("bigint").alias("x"),
                      (F.col("l_partkey") % 128).cast("bigint").alias("y"),
                      (F.col("l_suppkey") % 16).cast("bigint").alias("z"),
                      (F.col("l_quantity").cast("bigint") % 6).alias("label"))
              .groupBy("x", "y", "z", "label").agg(F.count(F.lit(1)).alias("n")))


def affinity_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A: dense 4-channel affinities; values are multiples of 1/1024."""
    emb = table(spark, sf_dir, "embeddings")
    e = emb.select("vec_id", "label", F.posexplode("embedding").alias("p", "v"))
    p = F.col("p").cast("bigint")
    return e.select(
        (p % 16).alias("x"),
        (F.col("vec_id") % 20).cast("bigint").alias("y"),
        F.floor(F.col("vec_id") / 20).cast("bigint").alias("z"),
        F.floor(p / 16).cast("bigint").alias("c"),
        (F.floor((F.col("v").cast("double") + 1) * 512) / 1024).alias("a"),
        F.col("label").cast("bigint").alias("seg"))


def edge_affinities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channels 0..2 of A: ``(x, y, z, c, a)``."""
    return affinity_volume(spark, sf_dir).filter(F.col("c") < 3).select("x", "y", "z", "c", "a")


def relief_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Channel 3 of A as a scalar relief ``(x, y, z, v)``."""
    return (affinity_volume(spark, sf_dir).filter(F.col("c") == GLIA_CHANNEL)
            .select("x", "y", "z", F.col("a").alias("v")))


def glia_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (affinity_volume(spark, sf_dir).filter(F.col("c") == GLIA_CHANNEL)
            .select("x", "y", "z", F.col("a").alias("g")))


def mask_volume(spark: SparkSession, sf_dir: str, thr: float = 0.45) -> DataFrame:
    return (affinity_volume(spark, sf_dir).filter(F.col("c") == GLIA_CHANNEL)
            .select("x", "y", "z", F.when(F.col("a") > thr, 1).otherwise(0).alias("m")))


def seg_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``seg`` column of A: a spatially coherent label volume (0..9)."""
    return (affinity_volume(spark, sf_dir).filter(F.col("c") == 0)
            .select("x", "y", "z", F.col("seg").alias("label")))


def offsets_df(spark: SparkSession, offsets=AFFINITY_OFFSETS) -> DataFrame:
    """Tiny ``(c, dx, dy, dz)`` table: one row per channel (size = #offsets)."""
    rows = [(i, int(o[0]), int(o[1]), int(o[2])) for i, o in enumerate(offsets)]
    return spark.createDataFrame(rows, "c bigint, dx bigint, dy bigint, dz bigint")


# ---------------------------------------------------------------------------
# The same derivations as SQL for the DuckDB oracle.  Use as CTEs:
#   WITH {V_SQL} SELECT ... FROM V
# ---------------------------------------------------------------------------

V_SQL = """V AS (
  SELECT x, y, z,
         CAST(CASE WHEN s % 7 = 0 THEN 0
              ELSE 1 + CAST(floor(x / 5.0) AS BIGINT) + 7 * CAST(floor(y / 6.0) AS BIGINT)
                     + 200 * CAST(floor(z / 4.0) AS BIGINT)
                     + (CASE WHEN s % 7 = 1 THEN 1 ELSE 0 END) END AS BIGINT) AS label
  FROM (SELECT CAST(l_orderkey % 32 AS BIGINT) AS x, CAST(l_partkey % 128 AS BIGINT) AS y,
               CAST(l_suppkey % 16 AS BIGINT) AS z, sum(l_linenumber) AS s
        FROM lineitem GROUP BY 1, 2, 3) t
)"""

M_SQL = """M AS (
  SELECT CAST(l_orderkey % 32 AS BIGINT) AS x, CAST(l_partkey % 128 AS BIGINT) AS y,
         CAST(l_suppkey % 16 AS BIGINT) AS z,
         CAST(CAST(l_quantity AS BIGINT) % 6 AS BIGINT) AS label, count(*) AS n
  FROM lineitem GROUP BY 1, 2, 3, 4
)"""

A_SQL = """A AS (
  SELECT CAST(p % 16 AS BIGINT) AS x, CAST(vec_id % 20 AS BIGINT) AS y,
         CAST(vec_id // 20 AS BIGINT) AS z, CAST(p // 16 AS BIGINT) AS c,
         floor((v + 1) * 512) / 1024 AS a, CAST(label AS BIGINT) AS seg
  FROM (SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS p,
               CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) e
),
AFF AS (SELECT x, y, z, c, a FROM A WHERE c < 3),
RELIEF AS (SELECT x, y, z, a AS v FROM A WHERE c = 3),
GLIA AS (SELECT x, y, z, a AS g FROM A WHERE c = 3),
MASK AS (SELECT x, y, z, CASE WHEN a > 0.45 THEN 1 ELSE 0 END AS m FROM A WHERE c = 3),
SEG AS (SELECT x, y, z, seg AS label FROM A WHERE c = 0),
OFFS AS (SELECT * FROM (VALUES (0, -1, 0, 0), (1, 0, -1, 0), (2, 0, 0, -1)) o(c, dx, dy, dz))"""


def with_sql(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
