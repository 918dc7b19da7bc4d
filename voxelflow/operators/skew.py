"""Equi-joins whose left side may hold a hot key.

A key that holds more than 1/``HOT_SHARE`` of the left rows is hot; there are
fewer than ``HOT_SHARE`` such keys, whatever the data (pigeonhole), so the right
rows of the hot keys are broadcast with a proven bound.  Rows of hot keys take
their value from that broadcast and are dealt out by a salt; all other rows
take part in an ordinary shuffled join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_SHARE = 1000
SALTS = 1024


def hot_keys(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    """The keys of ``counts(key, n)`` that hold more than 1/HOT_SHARE of the total.

    Fewer than HOT_SHARE rows.  ``counts`` is read twice: pass a cut or cheap frame.
    """
    total = counts.agg(F.sum(n)).scalar()
    return counts.filter(F.col(n) * F.lit(HOT_SHARE) > total).select(key)


def join_unique(left: DataFrame, right: DataFrame, key: str, counts: DataFrame | None = None,
                n: str = "n") -> DataFrame:
    """``left`` left-joined to ``right`` (one row per ``key``), without a hot task.

    ``counts(key, n)`` gives the left rows per key; computed when not passed.
    Columns of ``right`` other than ``key`` are null where nothing matches; a
    null key matches nothing.
    """
    if counts is None:
        counts = left.groupBy(key).agg(F.count(F.lit(1)).alias(n))
    vals = [c for c in right.columns if c != key]
    hot = hot_keys(counts.select(key, n).filter(F.col(key).isNotNull()), key, n)
    hot_right = right.join(F.broadcast(hot), key).select(
        F.col(key).alias("_hk"), F.struct(*vals).alias("_hv"))
    cols = left.columns
    marked = (left.join(F.broadcast(hot_right), F.col(key) == F.col("_hk"), "left")
                  .withColumn("_salt", F.when(F.col("_hk").isNull() & F.col(key).isNotNull(), F.lit(0))
                              .otherwise(1 + F.pmod(F.xxhash64(*cols), F.lit(SALTS)).cast("int"))))
    r = right.select(F.col(key).alias("_rk"), F.lit(0).alias("_rs"), F.struct(*vals).alias("_rv"))
    out = marked.join(r, (F.col(key) == F.col("_rk")) & (F.col("_salt") == F.col("_rs")), "left")
    return out.select(*cols, *[F.coalesce(F.col("_hv")[v], F.col("_rv")[v]).alias(v) for v in vals])
