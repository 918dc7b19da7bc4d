"""Spark session helpers: building a session for tests/bench, and lineage cuts.

Iterative operators (connected components, flooding, mutex clustering) cut
their lineage every few rounds with ``DataFrame.checkpoint``.  The checkpoint
folder is the cluster's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(master: str | None = None, shuffle_partitions: int = 8,
                  app_name: str = "voxelflow", extra: dict | None = None) -> SparkSession:
    """Session with the settings the engine assumes (AQE on, UI off)."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point the SparkContext at the shared checkpoint folder.

    The folder is the one the session names in ``spark.checkpoint.dir``; it has
    to be shared by driver and executors.  An unset value is an error: a
    machine-local folder would not survive the loss of an executor.  Tests and
    the bench set a scratch folder of their own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    d = spark.conf.get(CHECKPOINT_CONF, None)
    if not d:
        raise RuntimeError(
            f"{CHECKPOINT_CONF} must name a shared folder for iterative operators")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the reliable checkpoint folder and drop its lineage.

    The checkpointed DataFrame is rebuilt from the checkpointed RDD and the
    schema: a plain ``checkpoint()`` result still carries its origin logical
    plan, and in a loop that reuses the result twice per round the planning
    cost then doubles every round.  The rebuilt frame references only the
    checkpoint files, so a lost executor re-reads them instead of recomputing.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    c = df.checkpoint(eager=True)
    rdd = c._jdf.queryExecution().analyzed().rdd()
    jdf = spark._jsparkSession.createDataFrame(c._jdf.rdd(), c._jdf.schema())
    out = DataFrame(jdf, spark)
    out._checkpoint_rdd = rdd
    return out


def drop_checkpoint(df: DataFrame | None) -> None:
    """Delete the files behind a ``cut_lineage`` frame that nothing reads any more.

    Loops call it once the next round is materialised, so the folder holds the
    current and the previous round only.  Frames of other origin are left alone.
    """
    rdd = getattr(df, "_checkpoint_rdd", None)
    if rdd is None:
        return
    f = rdd.getCheckpointFile()
    if f.isDefined():
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(f.get())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
