"""Spark session and checkpoint-directory helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast only on measured sizes: no broadcast from file-size estimates
    # at planning time; AQE converts a join once the runtime size is known.
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "16MB",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "rankwright", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if (master or "local").startswith("local"):
        # Local mode: the driver JVM is the whole cluster (ignored if already running).
        conf["spark.driver.memory"] = "8g"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the cluster's shared ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (tests, laptops) gets a
    private temporary folder; on a cluster a missing setting is an error,
    because a machine-local folder would not survive losing an executor.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder (HDFS/S3) for this cluster")
    path = tempfile.mkdtemp(prefix="rankwright-ckpt-")
    sc.setCheckpointDir(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def retire(*frames: DataFrame) -> None:
    """Free the disk that superseded frames of :func:`cut_lineage` hold.

    Their checkpoint files are deleted; shuffle files of plans that nothing refers to go when Spark's cleaner
    hears of the driver's collected garbage, so that is collected here.  Only for frames whose
    every reader has been cut from them."""
    import gc
    jvm = None
    for df in frames:
        jvm = df.sparkSession._jvm
        plan = df._jdf.queryExecution().logical()
        if not plan.getClass().getSimpleName() == "LogicalRDD":
            raise ValueError("only checkpointed frames can be retired")
        file = plan.rdd().getCheckpointFile()
        if file.isDefined():
            path = jvm.org.apache.hadoop.fs.Path(file.get())
            path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)
    del frames
    gc.collect()
    if jvm is not None:
        jvm.System.gc()


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Repartition a CPU-heavy input only when its scan yields fewer partitions
    than the cluster can run at once (e.g. one large row group); on a real
    multi-file dataset the scan is already parallel and nothing is shuffled."""
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *keys) if keys else df.repartition(target)


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``rankwright`` importable in Python workers (as ``--py-files``
    would): zip the package once per SparkContext and ``addPyFile`` it, so
    pandas functions that refer to package code work on any executor, whatever
    the driver's working directory."""
    import os
    import zipfile
    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="rankwright-pyfiles-"), "rankwright.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    zf.write(path, os.path.join("rankwright", os.path.relpath(path, root)))
    sc.addPyFile(target)
    _SHIPPED.add(key)
