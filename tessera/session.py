"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile

from pyspark.sql import SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app: str = "tessera") -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    On a cluster, master, memory and shuffle sizing come from spark-submit /
    spark-defaults and are left alone; only a local run (no master
    configured, or an explicit ``local[...]``) gets a local master, driver
    memory and shuffle partitions sized to its cores.
    """
    from pyspark import SparkConf

    conf = SparkConf()
    configured = master or conf.get("spark.master", None) or os.environ.get("SPARK_MASTER")
    is_local = configured is None or configured.startswith("local")
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    if is_local:
        cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count() or 8)
        if not master:
            builder = builder.master(f"local[{cpus}]")
        builder = builder.config("spark.driver.memory", os.environ.get("TESSERA_DRIVER_MEMORY", "16g"))
        if shuffle_partitions is None:
            shuffle_partitions = int(os.environ.get("TESSERA_SHUFFLE_PARTITIONS", cpus))
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Only a local run (a laptop or a test)
    without one gets a fresh scratch folder, removed when Python ends; on a
    cluster a machine-local folder would be out of the executors' reach, so a
    missing setting is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None)
    if not conf:
        if not is_local_master(sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        conf = tempfile.mkdtemp(prefix="tessera-ckpt-")
        atexit.register(shutil.rmtree, conf, ignore_errors=True)
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def is_local_master(master: str) -> bool:
    """Whether driver and executors are one process (``local-cluster`` isn't)."""
    return master == "local" or master.startswith("local[")


def cut_lineage(df):
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def remove_checkpoint(df) -> None:
    """Delete the files of a frame made by ``cut_lineage`` that nothing reads any more."""
    file = df._jdf.queryExecution().logical().rdd().getCheckpointFile()
    if file.isDefined():
        remove_folder(df.sparkSession, file.get())


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store that this session wrote, through Spark's file system."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def forget_finished(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files and broadcasts of steps whose results are written.

    They go when the driver's JVM finds that nothing refers to them any more; a job of
    many steps would otherwise keep all of them until the JVM happens to run short.
    """
    import gc

    gc.collect()
    spark.sparkContext._jvm.System.gc()
