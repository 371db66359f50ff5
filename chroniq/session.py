"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_KEY = "spark.checkpoint.dir"


def build_session(app_name: str = "chroniq", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine is designed for.

    No master is set unless asked for, so that ``spark-submit`` decides on a cluster.
    Extra settings are passed with ``_`` in place of ``.`` or through ``conf`` as they are.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # Call sites of every column expression cost more than planning the query.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key if "." in key else key.replace("_", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Only where ``spark.checkpoint.dir`` is unset and the job runs in one local JVM is a
    temporary folder used; a real cluster without the setting is refused.
    """
    configured = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="chroniq-")
    spark.conf.set(CHECKPOINT_KEY, folder)
    return folder


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared folder.

    Who asks for it may remove it when done. What lazily returned frames still read is removed when the driver ends.
    """
    folder = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove_quietly, spark, folder)
    return folder


def remove_path(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def _remove_quietly(spark: SparkSession, folder: str) -> None:
    with contextlib.suppress(Exception):  # the gateway may be gone
        remove_path(spark, folder)


def stage(df: DataFrame, folder: str, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to a folder on shared storage and read it back.

    Cuts the lineage for a frame that feeds several actions. The files outlive any
    executor, unlike cached or locally checkpointed blocks. Texts are worth ``zstd``.
    """
    path = f"{folder}/{name}"
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
