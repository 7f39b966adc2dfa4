"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every session of ours wants. Partition counts are not fixed here:
# AQE coalesces shuffle partitions from the runtime sizes, and the cluster
# sets ``spark.sql.shuffle.partitions`` for its own core count.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app_name: str = "tarmac",
              conf: dict | None = None) -> SparkSession:
    """Build (or return) a session with AQE on and the UI off."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULT_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def remove_tables(spark: SparkSession) -> None:
    """Remove the tables that ``materialize`` wrote for this application.

    Call it when no DataFrame that reads them is needed any more.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(os.path.join(ensure_checkpoint_dir(spark), "tables"))
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder (HDFS, S3,
    ...) and is used as is. Only a local-mode session without that setting
    (tests, a laptop) gets a fresh temporary folder of its own.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster job needs a shared folder")
        configured = tempfile.mkdtemp(prefix="tarmac-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return configured
