"""SparkSession construction and the shared folder for lineage cuts.

Library code never creates a session; it receives one. The builder exists for
tests, the benchmark and command-line use. On a cluster the session comes from
the environment.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build(master: str | None = None, shuffle_partitions: int = 8, app: str = "salesguard",
          extra: dict | None = None) -> SparkSession:
    """Local/test session: UTC, AQE on, UI off, small shuffle partition count."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULTS)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("SALESGUARD_DRIVER_MEMORY", "4g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, for lineage cuts.

    The folder the operator set with ``setCheckpointDir`` wins, then the
    setting ``spark.checkpoint.dir``. Nothing is invented: with neither, this
    raises, since a driver-local folder is unreadable for executors.
    """
    current = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        raise RuntimeError("no shared folder for intermediate tables: set spark.checkpoint.dir "
                           "(or call setCheckpointDir) to a folder that the driver and all executors reach")
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path of its own under the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/salesguard-{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    Reliable (it survives lost executors) and columnar, so later reads prune
    columns and push filters. The table stays until the folder's owner, or
    ``release``, removes it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(*frames: DataFrame) -> None:
    """Delete the tables behind frames made by ``cut`` and no longer needed."""
    for df in frames:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            if "/salesguard-" in folder:
                p = jvm.org.apache.hadoop.fs.Path(folder)
                p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
