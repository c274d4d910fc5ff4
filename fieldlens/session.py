"""Session defaults and the shared working folder."""

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


# Generated methods above the JVM's own limit for compiling (8000 bytes of code) would run interpreted;
# with this setting Spark splits such stages instead. Wide band projections and aggregates need it.
METHOD_LIMIT = ("spark.sql.codegen.hugeMethodLimit", "8000")


def build_session(master=None, shuffle_partitions=None, **conf):
    """A session with the settings the operators rely on: UTC, AQE, Arrow."""
    builder = (
        SparkSession.builder.appName("fieldlens")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config(*METHOD_LIMIT)
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark):
    """Folder every executor can reach: the cluster's checkpoint folder.

    Only where the session names none and everything runs on one machine (tests, local runs) a temporary one is made and
    set; on a cluster without one there is no place that all executors see, so that raises.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="fieldlens-")
        spark.sparkContext.setCheckpointDir(found)
        found = spark.sparkContext.getCheckpointDir()
    return found


def scratch_path(spark, name):
    """A fresh path below the shared folder."""
    return os.path.join(shared_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


# Paths of the tables that this process has written to the shared folder and not removed, by application.
_WRITTEN = {}


def written(spark):
    """Paths of the tables written by ``materialize`` up to now, oldest first."""
    return _WRITTEN.setdefault(spark.sparkContext.applicationId, [])


def materialize(df, name="table", partition_by=()):
    """Write a table to the shared folder and read it back: later steps start from the files.

    Used where several jobs go on from the same expensive result; it survives lost executors. Tables stay until
    ``remove_tables``, as frames that read them may be run at any time.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.partitionBy(*partition_by).parquet(path)
    written(df.sparkSession).append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark, path):
    """Delete a folder or file, wherever it is stored."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def remove_tables(spark, since=0, keep=0):
    """Delete the tables written since there were ``since`` of them, but the last ``keep``: for callers that have written what they
    go on from, and know that nothing reads what came before it."""
    paths = written(spark)
    gone = paths[since:len(paths) - keep]
    for path in gone:
        remove(spark, path)
    paths[since:len(paths) - keep] = []
