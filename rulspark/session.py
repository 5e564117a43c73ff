"""Session defaults and durable intermediate results."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # The JVM leaves longer methods uncompiled; past this size Spark evaluates wide
    # projections by smaller generated methods instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}
# Fixed once the session starts. Call sites in error messages cost a stack walk per column
# expression; checkpoints go with their last reference.
STATIC = {
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "rulspark", master: str | None = None, **conf) -> SparkSession:
    """A session with ``conf``; this library's defaults fill in what is not set.

    A value given to the builder would override ``spark-submit --conf``, so defaults are
    set afterwards, and only where neither the submit nor ``conf`` names a value.
    """
    if (running := SparkSession.getActiveSession()) is not None:
        return running
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    # Under spark-submit the JVM already holds the submitted values.
    static = {} if "PYSPARK_GATEWAY_PORT" in os.environ else STATIC
    for key, value in {**static, **conf}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    given = dict(session.sparkContext.getConf().getAll())
    for key, value in DEFAULTS.items():
        if key not in given:
            session.conf.set(key, value)
    return session


def is_local(spark: SparkSession) -> bool:
    return spark.sparkContext._jsc.sc().isLocal()


def workers_import(spark: SparkSession) -> None:
    """Local workers that can import this package wherever the driver was started.

    A cluster gets the package as any Python code, by ``--py-files`` or PYTHONPATH.
    """
    package = Path(__file__).resolve().parent
    context = spark.sparkContext
    if is_local(spark) and not any(f.rstrip("/").endswith(f"/{package.name}") for f in context.listFiles):
        context.addFile(str(package), recursive=True)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``, as the cluster names it.

    A session on one machine may leave it unset and gets a folder of its warehouse; on a
    cluster that is an error, for executors would not see each other's files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise ValueError("name a folder that all executors share in spark.checkpoint.dir")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; the driver removes it when it ends."""
    path = f"{shared_dir(spark)}/rulspark-{label}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(hadoop)
    files.deleteOnExit(hadoop)
    return f"{path}/rows"


def durable(df: DataFrame) -> DataFrame:
    """The same rows, stored in the shared folder.

    Cuts the lineage: a lost executor re-reads the checkpoint instead of running the plan
    again, and every reader sees the very same rows in the same partitions. For narrow rows:
    checkpoints are not pruned. Spark removes them with their last reference where
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` is set.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
