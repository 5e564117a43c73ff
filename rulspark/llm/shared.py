"""What several operators need: reading a table, dealing rows into folds, fixing rows."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulspark.session import durable

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
PACKAGE = Path(__file__).resolve().parents[1]


def ready(spark: SparkSession) -> None:
    """Small Arrow batches, since a row holds a whole text, unless the session says otherwise;
    and local workers that can import this package wherever the driver was started.

    A cluster gets the package as any Python code, by ``--py-files`` or PYTHONPATH.
    """
    if spark.conf.get(BATCH_ROWS) == "10000":
        spark.conf.set(BATCH_ROWS, "2000")
    context = spark.sparkContext
    if context._jsc.sc().isLocal() and not any(f.rstrip("/").endswith(f"/{PACKAGE.name}") for f in context.listFiles):
        context.addFile(str(PACKAGE), recursive=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ready(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, folds: int) -> Column:
    """The fold of a document: crc32 of its id as text, modulo ``folds``; null for null."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fixed(df: DataFrame) -> DataFrame:
    """The same rows, narrow ones, stored in the folder that the cluster names for checkpoints."""
    return durable(df)


def one_label(labels: DataFrame, name: str) -> DataFrame:
    """One row per document: 1 if at least half of its labels are 1. Nulls are no labels."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(name).isNotNull())
    return known.groupBy("doc_id").agg((F.avg(name) >= 0.5).cast("double").alias("_label"))


def free_names(df: DataFrame, *wanted: str) -> tuple[str, ...]:
    """The wanted names, with underscores added until no column of ``df`` has them."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return tuple(out)
