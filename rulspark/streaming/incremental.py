"""Snapshots flattened and labelled as they arrive."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from rulspark.operators.silver import silver_frame
from rulspark.schema import BRONZE_SCHEMA
from rulspark.sources.writers import overwrite_snapshots

LANDING_SCHEMA = T.StructType([*BRONZE_SCHEMA, T.StructField("arrival", T.LongType())])
ARRIVALS_SCHEMA = "snapshot_date date, arrival long"


def arrivals_path(landing: str) -> str:
    """Where completed arrivals are noted, one file each; readers of the rows pass it over."""
    return f"{landing.rstrip('/')}/_commits/arrivals"


def land(bronze: DataFrame, landing: str, arrival: int | None = None) -> None:
    """Add bronze rows to the landing folder, by day and arrival, then note the arrival.

    ``arrival`` rises from one delivery to the next (the time in nanoseconds unless given);
    a day that comes again replaces what came before. Rows count only once their arrival is
    noted, so a delivery that is under way or broke off hides nothing; sent again, under the
    same number or another, it is whole.
    """
    number = time.time_ns() if arrival is None else arrival
    rows = bronze.withColumn("arrival", F.lit(number).cast("long"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "snapshot_date", "arrival"
    ).parquet(landing)
    stored = bronze.sparkSession.read.schema(LANDING_SCHEMA).parquet(landing).where(F.col("arrival") == number)
    # One file, so all days of an arrival appear at once.
    stored.select("snapshot_date", "arrival").distinct().coalesce(1).write.mode("append").parquet(
        arrivals_path(landing)
    )


def latest_arrival(landed: DataFrame, arrivals: DataFrame) -> DataFrame:
    """Rows of each snapshot's last completed arrival."""
    last = arrivals.groupBy("snapshot_date").agg(F.max("arrival").alias("arrival"))
    return landed.join(F.broadcast(last), ["snapshot_date", "arrival"], "left_semi")  # one row per day


def incremental_snapshots(
    spark: SparkSession,
    landing: str,
    silver: str,
    checkpoint: str,
    aux_layout: str = "with_dataset",
    max_files: int | None = None,
) -> StreamingQuery:
    """Process every completed arrival not seen yet, then stop.

    The checkpoint remembers what is done, so a rerun without new arrivals does nothing. A batch
    names the days it touches; each is rebuilt whole from its last completed arrival, read by the
    days' folders alone, and replaces its silver partition. So a resent day replaces the day, a
    batch replayed after a failure leaves no half snapshot and no duplicate, and rows of an
    arrival that is still being written are not seen.
    """

    def replace(batch: DataFrame, _: int) -> None:
        days = [r[0] for r in batch.select("snapshot_date").distinct().collect()]  # days of one batch
        read = batch.sparkSession.read
        touched = F.col("snapshot_date").isin(days)
        table = read.schema(LANDING_SCHEMA).parquet(landing).where(touched)
        arrivals = read.schema(ARRIVALS_SCHEMA).parquet(arrivals_path(landing)).where(touched)
        overwrite_snapshots(silver_frame(latest_arrival(table, arrivals).drop("arrival"), aux_layout), silver)

    stream = spark.readStream.schema(ARRIVALS_SCHEMA)
    if max_files is not None:
        stream = stream.option("maxFilesPerTrigger", max_files)
    return (
        stream.parquet(arrivals_path(landing))
        .writeStream.foreachBatch(replace)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
