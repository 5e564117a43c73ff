"""Raw archives to the bronze table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulspark.functions.columns import col
from rulspark.operators.projection import union_all


def ingest_bronze(
    dev: DataFrame, test: DataFrame, snapshot_date, position_col: str = "position"
) -> DataFrame:
    """Both splits of an archive, complete, stamped with the snapshot's date.

    ``position_col`` is the row's place in its source array and becomes ``seq``,
    the order inside a flight cycle. ``snapshot_date`` is a date or a column.
    """
    date = snapshot_date if not isinstance(snapshot_date, str) else F.lit(snapshot_date).cast("date")
    both = union_all(
        [dev.withColumn("split", F.lit("dev")), test.withColumn("split", F.lit("test"))]
    )
    return both.withColumnRenamed(position_col, "seq").withColumn("snapshot_date", date)


def union_archives(archives: Sequence[DataFrame]) -> DataFrame:
    """Archives stacked in the given order, each numbered from 1 as ``dataset``."""
    return union_all(
        [df.withColumn("dataset", F.lit(i).cast("int")) for i, df in enumerate(archives, 1)]
    )


def rows_per_snapshot(bronze: DataFrame) -> DataFrame:
    return bronze.groupBy(col("snapshot_date")).agg(F.count("*").alias("n"))
