"""The flagship query: from raw readings to a drift status per dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulspark.functions.columns import col
from rulspark.operators.metrics import metrics_rollup
from rulspark.operators.monitoring import drift_tier
from rulspark.operators.projection import clip_label
from rulspark.operators.rolling import multiscale_features
from rulspark.plans.frames import readings
from rulspark.schema import CLIPPED_LABEL


def drift_by_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings, labels, rolling features, a one-line predictor, metrics, status."""
    labelled = clip_label(readings(spark, sf_dir))
    features = multiscale_features(
        labelled, ["s1", "s2"], keep=["unit", "time", "dataset", "seq", CLIPPED_LABEL]
    )
    guess = F.lit(45.0) + col("s1_acceleration") - col("s2_acceleration")
    scored = features.select(
        "dataset",
        guess.cast("float").alias("RUL_Predicted"),
        col(CLIPPED_LABEL).cast("float").alias("RUL_Actual"),
    )
    return drift_tier(metrics_rollup(scored)).select(
        "dataset", "is_total", "n", "rmse", "mae", "drift_status", "drift_reason"
    )
