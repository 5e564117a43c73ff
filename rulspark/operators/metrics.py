"""Error metrics: per snapshot, dataset, engine, life stage and model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulspark.errors import MissingColumns
from rulspark.functions.columns import col, correlation, pct_change, squared
from rulspark.operators.projection import require_columns
from rulspark.schema import HIGH_LIFE, LOW_LIFE


def _predicted() -> Column:
    return F.col("RUL_Predicted")


def _actual() -> Column:
    return F.col("RUL_Actual")


def _error() -> Column:
    """Single-precision error, then widened so that sums do not lose digits."""
    return (_predicted() - _actual()).cast("float").cast("double")


def rmse() -> Column:
    return F.sqrt(F.avg(squared(_error())))


def mae() -> Column:
    return F.avg(F.abs(_error()))


def _grouped(df: DataFrame, by: Sequence[str]):
    return df.groupBy(*[col(b) for b in by])


def rmse_mae(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _grouped(df, by).agg(rmse().alias("rmse"), mae().alias("mae"))


def accuracy(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """RMSE, MAE, R² and number of rows."""
    actual = _actual().cast("double")
    total = F.count(_actual()) * F.var_pop(actual)
    explained = F.try_divide(F.sum(squared(_error())), total)
    return _grouped(df, by).agg(
        rmse().alias("rmse"),
        mae().alias("mae"),
        (F.lit(1.0) - explained).alias("r2"),
        F.count(F.lit(1)).alias("n"),
    )


def r2(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return accuracy(df, by).select(*by, "r2")


def metrics_sequence(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Metric set of the sequence model; deviations are population ones."""
    require_columns(df, ["unit", "time", "RUL_Predicted", "RUL_Actual", "Prediction_Error"])
    error = F.col("Prediction_Error").cast("double")
    return _grouped(df, by).agg(
        F.sqrt(F.avg(squared(error))).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        F.avg(_predicted().cast("double")).alias("mean_pred"),
        F.stddev_pop(_predicted().cast("double")).alias("std_pred"),
        F.avg(_actual().cast("double")).alias("mean_actual"),
        F.stddev_pop(_actual().cast("double")).alias("std_actual"),
        F.count(F.lit(1)).alias("n_predictions"),
        F.count_distinct("unit").alias("n_engines"),
    )


def metrics_tabular(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Metric set of the tabular model."""
    require_columns(df, ["RUL_Predicted", "RUL_Actual"])
    return _grouped(df, by).agg(
        rmse().alias("rmse"),
        mae().alias("mae"),
        F.count(F.lit(1)).alias("prediction_count"),
        F.avg(_error()).alias("residual_mean"),
        F.stddev_pop(_error()).alias("residual_std"),
    )


def _sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.sum(squared(_error())).alias("_sse"),
        F.sum(F.abs(_error())).alias("_sae"),
    ]


def _from_sums(n: Column, sse: Column, sae: Column) -> list[Column]:
    return [F.sqrt(F.try_divide(sse, n)).alias("rmse"), F.try_divide(sae, n).alias("mae")]


def metrics_rollup(df: DataFrame, by: str = "dataset") -> DataFrame:
    """RMSE and MAE per dataset and over all (``is_total`` = 1).

    Rolls up the per-dataset sums, so the rows themselves are reduced once.
    """
    sums = df.groupBy(col(by)).agg(*_sums())
    rolled = sums.rollup(col(by)).agg(
        F.grouping_id().cast("int").alias("is_total"),
        F.sum("n").alias("n"),
        F.sum("_sse").alias("_sse"),
        F.sum("_sae").alias("_sae"),
    )
    return rolled.select(
        by, "is_total", "n", *_from_sums(F.col("n"), F.col("_sse"), F.col("_sae"))
    )


def unit_metrics(df: DataFrame, unit: str = "unit") -> DataFrame:
    """Number of predictions, RMSE and MAE of every engine."""
    sums = df.groupBy(col(unit)).agg(*_sums())
    return sums.select(
        unit,
        F.col("n").alias("n_predictions"),
        *_from_sums(F.col("n"), F.col("_sse"), F.col("_sae")),
    )


def unit_rmse(df: DataFrame, unit: str = "unit") -> DataFrame:
    """Engines from best to worst."""
    return unit_metrics(df, unit).select(unit, "rmse").orderBy("rmse", unit)


def pooled_vs_unit(df: DataFrame, unit: str = "unit") -> DataFrame:
    """RMSE over all rows against the mean of the engines' RMSE, from one pass."""
    sums = df.groupBy(col(unit)).agg(*_sums())
    engines = sums.select(
        "n", "_sse", "_sae", *_from_sums(F.col("n"), F.col("_sse"), F.col("_sae"))
    )
    out = engines.agg(
        F.sqrt(F.try_divide(F.sum("_sse"), F.sum("n"))).alias("pooled_rmse"),
        F.try_divide(F.sum("_sae"), F.sum("n")).alias("pooled_mae"),
        F.avg("rmse").alias("unit_rmse_mean"),
        F.stddev_samp("rmse").alias("unit_rmse_std"),
        F.avg("mae").alias("unit_mae_mean"),
        F.min("rmse").alias("unit_rmse_min"),
        F.max("rmse").alias("unit_rmse_max"),
        F.count(F.lit(1)).alias("n_engines"),
    )
    return out.withColumn("rmse_gap", F.abs(F.col("pooled_rmse") - F.col("unit_rmse_mean")))


def error_stats(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Error moments, value ranges and correlation of actual and predicted."""
    return _grouped(df, by).agg(
        F.avg(_error()).alias("error_mean"),
        F.stddev_pop(_error()).alias("error_std"),
        F.min(_error()).alias("error_min"),
        F.max(_error()).alias("error_max"),
        F.min(_predicted().cast("double")).alias("pred_min"),
        F.max(_predicted().cast("double")).alias("pred_max"),
        F.min(_actual().cast("double")).alias("actual_min"),
        F.max(_actual().cast("double")).alias("actual_max"),
        correlation(_actual(), _predicted()).alias("correlation"),
    )


def calibration(stats: DataFrame, bias_limit: float = 1.0) -> DataFrame:
    """Verdicts on bias and correlation; ``bias_limit`` is 1 or 5 cycles."""
    bias = F.col("error_mean")
    return stats.select(
        *[c for c in stats.columns if c not in ("error_mean", "correlation")],
        "error_mean",
        "correlation",
        F.when(F.abs(bias) < bias_limit, "calibrated")
        .when(bias > 0, "over-predicting")
        .otherwise("under-predicting")
        .alias("bias_verdict"),
        F.when(F.col("correlation") > 0.9, "strong")
        .when(F.col("correlation") > 0.7, "good")
        .otherwise("weak")
        .alias("correlation_verdict"),
    )


def life_stage(actual: Column, low: float = LOW_LIFE, high: float = HIGH_LIFE) -> Column:
    return (
        F.when(actual > high, "early").when(actual >= low, "mid").when(actual < low, "end")
    )


def lifecycle_errors(
    df: DataFrame, low: float = LOW_LIFE, high: float = HIGH_LIFE, by: Sequence[str] = ()
) -> DataFrame:
    """Errors early, midway and at the end of life."""
    staged = df.withColumn("stage", life_stage(_actual(), low, high))
    return _grouped(staged, [*by, "stage"]).agg(
        F.count(F.lit(1)).alias("n"), rmse().alias("rmse"), mae().alias("mae")
    )


def model_comparison(metrics: DataFrame, reference: str, equivalent_below: float = 1.0) -> DataFrame:
    """Change of each model's RMSE against ``reference`` and the winner, per split.

    ``metrics`` holds one row per split and model, so its windows are tiny.
    """
    if not {"split", "model", "rmse", "mae"} <= set(metrics.columns):
        raise MissingColumns(["split", "model", "rmse", "mae"], metrics.columns)
    split = Window.partitionBy("split")
    base = F.max(F.when(F.col("model") == reference, F.col("rmse"))).over(split)
    best = F.min_by("model", F.struct("rmse", "model")).over(split)
    change = pct_change(F.col("rmse"), base)
    return metrics.select(
        "split",
        "model",
        "rmse",
        "mae",
        change.alias("rmse_change_pct"),
        best.alias("winner"),
        (F.abs(change) < equivalent_below).alias("equivalent"),
    )
