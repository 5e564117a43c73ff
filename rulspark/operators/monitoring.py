"""Drift status, metric history and report tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulspark.functions.columns import col, pct_change
from rulspark.operators.metrics import (
    metrics_sequence,
    metrics_tabular,
    unit_rmse,
)
from rulspark.operators.ordering import sample_rows
from rulspark.operators.stats import histogram
from rulspark.schema import DRIFT_OK, DRIFT_OVER, SEQUENCE_BASELINE, TABULAR_BASELINE


def _config_column(value, path: str, default: float | None = None) -> Column:
    """A number of a baseline given as a dict or as a struct column."""
    section, key = path.split(".")
    if isinstance(value, Mapping):
        number = value[section].get(key, default)
        return F.lit(None if number is None else float(number)).cast("double")
    found = value.getField(section).getField(key)
    return found if default is None else F.coalesce(found, F.lit(default))


def baseline_column(baseline: DataFrame) -> Column:
    """A one-row baseline table as a struct usable in any expression."""
    return baseline.select(F.struct("baseline", "thresholds").alias("config")).scalar()


def with_baseline(metrics: DataFrame, baseline) -> tuple[DataFrame, object]:
    """Put a baseline table next to the metrics; a dict needs nothing."""
    if isinstance(baseline, Mapping):
        return metrics, baseline
    if isinstance(baseline, Column):
        return metrics, baseline
    return metrics.withColumn("_baseline", baseline_column(baseline)), F.col("_baseline")


def drift_pct(metrics: DataFrame, baseline=SEQUENCE_BASELINE) -> DataFrame:
    """Flags for a percentage change of RMSE, MAE and mean prediction over the limit.

    A baseline without ``mean_pred`` compares the mean with itself over one, so
    the distribution flag stays off.
    """
    df, cfg = with_baseline(metrics, baseline)

    def change(name: str) -> Column:
        return F.abs(pct_change(F.col(name), _config_column(cfg, f"baseline.{name}")))

    expected = _config_column(cfg, "baseline.mean_pred")
    distribution = F.try_divide(
        F.abs(F.col("mean_pred") - F.coalesce(expected, F.col("mean_pred"))) * 100.0,
        F.coalesce(expected, F.lit(1.0)),
    )
    limit = _config_column(cfg, "thresholds.distribution_pct_change", 20.0)
    flags = {
        "rmse_drift": change("rmse") > _config_column(cfg, "thresholds.rmse_pct_change"),
        "mae_drift": change("mae") > _config_column(cfg, "thresholds.mae_pct_change"),
        "distribution_drift": distribution > limit,
    }
    out = df.withColumns(flags).drop("_baseline")
    return out.withColumn("any_drift", any_drift())


def any_drift(*flags: str) -> Column:
    names = flags or ("rmse_drift", "mae_drift", "distribution_drift")
    out = F.lit(False)
    for name in names:
        out = out | F.col(name)
    return out


def drift_tier(metrics: DataFrame, baseline=TABULAR_BASELINE) -> DataFrame:
    """ok, warning or critical with a reason.

    RMSE is looked at first: an RMSE warning hides a critical MAE.
    """
    df, cfg = with_baseline(metrics, baseline)
    base_rmse = _config_column(cfg, "baseline.rmse")
    base_mae = _config_column(cfg, "baseline.mae")
    limits = {
        "rmse_warning_threshold": base_rmse * _config_column(cfg, "thresholds.rmse_warning_multiplier", 1.15),
        "rmse_critical_threshold": base_rmse * _config_column(cfg, "thresholds.rmse_critical_multiplier", 1.30),
        "mae_warning_threshold": base_mae * _config_column(cfg, "thresholds.mae_warning_multiplier", 1.20),
        "mae_critical_threshold": base_mae * _config_column(cfg, "thresholds.mae_critical_multiplier", 1.40),
    }
    df = df.withColumns({"baseline_rmse": base_rmse, "baseline_mae": base_mae, **limits})
    ladder = [
        ("rmse", "critical"), ("rmse", "warning"), ("mae", "critical"), ("mae", "warning"),
    ]
    status, reason = F.lit("ok"), F.lit(DRIFT_OK)
    for metric, level in reversed(ladder):
        limit = F.col(f"{metric}_{level}_threshold")
        over = F.col(metric) > limit
        text = F.format_string(
            DRIFT_OVER.format(metric=metric.upper(), level=level), F.col(metric), limit
        )
        status = F.when(over, F.lit(level)).otherwise(status)
        reason = F.when(over, text).otherwise(reason)
    return df.withColumns({"drift_status": status, "drift_reason": reason}).drop("_baseline")


def stamped(df: DataFrame, name: str = "generated_at_utc") -> DataFrame:
    """The time of the run in UTC, whatever the session's time zone."""
    now = F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return df.withColumn(name, F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))


def history_append(history: DataFrame, record: DataFrame) -> DataFrame:
    """Rows are added as they come; a rerun of a day adds it again."""
    return history.unionByName(record, allowMissingColumns=True)


def history_upsert(history: DataFrame, record: DataFrame, key: str = "snapshot_date") -> DataFrame:
    """The record replaces its snapshot; ordered by snapshot."""
    kept = history.join(record.select(key).distinct(), key, "left_anti")
    return ordered_history(kept.unionByName(record, allowMissingColumns=True), key)


def ordered_history(history: DataFrame, key: str = "snapshot_date") -> DataFrame:
    return history.orderBy(key)


def history_trend(history: DataFrame, key: str = "snapshot_date") -> DataFrame:
    return ordered_history(history.select(key, "rmse", "mae"), key)


def drift_backfill(scored: DataFrame, baseline=TABULAR_BASELINE, kind: str = "tabular") -> DataFrame:
    """Metrics and drift of every snapshot in one job."""
    if kind == "tabular":
        return drift_tier(metrics_tabular(scored, ["snapshot_date"]), baseline)
    return drift_pct(metrics_sequence(scored, ["snapshot_date"]), baseline)


def metrics_document(with_drift: DataFrame, key: str = "snapshot_date") -> DataFrame:
    """The per-snapshot document: metrics on top, drift details nested."""
    drift = [
        F.col("drift_status").alias("status"),
        F.col("drift_reason").alias("reason"),
        *[
            F.col(c)
            for c in (
                "baseline_rmse", "baseline_mae",
                "rmse_warning_threshold", "rmse_critical_threshold",
                "mae_warning_threshold", "mae_critical_threshold",
            )
        ],
    ]
    return with_drift.select(
        col(key), "rmse", "mae", "prediction_count", "residual_mean", "residual_std",
        F.struct(*drift).alias("drift"),
    )


def report_tables(scored: DataFrame, bins: int = 50, sample: int = 5000) -> dict[str, DataFrame]:
    """The data behind a monitoring report."""
    return {
        "error_histogram": histogram(scored, "Prediction_Error", bins),
        "predicted_vs_actual": sample_rows(scored, sample, ["unit", "seq"], ["unit", "seq"]).select(
            "unit", "seq", "RUL_Actual", "RUL_Predicted"
        ),
        "unit_rmse": unit_rmse(scored),
        "summary": metrics_sequence(scored),
    }
