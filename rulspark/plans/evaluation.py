"""Queries that measure, compare and monitor predictions."""

from __future__ import annotations

from pyspark.sql import functions as F

from rulspark.operators import joins as J
from rulspark.operators import metrics as M
from rulspark.operators import monitoring as D
from rulspark.operators.ordering import skip_warmup
from rulspark.operators.projection import union_all
from rulspark.plans.frames import (
    PREDICTIONS_SQL,
    READINGS_SQL,
    label_lines,
    predictions_a,
    predictions_b,
    q4,
    q6,
    r4,
    r6,
    samples,
    sql_on,
)
from rulspark.plans.registry import query
from rulspark.schema import SEQUENCE_BASELINE, SEQUENCE_FALLBACK, TABULAR_BASELINE, TABULAR_CUTOFF

KEYS = ["unit", "time", "dataset"]


def _rounded(df, exact=()):
    kinds = dict(df.dtypes)
    return df.select(
        *[r6(c).alias(c) if kinds[c] == "double" and c not in exact else F.col(c) for c in df.columns]
    )


def scored_a(spark, sf_dir):
    return predictions_a(spark, sf_dir, seq=False)


_RMSE = q6("sqrt(avg(err * err))")
_MAE = q6("avg(abs(err))")


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT p.unit, p."time", p.dataset, {q4('predicted')} AS "RUL_Predicted", {q4('label')} AS "RUL_Actual"
FROM (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unit, "time", dataset ORDER BY seq) AS r
    FROM pred_a WHERE seq % 5 <> 4 OR dataset <> 2) WHERE r = 1) p
JOIN (SELECT * FROM (SELECT unit, "time", dataset, least(greatest(rul, 0e0), 90e0) AS label,
    row_number() OVER (PARTITION BY unit, "time", dataset ORDER BY seq) AS r FROM readings
    WHERE "time" <> 7) WHERE r = 1) l
  ON p.unit = l.unit AND p."time" = l."time" AND p.dataset = l.dataset""",
    )
)
def pred_label_join(spark, sf_dir):
    """Some predictions and some labels have no partner."""
    predictions = predictions_a(spark, sf_dir).where("seq % 5 <> 4 OR dataset <> 2")
    labels = label_lines(spark, sf_dir).where("time <> 7")
    out = J.join_actuals(predictions, labels)
    return out.select(*KEYS, r4("RUL_Predicted").alias("RUL_Predicted"), r4("RUL_Actual").alias("RUL_Actual"))


@query(
    sql_on(
        READINGS_SQL,
        """SELECT unit, "time", dataset, count(*) AS n FROM readings GROUP BY ALL HAVING count(*) > 1""",
    )
)
def key_violations(spark, sf_dir):
    return J.key_violations(samples(spark, sf_dir), KEYS)


@query(
    sql_on(
        PREDICTIONS_SQL,
        " UNION ALL ".join(
            f"""SELECT '{m}' AS model, {_RMSE} AS rmse, {_MAE} AS mae, {q6('1e0 - sum(err * err) / (count(*) * var_pop(actual))')} AS r2,
  count(*) AS n FROM pred_{m} WHERE seq >= 30"""
            for m in "ab"
        ),
    )
)
def fair_comparison(spark, sf_dir):
    models = {"a": predictions_a(spark, sf_dir), "b": predictions_b(spark, sf_dir)}
    return _rounded(J.fair_comparison(models))


@query(
    sql_on(
        READINGS_SQL,
        """SELECT DISTINCT snapshot_date FROM readings WHERE snapshot_date >= DATE '2024-12-31'
EXCEPT SELECT snapshot_date FROM readings WHERE snapshot_date < DATE '2025-01-08'""",
    )
)
def pending_snapshots(spark, sf_dir):
    df = samples(spark, sf_dir)
    return J.pending_snapshots(df, df.where("snapshot_date < DATE '2025-01-08'"), TABULAR_CUTOFF)


@query(sql_on(PREDICTIONS_SQL, f"SELECT {_RMSE} AS rmse, {_MAE} AS mae FROM pred_a"))
def rmse_mae(spark, sf_dir):
    return _rounded(M.rmse_mae(scored_a(spark, sf_dir)))


_SEQUENCE = f"""{_RMSE} AS rmse, {_MAE} AS mae, {q6('avg(predicted::DOUBLE)')} AS mean_pred,
  {q6('stddev_pop(predicted::DOUBLE)')} AS std_pred, {q6('avg(actual::DOUBLE)')} AS mean_actual,
  {q6('stddev_pop(actual::DOUBLE)')} AS std_actual, count(*) AS n_predictions,
  count(DISTINCT unit) AS n_engines"""
_TABULAR = f"""{_RMSE} AS rmse, {_MAE} AS mae, count(*) AS prediction_count,
  {q6('avg(err)')} AS residual_mean, {q6('stddev_pop(err)')} AS residual_std"""


@query(sql_on(PREDICTIONS_SQL, f"SELECT {_SEQUENCE} FROM pred_a"))
def metrics_sequence(spark, sf_dir):
    return _rounded(M.metrics_sequence(scored_a(spark, sf_dir)))


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT {_TABULAR} FROM (
  SELECT *, row_number() OVER (PARTITION BY unit, "time", dataset ORDER BY seq) AS r FROM pred_a)
WHERE r = 1""",
    )
)
def metrics_tabular(spark, sf_dir):
    """Measured after the join, so on one sample per cycle."""
    joined = J.join_actuals(predictions_a(spark, sf_dir), label_lines(spark, sf_dir))
    return _rounded(M.metrics_tabular(joined))


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT dataset, CAST(grouping(dataset) AS INTEGER) AS is_total, CAST(count(*) AS BIGINT) AS n,
  {_RMSE} AS rmse, {_MAE} AS mae FROM pred_a GROUP BY ROLLUP (dataset)""",
    )
)
def metrics_rollup(spark, sf_dir):
    return _rounded(M.metrics_rollup(scored_a(spark, sf_dir)))


@query(sql_on(PREDICTIONS_SQL, f"SELECT unit, {_RMSE} AS rmse FROM pred_a GROUP BY unit"))
def unit_rmse(spark, sf_dir):
    return _rounded(M.unit_rmse(scored_a(spark, sf_dir)))


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"SELECT unit, count(*) AS n_predictions, {_RMSE} AS rmse, {_MAE} AS mae FROM pred_a GROUP BY unit",
    )
)
def unit_metrics(spark, sf_dir):
    return _rounded(M.unit_metrics(scored_a(spark, sf_dir)))


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT {q6('pooled_rmse')} AS pooled_rmse, {q6('pooled_mae')} AS pooled_mae,
  {q6('avg(rmse)')} AS unit_rmse_mean, {q6('stddev_samp(rmse)')} AS unit_rmse_std,
  {q6('avg(mae)')} AS unit_mae_mean, {q6('min(rmse)')} AS unit_rmse_min,
  {q6('max(rmse)')} AS unit_rmse_max, count(*) AS n_engines,
  {q6('abs(pooled_rmse - avg(rmse))')} AS rmse_gap
FROM (SELECT sqrt(avg(err * err)) AS rmse, avg(abs(err)) AS mae FROM pred_a GROUP BY unit),
  (SELECT sqrt(avg(err * err)) AS pooled_rmse, avg(abs(err)) AS pooled_mae FROM pred_a)
GROUP BY pooled_rmse, pooled_mae""",
    )
)
def pooled_vs_unit(spark, sf_dir):
    return _rounded(M.pooled_vs_unit(scored_a(spark, sf_dir)))


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT dataset, {q6('1e0 - sum(err * err) / (count(*) * var_pop(actual::DOUBLE))')} AS r2
FROM pred_a GROUP BY dataset""",
    )
)
def r2(spark, sf_dir):
    return _rounded(M.r2(scored_a(spark, sf_dir), ["dataset"]))


_STATS = f"""{q6('avg(err)')} AS error_mean, {q6('stddev_pop(err)')} AS error_std,
  {q6('min(err)')} AS error_min, {q6('max(err)')} AS error_max,
  {q6('min(predicted)')} AS pred_min, {q6('max(predicted)')} AS pred_max,
  {q6('min(actual)')} AS actual_min, {q6('max(actual)')} AS actual_max,
  {q6('corr(actual::DOUBLE, predicted::DOUBLE)')} AS correlation"""


@query(sql_on(PREDICTIONS_SQL, f"SELECT dataset, {_STATS} FROM pred_a GROUP BY dataset"))
def error_stats(spark, sf_dir):
    return _rounded(M.error_stats(scored_a(spark, sf_dir), ["dataset"]))


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT *, CASE WHEN abs(error_mean) < 0.1e0 THEN 'calibrated' WHEN error_mean > 0 THEN 'over-predicting'
  ELSE 'under-predicting' END AS bias_verdict,
  CASE WHEN correlation > 0.9e0 THEN 'strong' WHEN correlation > 0.7e0 THEN 'good' ELSE 'weak' END
    AS correlation_verdict
FROM (SELECT dataset, {_STATS} FROM pred_a GROUP BY dataset)""",
    )
)
def calibration(spark, sf_dir):
    stats = M.error_stats(scored_a(spark, sf_dir), ["dataset"])
    return _rounded(M.calibration(stats, bias_limit=0.1))


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT model, stage, count(*) AS n, {_RMSE} AS rmse, {_MAE} AS mae FROM (
  SELECT 'a' AS model, *, CASE WHEN actual > 50 THEN 'early' WHEN actual >= 20 THEN 'mid' ELSE 'end' END AS stage
  FROM pred_a WHERE seq >= 30 UNION ALL
  SELECT 'b', *, CASE WHEN actual > 50 THEN 'early' WHEN actual >= 20 THEN 'mid' ELSE 'end' END
  FROM pred_b WHERE seq >= 30)
GROUP BY model, stage""",
    )
)
def lifecycle_errors(spark, sf_dir):
    models = union_all(
        [
            skip_warmup(df).withColumn("model", F.lit(name))
            for name, df in (
                ("a", predictions_a(spark, sf_dir)), ("b", predictions_b(spark, sf_dir))
            )
        ]
    )
    return _rounded(M.lifecycle_errors(models, by=["model"]))


def _models(spark, sf_dir):
    """Both models' rows with the split they belong to."""
    both = union_all(
        [
            df.withColumn("model", F.lit(name))
            for name, df in (("a", scored_a(spark, sf_dir)), ("b", predictions_b(spark, sf_dir)))
        ]
    )
    return both.withColumn("split", F.when(F.col("dataset") <= 5, "test").otherwise("oot"))


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT split, model, {q6('rmse')} AS rmse, {q6('mae')} AS mae,
  {q6('100e0 * (rmse - base) / base')} AS rmse_change_pct,
  first_value(model) OVER (PARTITION BY split ORDER BY rmse, model) AS winner,
  abs(100e0 * (rmse - base) / base) < 1e0 AS equivalent
FROM (SELECT *, max(CASE WHEN model = 'a' THEN rmse END) OVER (PARTITION BY split) AS base FROM (
  SELECT split, model, sqrt(avg(err * err)) AS rmse, avg(abs(err)) AS mae FROM (
    SELECT 'a' AS model, *, CASE WHEN dataset <= 5 THEN 'test' ELSE 'oot' END AS split FROM pred_a UNION ALL
    SELECT 'b', *, CASE WHEN dataset <= 5 THEN 'test' ELSE 'oot' END FROM pred_b)
  GROUP BY split, model))""",
    )
)
def model_comparison(spark, sf_dir):
    metrics = M.rmse_mae(_models(spark, sf_dir), ["split", "model"])
    return _rounded(M.model_comparison(metrics, "a"))


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT model, {_SEQUENCE},
  coalesce(abs(sqrt(avg(err * err)) - base_rmse) / base_rmse * 100e0 > 20e0, false) AS rmse_drift,
  coalesce(abs(avg(abs(err)) - base_mae) / base_mae * 100e0 > 20e0, false) AS mae_drift,
  abs(avg(predicted::DOUBLE) - coalesce(base_mean, avg(predicted::DOUBLE))) / coalesce(base_mean, 1e0) * 100e0 > 20e0
    AS distribution_drift,
  (abs(sqrt(avg(err * err)) - base_rmse) / base_rmse * 100e0 > 20e0
    OR abs(avg(abs(err)) - base_mae) / base_mae * 100e0 > 20e0
    OR abs(avg(predicted::DOUBLE) - coalesce(base_mean, avg(predicted::DOUBLE))) / coalesce(base_mean, 1e0) * 100e0 > 20e0)
    AS any_drift
FROM (VALUES ('published', 0.1244e0, 0.0366e0, 45e0), ('fallback', 0.15e0, 0.05e0, 45e0),
  ('close', 6e0, 5e0, NULL)) b(model, base_rmse, base_mae, base_mean), pred_a
GROUP BY model, base_rmse, base_mae, base_mean""",
    )
)
def drift_pct(spark, sf_dir):
    """One measurement against three baselines."""
    metrics = M.metrics_sequence(scored_a(spark, sf_dir))
    close = {
        "baseline": {"rmse": 6.0, "mae": 5.0},
        "thresholds": SEQUENCE_BASELINE["thresholds"],
    }
    named = {"published": SEQUENCE_BASELINE, "fallback": SEQUENCE_FALLBACK, "close": close}
    out = union_all(
        [D.drift_pct(metrics.withColumn("model", F.lit(n)), b) for n, b in named.items()]
    )
    return _rounded(out)


RUNGS = {
    "published": (18.2091, 14.6529),
    "ok": (6.0, 5.0),
    "rmse_warning": (5.0, 5.0),
    "rmse_critical": (4.5, 5.0),
    "mae_warning": (6.0, 4.2),
    "mae_critical": (6.0, 3.7),
    "hidden_mae_critical": (5.0, 3.7),
}
_LADDER = """CASE WHEN rmse > base_rmse * 1.3e0 THEN 'critical' WHEN rmse > base_rmse * 1.15e0 THEN 'warning'
  WHEN mae > base_mae * 1.4e0 THEN 'critical' WHEN mae > base_mae * 1.2e0 THEN 'warning' ELSE 'ok' END AS drift_status,
  CASE WHEN rmse > base_rmse * 1.3e0
    THEN printf('RMSE %.2f exceeds critical threshold (%.2f).', rmse, base_rmse * 1.3e0)
  WHEN rmse > base_rmse * 1.15e0
    THEN printf('RMSE %.2f exceeds warning threshold (%.2f).', rmse, base_rmse * 1.15e0)
  WHEN mae > base_mae * 1.4e0
    THEN printf('MAE %.2f exceeds critical threshold (%.2f).', mae, base_mae * 1.4e0)
  WHEN mae > base_mae * 1.2e0
    THEN printf('MAE %.2f exceeds warning threshold (%.2f).', mae, base_mae * 1.2e0)
  ELSE 'Within baseline thresholds.' END AS drift_reason"""
_LIMITS = f"""{q6('base_rmse')} AS baseline_rmse, {q6('base_mae')} AS baseline_mae,
  {q6('base_rmse * 1.15e0')} AS rmse_warning_threshold, {q6('base_rmse * 1.3e0')} AS rmse_critical_threshold,
  {q6('base_mae * 1.2e0')} AS mae_warning_threshold, {q6('base_mae * 1.4e0')} AS mae_critical_threshold"""


def _tabular_by(source: str, by: str) -> str:
    return f"""SELECT {by}, sqrt(avg(err * err)) AS rmse, avg(abs(err)) AS mae, count(*) AS prediction_count,
  avg(err) AS residual_mean, stddev_pop(err) AS residual_std FROM {source} GROUP BY {by}"""


_ROUNDED_TABULAR = f"""{q6('rmse')} AS rmse, {q6('mae')} AS mae, prediction_count,
  {q6('residual_mean')} AS residual_mean, {q6('residual_std')} AS residual_std"""


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT rung, {_ROUNDED_TABULAR}, {_LIMITS}, {_LADDER}
FROM (VALUES {', '.join(f"('{n}', {a!r}e0, {b!r}e0)" for n, (a, b) in RUNGS.items())}) b(rung, base_rmse, base_mae),
  ({_tabular_by('pred_a', 'true')}) m""",
    )
)
def drift_tier(spark, sf_dir):
    """One measurement against a baseline for every rung of the ladder."""
    metrics = M.metrics_tabular(scored_a(spark, sf_dir))
    parts = []
    for rung, (rmse, mae) in RUNGS.items():
        baseline = {**TABULAR_BASELINE, "baseline": {"rmse": rmse, "mae": mae}}
        parts.append(D.drift_tier(metrics.withColumn("rung", F.lit(rung)), baseline))
    return _rounded(union_all(parts))


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT snapshot_date, {_ROUNDED_TABULAR}, {_LIMITS}, {_LADDER}
FROM (SELECT 5.9e0 AS base_rmse, 5e0 AS base_mae), ({_tabular_by('pred_a', 'snapshot_date')}) m""",
    )
)
def drift_backfill(spark, sf_dir):
    baseline = {**TABULAR_BASELINE, "baseline": {"rmse": 5.9, "mae": 5.0}}
    return _rounded(D.drift_backfill(scored_a(spark, sf_dir), baseline))


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT snapshot_date, {_SEQUENCE},
  abs(sqrt(avg(err * err)) - 6e0) / 6e0 * 100e0 > 1e0 AS rmse_drift,
  abs(avg(abs(err)) - 5e0) / 5e0 * 100e0 > 1e0 AS mae_drift,
  abs(avg(predicted::DOUBLE) - 45e0) / 45e0 * 100e0 > 20e0 AS distribution_drift,
  (abs(sqrt(avg(err * err)) - 6e0) / 6e0 * 100e0 > 1e0 OR abs(avg(abs(err)) - 5e0) / 5e0 * 100e0 > 1e0
    OR abs(avg(predicted::DOUBLE) - 45e0) / 45e0 * 100e0 > 20e0) AS any_drift
FROM pred_a GROUP BY snapshot_date""",
    )
)
def drift_backfill_sequence(spark, sf_dir):
    baseline = {
        "baseline": {"rmse": 6.0, "mae": 5.0, "mean_pred": 45.0},
        "thresholds": {"rmse_pct_change": 1.0, "mae_pct_change": 1.0, "distribution_pct_change": 20.0},
    }
    return _rounded(D.drift_backfill(scored_a(spark, sf_dir), baseline, kind="sequence"))


def _records(spark, sf_dir):
    return M.metrics_tabular(scored_a(spark, sf_dir), ["snapshot_date"])


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT snapshot_date, {_ROUNDED_TABULAR} FROM ({_tabular_by('pred_a', 'snapshot_date')})
UNION ALL SELECT snapshot_date, {_ROUNDED_TABULAR} FROM ({_tabular_by('pred_a', 'snapshot_date')})
WHERE snapshot_date = DATE '2025-01-10'""",
    )
)
def history_append(spark, sf_dir):
    """The last day is recorded twice and stays twice."""
    records = _records(spark, sf_dir)
    return _rounded(D.history_append(records, records.where("snapshot_date = DATE '2025-01-10'")))


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"SELECT snapshot_date, {_ROUNDED_TABULAR} FROM ({_tabular_by('pred_a', 'snapshot_date')})",
    )
)
def history_upsert(spark, sf_dir):
    """A stale record of the last day is replaced."""
    records = _records(spark, sf_dir)
    last = F.col("snapshot_date") == F.lit("2025-01-10").cast("date")
    old = records.withColumn("rmse", F.when(last, F.lit(-1.0)).otherwise(F.col("rmse")))
    return _rounded(D.history_upsert(old, records.where(last)))


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"SELECT snapshot_date, {_RMSE} AS rmse, {_MAE} AS mae FROM pred_a GROUP BY snapshot_date",
    )
)
def history_trend(spark, sf_dir):
    """Trend read from a history table on storage."""
    from rulspark.session import scratch_path
    from rulspark.sources.readers import read_partitioned
    from rulspark.sources.writers import write_history

    path = scratch_path(spark, "history")
    write_history(_records(spark, sf_dir), path)
    return _rounded(D.history_trend(read_partitioned(spark, path)))


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT snapshot_date, {q6('rmse')} AS rmse, prediction_count, drift_status, drift_reason,
  {q6('base_rmse * 1.3e0')} AS rmse_critical
FROM (SELECT *, {_LADDER} FROM (SELECT 5.9e0 AS base_rmse, 5e0 AS base_mae),
  ({_tabular_by('pred_a', 'snapshot_date')}) m)""",
    )
)
def metrics_document(spark, sf_dir):
    """Documents written per snapshot and read back."""
    from rulspark.session import scratch_path
    from rulspark.sources.writers import write_metrics_document

    baseline = {**TABULAR_BASELINE, "baseline": {"rmse": 5.9, "mae": 5.0}}
    documents = D.metrics_document(D.drift_backfill(scored_a(spark, sf_dir), baseline))
    path = scratch_path(spark, "documents")
    write_metrics_document(documents, path)
    back = spark.read.schema(documents.schema).json(path)
    return back.select(
        "snapshot_date", r6("rmse").alias("rmse"), "prediction_count",
        F.col("drift.status").alias("drift_status"), F.col("drift.reason").alias("drift_reason"),
        r6("drift.rmse_critical_threshold").alias("rmse_critical"),
    )
