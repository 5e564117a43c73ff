"""Queries over windows as views: what they hold, engines that fail, recurrent forecasts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from rulspark.functions.columns import clip, unit_dataset
from rulspark.operators import sequence as S
from rulspark.operators import views as V
from rulspark.operators.reservoir import fit_reservoir
from rulspark.operators.scaling import fit_robust, scale
from rulspark.plans.frames import READINGS_SQL, SENSORS, q6, r6, readings, sql_on
from rulspark.plans.registry import query
from rulspark.schema import LABEL
from rulspark.session import durable

_ORDER = "PARTITION BY unit ORDER BY seq"
_PAST = f"OVER ({_ORDER} ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"


@query(
    sql_on(
        READINGS_SQL,
        "SELECT unit, CAST(seq AS BIGINT) AS seq, "
        + ", ".join(
            f"{q6('first_' + s)} AS first_{s}, {q6('last_' + s)} AS last_{s}, {q6('mean_' + s)} AS mean_{s}" for s in SENSORS
        )
        + " FROM (SELECT unit, seq, "
        + ", ".join(
            f"lag({s}, 30) OVER ({_ORDER}) AS first_{s}, lag({s}, 1) OVER ({_ORDER}) AS last_{s}, avg({s}) {_PAST} AS mean_{s}"
            for s in SENSORS
        )
        + " FROM readings) WHERE seq >= 30",
    )
)
def window_views(spark, sf_dir):
    """First, last and mean step of every look-back window of all sensors."""
    k = len(SENSORS)

    def ends(windows):
        return np.stack([windows[:, 0], windows[:, -1], windows.mean(axis=1)], axis=2).reshape(len(windows), 3 * k)

    names = [f"{what}_{s}" for s in SENSORS for what in ("first", "last", "mean")]
    out = V.over_windows(readings(spark, sf_dir, label=False), SENSORS, ends, names)
    return out.select("unit", "seq", *[r6(c).alias(c) for c in names])


# A window that reads the fleet's highest value of the first sensor is beyond this scorer.
_TOP = f"(SELECT max({SENSORS[0]}) FROM readings)"


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT unit, count(*) AS n_rows,
  CASE WHEN bool_or(high) OR count(*) <= 30 THEN 0 ELSE count(*) - 30 END AS n_scored,
  CASE WHEN bool_or(high) AND count(*) > 30 THEN 'ValueError: beyond the scale'
       WHEN count(*) <= 30 THEN 'not longer than 30 rows' END AS reason
FROM (SELECT unit, {SENSORS[0]} >= {_TOP} AND lead(seq) OVER ({_ORDER}) IS NOT NULL AS high FROM readings)
GROUP BY unit""",
    )
)
def scoring_quarantine(spark, sf_dir):
    """Every engine with its scored rows, or the reason for which it has none: a scorer that
    raises on one engine leaves the others scored."""
    series = readings(spark, sf_dir, label=False)
    top = series.agg(F.max(SENSORS[0])).first()[0]

    def mean(windows):
        if (windows >= top).any():
            raise ValueError("beyond the scale")
        return windows[:, :, 0].mean(axis=1)

    scored = durable(V.over_windows(series, SENSORS[:1], mean, ["prediction"], quarantine=True))
    good, failed = V.quarantined(scored)
    found = good.groupBy("unit").agg(F.count("*").alias("n_scored"))
    rest = S.unscored_with_reason(series, good, failed).select("unit", "reason")
    lengths = series.groupBy("unit").agg(F.count("*").alias("n_rows"))
    return lengths.join(found, "unit", "left").join(rest, "unit", "left").select(
        "unit", "n_rows", F.coalesce("n_scored", F.lit(0).cast("long")).alias("n_scored"), "reason"
    )


def _recurrent(spark, sf_dir, include_target_lags):
    """Forecasts of a reservoir fitted on datasets 1 to 4, its penalty chosen on 5; errors in
    cycles per dataset beside the label's deviation."""
    series = readings(spark, sf_dir).withColumn("label", clip(F.col(LABEL), 125.0, 0.0))
    series = series.select("unit", "dataset", "seq", "label", *SENSORS)
    params = fit_robust(series.where("dataset <= 5"), [*SENSORS, "label"])
    scaled = scale(series, params, [*SENSORS, "label"]).withColumn("_is_val", F.col("dataset") == 5)
    model = fit_reservoir(
        scaled.where("dataset <= 5"), SENSORS, "label", "_is_val", include_target_lags=include_target_lags
    )
    center, spread = params.where("feature = 'label'").select("center", "scale").first()
    good, _ = V.quarantined(durable(model.forecast(scaled, ["label"])))
    out = S.rolling_forecast(good, lambda rows: rows, "label", center, spread)
    error, actual = F.col("Prediction_Error").cast("double"), F.col("RUL_Actual").cast("double")
    return out.groupBy(unit_dataset(F.col("unit")).alias("dataset")).agg(
        F.count("*").alias("n"), r6(F.sqrt(F.avg(error * error))).alias("rmse"),
        r6(F.stddev_pop(actual)).alias("label_deviation"),
    )


@query()
def forecast_reservoir(spark, sf_dir):
    """One step ahead from thirty steps of all sensors and the past label, by a recurrent
    network of fixed weights."""
    return _recurrent(spark, sf_dir, True)


@query()
def forecast_reservoir_covariates(spark, sf_dir):
    """The same without the past label, where that would leak."""
    return _recurrent(spark, sf_dir, False)
