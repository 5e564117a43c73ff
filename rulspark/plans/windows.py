"""Queries over rolling statistics, row order and look-back windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from rulspark.functions.columns import clip
from rulspark.operators import ordering as O
from rulspark.operators import rolling as R
from rulspark.operators import sequence as S
from rulspark.operators.scaling import fit_robust, scale, unscale
from rulspark.operators.stats import sensor_trend
from rulspark.plans.frames import (
    PREDICTIONS_SQL,
    READINGS_SQL,
    SENSORS,
    label_lines,
    predictions_a,
    q4,
    q6,
    r4,
    r6,
    readings,
    samples,
    sql_on,
)
from rulspark.plans.registry import query
from rulspark.schema import EMA_SPAN, LABEL
from rulspark.session import durable, scratch_path

ROLLED = SENSORS


def _over(n: int) -> str:
    return f"OVER (PARTITION BY unit ORDER BY seq ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def _mean(s: str, n: int) -> str:
    return f"CAST(avg(CAST(CAST({s} AS FLOAT) AS DOUBLE)) {_over(n)} AS FLOAT)"


def _std(s: str, n: int) -> str:
    return (
        f"CAST(coalesce(stddev_samp(CAST(CAST({s} AS FLOAT) AS DOUBLE)) {_over(n)}, 0e0) AS FLOAT)"
    )


_SCALES = {"short": 5, "medium": 15, "long": 30}


def _rolled(spark, sf_dir):
    df = readings(spark, sf_dir, label=False)
    return R.multiscale_features(df, ROLLED, keep=["unit", "seq"])


@query(
    sql_on(
        READINGS_SQL,
        "SELECT unit, seq, "
        + ", ".join(f'{q4(_mean(s, n))} AS {s}_mean_{w}' for s in ROLLED for w, n in _SCALES.items())
        + " FROM readings",
    )
)
def rolling_mean(spark, sf_dir):
    names = [f"{s}_mean_{w}" for s in ROLLED for w in _SCALES]
    return _rolled(spark, sf_dir).select("unit", "seq", *[r4(n).alias(n) for n in names])


@query(
    sql_on(
        READINGS_SQL,
        "SELECT unit, seq, "
        + ", ".join(f'{q4(_std(s, n))} AS {s}_std_{w}' for s in ROLLED for w, n in _SCALES.items())
        + " FROM readings",
    )
)
def rolling_std(spark, sf_dir):
    names = [f"{s}_std_{w}" for s in ROLLED for w in _SCALES]
    return _rolled(spark, sf_dir).select("unit", "seq", *[r4(n).alias(n) for n in names])


@query(
    sql_on(
        READINGS_SQL,
        "SELECT unit, seq, "
        + ", ".join(f'{q4(f"{_mean(s, 5)} - {_mean(s, 15)}")} AS {s}_acceleration' for s in ROLLED)
        + " FROM readings",
    )
)
def acceleration(spark, sf_dir):
    names = [f"{s}_acceleration" for s in ROLLED]
    return _rolled(spark, sf_dir).select("unit", "seq", *[r4(n).alias(n) for n in names])


_ALPHA = f"(2e0 / {EMA_SPAN + 1}e0)"


@query(
    "WITH RECURSIVE "
    + READINGS_SQL
    + f""",
trend AS (
  SELECT dataset, "time", avg(s1) AS s1, avg(rul) AS rul,
    row_number() OVER (PARTITION BY dataset ORDER BY "time") AS i
  FROM readings GROUP BY dataset, "time"),
smooth AS (
  SELECT dataset, "time", s1, rul, i FROM trend WHERE i = 1
  UNION ALL
  SELECT t.dataset, t."time", {_ALPHA} * t.s1 + (1e0 - {_ALPHA}) * p.s1,
    {_ALPHA} * t.rul + (1e0 - {_ALPHA}) * p.rul, t.i
  FROM smooth p JOIN trend t ON t.dataset = p.dataset AND t.i = p.i + 1)
SELECT dataset, "time", {q6('s1')} AS s1, {q6('rul')} AS label FROM smooth"""
)
def ema(spark, sf_dir):
    trend = sensor_trend(readings(spark, sf_dir, seq=False), ["s1", LABEL])
    out = R.ema(trend, ["s1", LABEL])
    return out.select("dataset", "time", r6("s1").alias("s1"), r6(LABEL).alias("label"))


@query(
    sql_on(
        READINGS_SQL,
        """SELECT event_id, unit, CAST(least(max("time") OVER (PARTITION BY unit) - "time", 20) AS DOUBLE)
  AS derived FROM readings""",
    )
)
def derive_rul(spark, sf_dir):
    out = R.derive_rul(samples(spark, sf_dir), upper=20.0, name="derived")
    return out.select("event_id", "unit", "derived")


@query(sql_on(READINGS_SQL, "SELECT unit, event_id, seq FROM readings"))
def series_index(spark, sf_dir):
    return O.with_series_index(
        samples(spark, sf_dir), order=["time", "ts", "event_id"], name="seq"
    ).select("unit", "event_id", "seq")


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT unit, "time", dataset, event_id, {q4('predicted')} AS predicted FROM (
  SELECT *, row_number() OVER (PARTITION BY unit, "time", dataset ORDER BY seq) AS r FROM pred_a)
WHERE r = 1""",
    )
)
def dedup_first(spark, sf_dir):
    out = O.keep_first(predictions_a(spark, sf_dir), ["unit", "time", "dataset"])
    return out.select("unit", "time", "dataset", "event_id", r4("RUL_Predicted").alias("predicted"))


@query(
    sql_on(
        READINGS_SQL,
        """SELECT count(*) AS rows_before, count(DISTINCT (unit, "time", dataset)) AS rows_kept,
  count(*) - count(DISTINCT (unit, "time", dataset)) AS rows_dropped FROM readings""",
    )
)
def dedup_report(spark, sf_dir):
    return O.dedup_report(samples(spark, sf_dir), ["unit", "time", "dataset"])


@query(sql_on(READINGS_SQL, "SELECT unit, seq, event_id FROM readings WHERE seq >= 30"))
def skip_warmup(spark, sf_dir):
    df = readings(spark, sf_dir, label=False)
    return O.skip_warmup(df).select("unit", "seq", "event_id")


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT unit, seq, event_id, n_steps, {q6('target_total')} AS target_total,
  {", ".join(f"{q6(f'{s}_oldest')} AS {s}_oldest, {q6(f'{s}_newest')} AS {s}_newest, {q6(f'{s}_total')} AS {s}_total" for s in SENSORS)} FROM (
  SELECT unit, seq, event_id, count(*) OVER w AS n_steps, sum(rul) OVER w AS target_total,
    {", ".join(f"first_value({s}) OVER w AS {s}_oldest, last_value({s}) OVER w AS {s}_newest, sum({s}) OVER w AS {s}_total" for s in SENSORS)}
  FROM readings
  WINDOW w AS (PARTITION BY unit ORDER BY seq ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING))
WHERE seq >= 30""",
    )
)
def sequence_windows(spark, sf_dir):
    df = readings(spark, sf_dir)
    out = S.sequence_windows(df, SENSORS, target=LABEL)
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    shown = []
    for i, s in enumerate(SENSORS):
        steps = f"history.f{i}"
        shown += [
            r6(F.get(steps, F.lit(0))).alias(f"{s}_oldest"),
            r6(F.element_at(steps, -1)).alias(f"{s}_newest"),
            r6(total(F.col(steps))).alias(f"{s}_total"),
        ]
    return out.select(
        "unit", "seq", "event_id", F.size("history").cast("long").alias("n_steps"),
        r6(total(F.col("history.target"))).alias("target_total"), *shown,
    )


@query(
    sql_on(
        READINGS_SQL,
        """SELECT unit, event_id, md5(concat_ws('|', CAST(event_id AS VARCHAR), '42')) AS ticket
FROM readings ORDER BY ticket, event_id LIMIT 5000""",
    )
)
def sample_rows(spark, sf_dir):
    df = O.sample_rows(samples(spark, sf_dir), 5000, ["event_id"], ["unit", "event_id"])
    return df.select(
        "unit", "event_id", F.md5(F.concat_ws("|", F.col("event_id").cast("string"), F.lit("42"))).alias("ticket")
    )


@query(
    sql_on(
        READINGS_SQL,
        """SELECT unit, seq, event_id FROM readings
WHERE unit IN (SELECT DISTINCT unit FROM readings ORDER BY unit LIMIT 3)""",
    )
)
def first_units(spark, sf_dir):
    df = readings(spark, sf_dir, label=False)
    return O.first_units(df, 3).select("unit", "seq", "event_id")


@query(
    sql_on(
        READINGS_SQL,
        """SELECT CASE WHEN seq < 5 THEN 'head' ELSE 'tail' END AS part, unit, seq, event_id
FROM (SELECT *, count(*) OVER (PARTITION BY unit) AS n FROM readings
  WHERE unit = (SELECT min(unit) FROM readings))
WHERE seq < 5 OR seq >= n - 5""",
    )
)
def preview_unit(spark, sf_dir):
    """Both ends of the first engine."""
    df = readings(spark, sf_dir, label=False)
    first = df.agg(F.min("unit")).first()[0]
    head = O.preview(df, first).select(F.lit("head").alias("part"), "unit", "seq", "event_id")
    tail = O.preview(df, first, last=True).select(
        F.lit("tail").alias("part"), "unit", "seq", "event_id"
    )
    return head.unionByName(tail)


_PAST = "OVER (PARTITION BY unit ORDER BY seq ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)"


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT unit, split_part(unit, '_', 1) AS dataset, seq AS "time", {q4('CAST(p AS FLOAT)')} AS predicted,
  {q4('CAST(label AS FLOAT)')} AS actual, {q4('CAST(p - label AS FLOAT)')} AS error FROM (
  SELECT unit, seq, label, avg(label) {_PAST} AS p
  FROM (SELECT unit, seq, least(greatest(rul, 0e0), 125e0) AS label FROM readings))
WHERE seq >= 30""",
    )
)
def forecast_naive(spark, sf_dir):
    out = S.naive_forecast(_sequence_series(spark, sf_dir), "label")
    return out.select(
        "unit", "dataset", "time", r4("RUL_Predicted").alias("predicted"),
        r4("RUL_Actual").alias("actual"), r4("Prediction_Error").alias("error"),
    )


def _sequence_series(spark, sf_dir):
    df = readings(spark, sf_dir)
    return df.withColumn("label", clip(F.col(LABEL), 125.0, 0.0))


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT split_part(unit, '_', 1) AS dataset, count(*) AS n, {q6('sqrt(avg(e * e))')} AS rmse
FROM (SELECT unit, CAST(p - label AS FLOAT)::DOUBLE AS e FROM (
  SELECT unit, seq, label, lag(label) OVER (PARTITION BY unit ORDER BY seq) - 1e0 AS p
  FROM (SELECT unit, seq, least(greatest(rul, 0e0), 125e0) AS label FROM readings))
  WHERE seq >= 30)
GROUP BY 1""",
    )
)
def forecast_eval(spark, sf_dir):
    """The last label minus one, against the target at the forecast positions."""
    from rulspark.operators.joins import align_forecast

    series = _sequence_series(spark, sf_dir)
    forecast = S.naive_forecast(series, "label", how="last").select(
        "unit", "dataset", F.col("time").alias("seq"), "RUL_Predicted"
    )
    target = series.select("unit", "seq", F.col("label").cast("float").alias("RUL_Actual"))
    scored = align_forecast(forecast, target)
    error = F.col("RUL_Predicted") - F.col("RUL_Actual")
    return scored.groupBy("dataset").agg(
        F.count("*").alias("n"), r6(F.sqrt(F.avg(error.cast("double") * error.cast("double")))).alias("rmse")
    )


def _forecast(spark, sf_dir, include_target_lags):
    """Linear forecasts from scaled windows of all sensors, fitted on datasets 1 to 5; rows,
    finite predictions and whether they beat the mean, per dataset."""
    from rulspark.operators.modeling import train_vectors

    # Read by each pass of the quantiles and twice for windows.
    path = scratch_path(spark, "series")
    _sequence_series(spark, sf_dir).select("unit", "dataset", "seq", "label", *SENSORS).write.parquet(path)
    series = spark.read.parquet(path)
    train = F.col("dataset") <= 5
    # One row per feature, stored: it is used three times.
    params = durable(fit_robust(series.where(train), [*SENSORS, "label"]))
    windows = S.window_vectors(
        scale(series, params, [*SENSORS, "label"]), SENSORS, "label", include_target_lags=include_target_lags, views=True
    )
    model = train_vectors(windows.where(train), "window", "label", regParam=0.01)
    center, spread = params.where("feature = 'label'").select("center", "scale").first()
    out = S.rolling_forecast(windows, model.transform, "label", center, spread)
    error = F.col("Prediction_Error").cast("double")
    finite = F.col("RUL_Predicted").isNotNull() & (F.abs("RUL_Predicted") < float("inf"))
    return out, out.groupBy("dataset").agg(
        F.count("*").alias("n"), F.every(finite).alias("all_finite"),
        (F.avg(error * error) < F.var_pop(F.col("RUL_Actual").cast("double"))).alias("beats_mean"),
    )


_FORECAST_SQL = sql_on(
    READINGS_SQL,
    """SELECT split_part(unit, '_', 1) AS dataset, count(*) AS n, true AS all_finite{extra}
FROM readings WHERE seq >= 30 GROUP BY 1""",
)


@query(_FORECAST_SQL.replace("{extra}", ", true AS beats_mean"))
def forecast_lr(spark, sf_dir):
    """One step ahead from thirty steps of all sensors and the past label."""
    return _forecast(spark, sf_dir, True)[1]


@query(_FORECAST_SQL.replace("{extra}", ""))
def forecast_covariates(spark, sf_dir):
    """The same without the past label, where that would leak."""
    return _forecast(spark, sf_dir, False)[1].drop("beats_mean")


@query(
    sql_on(
        READINGS_SQL,
        """SELECT unit, count(*) AS n_rows FROM readings WHERE dataset <> 2 OR seq < 20
GROUP BY unit HAVING count(*) <= 30""",
    )
)
def unscored_units(spark, sf_dir):
    """One dataset's engines are cut short, so they get no forecast."""
    series = _sequence_series(spark, sf_dir).where((F.col("dataset") != 2) | (F.col("seq") < 20))
    return S.unscored_units(series, S.naive_forecast(series, "label"))


@query(
    sql_on(
        READINGS_SQL,
        """SELECT unit, count(*) FILTER (WHERE NOT (dataset = 3 AND seq = 0)) AS n_features,
  count(*) FILTER (WHERE NOT (dataset = 5 AND seq < 4)) AS n_labels FROM readings
GROUP BY unit HAVING n_features <> n_labels""",
    )
)
def series_mismatch(spark, sf_dir):
    from rulspark.operators.joins import series_mismatch as mismatch

    features = readings(spark, sf_dir, label=False).where("NOT (dataset = 3 AND seq = 0)")
    labels = label_lines(spark, sf_dir).where("NOT (dataset = 5 AND seq < 4)")
    return mismatch(features, labels)


@query(
    sql_on(
        READINGS_SQL,
        """SELECT unit, split_part(unit, '_', 1) AS dataset, count(*) AS n_timesteps FROM readings
GROUP BY unit""",
    )
)
def unit_metadata(spark, sf_dir):
    from rulspark.operators.joins import unit_metadata as metadata

    return metadata(samples(spark, sf_dir))


_ROBUST_SQL = ",\nparams AS (" + " UNION ALL ".join(
    f"SELECT '{s}' AS feature, quantile_cont({s}, 0.5) AS center, "
    f"CASE WHEN quantile_cont({s}, 0.75) = quantile_cont({s}, 0.25) THEN 1e0 "
    f"ELSE quantile_cont({s}, 0.75) - quantile_cont({s}, 0.25) END AS scale FROM {{source}}"
    for s in SENSORS
) + ")"
TRAIN_ONLY = "(SELECT * FROM readings WHERE dataset <= 5)"


@query(
    sql_on(
        READINGS_SQL + _ROBUST_SQL.format(source=TRAIN_ONLY),
        f"SELECT feature, {q6('center')} AS center, {q6('scale')} AS scale FROM params",
    )
)
def robust_params(spark, sf_dir):
    params = fit_robust(samples(spark, sf_dir).where("dataset <= 5"), SENSORS)
    return params.select("feature", r6("center").alias("center"), r6("scale").alias("scale"))


@query(
    sql_on(
        READINGS_SQL + _ROBUST_SQL.format(source="readings"),
        f"SELECT feature, {q6('center')} AS center, {q6('scale')} AS scale FROM params",
    )
)
def robust_params_pooled(spark, sf_dir):
    """Fitted on training and production data together."""
    df = samples(spark, sf_dir)
    params = fit_robust(df.where("dataset <= 5").unionByName(df.where("dataset > 5")), SENSORS)
    return params.select("feature", r6("center").alias("center"), r6("scale").alias("scale"))


@query(
    sql_on(
        READINGS_SQL + _ROBUST_SQL.format(source=TRAIN_ONLY),
        "SELECT event_id, "
        + ", ".join(
            q6(
                f"({s} - (SELECT center FROM params WHERE feature = '{s}')) / "
                f"(SELECT scale FROM params WHERE feature = '{s}')"
            )
            + f" AS {s}"
            for s in SENSORS
        )
        + " FROM readings",
    )
)
def robust_scaled(spark, sf_dir):
    df = samples(spark, sf_dir)
    out = scale(df, fit_robust(df.where("dataset <= 5"), SENSORS), SENSORS)
    return out.select("event_id", *[r6(s).alias(s) for s in SENSORS])


@query(
    sql_on(
        READINGS_SQL, "SELECT event_id, " + ", ".join(f"{q6(s)} AS {s}" for s in SENSORS) + " FROM readings"
    )
)
def robust_roundtrip(spark, sf_dir):
    df = samples(spark, sf_dir)
    params = fit_robust(df.where("dataset <= 5"), SENSORS)
    out = unscale(scale(df, params, SENSORS), params, SENSORS)
    return out.select("event_id", *[r6(s).alias(s) for s in SENSORS])


def _scaled_sql(center: str, spread: str) -> str:
    fields = ", ".join(
        q6(
            f"({s} - (SELECT {center.format(s)} FROM readings WHERE dataset <= 5)) / "
            f"(SELECT {spread.format(s)} FROM readings WHERE dataset <= 5)"
        )
        + f" AS {s}"
        for s in SENSORS
    )
    return sql_on(READINGS_SQL, f"SELECT event_id, {fields} FROM readings")


@query(_scaled_sql("min({0})", "max({0}) - min({0})"))
def minmax_scaled(spark, sf_dir):
    from rulspark.operators.scaling import fit_minmax

    df = samples(spark, sf_dir)
    out = scale(df, fit_minmax(df.where("dataset <= 5"), SENSORS), SENSORS)
    return out.select("event_id", *[r6(s).alias(s) for s in SENSORS])


@query(_scaled_sql("avg({0})", "stddev_pop({0})"))
def standard_scaled(spark, sf_dir):
    from rulspark.operators.scaling import fit_standard

    df = samples(spark, sf_dir)
    out = scale(df, fit_standard(df.where("dataset <= 5"), SENSORS), SENSORS)
    return out.select("event_id", *[r6(s).alias(s) for s in SENSORS])
