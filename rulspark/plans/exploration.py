"""Queries of the exploratory analysis: statistics, trends, shift, quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from rulspark.operators import quality as Q
from rulspark.operators import shift as H
from rulspark.operators import stats as S
from rulspark.operators.ordering import extreme_labels
from rulspark.operators.scaling import fit_minmax, scale
from rulspark.plans.evaluation import scored_a
from rulspark.operators.quantiles import exact_quantiles
from rulspark.plans.frames import (
    DISPLAY_SENSOR,
    PREDICTIONS_SQL,
    QUALITY_SQL,
    READINGS_SQL,
    SENSORS,
    predictions_a,
    q6,
    q9,
    quality_rows,
    r6,
    r9,
    readings,
    samples,
    sql_on,
    two_samples,
)
from rulspark.plans.registry import query
from rulspark.schema import EMA_SPAN, LABEL, LABEL_LAGS, LABEL_THRESHOLDS, TREND_SENSORS

DIRTY = ["s1", "s2", "flat", "nearly_flat"]


def _rounded(df):
    kinds = dict(df.dtypes)
    return df.select(*[r6(c).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns])


def _labelled(spark, sf_dir):
    df = readings(spark, sf_dir, seq=False)
    return df.withColumn("split", F.when(F.col("event_id") % 2 == 0, "dev").otherwise("test"))


_SPLIT = "(SELECT *, CASE WHEN event_id % 2 = 0 THEN 'dev' ELSE 'test' END AS split FROM readings)"


def _each(expr: str, names, source="readings", tail="") -> str:
    """The same aggregate row for every column."""
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {expr.format(c)} FROM {source} {tail}" for c in names
    )


@query(
    sql_on(
        READINGS_SQL,
        'SELECT dataset, "time", '
        + ", ".join(f"{q6(f'avg({s})')} AS {s}" for s in SENSORS)
        + ' FROM readings GROUP BY dataset, "time"',
    )
)
def sensor_trend(spark, sf_dir):
    return _rounded(S.sensor_trend(samples(spark, sf_dir), SENSORS))


_A = f"(2e0 / {EMA_SPAN + 1}e0)"
_SMOOTH_SQL = (
    "WITH RECURSIVE "
    + READINGS_SQL
    + f""",
trend AS (
  SELECT dataset, "time", {", ".join(f"avg({s}) AS {s}" for s in SENSORS)}, avg(rul) AS rul,
    row_number() OVER (PARTITION BY dataset ORDER BY "time") AS i
  FROM readings GROUP BY dataset, "time"),
smooth AS (
  SELECT dataset, "time", {", ".join(SENSORS)}, rul, i FROM trend WHERE i = 1
  UNION ALL
  SELECT t.dataset, t."time", {", ".join(f"{_A} * t.{s} + (1e0 - {_A}) * p.{s}" for s in SENSORS)},
    {_A} * t.rul + (1e0 - {_A}) * p.rul, t.i
  FROM smooth p JOIN trend t ON t.dataset = p.dataset AND t.i = p.i + 1)
"""
)


def _trend(spark, sf_dir):
    """The trend sensors by their display names, as the label base holds them."""
    df = readings(spark, sf_dir, seq=False)
    named = [F.col(DISPLAY_SENSOR[n]).alias(n) for n in TREND_SENSORS]
    return S.smoothed_trend(df.select("dataset", "time", LABEL, *named), TREND_SENSORS)


@query(
    _SMOOTH_SQL
    + " UNION ALL ".join(
        f"SELECT dataset, '{n}' AS feature, CASE WHEN count(*) > 5 THEN {q6(f'corr({DISPLAY_SENSOR[n]}, rul)')} END AS corr "
        "FROM smooth GROUP BY dataset"
        for n in TREND_SENSORS
    )
)
def sensor_rul_corr(spark, sf_dir):
    return _rounded(S.sensor_label_corr(_trend(spark, sf_dir), TREND_SENSORS))


@query(
    _SMOOTH_SQL
    + " UNION ALL ".join(
        f"SELECT dataset, '{n}' AS feature, {k} AS lag, CASE WHEN count(x) > 5 THEN {q6('corr(x, rul)')} END AS corr "
        f'FROM (SELECT dataset, rul, lag({DISPLAY_SENSOR[n]}, {k}) OVER (PARTITION BY dataset ORDER BY "time") AS x FROM smooth) '
        "GROUP BY dataset"
        for n in TREND_SENSORS
        for k in LABEL_LAGS
    )
)
def sensor_rul_lagcorr(spark, sf_dir):
    return _rounded(S.sensor_label_lagcorr(_trend(spark, sf_dir), TREND_SENSORS))


@query(
    sql_on(
        READINGS_SQL,
        """SELECT dataset, CAST(grouping(dataset) AS INTEGER) AS is_total, count(DISTINCT unit) AS n_units
FROM readings GROUP BY ROLLUP (dataset)""",
    )
)
def units_per_dataset(spark, sf_dir):
    return S.unit_counts(samples(spark, sf_dir))


@query(sql_on(READINGS_SQL, 'SELECT unit, max("time") AS max_cycle FROM readings GROUP BY unit'))
def max_cycle(spark, sf_dir):
    return S.max_cycle(samples(spark, sf_dir))


@query(sql_on(READINGS_SQL, "SELECT DISTINCT unit FROM readings"))
def distinct_units(spark, sf_dir):
    return S.units(samples(spark, sf_dir))


@query(
    sql_on(
        QUALITY_SQL,
        "SELECT * FROM ("
        + _each("count(*) FILTER (WHERE {0} IS NULL) AS n_missing", DIRTY, "quality")
        + ") WHERE n_missing > 0",
    )
)
def null_counts(spark, sf_dir):
    return S.null_counts(quality_rows(spark, sf_dir), DIRTY)


_DESCRIBE = (
    "count({0}) AS n, "
    + ", ".join(
        f"{q6(e)} AS {n}"
        for e, n in (
            ("avg({0})", "mean"), ("stddev_samp({0})", "std"), ("min({0})", "min"),
            ("quantile_cont({0}, 0.25)", "q25"), ("quantile_cont({0}, 0.5)", "q50"),
            ("quantile_cont({0}, 0.75)", "q75"), ("max({0})", "max"),
        )
    )
)


@query(sql_on(READINGS_SQL, _each(_DESCRIBE, [*SENSORS, "rul"])))
def describe(spark, sf_dir):
    df = readings(spark, sf_dir, seq=False).withColumnRenamed(LABEL, "rul")
    return _rounded(S.describe(df, [*SENSORS, "rul"]))


@query(
    sql_on(
        QUALITY_SQL,
        f"""SELECT feature, {q6('mean')} AS mean, {q6('std')} AS std, {q6('std / abs(mean)')} AS std_ratio,
  CASE WHEN std = 0 THEN 'constant' ELSE 'low_variance' END AS verdict FROM ("""
        + _each("avg({0}) AS mean, stddev_samp({0}) AS std", DIRTY, "quality")
        + ") WHERE std = 0 OR std / abs(mean) < 0.001e0",
    )
)
def low_variance(spark, sf_dir):
    return _rounded(S.low_variance(quality_rows(spark, sf_dir), DIRTY))


def _histogram_sql(source: str, column: str, bins: int) -> str:
    return f"""edges AS (
  SELECT CASE WHEN min(x) = max(x) THEN min(x) - 0.5e0 ELSE min(x) END AS lo,
    CASE WHEN min(x) = max(x) THEN 1e0 ELSE max(x) - min(x) END AS width
  FROM (SELECT {column}::DOUBLE AS x FROM {source})),
bins AS (
  SELECT CAST(i AS INTEGER) AS bin, lo + i * (width / {bins}e0) AS bin_low,
    CASE WHEN i = {bins - 1} THEN lo + width ELSE lo + (i + 1) * (width / {bins}e0) END AS bin_high
  FROM edges, range({bins}) r(i))
SELECT bin, {q6('bin_low')} AS bin_low, {q6('bin_high')} AS bin_high, count(x) AS n
FROM bins LEFT JOIN (SELECT {column}::DOUBLE AS x FROM {source})
  ON x >= bin_low AND (x < bin_high OR (bin = {bins - 1} AND x <= bin_high))
GROUP BY bin, bin_low, bin_high"""


@query("WITH " + PREDICTIONS_SQL + ",\n" + _histogram_sql("pred_a", "err", 50))
def residual_histogram(spark, sf_dir):
    return _rounded(S.histogram(scored_a(spark, sf_dir), "Prediction_Error", 50))


def _dirty(event_id, value):
    """Of a hundred values one is missing, one infinite and one negative infinite."""
    k = event_id % 100
    odd = F.when(k == 0, float("nan")).when(k == 1, float("inf")).when(k == 2, -float("inf"))
    return F.coalesce(odd, value.cast("double"))


@query(
    "WITH " + PREDICTIONS_SQL + ",\ndirty AS (SELECT err FROM pred_a WHERE event_id % 100 > 2),\n"
    + _histogram_sql("dirty", "err", 50)
)
def dirty_histogram(spark, sf_dir):
    """Residuals of which some are not numbers: only finite ones are counted."""
    df = predictions_a(spark, sf_dir, seq=False)
    return _rounded(S.histogram(df.select(_dirty(F.col("event_id"), F.col("Prediction_Error")).alias("x")), "x", 50))


@query(
    sql_on(
        READINGS_SQL,
        " UNION ALL ".join(
            f"SELECT '{s}' AS feature, {p}e0 AS prob, {q6(f'quantile_cont(x, {p})')} AS value FROM ("
            f"SELECT CASE event_id % 100 WHEN 1 THEN 'inf'::DOUBLE WHEN 2 THEN '-inf'::DOUBLE ELSE {s} END AS x "
            "FROM readings WHERE event_id % 100 > 0)"
            for s in SENSORS
            for p in (0.1, 0.5, 0.9)
        ),
    )
)
def dirty_quantiles(spark, sf_dir):
    """Quantiles over missing and infinite readings, by brackets that are narrowed."""
    df = samples(spark, sf_dir)
    odd = df.select(*[_dirty(F.col("event_id"), F.col(s)).alias(s) for s in SENSORS])
    out = exact_quantiles(odd, SENSORS, (0.1, 0.5, 0.9), max_rows=500, k=64)
    return out.select("feature", "prob", r6("value").alias("value"))


@query("WITH " + READINGS_SQL + ",\n" + _histogram_sql("readings", "s5", 30))
def sensor_histogram(spark, sf_dir):
    return _rounded(S.histogram(samples(spark, sf_dir), "s5", 30))


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT split, {q6('min(rul)')} AS min, {q6('max(rul)')} AS max, {q6('avg(rul)')} AS mean,
  {q6('stddev_pop(rul)')} AS std, count(*) AS n FROM {_SPLIT} GROUP BY split""",
    )
)
def label_stats(spark, sf_dir):
    return _rounded(S.label_stats(_labelled(spark, sf_dir)))


@query(
    sql_on(
        READINGS_SQL,
        " UNION ALL ".join(
            f"""SELECT split, {t} AS threshold, count(*) FILTER (WHERE rul > {t}) AS n_over,
  {q6(f'100e0 * count(*) FILTER (WHERE rul > {t}) / count(*)')} AS pct_over FROM {_SPLIT} GROUP BY split"""
            for t in LABEL_THRESHOLDS
        ),
    )
)
def label_exceedance(spark, sf_dir):
    return _rounded(S.label_exceedance(_labelled(spark, sf_dir)))


@query(
    sql_on(
        READINGS_SQL,
        """SELECT * FROM (SELECT 'first' AS side, value FROM high ORDER BY value LIMIT 30)
UNION ALL SELECT * FROM (SELECT 'last', value FROM high ORDER BY value DESC LIMIT 10)""",
        "high AS (SELECT DISTINCT rul AS value FROM readings WHERE rul > 100e0)",
    )
)
def high_labels(spark, sf_dir):
    return extreme_labels(readings(spark, sf_dir, seq=False), LABEL)


@query(
    sql_on(
        READINGS_SQL,
        " UNION ALL ".join(
            f"""SELECT dataset, '{s}' AS feature, count({s}) AS n, {q6(f'avg({s})')} AS mean,
  {q6(f'stddev_samp({s})')} AS std, {q6(f'min({s})')} AS min, {q6(f'max({s})')} AS max
FROM readings GROUP BY dataset"""
            for s in SENSORS
        ),
    )
)
def feature_distribution(spark, sf_dir):
    return _rounded(S.feature_distribution(samples(spark, sf_dir), SENSORS))


_FIT_SQL = "fit AS (SELECT " + ", ".join(
    f"min({s}) AS lo{s}, max({s}) - min({s}) AS w{s}" for s in SENSORS
) + " FROM readings WHERE dataset <= 3)"


def _range_by_feature() -> str:
    return " UNION ALL ".join(
        f"""SELECT '{s}' AS feature, min(z) AS min_scaled, max(z) AS max_scaled,
  100e0 * count(*) FILTER (WHERE z < 0) / count(z) AS pct_below,
  100e0 * count(*) FILTER (WHERE z > 1) / count(z) AS pct_above
FROM (SELECT ({s} - lo{s}) / w{s} AS z FROM readings, fit WHERE dataset > 3)"""
        for s in SENSORS
    )


def _range_report(spark, sf_dir):
    reference, current = two_samples(spark, sf_dir)
    return H.range_shift(scale(current, fit_minmax(reference, SENSORS), SENSORS), SENSORS)


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT feature, {q6('min_scaled')} AS min_scaled, {q6('max_scaled')} AS max_scaled,
  {q6('pct_below')} AS pct_below, {q6('pct_above')} AS pct_above,
  (min_scaled < -0.01e0 OR max_scaled > 1.01e0) AS out_of_range FROM ({_range_by_feature()})""",
        _FIT_SQL,
    )
)
def range_shift(spark, sf_dir):
    return _rounded(_range_report(spark, sf_dir))


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT {q6('lo')} AS min_scaled, {q6('hi')} AS max_scaled, {q6('abs(least(lo, 0e0))')} AS below_zero,
  {q6('greatest(hi - 1e0, 0e0)')} AS above_one,
  CASE WHEN lo > -0.05e0 AND hi < 1.05e0 THEN 'MILD' WHEN lo > -0.2e0 AND hi < 1.2e0 THEN 'MODERATE'
    ELSE 'SEVERE' END AS severity
FROM (SELECT min(min_scaled) AS lo, max(max_scaled) AS hi FROM ({_range_by_feature()}))""",
        _FIT_SQL,
    )
)
def shift_severity(spark, sf_dir):
    return _rounded(H.shift_severity(_range_report(spark, sf_dir)))


def _ks_sql() -> str:
    steps = " UNION ALL ".join(
        f"""SELECT '{s}' AS feature, {s} AS x, count(*) FILTER (WHERE dataset <= 3) AS r,
  count(*) FILTER (WHERE dataset > 3) AS c FROM readings GROUP BY {s}"""
        for s in SENSORS
    )
    return f"""SELECT feature, n_ref, n_cur, {q9('d')} AS distance, {q9('p')} AS p_value,
  p < 0.05e0 AS shifted
FROM (SELECT *, CASE WHEN d = 0 THEN 1e0 ELSE least(greatest(2e0 * (SELECT sum(
    CASE WHEN k % 2 = 1 THEN 1e0 ELSE -1e0 END
    * exp(-2e0 * k * k * pow(sqrt(n_ref::DOUBLE * n_cur / (n_ref + n_cur)) * d, 2e0)))
    FROM range(1, 101) t(k)), 0e0), 1e0) END AS p
  FROM (SELECT feature, n_ref, n_cur, max(abs(fr - fc)) AS d FROM (
    SELECT feature, CAST(sum(r) OVER f AS BIGINT) AS n_ref, CAST(sum(c) OVER f AS BIGINT) AS n_cur,
      sum(r) OVER w / (sum(r) OVER f)::DOUBLE AS fr, sum(c) OVER w / (sum(c) OVER f)::DOUBLE AS fc
    FROM ({steps})
    WINDOW f AS (PARTITION BY feature), w AS (PARTITION BY feature ORDER BY x))
  GROUP BY feature, n_ref, n_cur))"""


@query(sql_on(READINGS_SQL, _ks_sql()))
def ks_two_sample(spark, sf_dir):
    reference, current = two_samples(spark, sf_dir)
    out = H.ks_two_sample(reference, current, SENSORS)
    return out.select(
        "feature", "n_ref", "n_cur", r9("distance").alias("distance"), r9("p_value").alias("p_value"),
        "shifted",
    )


def _psi_sql() -> str:
    parts = []
    for s in SENSORS:
        cuts = " + ".join(f"CASE WHEN {s} > (SELECT q[{i}] FROM deciles_{s}) THEN 1 ELSE 0 END" for i in range(1, 10))
        parts.append(
            f"""SELECT '{s}' AS feature, count(*) FILTER (WHERE dataset <= 3) AS r,
  count(*) FILTER (WHERE dataset > 3) AS c FROM readings GROUP BY {cuts}"""
        )
    deciles = [
        f"deciles_{s} AS (SELECT quantile_cont({s}, [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS q "
        "FROM readings WHERE dataset <= 3)"
        for s in SENSORS
    ]
    return sql_on(
        READINGS_SQL,
        f"""SELECT feature, {q6('sum((p - q) * ln(p / q))')} AS psi, {q6('sum(p * ln(p / q))')} AS kl
FROM (SELECT feature, greatest(c / (sum(c) OVER f)::DOUBLE, 1e-6) AS p,
    greatest(r / (sum(r) OVER f)::DOUBLE, 1e-6) AS q
  FROM ({" UNION ALL ".join(parts)}) WINDOW f AS (PARTITION BY feature))
GROUP BY feature""",
        *deciles,
    )


@query(_psi_sql())
def psi_kl(spark, sf_dir):
    reference, current = two_samples(spark, sf_dir)
    return _rounded(H.psi_kl(reference, current, SENSORS))


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT {q6('avg(d)')} AS mean, {q6('stddev_pop(d)')} AS std, {q6('min(d)')} AS min, {q6('max(d)')} AS max,
  count(DISTINCT d) AS n_distinct, abs(avg(d) + 1e0) < 0.01e0 AND stddev_pop(d) < 0.01e0 AS is_linear
FROM (SELECT rul - lag(rul) OVER (PARTITION BY unit ORDER BY seq) AS d FROM readings)""",
    )
)
def label_linearity(spark, sf_dir):
    return _rounded(S.label_linearity(readings(spark, sf_dir), LABEL))


@query(
    sql_on(
        QUALITY_SQL,
        f"""SELECT event_id, unit, "time", {q6('coalesce(s1, 0e0)')} AS s1, {q6('s2')} AS s2 FROM (
  SELECT DISTINCT * FROM quality)""",
    )
)
def quality_dedup(spark, sf_dir):
    out = Q.quality_dedup(quality_rows(spark, sf_dir), fill={"s1": 0.0})
    return out.select("event_id", "unit", "time", r6("s1").alias("s1"), r6("s2").alias("s2"))


@query(
    sql_on(
        QUALITY_SQL,
        f"""SELECT 'count' AS part, reason, CAST(NULL AS BIGINT) AS event_id, CAST(NULL AS DOUBLE) AS s1, count(*) AS n
FROM (SELECT CASE WHEN s1 IS NULL THEN 'missing' WHEN label < 0 THEN 'negative_label' ELSE 'kept' END AS reason
  FROM quality) GROUP BY reason
UNION ALL SELECT 'row', 'kept', event_id, {q6('s1')}, count(*) FROM quality
WHERE s1 IS NOT NULL AND label >= 0 GROUP BY event_id, s1""",
    )
)
def quality_filter(spark, sf_dir):
    """Rows per reason, and every row that was kept with how often it occurs."""
    df = quality_rows(spark, sf_dir)
    kept, counts = Q.quality_filter(df, Q.validity_rules(["s1", "s2"], "label"))
    nothing = {"event_id": F.lit(None).cast("long"), "s1": F.lit(None).cast("double")}
    totals = counts.select(F.lit("count").alias("part"), "reason", *[v.alias(k) for k, v in nothing.items()], "n")
    rows = kept.groupBy("event_id", "s1").agg(F.count("*").alias("n"))
    return totals.unionByName(
        rows.select(F.lit("row").alias("part"), F.lit("kept").alias("reason"), "event_id", r6("s1").alias("s1"), "n")
    )


@query(
    sql_on(
        QUALITY_SQL,
        f"""SELECT feature AS subject, n_missing, CAST(0 AS BIGINT) AS n_repeated,
  CASE WHEN std = 0 THEN 'constant' WHEN std / abs(mean) < 0.001e0 THEN 'low_variance' ELSE 'ok' END AS verdict
FROM ({_each("count(*) FILTER (WHERE {0} IS NULL) AS n_missing, avg({0}) AS mean, stddev_samp({0}) AS std", DIRTY, "quality")})
UNION ALL SELECT 'event_id', 0, CAST(sum(n - 1) AS BIGINT), 'repeated'
FROM (SELECT count(*) AS n FROM quality GROUP BY event_id)""",
    )
)
def quality_summary(spark, sf_dir):
    return Q.quality_summary(quality_rows(spark, sf_dir), DIRTY, ["event_id"])
