"""Exploratory statistics: counts, moments, trends, correlations, histograms."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulspark.functions.columns import col, correlation
from rulspark.operators.quantiles import exact_quantiles
from rulspark.operators.rolling import ema
from rulspark.operators.sequence import with_delta
from rulspark.schema import (
    EMA_SPAN,
    LABEL,
    LABEL_LAGS,
    LABEL_THRESHOLDS,
    LOW_VARIANCE_RATIO,
    MIN_CORR_POINTS,
    SEQUENCE_LENGTH,
    TREND_SENSORS,
)


def rows_from(df: DataFrame, by: Sequence[str], records: Sequence[Column]) -> DataFrame:
    """Aggregates of a wide frame as one row per group and record."""
    grouped = df.groupBy(*[col(b) for b in by]).agg(F.array(*records).alias("_records"))
    return grouped.select(*[col(b) for b in by], F.inline("_records"))


def units(df: DataFrame, unit: str = "unit") -> DataFrame:
    return df.select(col(unit)).distinct().orderBy(unit)


def unit_counts(df: DataFrame, by: str = "dataset", unit: str = "unit") -> DataFrame:
    """Engines per dataset and in all (``is_total`` = 1); a unit belongs to one dataset."""
    pairs = df.select(col(by), col(unit)).distinct()
    return pairs.rollup(col(by)).agg(
        F.grouping_id().cast("int").alias("is_total"), F.count_distinct(col(unit)).alias("n_units")
    )


def max_cycle(df: DataFrame, unit: str = "unit", time: str = "time") -> DataFrame:
    return df.groupBy(col(unit)).agg(F.max(col(time)).alias("max_cycle"))


def series_lengths(df: DataFrame, by: Sequence[str] = ("split",), unit: str = "unit") -> DataFrame:
    return df.groupBy(*[col(b) for b in by], col(unit)).agg(F.count("*").alias("n_rows"))


def split_stats(
    df: DataFrame, seq_len: int = SEQUENCE_LENGTH, split: str = "split", unit: str = "unit"
) -> DataFrame:
    """Engines, mean series length, expected forecasts and sample-size verdict per split."""
    lengths = series_lengths(df, [split], unit)
    per_split = lengths.groupBy(col(split)).agg(
        F.count("*").alias("n_engines"),
        F.sum("n_rows").alias("n_rows"),
        F.avg("n_rows").alias("mean_length"),
        F.sum(F.greatest(F.col("n_rows") - F.lit(seq_len), F.lit(0))).alias("n_forecasts"),
    )
    everything = Window.partitionBy(F.lit(1))  # one row per split
    return per_split.select(
        split,
        "n_engines",
        "n_rows",
        "mean_length",
        "n_forecasts",
        F.try_divide(F.col("n_engines") * 100.0, F.sum("n_engines").over(everything)).alias(
            "engine_share_pct"
        ),
        F.when(F.col("n_engines") >= 30, "sufficient")
        .when(F.col("n_engines") >= 20, "marginal")
        .otherwise("insufficient")
        .alias("verdict"),
    )


def missing(value: Column) -> Column:
    return value.isNull() | F.isnan(value)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns with NULL or NaN and how many, from one pass."""
    records = [
        F.struct(F.lit(c).alias("feature"), F.count_if(missing(col(c))).alias("n_missing"))
        for c in columns
    ]
    return rows_from(df, [], records).where("n_missing > 0")


def _moments(c: str) -> Column:
    x = F.nanvl(col(c), F.lit(None).cast("double"))
    return F.struct(
        F.lit(c).alias("feature"),
        F.count(x).alias("n"),
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min"),
        F.max(x).alias("max"),
    )


def describe(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles per column."""
    probs = (0.25, 0.5, 0.75)
    quartiles = exact_quantiles(df, columns, probs)
    wide = quartiles.groupBy("feature").agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
            for p, n in zip(probs, ("q25", "q50", "q75"))
        ]
    )
    moments = rows_from(df, [], [_moments(c) for c in columns])
    return moments.join(wide, "feature", "left").select(
        "feature", "n", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def low_variance(
    df: DataFrame, columns: Sequence[str], ratio: float = LOW_VARIANCE_RATIO
) -> DataFrame:
    """Constant features and those whose deviation is under ``ratio`` of the mean."""
    moments = rows_from(df, [], [_moments(c) for c in columns])
    std_ratio = F.try_divide(F.col("std"), F.abs("mean"))
    verdict = F.when(F.col("std") == 0, "constant").when(
        (F.col("std") > 0) & (std_ratio < ratio), "low_variance"
    )
    return (
        moments.select("feature", "mean", "std", std_ratio.alias("std_ratio"), verdict.alias("verdict"))
        .where(F.col("verdict").isNotNull())
    )


def feature_distribution(
    df: DataFrame, columns: Sequence[str], by: Sequence[str] = ("dataset",)
) -> DataFrame:
    return rows_from(df, by, [_moments(c) for c in columns])


def sensor_trend(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = ("dataset", "time"),
) -> DataFrame:
    """Mean of every sensor per dataset and cycle, all in one aggregate."""
    return df.groupBy(*[col(b) for b in by]).agg(*[F.avg(col(c)).alias(c) for c in columns])


def smoothed_trend(
    df: DataFrame, columns: Sequence[str] = TREND_SENSORS, label: str = LABEL, span: int = EMA_SPAN
) -> DataFrame:
    """Sensor and label trends, both smoothed, one row per dataset and cycle."""
    names = [*columns, label]
    return ema(sensor_trend(df, names), names, ["dataset"], "time", span)


def _pair_corr(x: Column, y: Column, min_points: int) -> Column:
    both = x.isNotNull() & y.isNotNull()
    return F.when(F.count_if(both) >= min_points, correlation(x, y))


def sensor_label_corr(
    trend: DataFrame,
    sensors: Sequence[str] = TREND_SENSORS,
    label: str = LABEL,
    min_points: int = MIN_CORR_POINTS,
) -> DataFrame:
    """Correlation of each smoothed sensor with the smoothed label per dataset."""
    records = [
        F.struct(
            F.lit(s).alias("feature"), _pair_corr(col(s), col(label), min_points).alias("corr")
        )
        for s in sensors
    ]
    return rows_from(trend, ["dataset"], records)


def corr_matrix(corr: DataFrame, sensors: Sequence[str]) -> DataFrame:
    """Datasets by sensors."""
    return corr.groupBy("dataset").pivot("feature", list(sensors)).agg(F.first("corr"))


def sensor_label_lagcorr(
    trend: DataFrame,
    sensors: Sequence[str] = TREND_SENSORS,
    label: str = LABEL,
    lags: Sequence[int] = LABEL_LAGS,
    min_points: int = MIN_CORR_POINTS,
) -> DataFrame:
    """The same with the sensor delayed by each lag."""
    order = Window.partitionBy("dataset").orderBy("time")
    shifted = {
        f"_s{i}_{k}": F.lag(col(s), k).over(order)
        for i, s in enumerate(sensors)
        for k in lags
    }
    wide = trend.select("dataset", col(label).alias("_label"), *[v.alias(n) for n, v in shifted.items()])
    records = [
        F.struct(
            F.lit(s).alias("feature"),
            F.lit(k).alias("lag"),
            _pair_corr(F.col(f"_s{i}_{k}"), F.col("_label"), min_points).alias("corr"),
        )
        for i, s in enumerate(sensors)
        for k in lags
    ]
    return rows_from(wide, ["dataset"], records)


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Equal-width counts between minimum and maximum, last bin closed, empty bins kept.

    A zero range is widened by half a unit on each side. Only finite values count.
    """
    value = col(column).cast("double")
    x = F.when(F.abs(value) < float("inf"), value)
    span = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    flat = F.col("lo") == F.col("hi")
    limits = span.select(
        F.struct(
            F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
            F.when(flat, F.lit(1.0)).otherwise(F.col("hi") - F.col("lo")).alias("width"),
        ).alias("limits")
    ).scalar()

    def edge(i: Column) -> Column:
        lo, width = F.col("_l.lo"), F.col("_l.width")
        return F.when(i >= bins, lo + width).otherwise(lo + i * (width / F.lit(float(bins))))

    guess = F.floor((F.col("_x") - F.col("_l.lo")) / F.col("_l.width") * F.lit(float(bins)))
    g = F.least(F.greatest(guess, F.lit(0)), F.lit(bins - 1))
    # The division may round across an edge, so the edges decide.
    fixed = (
        F.when((F.col("_x") < edge(F.col("_g"))) & (F.col("_g") > 0), F.col("_g") - 1)
        .when((F.col("_x") >= edge(F.col("_g") + 1)) & (F.col("_g") < bins - 1), F.col("_g") + 1)
        .otherwise(F.col("_g"))
    )
    counts = (
        df.select(x.alias("_x")).where(F.col("_x").isNotNull())
        .withColumn("_l", limits)
        .withColumn("_g", g)
        .groupBy(fixed.alias("_bin"))
        .agg(F.count("*").alias("_n"))
    )
    frame = df.sparkSession.range(bins).select(F.col("id").alias("bin")).withColumn("_l", limits)
    return frame.join(counts, F.col("bin") == F.col("_bin"), "left").select(
        F.col("bin").cast("int").alias("bin"),
        edge(F.col("bin")).alias("bin_low"),
        edge(F.col("bin") + 1).alias("bin_high"),
        F.coalesce("_n", F.lit(0)).alias("n"),
    )


def label_stats(df: DataFrame, label: str = LABEL, by: Sequence[str] = ("split",)) -> DataFrame:
    x = col(label)
    return df.groupBy(*[col(b) for b in by]).agg(
        F.min(x).alias("min"),
        F.max(x).alias("max"),
        F.avg(x).alias("mean"),
        F.stddev_pop(x).alias("std"),
        F.count("*").alias("n"),
    )


def label_exceedance(
    df: DataFrame,
    label: str = LABEL,
    thresholds: Sequence[float] = LABEL_THRESHOLDS,
    by: Sequence[str] = ("split",),
) -> DataFrame:
    """Rows over each threshold, as count and share."""
    records = [
        F.struct(
            F.lit(int(t)).alias("threshold"),
            F.count_if(col(label) > F.lit(float(t))).alias("n_over"),
            F.try_divide(
                F.count_if(col(label) > F.lit(float(t))) * F.lit(100.0), F.count(F.lit(1))
            ).alias("pct_over"),
        )
        for t in thresholds
    ]
    return rows_from(df, by, records)


def label_linearity(df: DataFrame, label: str, unit: str = "unit", seq: str = "seq") -> DataFrame:
    """Moments of the label's first difference and whether it falls by one per step."""
    steps = with_delta(df, label, "_delta", unit, seq)
    d = F.col("_delta")
    out = steps.agg(
        F.avg(d).alias("mean"),
        F.stddev_pop(d).alias("std"),
        F.min(d).alias("min"),
        F.max(d).alias("max"),
        F.count_distinct(d).alias("n_distinct"),
    )
    linear = (F.abs(F.col("mean") + 1.0) < 0.01) & (F.col("std") < 0.01)
    return out.withColumn("is_linear", linear)

