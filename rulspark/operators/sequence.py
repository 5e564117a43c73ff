"""Fixed-length look-back windows per engine and forecasts made from them."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulspark.errors import NoPredictions
from rulspark.functions.columns import col, unit_dataset
from rulspark.operators.ordering import BLOCK_ROWS, in_blocks
from rulspark.schema import SEQUENCE_LENGTH


def lagged(value: Column, k: int, window) -> Column:
    return F.lag(value, k).over(window)


def delta(value: Column, window) -> Column:
    """First difference."""
    return value - F.lag(value, 1).over(window)


def with_delta(
    df: DataFrame, column: str, name: str, unit: str = "unit", seq: str = "seq",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    return in_blocks(
        df, 1, lambda cut, w: cut.withColumn(name, delta(col(column), w)), unit, seq, block_rows
    )


def sequence_windows(
    df: DataFrame,
    features: Sequence[str],
    n: int = SEQUENCE_LENGTH,
    target: str | None = None,
    include_target_lags: bool = True,
    unit: str = "unit",
    seq: str = "seq",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The ``n`` samples before each sample, oldest first, as ``history``.

    An engine of m rows gives m - n windows. With ``include_target_lags`` the
    past values of ``target`` are part of every step, as a forecaster that is fed
    the true label sees them; leave it off where that would leak.
    """
    steps = [col(f).cast("double").alias(f"f{i}") for i, f in enumerate(features)]
    if target is not None and include_target_lags:
        steps.append(col(target).cast("double").alias("target"))

    def compute(cut: DataFrame, window) -> DataFrame:
        past = window.rowsBetween(-n, -1)
        return cut.withColumn("history", F.collect_list(F.struct(*steps)).over(past))

    return in_blocks(df, n, compute, unit, seq, block_rows).where(col(seq) >= n)


@dataclass(frozen=True)
class Windows:
    """Look-back windows as ``window_vectors`` describes them, not laid out: ``rows`` once, and
    what a window reads of them. ``wanted`` tells of which rows the windows are."""

    rows: DataFrame
    inputs: list[str]
    target: str
    n: int = SEQUENCE_LENGTH
    unit: str = "unit"
    seq: str = "seq"
    block_rows: int = BLOCK_ROWS
    wanted: Column | None = None

    def where(self, condition: Column) -> Windows:
        return replace(self, wanted=condition if self.wanted is None else self.wanted & condition)


def window_vectors(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    n: int = SEQUENCE_LENGTH,
    include_target_lags: bool = True,
    name: str = "window",
    unit: str = "unit",
    seq: str = "seq",
    block_rows: int = BLOCK_ROWS,
    views: bool = False,
) -> DataFrame | Windows:
    """Look-back windows as one vector per row: ``n`` steps of every feature, and of the past
    target if ``include_target_lags``, oldest first. Rows with a missing value in their
    window are dropped. With ``views`` no vector is made: ``modeling.train_vectors`` and its
    model walk the rows themselves."""
    if views:
        inputs = [*features, target] if include_target_lags else list(features)
        return Windows(df, inputs, target, n, unit, seq, block_rows)
    windows = sequence_windows(df, features, n, target, include_target_lags, unit, seq, block_rows)
    fields = [f"f{i}" for i in range(len(features))] + (["target"] if include_target_lags else [])
    flat = F.flatten(F.transform("history", lambda step: F.array(*[step[f] for f in fields])))
    whole = F.forall(flat, lambda x: x.isNotNull() & ~F.isnan(x))
    return windows.withColumn("_flat", flat).where(whole).withColumn(name, array_to_vector("_flat")).drop("_flat", "history")


def lag_columns(
    df: DataFrame,
    column: str,
    lags: Sequence[int],
    unit: str = "unit",
    seq: str = "seq",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``<column>_lag<k>`` for every k, rows without a full history dropped."""

    def compute(cut: DataFrame, window) -> DataFrame:
        return cut.withColumns({f"{column}_lag{k}": lagged(col(column), k, window) for k in lags})

    return in_blocks(df, max(lags), compute, unit, seq, block_rows).where(col(seq) >= max(lags))


def forecast_frame(df: DataFrame, predicted: Column, actual: Column, carry: Sequence[str] = ()) -> DataFrame:
    """Predictions in the sequence layout: ``time`` is the position in the series."""
    p, a = predicted.cast("float"), actual.cast("float")
    return df.select(
        "unit",
        unit_dataset(F.col("unit")).alias("dataset"),
        F.col("seq").alias("time"),
        *carry,
        p.alias("RUL_Predicted"),
        a.alias("RUL_Actual"),
        (predicted - actual).cast("float").alias("Prediction_Error"),
    )


def naive_forecast(
    df: DataFrame, target: str, n: int = SEQUENCE_LENGTH, how: str = "mean",
    unit: str = "unit", seq: str = "seq", block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One step ahead from the past labels alone: their mean, or the last one minus a cycle."""

    def compute(cut: DataFrame, window) -> DataFrame:
        if how == "mean":
            value = F.avg(col(target)).over(window.rowsBetween(-n, -1))
        else:
            value = F.lag(col(target), 1).over(window) - F.lit(1.0)
        return cut.withColumn("_predicted", value)

    scored = in_blocks(df, n, compute, unit, seq, block_rows).where(col(seq) >= n)
    return forecast_frame(scored, F.col("_predicted"), col(target))


def rolling_forecast(
    windows: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    target: str,
    center: float = 0.0,
    scale: float = 1.0,
) -> DataFrame:
    """Score look-back windows and undo the target's scaling.

    ``score`` adds a column ``prediction`` in scaled units; any Spark ML model or
    Arrow-batched scorer will do.
    """
    scored = score(windows)
    back = lambda c: c * F.lit(scale) + F.lit(center)
    return forecast_frame(scored, back(F.col("prediction")), back(col(target)))


def unscored_units(series: DataFrame, predictions: DataFrame, unit: str = "unit") -> DataFrame:
    """Engines that got no prediction, with their length."""
    lengths = series.groupBy(col(unit)).agg(F.count("*").alias("n_rows"))
    return lengths.join(predictions.select(unit).distinct(), unit, "left_anti")


def unscored_with_reason(
    series: DataFrame, predictions: DataFrame, failed: DataFrame, n: int = SEQUENCE_LENGTH, unit: str = "unit"
) -> DataFrame:
    """``unscored_units`` with a ``reason``: the ``error`` of the engine in ``failed``, that it
    is too short, or that every window misses a value."""
    short = F.when(F.col("n_rows") <= n, F.lit(f"not longer than {n} rows"))
    reason = F.coalesce(F.col("error"), short, F.lit("every window misses a value"))
    theirs = failed.select(col(unit).alias("_failed"), "error")
    missing = unscored_units(series, predictions, unit)
    return missing.join(theirs, col(unit).eqNullSafe(F.col("_failed")), "left").select(unit, "n_rows", reason.alias("reason"))


def require_predictions(predictions: DataFrame) -> None:
    if predictions.isEmpty():
        raise NoPredictions("no engine was long enough to be scored")
