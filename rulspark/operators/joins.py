"""Joins of predictions, labels, series and snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulspark.errors import DuplicateKeys, MissingColumns, NoActuals
from rulspark.functions.columns import col, unit_dataset
from rulspark.operators.metrics import accuracy
from rulspark.operators.ordering import keep_first, skip_warmup
from rulspark.operators.projection import require_columns
from rulspark.schema import CLIPPED_LABEL, SEQUENCE_LENGTH


def join_keys(predictions: DataFrame, labels: DataFrame) -> list[str]:
    keys = ["unit", "time"]
    if "dataset" in predictions.columns and "dataset" in labels.columns:
        keys.append("dataset")
    return keys


def join_actuals(
    predictions: DataFrame,
    labels: DataFrame,
    keys: Sequence[str] | None = None,
    order: Sequence[str] = ("seq",),
) -> DataFrame:
    """Predictions with the actual label of the same key.

    Both sides keep the first row per key, so the join is one to one and no key
    is hot any more; the two aggregates already shuffled on the join key.
    """
    keys = list(keys or join_keys(predictions, labels))
    require_columns(predictions, keys)
    require_columns(labels, keys)
    if CLIPPED_LABEL in labels.columns:
        actual = col(CLIPPED_LABEL)
    elif "RUL_Actual" in labels.columns:
        actual = col("RUL_Actual")
    else:
        raise MissingColumns([f"{CLIPPED_LABEL} or RUL_Actual"], labels.columns)
    left = predictions.drop("RUL_Actual", "Prediction_Error")
    right = labels.select(
        *[col(k) for k in keys], actual.cast("float").alias("RUL_Actual"),
        *[col(o).alias(f"_order_{o}") for o in order],
    )
    left = keep_first(left, keys, order)
    right = keep_first(right, keys, [f"_order_{o}" for o in order])
    right = right.drop(*[f"_order_{o}" for o in order])
    return left.join(right, keys, "inner")


def key_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with how often."""
    return df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: Sequence[str]) -> None:
    if not key_violations(df, keys).isEmpty():
        raise DuplicateKeys(f"rows are not unique on {list(keys)}")


def require_actuals(df: DataFrame, actual: str = "RUL_Actual") -> None:
    if df.where(col(actual).isNotNull()).isEmpty():
        raise NoActuals(f"no row has a value in {actual}")


def align_on(a: DataFrame, b: DataFrame, keys: Sequence[str], values: Sequence[str] = ()) -> DataFrame:
    """Inner alignment of two series, rows with a missing value dropped."""
    joined = a.join(b, list(keys), "inner")
    return joined.dropna(subset=list(values) or None)


def align_forecast(
    forecast: DataFrame, target: DataFrame, keys: Sequence[str] = ("unit", "seq")
) -> DataFrame:
    """The target restricted to the positions that were forecast."""
    return forecast.join(target, list(keys), "inner")


def apply_split(df: DataFrame, split_map: DataFrame, unit: str = "unit") -> DataFrame:
    """Attach each engine's split; adaptive execution broadcasts the map when it is small."""
    return df.join(split_map.select(unit, "split"), unit, "inner")


def unit_metadata(series: DataFrame, unit: str = "unit") -> DataFrame:
    """Dataset tag and length of every engine, by id."""
    return (
        series.groupBy(col(unit))
        .agg(F.count("*").alias("n_timesteps"))
        .withColumn("dataset", unit_dataset(col(unit)))
        .orderBy(unit)
    )


def series_mismatch(features: DataFrame, labels: DataFrame, unit: str = "unit") -> DataFrame:
    """Engines whose feature and label series differ in length or exist on one side only."""
    a = features.groupBy(unit).agg(F.count("*").alias("n_features"))
    b = labels.groupBy(unit).agg(F.count("*").alias("n_labels"))
    both = a.join(b, unit, "full_outer").fillna(0, ["n_features", "n_labels"])
    return both.where(F.col("n_features") != F.col("n_labels"))


def shared_rows(
    models: dict[str, DataFrame],
    skip: int = SEQUENCE_LENGTH,
    keys: Sequence[str] = ("unit", "seq"),
) -> DataFrame:
    """Predictions of several models on the rows all of them scored, warm-up left out.

    One row per key with ``actual`` and ``predicted_<model>``.
    """
    sides = []
    for i, (name, scored) in enumerate(models.items()):
        actual = [F.col("RUL_Actual").alias("actual")] if i == 0 else []
        sides.append(
            skip_warmup(scored, skip).select(
                *[col(k) for k in keys], *actual, F.col("RUL_Predicted").alias(f"predicted_{name}")
            )
        )
    return reduce(lambda a, b: a.join(b, list(keys), "inner"), sides)


def fair_comparison(
    models: dict[str, DataFrame],
    skip: int = SEQUENCE_LENGTH,
    keys: Sequence[str] = ("unit", "seq"),
) -> DataFrame:
    """RMSE, MAE, R² and size per model on the shared rows."""
    rows = shared_rows(models, skip, keys)
    scored = F.explode(
        F.array(
            *[
                F.struct(F.lit(m).alias("model"), F.col(f"predicted_{m}").alias("RUL_Predicted"))
                for m in models
            ]
        )
    )
    long = rows.select("actual", scored.alias("s")).select(
        "s.model", "s.RUL_Predicted", F.col("actual").alias("RUL_Actual")
    )
    return accuracy(long, by=["model"])


def pending_snapshots(features: DataFrame, predictions: DataFrame, cutoff: str) -> DataFrame:
    """Snapshots on or after ``cutoff`` that have features but no predictions."""
    wanted = features.where(F.col("snapshot_date") >= F.lit(cutoff).cast("date"))
    done = predictions.select("snapshot_date").distinct()
    return (
        wanted.select("snapshot_date").distinct()
        .join(done, "snapshot_date", "left_anti")
        .orderBy("snapshot_date")
    )
