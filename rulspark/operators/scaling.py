"""Scaler parameters as rows (feature, center, scale), and their use.

Every scaler is ``(x - center) / scale``; a spread of zero counts as one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulspark.functions.columns import col
from rulspark.operators.quantiles import exact_quantiles
from rulspark.operators.stats import rows_from


def _nonzero(spread: Column) -> Column:
    return F.when(spread == 0, F.lit(1.0)).otherwise(spread)


def fit_robust(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Median and interquartile range."""
    quartiles = exact_quantiles(df, columns, (0.25, 0.5, 0.75)).groupBy("feature").agg(
        *[
            F.max(F.when(F.col("prob") == p, F.col("value"))).alias(n)
            for p, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
        ]
    )
    return quartiles.select(
        "feature", F.col("q50").alias("center"), _nonzero(F.col("q75") - F.col("q25")).alias("scale")
    )


def _fit(df: DataFrame, columns: Sequence[str], center, spread) -> DataFrame:
    records = []
    for c in columns:
        x = F.nanvl(col(c).cast("double"), F.lit(None).cast("double"))
        records.append(
            F.struct(
                F.lit(c).alias("feature"),
                center(x).alias("center"),
                _nonzero(spread(x)).alias("scale"),
            )
        )
    return rows_from(df, [], records)


def fit_minmax(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _fit(df, columns, F.min, lambda x: F.max(x) - F.min(x))


def fit_standard(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and population deviation."""
    return _fit(df, columns, F.avg, F.stddev_pop)


def _with_params(df: DataFrame, params: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Attach the parameters of the given columns as one struct, evaluated once."""
    fields = []
    for i, c in enumerate(columns):
        mine = F.col("feature") == c
        fields += [
            F.max(F.when(mine, F.col("center"))).alias(f"center{i}"),
            F.max(F.when(mine, F.col("scale"))).alias(f"scale{i}"),
        ]
    return df.withColumn("_params", params.agg(F.struct(*fields).alias("p")).scalar())


def scale(df: DataFrame, params: DataFrame, columns: Sequence[str]) -> DataFrame:
    out = _with_params(df, params, columns)
    values = {
        c: ((col(c) - F.col(f"_params.center{i}")) / F.col(f"_params.scale{i}")).alias(c)
        for i, c in enumerate(columns)
    }
    return out.select(*[values.get(c, col(c)) for c in df.columns])


def unscale(df: DataFrame, params: DataFrame, columns: Sequence[str]) -> DataFrame:
    out = _with_params(df, params, columns)
    values = {
        c: (col(c) * F.col(f"_params.scale{i}") + F.col(f"_params.center{i}")).alias(c)
        for i, c in enumerate(columns)
    }
    return out.select(*[values.get(c, col(c)) for c in df.columns])
