"""Data-quality rules of the silver layer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulspark.functions.columns import col
from rulspark.operators.stats import _moments, missing, rows_from
from rulspark.schema import LABEL, LOW_VARIANCE_RATIO


def quality_dedup(df: DataFrame, fill: Mapping[str, float] | None = None) -> DataFrame:
    """Drop repeated rows; fill missing values where a default is given, else leave them."""
    out = df.dropDuplicates()
    return out.fillna(dict(fill)) if fill else out


def drop_missing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(columns))


def infinite(value: Column) -> Column:
    return F.abs(value) == F.lit(float("inf"))


def validity_rules(columns: Sequence[str], label: str = LABEL) -> dict[str, Column]:
    """Rule name to the condition that rejects a row; the first that holds is its reason."""
    def some(check):
        out = F.lit(False)
        for c in columns:
            out = out | F.coalesce(check(col(c)), F.lit(False))
        return out

    return {
        "missing": some(missing),
        "infinite": some(infinite),
        "negative_label": F.coalesce(col(label) < 0, F.lit(False)),
    }


def quality_filter(
    df: DataFrame, rules: Mapping[str, Column]
) -> tuple[DataFrame, DataFrame]:
    """Rows that break no rule, and the number of rows per reason (``kept`` included)."""
    reason = F.lit("kept")
    for name, broken in reversed(list(rules.items())):
        reason = F.when(broken, F.lit(name)).otherwise(reason)
    tagged = df.withColumn("_reason", reason)
    kept = tagged.where(F.col("_reason") == "kept").drop("_reason")
    counts = tagged.groupBy(F.col("_reason").alias("reason")).agg(F.count("*").alias("n"))
    return kept, counts


def quality_summary(
    df: DataFrame, columns: Sequence[str], keys: Sequence[str], ratio: float = LOW_VARIANCE_RATIO
) -> DataFrame:
    """Per feature: missing values and spread verdict; for the key: rows that repeat it."""
    features = rows_from(
        df, [],
        [
            F.struct(
                _moments(c).alias("m"), F.count_if(missing(col(c))).alias("n_missing")
            )
            for c in columns
        ],
    )
    spread = F.try_divide(F.col("m.std"), F.abs("m.mean"))
    per_feature = features.select(
        F.col("m.feature").alias("subject"),
        "n_missing",
        F.lit(0).cast("long").alias("n_repeated"),
        F.when(F.col("m.std") == 0, "constant")
        .when((F.col("m.std") > 0) & (spread < ratio), "low_variance")
        .otherwise("ok")
        .alias("verdict"),
    )
    repeats = (
        df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("n_repeated"))
    )
    per_key = repeats.select(
        F.lit(",".join(keys)).alias("subject"),
        F.lit(0).cast("long").alias("n_missing"),
        "n_repeated",
        F.when(F.col("n_repeated") > 0, "repeated").otherwise("ok").alias("verdict"),
    )
    return per_feature.unionByName(per_key)
