"""Flattening, naming, typing and selecting columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rulspark.errors import MissingColumns
from rulspark.functions import columns as C
from rulspark.functions.columns import col
from rulspark.schema import (
    ARRAY_SLOTS,
    AUX_LAYOUTS,
    BASE_FEATURES,
    CLIPPED_LABEL,
    DEFAULT_DATASET,
    DISPLAY_NAMES,
    ID_COLUMNS,
    LABEL,
    NON_FEATURE_COLUMNS,
    ROLLING_WINDOWS,
    TABULAR_CLIP,
    TABULAR_METADATA,
    derived_names,
)


def require_columns(df: DataFrame, needed: Sequence[str]) -> None:
    missing = [c for c in needed if c not in df.columns]
    if missing:
        raise MissingColumns(missing, df.columns)


def _slot(array: str, position: int) -> Column:
    """An array slot, NULL where the array is too short."""
    return F.get(col(array), F.lit(position))


def aux_columns(layout: str, dataset: int = DEFAULT_DATASET) -> dict[str, Column]:
    slots = AUX_LAYOUTS[layout]
    ids = {name: _slot("A", i).cast("int") for i, name in enumerate(slots)}
    ids.setdefault("dataset", F.lit(dataset).cast("int"))
    return {name: ids[name] for name in ID_COLUMNS}


def aux_ids(df: DataFrame, layout: str = "with_dataset") -> DataFrame:
    """Integer ids decoded from the auxiliary array, next to the other columns."""
    return df.withColumns(aux_columns(layout))


def flatten_arrays(
    df: DataFrame,
    slots: Mapping[str, Sequence[str]] = ARRAY_SLOTS,
    aux_layout: str = "with_dataset",
    carry: Sequence[str] = ("seq",),
) -> DataFrame:
    """Bronze arrays to named columns in one projection; NaN readings become NULL."""
    sensors = [
        C.null_if_nan(_slot(array, i)).alias(name)
        for array, names in slots.items()
        for i, name in enumerate(names)
    ]
    ids = [expr.alias(name) for name, expr in aux_columns(aux_layout).items()]
    extra = [col(c) for c in carry if c in df.columns]
    return df.select(
        *ids,
        *sensors,
        C.null_if_nan(_slot("Y", 0)).alias(LABEL),
        F.to_date(col("snapshot_date")).alias("snapshot_date"),
        *extra,
    )


def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    return df.withColumns({c: col(c).cast(t) for c, t in types.items()})


def parse_date(df: DataFrame, column: str, fmt: str = "yyyy-MM-dd") -> DataFrame:
    return df.withColumn(column, F.to_date(col(column), fmt))


def rename_present(df: DataFrame, names: Mapping[str, str] = DISPLAY_NAMES) -> DataFrame:
    return df.withColumnsRenamed({a: b for a, b in names.items() if a in df.columns})


def with_unit_id(
    df: DataFrame, dataset: str = "dataset", unit_orig: str = "unit_orig", name: str = "unit"
) -> DataFrame:
    return df.withColumn(name, C.unit_id(col(dataset), col(unit_orig)))


def with_unit_dataset(df: DataFrame, unit: str = "unit", name: str = "dataset") -> DataFrame:
    return df.withColumn(name, C.unit_dataset(col(unit)))


def with_path_dataset(df: DataFrame, name: str = "path_dataset") -> DataFrame:
    """Dataset number read from the path of the file a row came from."""
    return df.withColumn(name, C.path_dataset(F.col("_metadata.file_path")))


def clip_label(
    df: DataFrame,
    column: str = LABEL,
    upper: float | None = TABULAR_CLIP,
    lower: float | None = 0.0,
    name: str = CLIPPED_LABEL,
) -> DataFrame:
    return df.withColumn(name, C.clip(col(column), upper, lower))


def label_base(df: DataFrame, upper: float = TABULAR_CLIP, lower: float | None = 0.0) -> DataFrame:
    """Silver rows with descriptive names, unit id and clipped label."""
    return clip_label(with_unit_id(rename_present(df)), LABEL, upper, lower)


def select_present(
    df: DataFrame, features: Sequence[str] = BASE_FEATURES, metadata: Sequence[str] = ()
) -> tuple[DataFrame, list[str]]:
    """The wanted features that exist, and the names of those that do not."""
    present = [c for c in [*metadata, *features] if c in df.columns]
    return df.select(*[col(c) for c in present]), [f for f in features if f not in df.columns]


def order_feature_columns(
    df: DataFrame,
    features: Sequence[str] = BASE_FEATURES,
    metadata: Sequence[str] = TABULAR_METADATA,
    windows: Mapping[str, int] = ROLLING_WINDOWS,
) -> DataFrame:
    """Metadata, then base features, then every derived column."""
    derived = [n for f in features for n in derived_names(f, windows) if n in df.columns]
    head = [c for c in [*metadata, *features] if c in df.columns]
    return df.select(*[col(c) for c in [*head, *derived]])


def feature_columns(df: DataFrame, metadata: Sequence[str] = NON_FEATURE_COLUMNS) -> list[str]:
    return [c for c in df.columns if c not in metadata]


def tabular_labels(base: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """The label lines of the tabular model."""
    wanted = ["unit", "time", CLIPPED_LABEL, "dataset"]
    require_columns(base, wanted)
    return base.select(*[col(c) for c in [*wanted, *carry]])


def with_error(
    df: DataFrame,
    predicted: str = "RUL_Predicted",
    actual: str = "RUL_Actual",
    name: str = "Prediction_Error",
) -> DataFrame:
    return df.withColumn(name, C.signed_error(col(predicted), col(actual)))


def residuals(scored: DataFrame) -> DataFrame:
    """The audit table of a snapshot."""
    return scored.select(
        "unit",
        "time",
        "RUL_Predicted",
        "RUL_Actual",
        C.signed_error(F.col("RUL_Predicted"), F.col("RUL_Actual")).alias("residual"),
    )


def filter_in(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    return df.where(col(column).isin(list(values)))


def with_snapshot_role(
    df: DataFrame, ranges: Mapping[str, tuple[str, str]], date: str = "snapshot_date",
    name: str = "role",
) -> DataFrame:
    """Tag rows by the date range their snapshot falls in; NULL outside all ranges."""
    role = F.lit(None).cast("string")
    for label, (first, last) in reversed(list(ranges.items())):
        inside = col(date).between(F.lit(first).cast("date"), F.lit(last).cast("date"))
        role = F.when(inside, F.lit(label)).otherwise(role)
    return df.withColumn(name, role)


def union_all(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def with_columns(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Put batches of columns side by side in one projection."""
    return df.withColumns(dict(exprs))
