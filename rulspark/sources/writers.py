"""Writing layer tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame

from rulspark.functions.columns import col
from rulspark.operators.ordering import ordered_series
from rulspark.schema import MAX_ROWS_PER_FILE

# Options of the silver and label tables.
LAYER_OPTIONS = {"compression": "snappy", "parquet.enable.dictionary": "false"}


def write_layer(
    df: DataFrame,
    path: str,
    by: Sequence[str] = (),
    mode: str = "overwrite",
    max_rows: int = MAX_ROWS_PER_FILE,
    options: Mapping[str, str] = LAYER_OPTIONS,
    spread: bool = True,
) -> None:
    """Parquet with bounded files; partitions not in ``df`` stay untouched.

    Rows of a partition spread over as many tasks as its size asks for: the
    rebalance splits a partition value that is too big and merges small ones.
    """
    rows = df.hint("rebalance", *[col(b) for b in by]) if by and spread else df
    writer = (
        rows.write.mode(mode)
        .option("maxRecordsPerFile", max_rows)
        .options(**options)
    )
    if by:
        writer = writer.option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    writer.parquet(path)


def overwrite_snapshots(df: DataFrame, path: str, by: str = "snapshot_date", **kwargs) -> None:
    """Replace the snapshots found in ``df`` and no others."""
    write_layer(df, path, by=[by], **kwargs)


def write_label_base(
    df: DataFrame, path: str, partitioned: bool = True, max_rows: int = MAX_ROWS_PER_FILE
) -> None:
    """By snapshot and dataset, or by snapshot alone.

    Either way a snapshot is cut into files of at most ``max_rows``, so one that fits a
    file is one file.
    """
    write_layer(df, path, by=["snapshot_date", *(["dataset"] if partitioned else [])], max_rows=max_rows)


def series_table(
    df: DataFrame, columns: Sequence[str], unit: str = "unit", seq: str = "seq"
) -> DataFrame:
    """One series per engine in long form, laid out by engine and position."""
    return ordered_series(df.select(col(unit), col(seq), *[col(c) for c in columns]), unit, seq)


def write_splits(df: DataFrame, path: str) -> None:
    write_layer(df, path, by=["split"])


def write_metrics_document(documents: DataFrame, path: str, key: str = "snapshot_date") -> None:
    """One JSON document per snapshot."""
    documents.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        key
    ).json(path)


def write_history(history: DataFrame, path: str, mode: str = "upsert") -> None:
    """``append`` adds the rows, ``upsert`` replaces the snapshots they belong to."""
    if mode == "append":
        history.write.mode("append").parquet(path)
    else:
        write_layer(history, path, by=["snapshot_date"])
