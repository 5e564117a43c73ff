"""Row order inside an engine: positions, blocks, first rows, samples.

An engine may hold a large share of all rows, so nothing here sorts a whole
engine in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rulspark.functions.columns import col
from rulspark.schema import SEED, SEQUENCE_LENGTH

# Rows of one engine handled by one window task.
BLOCK_ROWS = 100_000


def with_ordinal(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "seq") -> DataFrame:
    """Number the rows of each key group 0, 1, 2 ... by ``order``.

    The first column of ``order`` cuts a group into pieces, as a cycle does an engine's
    life: pieces are counted by a map-side aggregate, a running sum over these few rows says
    where each piece begins, and rows are numbered inside their piece. So a task sorts one
    piece, not a group, whatever share of all rows a group has. ``order`` should tell rows
    apart, or ties are numbered in no fixed order.
    """
    # A struct is never null and compares nulls as equal, in the window and in the join.
    piece = F.struct(*[col(k).alias(f"k{i}") for i, k in enumerate(keys)], col(order[0]).alias("at"))
    cut = df.withColumn("_piece", piece)
    sizes = df.select(piece.alias("_piece")).groupBy("_piece").agg(F.count("*").alias("_rows"))
    earlier = (
        Window.partitionBy(*[F.col(f"_piece.k{i}") for i in range(len(keys))])
        .orderBy("_piece.at")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    begins = sizes.select("_piece", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_begin"))
    inside = Window.partitionBy("_piece").orderBy(*[col(o) for o in (order[1:] or order)])
    numbered = cut.withColumn("_inside", F.row_number().over(inside) - 1)
    return numbered.join(begins, "_piece").select(
        *[col(c) for c in df.columns], (F.col("_begin") + F.col("_inside")).alias(name)
    )


def with_series_index(
    df: DataFrame, unit: str = "unit", order: Sequence[str] = ("time", "seq"), name: str = "index"
) -> DataFrame:
    """Position 0..n-1 of every sample in its engine's series."""
    return with_ordinal(df, [unit], list(order), name)


def in_blocks(
    df: DataFrame,
    halo: int,
    compute: Callable[[DataFrame, Window], DataFrame],
    unit: str = "unit",
    seq: str = "seq",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Apply a bounded look-back window to engines cut into blocks of ``block_rows``.

    ``seq`` must be the dense position within the engine. The last ``halo`` rows
    of a block are copied into the next one as its history and dropped again
    afterwards, so the result equals the uncut window. ``compute`` gets the rows
    and the window (partitioned and ordered, without a frame). A null position is an error.
    """
    if halo >= block_rows:
        raise ValueError("a block must be longer than the history it needs")
    known = F.when(col(seq).isNull(), F.raise_error(F.lit(f"{seq} is null"))).otherwise(col(seq))
    own = F.floor(known / F.lit(block_rows))
    near_end = F.pmod(col(seq), F.lit(block_rows)) >= F.lit(block_rows - halo)
    copies = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    window = Window.partitionBy(col(unit), F.col("_block")).orderBy(col(seq))
    cut = df.withColumn("_block", F.explode(copies))
    return compute(cut, window).where(F.col("_block") == own).drop("_block")


def ordered_series(df: DataFrame, unit: str = "unit", seq: str = "seq") -> DataFrame:
    """Rows laid out by engine and position; a big engine spans several partitions."""
    keys = [col(unit), col(seq)]
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str] = ("seq",)) -> DataFrame:
    """One row per key: the earliest by ``order``.

    A rank of which only the first is kept: every task drops later copies of a key before
    they are shuffled, so a hot key arrives as one row per task.
    """
    first = Window.partitionBy(*[col(k) for k in keys]).orderBy(*[col(o) for o in order])
    return df.withColumn("_rank", F.row_number().over(first)).where("_rank = 1").drop("_rank")


def dedup_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows, rows kept by ``keep_first`` and rows dropped."""
    return (
        df.groupBy(*[col(k) for k in keys])
        .agg(F.count("*").alias("_n"))
        .agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("rows_before"),
            F.count("*").alias("rows_kept"),
        )
        .withColumn("rows_dropped", F.col("rows_before") - F.col("rows_kept"))
    )


def skip_warmup(df: DataFrame, rows: int = SEQUENCE_LENGTH, index: str = "seq") -> DataFrame:
    """Drop the first rows of every engine."""
    return df.where(col(index) >= F.lit(rows))


def sample_rows(
    df: DataFrame, n: int, key: Sequence[str], order: Sequence[str], seed: int = SEED
) -> DataFrame:
    """``n`` rows drawn without replacement, the same ones on every run, in original order."""
    ticket = F.md5(F.concat_ws("|", *[col(k).cast("string") for k in key], F.lit(str(seed))))
    return (
        df.withColumn("_ticket", ticket)
        .orderBy("_ticket", *[col(k) for k in key])
        .limit(n)
        .drop("_ticket")
        .orderBy(*[col(o) for o in order])
    )


def first_units(df: DataFrame, n: int = 3, unit: str = "unit") -> DataFrame:
    """All rows of the first ``n`` engines by id."""
    chosen = df.select(col(unit)).distinct().orderBy(col(unit)).limit(n)
    return df.join(F.broadcast(chosen), unit, "left_semi")  # at most n rows


def preview(
    df: DataFrame, unit_id: str, n: int = 5, last: bool = False, unit: str = "unit", seq: str = "seq"
) -> DataFrame:
    """Head or tail of one engine."""
    end = col(seq).desc() if last else col(seq).asc()
    return df.where(col(unit) == F.lit(unit_id)).orderBy(end).limit(n)


def extreme_labels(
    df: DataFrame, label: str, above: float = 100.0, first: int = 30, last: int = 10
) -> DataFrame:
    """Lowest ``first`` and highest ``last`` distinct labels over a limit."""
    high = df.where(col(label) > F.lit(float(above))).select(col(label).alias("value")).distinct()
    low_end = high.orderBy("value").limit(first).select(F.lit("first").alias("side"), "value")
    high_end = high.orderBy(F.desc("value")).limit(last).select(F.lit("last").alias("side"), "value")
    return low_end.unionByName(high_end)


def group_total(df: DataFrame, keys: Sequence[str], **totals: Column) -> DataFrame:
    """Attach per-group aggregates to every row.

    Aggregates first and joins back, instead of a window over the whole group;
    adaptive execution broadcasts the totals when they are measured to be small
    and splits a skewed key otherwise.
    """
    sums = df.groupBy(*[col(k) for k in keys]).agg(*[v.alias(n) for n, v in totals.items()])
    return df.join(sums, list(keys), "left")
