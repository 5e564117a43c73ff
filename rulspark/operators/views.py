"""Look-back windows as views over sorted rows, for work done in Arrow batches.

``sequence_windows`` gives every row an array of the n rows before it. Here engines are cut
into the same blocks and sorted, and a task walks its rows once: consecutive windows are
overlapping views of one matrix, so a row is stored once, not n times, in the shuffle and
in memory. A task holds one Arrow batch and the last n rows of the batch before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rulspark.functions.columns import col
from rulspark.operators.ordering import BLOCK_ROWS
from rulspark.schema import SEQUENCE_LENGTH
from rulspark.session import workers_import


class Stretch(NamedTuple):
    """Consecutive rows of an engine that have a whole window. ``values`` holds the n rows
    before the first of them, then the rows; ``whole`` tells which windows miss no value."""

    unit: str | None
    values: np.ndarray
    rows: pa.RecordBatch
    whole: np.ndarray

    @property
    def past(self) -> np.ndarray:
        """The rows that windows read: window i is rows i to i + n - 1."""
        return self.values[:-1]


def windows_of(past: np.ndarray, n: int) -> np.ndarray:
    """(window, step, column): a view of ``past``, nothing is copied."""
    return np.lib.stride_tricks.sliding_window_view(past, n, axis=0).transpose(0, 2, 1)


def blocks(
    df: DataFrame,
    features: Sequence[str],
    n: int = SEQUENCE_LENGTH,
    carry: Sequence[str] = (),
    unit: str = "unit",
    seq: str = "seq",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows dealt by engine and block, sorted by position, each block after the n rows before
    it: ``_unit``, ``_block``, ``_seq``, ``_f0`` ..., ``_c0`` ... One exchange."""
    if n >= block_rows:
        raise ValueError("a block must be longer than the history it needs")
    known = F.when(col(seq).isNull(), F.raise_error(F.lit(f"{seq} is null"))).otherwise(col(seq))
    own = F.floor(known / F.lit(block_rows))
    near_end = F.pmod(col(seq), F.lit(block_rows)) >= F.lit(block_rows - n)
    copies = F.when(near_end, F.array(own, own + 1)).otherwise(F.array(own))
    cut = df.select(
        col(unit).cast("string").alias("_unit"),
        F.explode(copies).alias("_block"),
        col(seq).cast("long").alias("_seq"),
        *[F.coalesce(col(f).cast("double"), F.lit(float("nan"))).alias(f"_f{i}") for i, f in enumerate(features)],
        *[col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
    )
    return cut.repartition("_unit", "_block").sortWithinPartitions("_unit", "_block", "_seq")


def stretches(batches: Iterator[pa.RecordBatch], n_features: int, n: int) -> Iterator[Stretch]:
    """Stretches of the sorted batches of one task of ``blocks``."""
    key, tail, tail_at = None, np.zeros((0, n_features)), np.zeros(0, np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        units, cuts = batch.column("_unit"), batch.column("_block").to_numpy()
        code = units.dictionary_encode().indices.fill_null(-1).to_numpy()
        edges = np.flatnonzero((np.diff(code) != 0) | (np.diff(cuts) != 0)) + 1
        seq = batch.column("_seq").to_numpy()
        values = np.column_stack([batch.column(f"_f{i}").to_numpy() for i in range(n_features)])
        for low, high in zip([0, *edges.tolist()], [*edges.tolist(), len(cuts)]):
            unit = units[low].as_py()
            if (unit, cuts[low]) != key:
                key, tail, tail_at = (unit, cuts[low]), tail[:0], tail_at[:0]
            joined, at = np.concatenate([tail, values[low:high]]), np.concatenate([tail_at, seq[low:high]])
            if (np.diff(at) != 1).any():
                raise ValueError(f"positions of {unit} are not dense")
            tail, tail_at = joined[-n:], at[-n:]
            m = len(joined) - n
            if m > 0:
                missing = np.concatenate([[0], np.cumsum(np.isnan(joined).any(axis=1))])
                whole = missing[n : n + m] == missing[:m]
                yield Stretch(unit, joined, batch.slice(high - m, m), whole)


def over_windows(
    df: DataFrame,
    features: Sequence[str],
    compute: Callable[[np.ndarray], np.ndarray],
    outputs: Sequence[str],
    n: int = SEQUENCE_LENGTH,
    carry: Sequence[str] = (),
    unit: str = "unit",
    seq: str = "seq",
    block_rows: int = BLOCK_ROWS,
    quarantine: bool = False,
) -> DataFrame:
    """``compute`` applied to the windows of the n rows before each row.

    It gets an array (windows, n, features), a view, and returns one row of doubles,
    ``outputs``, per window (one number each may be a plain vector). The result has ``unit``,
    ``seq``, ``carry`` and ``outputs``. Rows without n earlier ones, and rows with a missing
    value in their window, have no result; positions must be dense in an engine.

    With ``quarantine``, a stretch for which ``compute`` raises gets nulls and the error as
    text in a column ``error``; see ``quarantined``. Otherwise the error ends the job.
    """

    def stretch(s: Stretch) -> np.ndarray:
        return compute(windows_of(s.past, n))

    return scored_stretches(df, features, stretch, outputs, n, carry, unit, seq, block_rows, quarantine)


def scored_stretches(
    df: DataFrame,
    features: Sequence[str],
    compute: Callable[[Stretch], np.ndarray],
    outputs: Sequence[str],
    n: int = SEQUENCE_LENGTH,
    carry: Sequence[str] = (),
    unit: str = "unit",
    seq: str = "seq",
    block_rows: int = BLOCK_ROWS,
    quarantine: bool = False,
) -> DataFrame:
    """``over_windows`` for work on whole stretches."""
    workers_import(df.sparkSession)
    names = [unit, seq, *carry, *outputs]
    if quarantine:
        names.append("error")
    if len({x.lower() for x in names}) < len(names):
        raise ValueError(f"names repeat: {names}")
    width, k = len(features), len(outputs)

    def run(batches):
        for s in stretches(batches, width, n):
            error = None
            try:
                found = np.asarray(compute(s), np.float64).reshape(len(s.whole), k)
            except Exception as raised:
                if not quarantine:
                    raise
                error = f"{type(raised).__name__}: {raised}"
                found = np.full((len(s.whole), k), np.nan)
            kept = pa.array(s.whole)
            columns = [s.rows.column(c) for c in ("_unit", "_seq", *[f"_c{i}" for i in range(len(carry))])]
            columns += [pa.array(found[:, i], mask=np.full(len(found), error is not None)) for i in range(k)]
            if quarantine:
                columns.append(pa.array([error] * len(found), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names).filter(kept)

    kinds = dict(df.dtypes)
    fields = [f"`{unit}` string", f"`{seq}` long", *[f"`{c}` {kinds[c]}" for c in carry], *[f"`{o}` double" for o in outputs]]
    if quarantine:
        fields.append("error string")
    return blocks(df, features, n, carry, unit, seq, block_rows).mapInArrow(run, ", ".join(fields))


def quarantined(scored: DataFrame, unit: str = "unit") -> tuple[DataFrame, DataFrame]:
    """(rows of engines that scored throughout, one row per other engine with its ``error``).

    An engine that raised in one stretch leaves with all its rows, so the outcome does not
    depend on how rows fell into batches. Of several messages the first in order is kept.
    ``scored`` is read twice; store it before if it is costly.
    """
    failed = scored.where("error IS NOT NULL").groupBy(unit).agg(F.min("error").alias("error"))
    mine, theirs = col(unit), F.col("_failed")
    good = scored.join(failed.select(col(unit).alias("_failed")), mine.eqNullSafe(theirs), "left_anti")
    return good.drop("error"), failed
