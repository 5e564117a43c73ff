"""A recurrent forecaster whose recurrent weights are drawn once and never trained.

Every look-back window runs through a leaky network of ``hidden`` units from a state of
zero, so a forecast depends on its window alone, not on blocks or batches. Its last state,
the window's last row and its mean are the inputs of a ridge regression, whose normal
equations each task sums for its rows. They are summed apart for validation rows, so the
penalty with the least validation error is found without another pass over the data.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rulspark.operators.ordering import BLOCK_ROWS
from rulspark.operators.views import Stretch, blocks, scored_stretches, stretches
from rulspark.schema import SEED, SEQUENCE_LENGTH
from rulspark.session import workers_import

PENALTIES = (1e-6, 1e-5, 1e-4, 1e-3, 1e-2, 1e-1, 1.0)
# The penalty where no row is for validation.
PENALTY = 1e-3
# Windows that are run at once: bounds the memory of states.
STEP = 4_096


@dataclass
class Reservoir:
    """``radius`` is the largest absolute eigenvalue of the recurrent weights, ``leak`` the
    share of a state that a step replaces. ``rmse`` is in the target's units, per kind of
    rows (``train`` and, if there were any, ``validation``)."""

    features: list[str]
    target: str
    n: int = SEQUENCE_LENGTH
    hidden: int = 64
    leak: float = 0.3
    radius: float = 0.9
    reach: float = 0.5
    seed: int = SEED
    include_target_lags: bool = True
    penalty: float = PENALTY
    weights: np.ndarray | None = None
    rmse: dict = field(default_factory=dict)

    @property
    def inputs(self) -> list[str]:
        return [*self.features, self.target] if self.include_target_lags else list(self.features)

    def fixed_weights(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input weights, recurrent weights and bias, from the seed."""
        rng = np.random.default_rng(self.seed)
        d = len(self.inputs)
        inward = rng.uniform(-self.reach, self.reach, (d, self.hidden)) / np.sqrt(max(d, 1))
        inner = rng.normal(size=(self.hidden, self.hidden))
        inner *= self.radius / np.abs(np.linalg.eigvals(inner)).max()
        return inward, inner, rng.uniform(-self.reach, self.reach, self.hidden)

    def regressors(self, past: np.ndarray, fixed: tuple) -> np.ndarray:
        """One row per window of ``past``: 1, the last state, the last row, the mean row."""
        inward, inner, bias = fixed
        past = np.nan_to_num(past, nan=0.0, posinf=0.0, neginf=0.0)
        m = len(past) - self.n + 1
        # A row enters n windows; its input weights are applied once.
        drive = past @ inward + bias
        state = np.zeros((m, self.hidden))
        for k in range(self.n):
            state += self.leak * (np.tanh(drive[k : k + m] + state @ inner) - state)
        sums = np.concatenate([np.zeros((1, past.shape[1])), np.cumsum(past, axis=0)])
        mean = (sums[self.n :] - sums[: m]) / self.n
        return np.hstack([np.ones((m, 1)), state, past[self.n - 1 :], mean])

    def _steps(self, past: np.ndarray, fixed: tuple):
        for low in range(0, len(past) - self.n + 1, STEP):
            yield low, self.regressors(past[low : low + STEP + self.n - 1], fixed)

    def forecast(
        self, df: DataFrame, carry: Sequence[str] = (), name: str = "prediction", quarantine: bool = True,
        unit: str = "unit", seq: str = "seq", block_rows: int = BLOCK_ROWS,
    ) -> DataFrame:
        """``unit``, ``seq``, ``carry``, the forecast of each row with a whole window and, with
        ``quarantine``, ``error`` for engines whose forecast is not finite."""
        if self.weights is None:
            raise ValueError("the forecaster is not fitted")

        def compute(s: Stretch) -> np.ndarray:
            fixed = self.fixed_weights()
            out = np.concatenate([z @ self.weights for _, z in self._steps(s.past, fixed)])
            # Infinite inputs were silenced above; say so rather than forecast from them.
            if np.isinf(s.past).any() or not np.isfinite(out[s.whole]).all():
                raise ValueError("a value is not finite")
            return out

        return scored_stretches(df, self.inputs, compute, [name], self.n, carry, unit, seq, block_rows, quarantine)

    def save(self, spark: SparkSession, path: str) -> None:
        about = {k: v for k, v in vars(self).items() if k != "weights"}
        row = (json.dumps(about), self.weights.tolist())
        spark.createDataFrame([row], "about string, weights array<double>").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> Reservoir:
        row = spark.read.parquet(path).first()
        return Reservoir(**json.loads(row["about"]), weights=np.array(row["weights"]))


def normal_sums(
    df: DataFrame, model: Reservoir, validation_col: str | None = None,
    unit: str = "unit", seq: str = "seq", block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``kind`` (0 train, 1 validation), ``position``, ``value``: the upper triangle of
    [Z y]'[Z y], row by row. A task sends one triangle per kind, whatever its rows."""
    workers_import(df.sparkSession)
    kept = [*model.inputs, *([] if model.include_target_lags else [model.target])]
    target_at = kept.index(model.target) if not model.include_target_lags else len(kept) - 1
    carry = [validation_col] if validation_col else []
    d, n = len(model.inputs), model.n

    def run(batches):
        fixed, sums = model.fixed_weights(), {}
        for s in stretches(batches, len(kept), n):
            y = s.values[n:, target_at]
            past = s.past[:, :d]
            # A target that no window reads may be missing too; windows are judged by inputs.
            missing = np.concatenate([[0], np.cumsum(~np.isfinite(past).all(axis=1))])
            good = (missing[n:] == missing[: len(y)]) & np.isfinite(y)
            kind = np.zeros(len(y), np.int64)
            if carry:
                kind = s.rows.column("_c0").fill_null(False).to_numpy(zero_copy_only=False).astype(np.int64)
            for low, z in model._steps(past, fixed):
                span = slice(low, low + len(z))
                both = np.column_stack([z, y[span]])
                for k in (0, 1):
                    part = both[good[span] & (kind[span] == k)]
                    if len(part):
                        sums[k] = sums.get(k, 0.0) + part.T @ part
        for k, total in sums.items():
            upper = total[np.triu_indices(len(total))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(upper), k, np.int32)), pa.array(np.arange(len(upper), dtype=np.int32)), pa.array(upper)],
                ["kind", "position", "value"],
            )

    parts = blocks(df, kept, n, carry, unit, seq, block_rows).mapInArrow(run, "kind int, position int, value double")
    return parts.groupBy("kind", "position").agg(F.sum("value").alias("value"))


def solved(total: np.ndarray, penalty: float) -> np.ndarray:
    """Ridge weights from [Z y]'[Z y]; the constant is free, other columns are penalised in
    units of their mean square."""
    count = total[0, 0]
    left, right = total[:-1, :-1] / count, total[:-1, -1] / count
    cost = penalty * np.maximum(np.diag(left), 1e-12)
    cost[0] = 0.0
    return np.linalg.solve(left + np.diag(cost), right)


def squared_error(total: np.ndarray, weights: np.ndarray) -> float:
    """Mean squared error of ``weights`` on the rows summed in ``total``."""
    w = np.append(weights, -1.0)
    return max(float(w @ total @ w / total[0, 0]), 0.0)


def fit_reservoir(
    df: DataFrame, features: Sequence[str], target: str, validation_col: str | None = None,
    unit: str = "unit", seq: str = "seq", block_rows: int = BLOCK_ROWS, **settings,
) -> Reservoir:
    """Fit the readout on rows whose window and target are known. Rows with
    ``validation_col`` true only choose the penalty; a null one is false.

    Inputs should be scaled. The driver receives the summed triangles: at most two times
    (hidden + 2 inputs + 2) squared over two numbers, whatever the rows.
    """
    model = Reservoir(list(features), target, **settings)
    size = 2 + model.hidden + 2 * len(model.inputs)
    totals = {}
    for kind, position, value in normal_sums(df, model, validation_col, unit, seq, block_rows).collect():
        totals.setdefault(kind, np.zeros(size * (size + 1) // 2))[position] = value

    def full(upper: np.ndarray) -> np.ndarray:
        out = np.zeros((size, size))
        out[np.triu_indices(size)] = upper
        return np.triu(out) + np.triu(out, 1).T

    totals = {k: full(v) for k, v in totals.items()}
    if 0 not in totals:
        raise ValueError("no row to fit has a whole window and a target")
    fits = {p: solved(totals[0], p) for p in (PENALTIES if 1 in totals else (model.penalty,))}
    judge = totals.get(1, totals[0])
    model.penalty = min(fits, key=lambda p: squared_error(judge, fits[p]))
    model.weights = fits[model.penalty]
    names = {0: "train", 1: "validation"}
    model.rmse = {names[k]: squared_error(t, model.weights) ** 0.5 for k, t in totals.items()}
    return model
