"""The dated jobs: each reads one layer's snapshot and replaces the next one's.

``base`` is the lake's root folder. Every job may be run again for its date.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulspark.errors import NothingFound
from rulspark.operators import joins as J
from rulspark.operators import metrics as M
from rulspark.operators import modeling as L
from rulspark.operators import monitoring as D
from rulspark.operators import projection as P
from rulspark.operators import scaling as C
from rulspark.operators import sequence as S
from rulspark.operators import splits as SP
from rulspark.operators import views as V
from rulspark.operators.boosting import Boosted
from rulspark.operators.reservoir import Reservoir, fit_reservoir
from rulspark.operators.rolling import multiscale_features
from rulspark.operators.silver import silver_frame
from rulspark.operators.stats import unit_counts
from rulspark.schema import (
    BASE_FEATURES,
    CLIPPED_LABEL,
    LABEL,
    SEQUENCE_BASELINE_SCHEMA,
    SEQUENCE_CLIP,
    SEQUENCE_CUTOFF,
    SEQUENCE_FALLBACK,
    SEQUENCE_LENGTH,
    TABULAR_BASELINE_SCHEMA,
    TABULAR_CLIP,
    TABULAR_CUTOFF,
)
from rulspark.sources import bronze as B
from rulspark.sources import readers as R
from rulspark.sources import writers as W
from rulspark.session import durable


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    base: str

    def path(self, layer: str) -> str:
        return f"{self.base.rstrip('/')}/{layer}"

    def snapshot(self, layer: str, date: str) -> DataFrame:
        return R.scan_snapshot(self.spark, self.path(layer), date, required=True)

    def replace(
        self, df: DataFrame, layer: str, by: Sequence[str] = ("snapshot_date",), spread: bool = True
    ) -> str:
        W.write_layer(df, self.path(layer), by=by, spread=spread)
        return self.path(layer)

    def dated(self, df: DataFrame, date: str) -> DataFrame:
        return df.withColumn("snapshot_date", F.lit(date).cast("date"))


def ingest(lake: Lake, date: str) -> str:
    """``raw/dev`` and ``raw/test`` to ``bronze``."""
    splits = [lake.snapshot(f"raw/{s}", date).drop("snapshot_date") for s in ("dev", "test")]
    return lake.replace(B.ingest_bronze(*splits, date), "bronze")


def silver(lake: Lake, date: str, aux_layout: str = "with_dataset") -> str:
    """``bronze`` to ``silver``; ``seq`` becomes the dense position in the engine's series."""
    return lake.replace(silver_frame(lake.snapshot("bronze", date), aux_layout), "silver")


def label_base(lake: Lake, date: str, upper: float = TABULAR_CLIP, partitioned: bool = True) -> str:
    """``silver`` to ``gold/label_base``."""
    out = P.label_base(lake.snapshot("silver", date), upper)
    W.write_label_base(out, lake.path("gold/label_base"), partitioned)
    return lake.path("gold/label_base")


def tabular_labels(lake: Lake, date: str) -> str:
    out = P.tabular_labels(lake.snapshot("gold/label_base", date), carry=["seq", "snapshot_date"])
    return lake.replace(out, "gold/tabular_labels")


def tabular_features(lake: Lake, date: str) -> str:
    base, missing = P.select_present(
        lake.snapshot("gold/label_base", date), BASE_FEATURES,
        ["unit", "time", CLIPPED_LABEL, "dataset", "seq", "snapshot_date"],
    )
    present = [f for f in BASE_FEATURES if f not in missing]
    out = multiscale_features(base, present)
    return lake.replace(out, "gold/tabular_features", by=["snapshot_date", "dataset"])


def series_features(lake: Lake, date: str) -> str:
    base, missing = P.select_present(
        lake.snapshot("gold/label_base", date), BASE_FEATURES, ["unit", "seq"]
    )
    present = [f for f in BASE_FEATURES if f not in missing]
    return lake.replace(lake.dated(W.series_table(base, present), date), "gold/series_features", spread=False)


def series_labels(lake: Lake, date: str, upper: float = SEQUENCE_CLIP) -> str:
    df = P.clip_label(lake.snapshot("gold/label_base", date), LABEL, upper, 0.0)
    return lake.replace(lake.dated(W.series_table(df, [CLIPPED_LABEL]), date), "gold/series_labels", spread=False)


def train_tabular(lake: Lake, date: str, **params) -> str:
    """Boosted trees on the dates up to ``date``; the last one decides when to stop, and where
    it is the only one, about 15 % of its engines, drawn by their hash."""
    table = R.read_partitioned(lake.spark, lake.path("gold/tabular_features"))
    last = F.lit(date).cast("date")
    rows = table.where(F.col("snapshot_date") <= last)
    features = L.feature_columns(rows, ["unit", "time", CLIPPED_LABEL, "dataset", "seq", "snapshot_date"])
    only_last = rows.where(F.col("snapshot_date") < last).isEmpty()
    rows = rows.withColumn("_is_val", _validation_drawn() if only_last else F.col("snapshot_date") == last)
    model = L.train_gbt(rows, features, validation_col="_is_val", **params)
    path = lake.path("models/tabular")
    model.save(lake.spark, path)
    L.feature_importance(model, lake.spark).write.mode("overwrite").parquet(
        lake.path("models/tabular_importance")
    )
    return path


def score_tabular(lake: Lake, date: str) -> str:
    model = Boosted.load(lake.spark, lake.path("models/tabular"))
    rows = lake.snapshot("gold/tabular_features", date)
    out = L.score(rows, model, carry=["seq", "snapshot_date"])
    return lake.replace(out, "inference/tabular")


def split_engines(lake: Lake, date: str, train_sets: Sequence[int] | None = None, oot_sets: Sequence[int] = ()) -> str:
    """Whole engines of ``gold/tabular_features`` dealt to train, val, test and oot; rows
    scaled by a scaler that saw train rows only. Writes ``gold/splits`` and the scaler."""
    rows = lake.snapshot("gold/tabular_features", date)
    if train_sets is None:
        found = unit_counts(rows).where("is_total = 0").select("dataset").collect()
        train_sets = sorted(r[0] for r in found if r[0] not in oot_sets)
    dealt = J.apply_split(rows, SP.split_units(rows, train_sets, oot_sets))
    features = [f for f in BASE_FEATURES if f in dealt.columns]
    scaler = lake.path("models/tabular_scaler")
    C.fit_robust(dealt.where("split = 'train'"), features).write.mode("overwrite").parquet(scaler)
    scaled = C.scale(dealt, R.read_partitioned(lake.spark, scaler), features)
    return lake.replace(scaled, "gold/splits", by=["snapshot_date", "split"])


def _series(lake: Lake, date: str) -> tuple[DataFrame, list[str]]:
    """Covariates and label of every position; both series must be of one length."""
    labels = lake.snapshot("gold/series_labels", date).drop("snapshot_date")
    covariates = lake.snapshot("gold/series_features", date).drop("snapshot_date")
    if uneven := J.series_mismatch(covariates, labels).limit(5).collect():
        raise ValueError(f"series of different length: {uneven}")
    features = [c for c in covariates.columns if c not in ("unit", "seq")]
    return covariates.join(labels, ["unit", "seq"]), features


def _scaled_series(lake: Lake, date: str) -> tuple[DataFrame, list[str]]:
    series, features = _series(lake, date)
    scaler = R.read_partitioned(lake.spark, lake.path("models/sequence_scaler"))
    return C.scale(series, scaler, [*features, CLIPPED_LABEL]), features


def _scaled_windows(lake: Lake, date: str, include_target_lags: bool) -> DataFrame:
    scaled, features = _scaled_series(lake, date)
    return S.window_vectors(scaled, features, CLIPPED_LABEL, SEQUENCE_LENGTH, include_target_lags)


def _validation_drawn() -> Column:
    """About 15 % of the engines, drawn by their hash."""
    return F.pmod(F.crc32(F.col("unit").cast("binary")), F.lit(100)) < 15


def train_sequence(
    lake: Lake, date: str, include_target_lags: bool = True, forecaster: str = "linear", **params
) -> str:
    """A one-step forecaster on scaled look-back windows of all covariates, and of the past
    label if ``include_target_lags``: ``linear``, or the recurrent ``reservoir``, whose
    penalty is chosen on about 15 % of the engines."""
    series, features = _series(lake, date)
    C.fit_robust(series, [*features, CLIPPED_LABEL]).write.mode("overwrite").parquet(
        lake.path("models/sequence_scaler")
    )
    path = _sequence_model(lake, forecaster)
    if forecaster == "reservoir":
        scaled, features = _scaled_series(lake, date)
        rows = scaled.withColumn("_is_val", _validation_drawn())
        fit_reservoir(
            rows, features, CLIPPED_LABEL, "_is_val", n=SEQUENCE_LENGTH, include_target_lags=include_target_lags, **params
        ).save(lake.spark, path)
        return path
    windows = _scaled_windows(lake, date, include_target_lags)
    model = L.train_vectors(windows, "window", CLIPPED_LABEL, **params)
    model.write().overwrite().save(path)
    return path


def _sequence_model(lake: Lake, forecaster: str) -> str:
    names = {"linear": "models/sequence", "reservoir": "models/sequence_reservoir"}
    if forecaster not in names:
        raise ValueError(f"forecaster {forecaster!r}; one of {sorted(names)}")
    return lake.path(names[forecaster])


def forecast_sequence(lake: Lake, date: str, include_target_lags: bool = True, forecaster: str = "linear") -> str:
    """One step ahead at every position from 30 on, in cycles. Engines that are too short, or
    that the reservoir failed on, are listed with the reason in ``inference/sequence_unscored``;
    the others are scored. No engine scored is an error."""
    path = _sequence_model(lake, forecaster)
    scaler = R.read_partitioned(lake.spark, lake.path("models/sequence_scaler"))
    center, spread = scaler.where(F.col("feature") == CLIPPED_LABEL).select("center", "scale").first()
    if forecaster == "reservoir":
        model = Reservoir.load(lake.spark, path)
        scored = durable(model.forecast(_scaled_series(lake, date)[0], [CLIPPED_LABEL]))
        good, failed = V.quarantined(scored)
        out = durable(S.rolling_forecast(good, lambda rows: rows, CLIPPED_LABEL, center, spread))
    else:
        windows = _scaled_windows(lake, date, include_target_lags)
        out = durable(S.rolling_forecast(windows, PipelineModel.load(path).transform, CLIPPED_LABEL, center, spread))
        failed = lake.spark.createDataFrame([], "unit string, error string")
    S.require_predictions(out)
    rest = S.unscored_with_reason(lake.snapshot("gold/series_labels", date), out, failed)
    lake.replace(lake.dated(rest, date), "inference/sequence_unscored")
    return lake.replace(lake.dated(out, date), "inference/sequence")


def monitor_tabular(lake: Lake, date: str) -> str:
    """Join, metrics, drift tier, history, documents and residuals of a snapshot."""
    predictions = lake.snapshot("inference/tabular", date)
    labels = lake.snapshot("gold/tabular_labels", date).drop("snapshot_date")
    # Four results read the joined rows; the join itself runs once.
    joined = durable(J.join_actuals(predictions, labels))
    J.require_actuals(joined)
    baseline = R.read_baseline(
        lake.spark, lake.path("models/tabular_baseline.json"), TABULAR_BASELINE_SCHEMA
    )
    judged = D.drift_tier(M.metrics_tabular(joined, ["snapshot_date"]), baseline)
    W.write_metrics_document(D.metrics_document(judged), lake.path("monitoring/tabular/metrics"))
    lake.replace(lake.dated(P.residuals(joined), date), "monitoring/tabular/residuals")
    record = D.stamped(
        judged.select(
            "snapshot_date", "rmse", "mae", "prediction_count", "residual_mean", "residual_std",
            "drift_status", "drift_reason",
        )
    )
    W.write_history(record, lake.path("monitoring/tabular/history"))
    _report(lake, date, P.with_error(joined), "tabular")
    return lake.path("monitoring/tabular/history")


def _report(lake: Lake, date: str, scored: DataFrame, model: str) -> None:
    """Histogram, sample, engine ranking and summary of a snapshot's errors."""
    for name, rows in D.report_tables(scored).items():
        lake.replace(lake.dated(rows.drop("snapshot_date"), date), f"monitoring/{model}/report/{name}")


def monitor_sequence(lake: Lake, date: str) -> str:
    """Metrics, drift flags and history of a snapshot; a rerun adds a row."""
    scored = lake.snapshot("inference/sequence", date)
    _report(lake, date, scored.withColumn("seq", F.col("time")), "sequence")
    baseline = R.read_baseline(
        lake.spark, lake.path("models/sequence_baseline.json"), SEQUENCE_BASELINE_SCHEMA,
        SEQUENCE_FALLBACK,
    )
    flags = D.drift_pct(M.metrics_sequence(scored, ["snapshot_date"]), baseline)
    record = D.stamped(flags.drop("any_drift"), "timestamp")
    W.write_history(record, lake.path("monitoring/sequence/history"), mode="append")
    return lake.path("monitoring/sequence/history")


def pending(lake: Lake, model: str) -> list[str]:
    """Dates with input but no predictions yet, oldest first."""
    source, cutoff = {
        "tabular": ("gold/tabular_features", TABULAR_CUTOFF),
        "sequence": ("gold/series_labels", SEQUENCE_CUTOFF),
    }[model]
    spark = lake.spark

    def dates(layer: str) -> DataFrame:
        return spark.createDataFrame([(d,) for d in R.existing_partitions(spark, lake.path(layer))], "snapshot_date date")

    features = dates(source)
    try:
        done = dates(f"inference/{model}")
    except NothingFound:
        done = features.limit(0)
    return [str(r[0]) for r in J.pending_snapshots(features, done, cutoff).collect()]


STAGES: dict[str, Callable[..., str]] = {
    "ingest": ingest,
    "silver": silver,
    "label-base": label_base,
    "tabular-labels": tabular_labels,
    "tabular-features": tabular_features,
    "series-features": series_features,
    "series-labels": series_labels,
    "split": split_engines,
    "train-tabular": train_tabular,
    "score-tabular": score_tabular,
    "train-sequence": train_sequence,
    "forecast-sequence": forecast_sequence,
    "monitor-tabular": monitor_tabular,
    "monitor-sequence": monitor_sequence,
}


def run(spark: SparkSession, base: str, stage: str, date: str, **options) -> str:
    return STAGES[stage](Lake(spark, base), date, **options)

