"""Metrics, joins, drift ladder, history and contracts on hand-made rows."""

import json
from datetime import datetime, timezone

import numpy as np
import pytest
from pyspark.sql import functions as F

from rulspark import errors as E
from rulspark.operators import joins as J
from rulspark.operators import metrics as M
from rulspark.operators import monitoring as D
from rulspark.operators import projection as P
from rulspark.operators import splits as SP
from rulspark.schema import (
    SEQUENCE_BASELINE,
    SEQUENCE_BASELINE_SCHEMA,
    SEQUENCE_FALLBACK,
    SILVER_COLUMNS,
    TABULAR_BASELINE,
    TABULAR_BASELINE_SCHEMA,
)
from rulspark.sources.readers import read_baseline

SCORED = "unit string, time int, dataset int, seq long, RUL_Predicted float, RUL_Actual float"


@pytest.fixture(scope="module")
def scored(spark):
    rng = np.random.default_rng(5)
    rows = [
        (f"DS{d:02d}_{u:03d}", i // 4, d, i, float(rng.normal(40, 25)), float(rng.integers(0, 90)))
        for d in (1, 2) for u in (1, 2, 3) for i in range(40 + 10 * u)
    ]
    return P.with_error(spark.createDataFrame(rows, SCORED))


def test_metrics_equal_numpy(scored):
    pdf = scored.toPandas()
    e = (pdf.RUL_Predicted - pdf.RUL_Actual).astype("float64")
    m = M.metrics_sequence(scored).first()
    assert m.rmse == pytest.approx(np.sqrt((e**2).mean())) and m.mae == pytest.approx(e.abs().mean())
    assert m.std_pred == pytest.approx(pdf.RUL_Predicted.astype(float).std(ddof=0))
    assert (m.n_predictions, m.n_engines) == (len(pdf), 6)
    t = M.metrics_tabular(scored).first()
    assert t.residual_std == pytest.approx(e.std(ddof=0)) and t.residual_mean == pytest.approx(e.mean())
    a = M.accuracy(scored).first()
    y = pdf.RUL_Actual.astype(float)
    assert a.r2 == pytest.approx(1 - (e**2).sum() / ((y - y.mean()) ** 2).sum())
    s = M.error_stats(scored).first()
    assert s.correlation == pytest.approx(np.corrcoef(pdf.RUL_Actual, pdf.RUL_Predicted)[0, 1])


def test_rollup_total_is_the_pooled_metric(scored):
    rows = {r.dataset: r for r in M.metrics_rollup(scored).collect()}
    assert rows[None].is_total == 1 and rows[None].rmse == pytest.approx(M.rmse_mae(scored).first().rmse)
    assert rows[1].n + rows[2].n == rows[None].n


def test_pooled_equals_unit_mean_for_equal_engines(spark):
    rows = [(u, i, 1, i, 10.0 + (-1) ** i, 10.0) for u in "ab" for i in range(8)]
    out = M.pooled_vs_unit(spark.createDataFrame(rows, SCORED)).first()
    assert out.rmse_gap == pytest.approx(0) and out.unit_rmse_std == pytest.approx(0)


def test_constant_actual_has_no_r2_or_correlation(spark):
    df = spark.createDataFrame([("u", 1, 1, 0, 4.0, 5.0), ("u", 2, 1, 1, 6.0, 5.0)], SCORED)
    assert M.accuracy(df).first().r2 is None and M.error_stats(df).first().correlation is None


def test_life_stages_meet_at_their_limits(spark):
    df = spark.createDataFrame([("u", i, 1, i, 0.0, a) for i, a in enumerate([50.5, 50.0, 20.0, 19.5])], SCORED)
    got = {r.stage: r.n for r in M.lifecycle_errors(df).collect()}
    assert got == {"early": 1, "mid": 2, "end": 1}


def test_calibration_verdicts(spark):
    rows = [(0.9, 0.95), (1.0, 0.9), (-1.0, 0.8), (0.0, 0.7), (0.0, None)]
    df = spark.createDataFrame(rows, "error_mean double, correlation double")
    got = [(r.bias_verdict, r.correlation_verdict) for r in M.calibration(df).collect()]
    assert got == [
        ("calibrated", "strong"), ("over-predicting", "good"), ("under-predicting", "good"),
        ("calibrated", "weak"), ("calibrated", "weak"),
    ]


def test_join_is_one_to_one_and_drops_old_actuals(spark):
    pred = spark.createDataFrame(
        [("u", 1, 1, 0, 5.0, 0.0), ("u", 1, 1, 1, 9.0, 0.0), ("u", 2, 1, 2, 7.0, 0.0), ("v", 1, 1, 0, 1.0, 0.0)], SCORED
    )
    labels = spark.createDataFrame(
        [("u", 1, 1, 3, 50.0), ("u", 1, 1, 2, 40.0), ("u", 2, 1, 4, None), ("w", 1, 1, 0, 1.0)],
        "unit string, time int, dataset int, seq long, RUL_Clipped double",
    )
    out = J.join_actuals(pred, labels)
    got = {(r.unit, r.time): (r.RUL_Predicted, r.RUL_Actual) for r in out.collect()}
    assert got == {("u", 1): (5.0, 40.0), ("u", 2): (7.0, None)}
    J.assert_unique(out, ["unit", "time"])
    with pytest.raises(E.DuplicateKeys):
        J.assert_unique(pred, ["unit", "time"])
    J.require_actuals(out)
    with pytest.raises(E.NoActuals):
        J.require_actuals(out.where("time = 2"))
    with pytest.raises(E.MissingColumns):
        J.join_actuals(pred, labels.drop("RUL_Clipped"))
    with pytest.raises(E.MissingColumns):
        J.join_actuals(pred.drop("time"), labels)
    assert J.join_keys(pred.drop("dataset"), labels) == ["unit", "time"]


def test_contract_names_what_is_missing(scored):
    with pytest.raises(E.MissingColumns) as found:
        M.metrics_sequence(scored.drop("Prediction_Error"))
    assert found.value.missing == ["Prediction_Error"] and "unit" in found.value.available


LADDER = [
    (18.0, 14.0, "ok", "Within"),
    (18.2091 * 1.15, 14.0, "ok", "Within"),
    (21.0, 14.0, "warning", "RMSE 21.00 exceeds warning threshold (20.94)."),
    (21.0, 90.0, "warning", "RMSE"),
    (24.0, 14.0, "critical", "RMSE 24.00 exceeds critical threshold (23.67)."),
    (18.0, 17.6, "warning", "MAE 17.60 exceeds warning threshold (17.58)."),
    (18.0, 20.6, "critical", "MAE 20.60 exceeds critical threshold (20.51)."),
]


@pytest.mark.parametrize("rmse,mae,status,reason", LADDER)
def test_drift_ladder(spark, rmse, mae, status, reason):
    out = D.drift_tier(spark.createDataFrame([(rmse, mae)], "rmse double, mae double")).first()
    assert out.drift_status == status and out.drift_reason.startswith(reason)


def test_percentage_drift_and_its_defaults(spark):
    schema = "rmse double, mae double, mean_pred double"
    at_limit = spark.createDataFrame([(120.0, 80.0, 54.0)], schema)
    base = {"baseline": {"rmse": 100.0, "mae": 100.0, "mean_pred": 45.0}, "thresholds": SEQUENCE_BASELINE["thresholds"]}
    assert not D.drift_pct(at_limit, base).first().any_drift
    over = spark.createDataFrame([(120.1, 80.0, 54.0)], schema)
    out = D.drift_pct(over, base).first()
    assert (out.rmse_drift, out.mae_drift, out.distribution_drift, out.any_drift) == (True, False, False, True)
    no_mean = {**base, "baseline": {"rmse": 100.0, "mae": 100.0}}
    assert not D.drift_pct(spark.createDataFrame([(100.0, 100.0, 9e9)], schema), no_mean).first().any_drift


def write_json(tmp_path, document):
    path = tmp_path / "baseline.json"
    path.write_text(json.dumps(document, indent=2))
    return str(path)


def test_baseline_document(spark, tmp_path):
    full = read_baseline(spark, write_json(tmp_path, TABULAR_BASELINE), TABULAR_BASELINE_SCHEMA)
    metrics = spark.createDataFrame([(21.0, 14.0)], "rmse double, mae double")
    assert D.drift_tier(metrics, full).first().drift_status == "warning"
    with pytest.raises(E.MissingSections):
        read_baseline(spark, write_json(tmp_path, {"baseline": {"rmse": 1.0}}), TABULAR_BASELINE_SCHEMA)
    absent = str(tmp_path / "absent.json")
    with pytest.raises(E.NothingFound):
        read_baseline(spark, absent, TABULAR_BASELINE_SCHEMA)
    fallback = read_baseline(spark, absent, SEQUENCE_BASELINE_SCHEMA, SEQUENCE_FALLBACK)
    assert fallback.first().baseline.rmse == 0.15


def test_history_modes(spark):
    old = spark.createDataFrame([("2025-01-02", 2.0), ("2025-01-01", 1.0)], "snapshot_date string, rmse double")
    new = spark.createDataFrame([("2025-01-01", 9.0)], "snapshot_date string, rmse double")
    assert D.history_append(old, new).count() == 3
    once = D.history_upsert(old, new)
    assert [tuple(r) for r in once.collect()] == [("2025-01-01", 9.0), ("2025-01-02", 2.0)]
    assert [tuple(r) for r in D.history_upsert(once, new).collect()] == [tuple(r) for r in once.collect()]
    assert "generated_at_utc" in D.stamped(new).columns
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        stamp = datetime.fromisoformat(D.stamped(new).first()["generated_at_utc"])
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert abs((datetime.now(timezone.utc).replace(tzinfo=None) - stamp).total_seconds()) < 600


def test_report_tables(scored):
    tables = D.report_tables(scored, bins=10, sample=20)
    assert tables["error_histogram"].count() == 10
    assert tables["error_histogram"].agg(F.sum("n")).first()[0] == scored.count()
    assert tables["predicted_vs_actual"].count() == 20 and tables["unit_rmse"].count() == 6


def test_comparison_names_a_winner(spark):
    rows = [("test", "a", 10.0, 1.0), ("test", "b", 9.95, 1.0), ("oot", "a", 5.0, 1.0), ("oot", "b", 6.0, 1.0)]
    df = spark.createDataFrame(rows, "split string, model string, rmse double, mae double")
    got = {(r.split, r.model): r for r in M.model_comparison(df, "a").collect()}
    assert got[("test", "b")].winner == "b" and got[("test", "b")].equivalent
    assert got[("oot", "b")].rmse_change_pct == pytest.approx(20) and got[("oot", "b")].winner == "a"


def test_split_sizes_and_no_leakage(spark):
    rows = [(f"DS{i % 7 + 1:02d}_{i:03d}", i % 7 + 1) for i in range(77)] * 3
    df = spark.createDataFrame(rows, "unit string, dataset int")
    split = SP.split_units(df, [1, 3, 4, 5, 6], [2, 7])
    sizes = {r.split: r["count"] for r in split.groupBy("split").count().collect()}
    assert sizes == {"oot": 22, "test": 9, "val": 7, "train": 39}
    assert SP.split_leakage(J.apply_split(df.drop("dataset"), split)).count() == 0
    again = SP.split_units(df.repartition(5), [1, 3, 4, 5, 6], [2, 7])
    assert split.exceptAll(again).count() == 0
    assert SP.split_units(df, [1, 3], seed=1).where("split = 'oot'").count() == 0


def test_flatten_layouts_nan_and_short_arrays(spark):
    nan = float("nan")
    rows = [
        ([1.0, nan, 3.0, 4.0], [float(i) for i in range(14)], [float(i) for i in range(14)], [1.0, 2.0, 3.0], [130.0],
         [2.0, 1234.9, 7.0, 3.0], 0, "2025-01-01"),
    ]
    schema = ", ".join(f"{c} array<double>" for c in ("W", "X_s", "X_v", "T", "Y", "A")) + ", seq long, snapshot_date string"
    df = spark.createDataFrame(rows, schema)
    a = P.flatten_arrays(df, carry=())
    assert a.columns == SILVER_COLUMNS and len(a.columns) == 42
    r = a.first()
    assert (r.dataset, r.unit_orig, r.time, r.Fc, r.hs) == (2, 1234, 7, 3, None)
    assert r.Mach_Number is None and r.phi == 13.0 and str(r.snapshot_date) == "2025-01-01"
    b = P.flatten_arrays(df, aux_layout="without_dataset").first()
    assert (b.dataset, b.unit_orig, b.time, b.Fc, b.hs) == (1, 2, 1234, 7, 3)
    base = P.label_base(a).first()
    assert base.unit == "DS02_1234" and base.RUL_Clipped == 90.0 and base["LPT Outlet Temperature"] == 3.0


@pytest.mark.parametrize("value,tabular,sequence,upper", [
    (130.0, 90.0, 125.0, 90.0), (100.0, 90.0, 100.0, 90.0), (0.0, 0.0, 0.0, 0.0), (-3.0, 0.0, 0.0, -3.0), (None, None, None, None),
])
def test_clip(spark, value, tabular, sequence, upper):
    df = spark.createDataFrame([(value,)], "y double")
    df = P.clip_label(df, "y", 90.0, 0.0, "t")
    df = P.clip_label(df, "y", 125.0, 0.0, "s")
    df = P.clip_label(df, "y", 90.0, None, "u")
    assert df.first()[1:] == (tabular, sequence, upper)
    twice = P.clip_label(df, "t", 90.0, 0.0, "tt")
    assert twice.first().tt == tabular


def test_column_lists(spark):
    df = spark.createDataFrame([(1, "u", 1.0, 2.0)], "time int, unit string, `x y_mean_short` float, `x y` double")
    got, missing = P.select_present(df, ["x y", "z"], ["unit"])
    assert got.columns == ["unit", "x y"] and missing == ["z"]
    assert P.order_feature_columns(df, ["x y"]).columns == ["unit", "time", "x y", "x y_mean_short"]
    assert P.feature_columns(df) == ["x y_mean_short", "x y"]
    assert P.filter_in(df, "time", [1, 2]).count() == 1


def test_ids(spark):
    df = spark.createDataFrame([(1, 5), (12, 1234)], "dataset int, unit_orig int")
    ids = P.with_unit_id(df)
    assert [r.unit for r in ids.collect()] == ["DS01_005", "DS12_1234"]
    assert [r.ds for r in P.with_unit_dataset(ids, name="ds").collect()] == ["DS01", "DS12"]


def test_snapshot_roles(spark):
    df = spark.createDataFrame([("2025-01-01",), ("2025-01-04",), ("2024-12-31",)], "d string").selectExpr(
        "date(d) AS snapshot_date"
    )
    roles = {"train": ("2025-01-01", "2025-01-03"), "val": ("2025-01-04", "2025-01-04")}
    assert [r.role for r in P.with_snapshot_role(df, roles).collect()] == ["train", "val", None]


def test_alignment_casts_and_dates(spark):
    a = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0)], "t int, x double")
    b = spark.createDataFrame([(1, 5.0), (2, 6.0), (4, 7.0)], "t int, y double")
    assert [tuple(r) for r in J.align_on(a, b, ["t"]).collect()] == [(1, 1.0, 5.0)]
    assert J.align_forecast(a, b, ["t"]).count() == 2
    df = spark.createDataFrame([("2025-01-02", 7.9)], "d string, x double")
    row = P.cast_columns(P.parse_date(df, "d"), {"x": "int"}).first()
    assert str(row.d) == "2025-01-02" and row.x == 7
    both = P.union_all([a, b], allow_missing=True)
    assert both.columns == ["t", "x", "y"] and both.count() == 6
    assert P.with_columns(a, {"p": F.col("t") + 1, "q": F.col("t") * 2}).first()[2:] == (2, 2)


def test_series_of_unequal_length_are_found(spark):
    a = spark.createDataFrame([("u", 0), ("u", 1), ("v", 0)], "unit string, seq long")
    b = spark.createDataFrame([("u", 0), ("u", 1), ("w", 0)], "unit string, seq long")
    got = {tuple(r) for r in J.series_mismatch(a, b).collect()}
    assert got == {("v", 1, 0), ("w", 0, 1)}
    meta = J.unit_metadata(a).collect()
    assert [(r.unit, r.n_timesteps, r.dataset) for r in meta] == [("u", 2, "unknown"), ("v", 1, "unknown")]


def test_pending_needs_features_after_the_cutoff(spark):
    days = spark.createDataFrame([("2024-12-30",), ("2024-12-31",), ("2025-01-01",)], "d string").selectExpr(
        "date(d) AS snapshot_date"
    )
    done = days.where("snapshot_date = DATE'2025-01-01'")
    assert [str(r[0]) for r in J.pending_snapshots(days, done, "2024-12-31").collect()] == ["2024-12-31"]
