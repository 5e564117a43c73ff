"""Windows as views, engines that fail, and the reservoir forecaster against loops."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rulspark.operators import modeling as M
from rulspark.operators import reservoir as V
from rulspark.operators import sequence as S
from rulspark.operators import views as W
from rulspark.plans import windows as queries

SCHEMA = "unit string, seq long, a double, b double, label double, is_val boolean"


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    out = []
    for unit, n in {"DS01_001": 400, "DS01_002": 1, "DS02_003": 30, "DS02_004": 31, "DS03_005": 90, None: 45}.items():
        a, b = rng.normal(size=n), rng.normal(size=n)
        for i in range(n):
            # The label is a curved function of the last two steps.
            label = float(np.tanh(2 * a[i - 1]) * 3 + b[i - 2] ** 2) if i > 1 else 0.0
            hole = unit == "DS03_005" and i == 40
            out.append((unit, i, None if hole else float(a[i]), float(b[i]), label, unit == "DS03_005"))
    return out


@pytest.fixture(scope="module")
def frame(spark, rows):
    # A column by the name of every internal one.
    df = spark.createDataFrame(rows, SCHEMA).repartition(5, "a")
    return df.withColumns({c: F.lit("x") for c in ("_unit", "_block", "_seq", "_f0", "_c0")})


@pytest.fixture
def small_batches(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, "17")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("block", [100_000, 31, 64])
def test_views_hold_the_rows_of_sequence_windows(frame, small_batches, block):
    n = 30
    names = [f"w{i}" for i in range(n * 2)]
    got = W.over_windows(frame, ["a", "b"], lambda w: w.reshape(len(w), -1), names, n, block_rows=block).toPandas()
    plain = S.sequence_windows(frame.select("unit", "seq", "a", "b"), ["a", "b"], n)
    flat = F.flatten(F.transform("history", lambda s: F.array(s["f0"], s["f1"])))
    want = plain.select("unit", "seq", flat.alias("w")).where(F.forall("w", lambda x: x.isNotNull())).toPandas()
    key = lambda df: df.assign(unit=df.unit.fillna("-")).sort_values(["unit", "seq"], ignore_index=True)
    got, want = key(got), key(want)
    assert got[["unit", "seq"]].equals(want[["unit", "seq"]]) and len(got) == 370 + 1 + 60 - 30 + 15
    assert np.array_equal(got[names].to_numpy(), np.stack(want.w))


def test_windows_are_not_copied_and_rows_cross_once(frame):
    past = np.arange(20.0).reshape(10, 2)
    assert np.shares_memory(W.windows_of(past, 4), past)
    out = W.over_windows(frame, ["a"], lambda w: w[:, -1, 0], ["last"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    # The frame's own repartitioning, and one by engine and block.
    assert plan.count("Exchange hashpartitioning") == 2 and "collect_list" not in plan and "Window" not in plan


def test_an_engine_that_raises_is_listed_and_others_are_scored(frame, small_batches):
    def mean(windows):
        if windows[:, :, 0].max() > top:
            raise RuntimeError("too high")
        return windows[:, :, 0].mean(axis=1)

    unit = "DS01_001"
    known = frame.where("unit IN ('DS01_001', 'DS02_004')").withColumn("a", F.expr("IF(unit = 'DS01_001' AND seq = 200, 99, a)"))
    top = 50.0
    scored = W.over_windows(known, ["a"], mean, ["prediction"], quarantine=True)
    good, failed = W.quarantined(scored)
    assert [tuple(r) for r in failed.collect()] == [(unit, "RuntimeError: too high")]
    assert {r[0] for r in good.select("unit").distinct().collect()} == {"DS02_004"}
    with pytest.raises(Exception, match="too high"):
        W.over_windows(known, ["a"], mean, ["prediction"]).collect()


def test_a_null_engine_can_fail_too(spark):
    df = spark.createDataFrame([(None, i, 1.0) for i in range(40)], "unit string, seq long, a double")

    def refuse(_):
        raise ValueError("no")

    good, failed = W.quarantined(W.over_windows(df, ["a"], refuse, ["p"], quarantine=True))
    assert good.count() == 0 and failed.collect()[0]["error"] == "ValueError: no"


def test_positions_with_a_gap_or_without_number_are_errors(frame):
    with pytest.raises(Exception, match="not dense"):
        W.over_windows(frame.where("seq <> 7"), ["a"], lambda w: w[:, 0, 0], ["p"]).collect()
    with pytest.raises(Exception, match="seq is null"):
        W.over_windows(frame.withColumn("seq", F.lit(None).cast("long")), ["a"], lambda w: w[:, 0, 0], ["p"]).collect()
    with pytest.raises(ValueError, match="repeat"):
        W.over_windows(frame, ["a"], lambda w: w[:, 0, 0], ["seq"])


def by_hand(model, rows):
    """Forecasts, one window and one step at a time."""
    inward, inner, bias = model.fixed_weights()
    out = {}
    frame = pd.DataFrame(rows, columns=["unit", "seq", "a", "b", "label", "is_val"])
    for unit, group in frame.groupby("unit", dropna=False):
        x = group.sort_values("seq")[model.inputs].to_numpy(float)
        for t in range(model.n, len(x)):
            window = x[t - model.n : t]
            if np.isnan(window).any():
                continue
            state = np.zeros(model.hidden)
            for row in window:
                state = (1 - model.leak) * state + model.leak * np.tanh(row @ inward + bias + state @ inner)
            z = np.concatenate([[1.0], state, window[-1], window.mean(axis=0)])
            out[(None if pd.isna(unit) else unit, t)] = z, z @ model.weights
    return out


@pytest.mark.parametrize("lags", [True, False])
@pytest.mark.parametrize("block", [100_000, 40])
def test_reservoir_equals_loops_and_least_squares(frame, rows, small_batches, lags, block):
    model = V.fit_reservoir(
        frame, ["a", "b"], "label", "is_val", block_rows=block, n=10, hidden=12, include_target_lags=lags
    )
    mine = by_hand(model, rows)
    out = model.forecast(frame, ["label"], block_rows=block).collect()
    assert {(r.unit, r.seq) for r in out} == set(mine) and all(r.error is None for r in out)
    assert np.allclose([r.prediction for r in out], [mine[r.unit, r.seq][1] for r in out], atol=1e-8)
    # The readout solves the penalised least squares over training rows.
    label = {(r[0], r[1]): r[4] for r in rows}
    fit = [k for k in mine if k[0] != "DS03_005"]
    z, y = np.stack([mine[k][0] for k in fit]), np.array([label[k] for k in fit])
    best = {}
    held = [k for k in mine if k[0] == "DS03_005"]
    for p in V.PENALTIES:
        cost = p * (z**2).mean(axis=0)
        cost[0] = 0
        w = np.linalg.solve(z.T @ z / len(z) + np.diag(cost), z.T @ y / len(z))
        best[p] = np.mean([(mine[k][0] @ w - label[k]) ** 2 for k in held]) ** 0.5, w
    penalty = min(best, key=lambda p: best[p][0])
    assert model.penalty == penalty and np.allclose(model.weights, best[penalty][1], atol=1e-6)
    assert np.isclose(model.rmse["validation"], best[penalty][0])


def test_reservoir_learns_what_a_line_cannot(spark):
    rng = np.random.default_rng(11)
    rows = []
    for u in range(6):
        a = rng.normal(size=400)
        rows += [(f"DS0{u}_1", i, float(a[i]), float(abs(a[i - 1]) * 4) if i else 0.0, u == 5) for i in range(400)]
    df = spark.createDataFrame(rows, "unit string, seq long, a double, label double, is_val boolean")
    model = V.fit_reservoir(df, ["a"], "label", "is_val", n=5, hidden=48, leak=0.9, reach=1.5, include_target_lags=False)
    spread = np.std([r[3] for r in rows if r[4]])
    assert model.rmse["validation"] < 0.5 * spread


def test_reservoir_is_stored_whole(spark, frame, tmp_path):
    model = V.fit_reservoir(frame, ["a", "b"], "label", n=10, hidden=8)
    model.save(spark, str(tmp_path / "m"))
    back = V.Reservoir.load(spark, str(tmp_path / "m"))
    assert vars(back).keys() == vars(model).keys() and np.array_equal(back.weights, model.weights)
    assert {k: v for k, v in vars(back).items() if k != "weights"} == {k: v for k, v in vars(model).items() if k != "weights"}


def test_infinite_values_put_an_engine_aside(spark, frame):
    model = V.fit_reservoir(frame, ["a", "b"], "label", n=10, hidden=8)
    broken = frame.withColumn("b", F.when(F.expr("unit = 'DS02_004' AND seq = 20"), float("inf")).otherwise(F.col("b")))
    good, failed = W.quarantined(model.forecast(broken))
    assert [r.unit for r in failed.collect()] == ["DS02_004"]
    assert good.where("unit = 'DS01_001'").count() == 390 and good.where("unit = 'DS02_004'").count() == 0


def test_nothing_to_fit_is_an_error(frame):
    with pytest.raises(ValueError, match="no row"):
        V.fit_reservoir(frame.where("seq < 5"), ["a"], "label", n=10)
    model = V.Reservoir(["a"], "label")
    with pytest.raises(ValueError, match="not fitted"):
        model.forecast(frame)


@pytest.mark.parametrize("lags,block", [(True, 100_000), (False, 31), (True, 64)])
def test_windows_as_views_give_the_model_of_vectors(frame, small_batches, monkeypatch, lags, block):
    """Coefficients and forecasts of Spark's regression on vectors that are laid out."""
    monkeypatch.setattr(M, "WINDOWS_AT_ONCE", 50)
    df, train = frame.where("unit IS NOT NULL"), F.col("unit") != "DS01_001"
    for n, penalty in ((3, 0.01), (30, 0.1)):
        laid = S.window_vectors(df, ["a", "b"], "label", n, lags)
        viewed = S.window_vectors(df, ["a", "b"], "label", n, lags, block_rows=block, views=True)
        plain = M.train_vectors(laid.where(train), "window", "label", regParam=penalty)
        model = M.train_vectors(viewed.where(train), "window", "label", regParam=penalty)
        assert model.coefficients == pytest.approx(plain.stages[-1].coefficients.toArray(), abs=1e-9)
        assert model.intercept == pytest.approx(plain.stages[-1].intercept, abs=1e-9)
        got, want = ({(r.unit, r.seq): r.prediction for r in m.transform(w).collect()} for m, w in ((model, viewed), (plain, laid)))
        assert got.keys() == want.keys() and got == {k: pytest.approx(v, abs=1e-9) for k, v in want.items()}
    missing = df.withColumn("label", F.when(F.col("seq") != 35, F.col("label")))
    with pytest.raises(Exception, match="a label is missing"):
        M.train_vectors(S.window_vectors(missing, ["a"], "label", 30, False, views=True), "window", "label")


def test_forecasts_lay_no_windows_out(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(S, "sequence_windows", None)
    assert queries.forecast_lr(spark, sf_dir).count() and queries.forecast_covariates(spark, sf_dir).count()
