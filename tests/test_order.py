"""Order, blocks and rolling windows: pandas twins, hot engines, every cut alike."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rulspark.operators import ordering as O
from rulspark.operators import rolling as R
from rulspark.operators import sequence as S
from rulspark.schema import BASE_FEATURES, derived_names


@pytest.fixture(scope="module")
def hot():
    """One engine with most rows, short engines of 1, 30 and 31 rows, ties, gaps."""
    rng = np.random.default_rng(7)
    rows = []
    for unit, n in {"DS01_001": 700, "DS01_002": 1, "DS01_003": 30, "DS02_004": 31, "DS02_1005": 200}.items():
        for i in range(n):
            a = None if (unit == "DS02_1005" and i % 7 == 0) else float(rng.normal(50, 20))
            rows.append((unit, i // 9 + 1, len(rows), a, 3.25, float(n - i)))
    return pd.DataFrame(rows, columns=["unit", "time", "position", "a", "flat", "label"])


@pytest.fixture(scope="module")
def frame(spark, hot):
    schema = "unit string, time int, position long, a double, flat double, label double"
    return spark.createDataFrame(
        [tuple(None if isinstance(x, float) and np.isnan(x) else x for x in r) for r in hot.itertuples(index=False)],
        schema,
    ).repartition(4, "position")


def numbered(pdf):
    return pdf.assign(seq=pdf.groupby("unit").cumcount())


@pytest.fixture
def many_partitions(spark):
    """Small range partitions are kept apart, as big ones would be."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield
    spark.conf.set(key, "true")


def test_ordinal_is_dense(frame, hot, many_partitions):
    got = (
        O.with_ordinal(frame, ["unit"], ["time", "position"], "seq")
        .select("unit", "position", "seq").toPandas().sort_values("position").reset_index(drop=True)
    )
    want = numbered(hot)[["unit", "position", "seq"]].reset_index(drop=True)
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_one_engine_spreads_over_partitions(spark, many_partitions):
    alone = spark.range(700).selectExpr("'u' AS unit", "int(id / 10) AS time", "id AS position")
    out = O.with_ordinal(alone, ["unit"], ["time", "position"], "seq").withColumn("at", F.spark_partition_id())
    sizes = [r["count"] for r in out.groupBy("at").count().collect()]
    assert len(sizes) > 1 and max(sizes) < 400
    assert out.where("seq <> position").count() == 0


def test_ordinal_without_keys_and_with_nulls(spark, frame, many_partitions):
    got = O.with_ordinal(frame, [], ["position"], "rank")
    assert got.where("rank <> position").count() == 0
    rows = spark.createDataFrame([(None, 1, 1), (None, None, 2), ("a", None, 3), ("a", 2, 4), ("a", 2, 5)], "k string, t int, p int")
    got = {r.p: r.n for r in O.with_ordinal(rows, ["k"], ["t", "p"], "n").collect()}
    assert got == {2: 0, 1: 1, 3: 0, 4: 1, 5: 2}


def test_a_null_position_is_an_error(spark):
    rows = spark.createDataFrame([("u", 0, 1.0), ("u", None, 2.0)], "unit string, seq long, x double")
    with pytest.raises(Exception, match="seq is null"):
        O.in_blocks(rows, 1, lambda cut, w: cut).collect()


def test_ema_carries_over_any_gap(spark):
    from rulspark.operators.rolling import ema

    values = [5.0] + [None] * 599 + [7.0, None, 9.0]
    other = [None, 1.0] + [float(i % 7) for i in range(601)]
    rows = [(1, i, v, o) for i, (v, o) in enumerate(zip(values, other))]
    got = ema(spark.createDataFrame(rows, "dataset int, time int, x double, y double"), ["x", "y"]).toPandas().sort_values("time")
    for name, v in (("x", values), ("y", other)):
        want = pd.Series(v, dtype=float).ewm(span=10, adjust=False).mean()
        np.testing.assert_allclose(got[name].to_numpy(float), want.to_numpy(), rtol=1e-12)
    rng = np.random.default_rng(3)
    long = [None if u < 0.3 else float(x) for u, x in zip(rng.random(5000), rng.normal(size=5000))]
    frame = spark.createDataFrame([(2, i, v) for i, v in enumerate(long)], "dataset int, time int, x double")
    got = ema(frame, ["x"], span=200).toPandas().sort_values("time")
    want = pd.Series(long, dtype=float).ewm(span=200, adjust=False).mean()
    np.testing.assert_allclose(got["x"].to_numpy(float), want.to_numpy(), rtol=1e-9)


def test_keep_first_needs_no_sort_aggregate(spark):
    df = spark.range(100).selectExpr("id % 7 AS k", "id AS seq", "id * 2 AS v")
    out = O.keep_first(df, ["k"])
    assert sorted(tuple(r) for r in out.collect()) == [(k, k, 2 * k) for k in range(7)]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "WindowGroupLimit" in plan


def pandas_rolling(pdf, column):
    out = pdf[["unit", "seq"]].copy()
    groups = pdf.assign(x=pdf[column].astype("float32").astype("float64")).groupby("unit")["x"]
    for name, n in {"short": 5, "medium": 15, "long": 30}.items():
        out[f"{column}_mean_{name}"] = groups.transform(lambda x: x.rolling(n, min_periods=1).mean()).astype("float32")
        out[f"{column}_std_{name}"] = groups.transform(lambda x: x.rolling(n, min_periods=1).std()).fillna(0).astype("float32")
    out[f"{column}_acceleration"] = out[f"{column}_mean_short"] - out[f"{column}_mean_medium"]
    return out


@pytest.mark.parametrize("block", [100_000, 64])
@pytest.mark.parametrize("windows", [{"short": 5, "medium": 15, "long": 30}])
def test_rolling_equals_pandas_in_any_block_size(spark, frame, hot, block, windows):
    df = O.with_ordinal(frame, ["unit"], ["position"])
    got = R.multiscale_features(df, ["a", "flat"], windows, block_rows=block).toPandas()
    assert len(got) == len(hot)
    for column in ("a", "flat"):
        want = pandas_rolling(numbered(hot), column)
        both = got.merge(want, on=["unit", "seq"], suffixes=("", "_want"))
        for name in derived_names(column):
            np.testing.assert_allclose(
                both[name].astype(float), both[f"{name}_want"].astype(float), rtol=1e-5, atol=1e-4, err_msg=name
            )
    assert (got[[c for c in got.columns if c.startswith("flat_std")]] == 0).all().all()


def test_merged_and_separate_scales_agree(frame, monkeypatch):
    df = O.with_ordinal(frame, ["unit"], ["position"])
    merged = R.multiscale_features(df, ["a"]).toPandas().sort_values(["unit", "seq"])
    monkeypatch.setattr(R, "_nested", lambda windows: False)
    separate = R.multiscale_features(df, ["a"]).toPandas().sort_values(["unit", "seq"])
    for name in derived_names("a"):
        np.testing.assert_allclose(merged[name], separate[name], rtol=1e-6, atol=1e-6)


def test_windows_that_do_not_nest(frame, hot):
    df = O.with_ordinal(frame, ["unit"], ["position"])
    out = R.multiscale_features(df, ["a"], {"short": 4, "medium": 9}).toPandas()
    want = numbered(hot).groupby("unit")["a"].transform(lambda x: x.rolling(9, min_periods=1).mean())
    both = out.merge(numbered(hot).assign(want=want)[["unit", "seq", "want"]], on=["unit", "seq"])
    np.testing.assert_allclose(both["a_mean_medium"].astype(float), both["want"], rtol=1e-5)


def test_rolling_mean_stays_in_range_and_order_of_input_is_irrelevant(frame):
    df = O.with_ordinal(frame, ["unit"], ["position"])
    one = R.multiscale_features(df, ["a"]).orderBy("unit", "seq").toPandas()
    two = R.multiscale_features(df.orderBy(F.rand(3)), ["a"]).orderBy("unit", "seq").toPandas()
    pd.testing.assert_frame_equal(one, two)
    assert one.a_mean_long.max() <= one.a.max() and (one.a_std_long >= 0).all()


def test_ninety_six_features():
    assert len(BASE_FEATURES) + sum(len(derived_names(f)) for f in BASE_FEATURES) == 96


def test_one_exchange_serves_all_scales(spark, frame):
    path = O.with_ordinal(frame, ["unit"], ["position"])
    stored = spark.createDataFrame(path.toPandas())
    plan = R.multiscale_features(stored, ["a", "flat"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 1


@pytest.mark.parametrize("block", [100_000, 40])
def test_sequence_windows(frame, hot, block):
    df = O.with_ordinal(frame, ["unit"], ["position"])
    out = S.sequence_windows(df, ["flat"], 30, target="label", block_rows=block)
    got = out.select("unit", "seq", F.size("history").alias("n"), F.col("history.target").alias("t")).toPandas()
    sizes = got.groupby("unit").size().to_dict()
    assert sizes == {"DS01_001": 670, "DS02_004": 1, "DS02_1005": 170}
    assert (got.n == 30).all()
    labels = numbered(hot).set_index(["unit", "seq"]).label
    for r in got.itertuples():
        assert r.t[0] == labels[(r.unit, r.seq - 30)] and r.t[-1] == labels[(r.unit, r.seq - 1)]
    bare = S.sequence_windows(df, ["flat"], 30, target="label", include_target_lags=False)
    assert bare.select(F.inline("history")).columns == ["f0"]


@pytest.mark.parametrize("block", [100_000, 33])
def test_lags_and_naive_forecast_across_blocks(frame, hot, block):
    df = O.with_ordinal(frame, ["unit"], ["position"])
    lags = S.lag_columns(df, "label", [1, 20], block_rows=block).toPandas()
    assert (lags.label_lag1 == lags.label + 1).all() and (lags.label_lag20 == lags.label + 20).all()
    naive = S.naive_forecast(df, "label", 30, block_rows=block).toPandas()
    assert np.allclose(naive.Prediction_Error, 15.5)
    last = S.naive_forecast(df, "label", 30, how="last", block_rows=block).toPandas()
    assert np.allclose(last.Prediction_Error, 0)
    assert S.unscored_units(df, naive_frame(df)).count() == 2


def naive_frame(df):
    return S.naive_forecast(df, "label", 30)


def test_delta_across_blocks(frame):
    df = O.with_ordinal(frame, ["unit"], ["position"])
    out = S.with_delta(df, "label", "d", block_rows=10)
    assert out.where("d IS NOT NULL AND d <> -1").count() == 0
    assert out.where("d IS NULL").count() == 5


@pytest.mark.parametrize("missing", [False, True])
def test_ema_equals_pandas(spark, missing):
    rng = np.random.default_rng(3)
    rows = [
        (d, t, None if missing and t % 6 in (0, 4) else float(rng.normal())) for d in (1, 2) for t in range(1, 400)
    ]
    df = spark.createDataFrame(rows, "dataset int, time int, x double").repartition(3)
    got = R.ema(df, ["x"]).orderBy("dataset", "time").toPandas()
    want = (
        pd.DataFrame(rows, columns=["dataset", "time", "x"]).astype({"x": float})
        .groupby("dataset")["x"].transform(lambda x: x.ewm(span=10, adjust=False).mean())
    )
    np.testing.assert_allclose(got.x.astype(float), want, rtol=1e-12, equal_nan=True)


def test_keep_first_takes_the_lowest_position(spark):
    rows = [("u", 1, 5, None), ("u", 1, 3, "b"), ("u", 2, 4, "c"), (None, 1, 9, "d"), (None, 1, 8, "e")]
    df = spark.createDataFrame(rows, "unit string, time int, seq int, v string")
    got = {tuple(r) for r in O.keep_first(df, ["unit", "time"]).collect()}
    assert got == {("u", 1, 3, "b"), ("u", 2, 4, "c"), (None, 1, 8, "e")}
    report = O.dedup_report(df, ["unit", "time"]).first()
    assert report[:] == (5, 3, 2)


def test_keep_first_may_keep_a_null(spark):
    df = spark.createDataFrame([("u", 1, None), ("u", 2, "x")], "unit string, seq int, v string")
    assert O.keep_first(df, ["unit"]).first().v is None


def test_sample_is_stable_and_ordered(frame):
    one = O.sample_rows(frame, 50, ["position"], ["position"]).toPandas()
    two = O.sample_rows(frame.repartition(7), 50, ["position"], ["position"]).toPandas()
    assert len(one) == 50 and one.position.is_monotonic_increasing
    pd.testing.assert_frame_equal(one, two)
    assert set(O.sample_rows(frame, 50, ["position"], ["position"], seed=1).toPandas().position) != set(one.position)


def test_first_units_and_preview(frame):
    assert O.first_units(frame, 2).select("unit").distinct().count() == 2
    df = O.with_ordinal(frame, ["unit"], ["position"])
    assert [r.seq for r in O.preview(df, "DS01_001", 3).collect()] == [0, 1, 2]
    assert [r.seq for r in O.preview(df, "DS01_001", 2, last=True).collect()] == [699, 698]


def test_block_must_exceed_history(frame):
    with pytest.raises(ValueError):
        O.in_blocks(frame, 30, lambda d, w: d, block_rows=30)
