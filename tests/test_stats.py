"""Quantiles, histograms, shift and scaling against numpy, on every code path."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rulspark.operators import quality as Q
from rulspark.operators import quantiles
from rulspark.operators import scaling as C
from rulspark.operators import shift as H
from rulspark.operators import stats as S
from rulspark.operators.quantiles import exact_quantiles

NAN = float("nan")


@pytest.fixture(scope="module")
def columns():
    rng = np.random.default_rng(11)
    n = 3001
    hot = rng.normal(size=n)
    hot[: n // 3] = 1.5  # a third of the rows share one value
    heavy = np.exp(rng.normal(size=n) * 8)  # nearly all of the range is empty
    return {
        "normal": rng.normal(10, 3, n),
        "hot": hot,
        "heavy": heavy,
        "constant": np.full(n, 4.0),
        "whole": rng.integers(0, 5, n).astype(float),
    }


@pytest.fixture(scope="module")
def table(spark, columns):
    rows = [tuple(float(v[i]) for v in columns.values()) for i in range(3001)]
    return spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(5)


@pytest.mark.parametrize("max_rows,bins", [(10**6, 4096), (40, 16), (3, 7)])
def test_quantiles_are_exact_however_narrow_the_brackets(table, columns, max_rows, bins):
    probs = (0.0, 0.25, 0.5, 0.75, 0.9, 1.0)
    got = {
        (r.feature, r.prob): r.value
        for r in exact_quantiles(table, list(columns), probs, max_rows, bins).collect()
    }
    for c, v in columns.items():
        for p in probs:
            assert got[(c, p)] == pytest.approx(np.quantile(v, p), rel=1e-12, abs=1e-12), (c, p)


def test_quantiles_and_histogram_of_infinite_values(spark):
    inf = float("inf")
    values = [-inf] * 40 + [float(i) for i in range(300)] + [inf] * 60 + [NAN, None]
    df = spark.createDataFrame([(v,) for v in values], "a double").repartition(3)
    probs = (0.0, 0.05, 0.2, 0.3, 0.5, 0.8, 0.9, 1.0)
    known = np.sort([v for v in values if v is not None and v == v])
    for limit in (10**6, 20):
        got = {r.prob: r.value for r in exact_quantiles(df, ["a"], probs, limit, 8).collect()}
        for p in probs:
            at = p * (len(known) - 1)
            low, high = known[int(np.floor(at))], known[int(np.ceil(at))]
            want = low if low == high else low + (at - np.floor(at)) * (high - low)
            assert got[p] == pytest.approx(want), (p, limit)
    rows = S.histogram(df, "a", 10).orderBy("bin").collect()
    assert [r.n for r in rows] == [30] * 10 and rows[0].bin_low == 0.0 and rows[-1].bin_high == 299.0


def test_quantiles_of_any_values_take_few_passes(spark, monkeypatch):
    rng = np.random.default_rng(5)
    n = 60_000
    inf = float("inf")
    odd = rng.choice([-1.0, 1.0], n) * 10.0 ** rng.uniform(-300, 300, n)
    odd[: n // 10], odd[n // 10 : n // 8] = inf, -inf
    near = 1.0 + rng.integers(0, n, n) * 2.0**-52  # neighbouring doubles
    near[::3] = 1e300
    cols = {"odd": rng.permutation(odd), "near": rng.permutation(near)}
    df = spark.createDataFrame(
        [tuple(map(float, r)) for r in zip(*cols.values())], "odd double, near double"
    ).repartition(3)
    passes, look = [], quantiles._look

    def counted(df, columns, brackets, k):
        passes.append(brackets)
        return look(df, columns, brackets, k)

    monkeypatch.setattr(quantiles, "_look", counted)
    probs = (0.001, 0.25, 0.5, 0.75, 0.999)
    got = {(r.feature, r.prob): r.value for r in exact_quantiles(df, list(cols), probs, 2_000).collect()}
    assert len(passes) <= 3  # and the one that selects
    for c, v in cols.items():
        known = np.sort(v)
        for p in probs:
            at = p * (n - 1)
            low, high = known[int(np.floor(at))], known[int(np.ceil(at))]
            want = low if low == high else low + (at - np.floor(at)) * (high - low)
            assert got[c, p] == pytest.approx(want, rel=1e-15), (c, p)
    # What the last pass orders is a small part of the rows.
    assert all(n_inside(cols, b) <= 2_000 for b in passes[-1])


def n_inside(cols, bracket):
    v = list(cols.values())[bracket.feature]
    return int(((v > bracket.lo) & (v < bracket.hi)).sum())


def test_a_sketch_that_errs_costs_a_pass_not_the_result(spark, monkeypatch):
    """A margin of nothing loses ranks; the counts show it and the bracket grows back."""
    monkeypatch.setattr(quantiles, "rank_error", lambda k: -0.01)
    v = np.random.default_rng(6).normal(size=20_000)
    df = spark.createDataFrame([(float(x),) for x in v], "a double").repartition(4)
    probs = (0.0, 0.1, 0.5, 0.77, 1.0)
    got = {r.prob: r.value for r in exact_quantiles(df, ["a"], probs, 50, 64).collect()}
    for p in probs:
        assert got[p] == pytest.approx(np.quantile(v, p), rel=1e-12)


def test_quantiles_skip_missing_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None), (NAN, None), (3.0, None), (None, None)], "a double, b double")
    got = {r.feature: r.value for r in exact_quantiles(df, ["a", "b"], [0.5]).collect()}
    assert got == {"a": 2.0}
    assert exact_quantiles(df, ["b"], [0.5]).count() == 0


@pytest.mark.parametrize("pieces", [None, 1, 20])
def test_ks_equals_brute_force_however_cut(table, columns, pieces):
    a, b = table.where("whole <= 1"), table.where("whole > 1")
    mask = columns["whole"] <= 1
    got = {
        r.feature: r
        for r in H.ks_two_sample(a, b, ["normal", "hot", "heavy", "constant"], pieces=pieces).collect()
    }
    for c in got:
        x, y = np.sort(columns[c][mask]), np.sort(columns[c][~mask])
        grid = np.concatenate([x, y])
        want = np.abs(
            np.searchsorted(x, grid, "right") / len(x) - np.searchsorted(y, grid, "right") / len(y)
        ).max()
        assert got[c].distance == pytest.approx(want, abs=1e-12)
        z = math.sqrt(len(x) * len(y) / (len(x) + len(y))) * want
        p = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * z * z) for k in range(1, 101))
        assert got[c].p_value == pytest.approx(1.0 if want == 0 else min(max(p, 0), 1), abs=1e-9)


def test_ks_of_disjoint_samples_is_one(spark):
    a = spark.createDataFrame([(float(i),) for i in range(50)], "x double")
    out = H.ks_two_sample(a, a.select((F.col("x") + 100).alias("x")), ["x"]).first()
    assert out.distance == 1.0 and out.shifted


@pytest.mark.parametrize("buckets", [2, 5, 64])
def test_ks_is_the_same_however_many_buckets(spark, table, buckets):
    names = ["normal", "hot", "heavy", "constant", "whole"]
    inf = float("inf")
    odd = F.when(F.col("normal") > 12, inf).when(F.col("normal") < 7, -inf).otherwise(F.col("hot")).alias("odd")
    rows = table.select(*names, odd)
    a, b = rows.where("heavy > 0.5"), rows.where("heavy < 2 or normal > 10")
    got = {r.feature: r for r in H.ks_two_sample(a, b, [*names, "odd"], buckets=buckets).collect()}
    x, y = a.toPandas(), b.toPandas()
    for c in [*names, "odd"]:
        u, v = np.sort(x[c].to_numpy()), np.sort(y[c].to_numpy())
        grid = np.concatenate([u, v])
        want = np.abs(
            np.searchsorted(u, grid, "right") / len(u) - np.searchsorted(v, grid, "right") / len(v)
        ).max()
        assert got[c].distance == want and (got[c].n_ref, got[c].n_cur) == (len(u), len(v)), c


def test_ks_walks_fewer_values_the_more_buckets_there_are(spark):
    rng = np.random.default_rng(8)
    rows = [(float(x), 1) for x in rng.normal(size=8_000)] + [(float(x), 0) for x in rng.normal(0.5, size=8_000)]
    both = spark.createDataFrame(rows, "v0 double, is_ref int").repartition(3)
    walked = []
    for buckets in (2, 8, 64):
        edges, open_, _ = H.ks_leaves(both, 1, buckets)
        walked.append(H._in_leaves(both, edges, open_).count())
    # Half a deviation apart: the gap is flat around its top, where leaves stay open.
    assert 16_000 > walked[0] > walked[1] > walked[2] and walked[2] < 16_000 / 3, walked


def test_ks_of_like_samples_walks_few_values(spark, monkeypatch):
    """Where samples are alike, every leaf of 64 may hold the distance; cut further, few do."""
    monkeypatch.setattr(H, "WALK_ROWS", 2_000)
    monkeypatch.setattr(H, "BUFFER_ROWS", 7_000)
    rng = np.random.default_rng(9)
    x, y = rng.normal(size=20_000), rng.normal(size=20_000)
    rows = spark.createDataFrame([(float(v), 1) for v in x] + [(float(v), 0) for v in y], "v0 double, is_ref int").repartition(3)
    edges, open_, _ = H.ks_leaves(rows, 1, 64)
    assert H._in_leaves(rows, edges, open_).count() < 4_000
    a, b = rows.where("is_ref = 1"), rows.where("is_ref = 0")
    x, y, grid = np.sort(x), np.sort(y), np.concatenate([x, y])
    want = np.abs(np.searchsorted(x, grid, "right") / len(x) - np.searchsorted(y, grid, "right") / len(y)).max()
    assert H.ks_two_sample(a, b, ["v0"]).first().distance == want


def test_ks_of_an_empty_side_is_unknown(spark):
    a = spark.createDataFrame([(1.0, None), (2.0, None)], "x double, y double")
    out = H.ks_two_sample(a, a.where("x > 5"), ["x", "y"]).collect()
    assert [(r.feature, r.n_ref, r.n_cur, r.distance) for r in out] == [("x", 2, 0, None)]


def test_psi_of_a_sample_with_itself_is_zero(table):
    for r in H.psi_kl(table, table, ["normal", "hot", "constant"]).collect():
        assert r.psi == pytest.approx(0) and r.kl == pytest.approx(0)


@pytest.mark.parametrize("values", [[1.0, 2.0, 2.0, 7.0, 9.5], [3.0, 3.0], [-1.0, 0.0, 1e-9, 1.0], list(np.linspace(0, 1, 31))])
@pytest.mark.parametrize("bins", [1, 7, 30])
def test_histogram_equals_numpy(spark, values, bins):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (NAN,)], "x double")
    df = df.where(~F.isnan("x") | F.col("x").isNull())
    rows = S.histogram(df, "x", bins).orderBy("bin").collect()
    want, edges = np.histogram(values, bins)
    assert [r.n for r in rows] == want.tolist()
    assert np.allclose([r.bin_low for r in rows], edges[:-1]) and rows[-1].bin_high == pytest.approx(edges[-1])


def test_scalers_round_trip_and_guard_zero_spread(table, columns):
    names = list(columns)
    for fit in (C.fit_robust, C.fit_minmax, C.fit_standard):
        params = fit(table, names)
        assert {r.feature: r.scale for r in params.collect()}["constant"] == 1.0
        back = C.unscale(C.scale(table, params, names), params, names)
        for c in names:
            total = back.agg(F.sum(c)).first()[0]
            assert total == pytest.approx(columns[c].sum(), rel=1e-9)
    scaled = C.scale(table, C.fit_minmax(table, names), names)
    assert scaled.agg(F.min("normal"), F.max("normal")).first()[:] == (0.0, 1.0)


def test_describe_equals_numpy(table, columns):
    for r in S.describe(table, list(columns)).collect():
        v = columns[r.feature]
        assert (r.n, r.min, r.max) == (len(v), v.min(), v.max())
        assert r.std == pytest.approx(v.std(ddof=1), rel=1e-9, abs=1e-12) and r.q50 == pytest.approx(np.median(v))


def test_missing_constant_and_nearly_constant(spark):
    rows = [(None if i == 3 else float(i), NAN if i < 2 else 1.0, 5.0, 1000.0 + i * 0.01) for i in range(10)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double")
    assert {tuple(r) for r in S.null_counts(df, list("abcd")).collect()} == {("a", 1), ("b", 2)}
    verdicts = {r.feature: r.verdict for r in S.low_variance(df, list("abcd")).collect()}
    assert verdicts == {"b": "constant", "c": "constant", "d": "low_variance"}


def test_correlation_needs_six_points(spark):
    rows = [(1, t, float(t), 10.0 - t) for t in range(5)] + [(2, t, float(t), 10.0 - t) for t in range(6)]
    rows += [(3, t, 1.0, float(t)) for t in range(9)]
    df = spark.createDataFrame(rows, "dataset int, time int, s double, label double")
    got = {r.dataset: r["corr"] for r in S.sensor_label_corr(df, ["s"], "label").collect()}
    assert got[1] is None and got[2] == pytest.approx(-1) and got[3] is None
    lagged = {(r.dataset, r.lag): r["corr"] for r in S.sensor_label_lagcorr(df, ["s"], "label", [1, 3]).collect()}
    assert lagged[(2, 1)] is None and lagged[(3, 1)] is None
    matrix = S.corr_matrix(S.sensor_label_corr(df, ["s"], "label"), ["s"])
    assert matrix.columns == ["dataset", "s"] and matrix.count() == 3


@pytest.mark.parametrize(
    "lo,hi,severity",
    [(0.0, 1.0, "MILD"), (-0.05, 1.0, "MODERATE"), (0.0, 1.05, "MODERATE"), (-0.2, 1.0, "SEVERE"), (0.0, 1.2, "SEVERE")],
)
def test_severity_limits(spark, lo, hi, severity):
    report = spark.createDataFrame([("f", lo, hi)], "feature string, min_scaled double, max_scaled double")
    assert H.shift_severity(report).first().severity == severity


def test_linear_label(spark):
    df = spark.createDataFrame([("u", i, float(50 - i)) for i in range(40)], "unit string, seq long, y double")
    out = S.label_linearity(df, "y").first()
    assert out.is_linear and out.n_distinct == 1 and out.mean == -1


def test_quality_rules(spark):
    inf = float("inf")
    rows = [(1.0, 5.0), (None, 5.0), (NAN, -1.0), (inf, 1.0), (2.0, -3.0), (1.0, 5.0)]
    df = spark.createDataFrame(rows, "x double, label double")
    kept, counts = Q.quality_filter(df, Q.validity_rules(["x"], "label"))
    assert kept.count() == 2
    assert {tuple(r) for r in counts.collect()} == {
        ("kept", 2), ("missing", 2), ("infinite", 1), ("negative_label", 1)
    }
    assert Q.quality_dedup(df).count() == 5
    assert Q.quality_dedup(df, {"x": 0.0}).where("x = 0").count() == 2
    assert Q.drop_missing(df, ["x"]).count() == 4
