"""The dated jobs from raw arrays to drift status, for two days."""

import json

import pytest
from pyspark.sql import functions as F

from rulspark.__main__ import main
from rulspark.errors import MissingSections, NothingFound
from rulspark.plans.frames import raw_arrays, readings
from rulspark.plans.stages import Lake, pending, run
from rulspark.schema import CLIPPED_LABEL, TABULAR_BASELINE
from rulspark.sources.readers import read_partitioned

DATES = ["2025-01-02", "2025-01-03"]


@pytest.fixture(scope="module")
def base(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    # Two wide snapshots, so that engines are long enough for the look-back.
    rows = readings(spark, sf_dir).withColumn(
        "snapshot_date", F.when(F.col("seq") % 2 == 0, DATES[0]).otherwise(DATES[1]).cast("date")
    )
    raw = raw_arrays(rows)
    for split, part in (("dev", raw.where("event_id % 2 = 0")), ("test", raw.where("event_id % 2 = 1"))):
        part.drop("event_id").write.partitionBy("snapshot_date").parquet(str(root / "raw" / split))
    (root / "models").mkdir()
    (root / "models" / "tabular_baseline.json").write_text(json.dumps(TABULAR_BASELINE))
    return str(root)


def test_all_stages_for_two_days(spark, base, monkeypatch):
    lake = Lake(spark, base)
    for date in DATES:
        for stage in (
            "ingest", "silver", "label-base", "tabular-labels", "tabular-features", "series-features", "series-labels"
        ):
            run(spark, base, stage, date)
    n = read_partitioned(spark, lake.path("bronze")).count()
    silver = read_partitioned(spark, lake.path("silver"))
    assert n == 1000 and silver.count() == n
    dense = silver.groupBy("snapshot_date", "dataset", "unit_orig").agg(
        F.max("seq").alias("top"), F.count_distinct("seq").alias("n")
    )
    assert dense.where("top <> n - 1").count() == 0
    features = read_partitioned(spark, lake.path("gold/tabular_features"))
    assert features.count() == n and len(features.columns) == 96 + 6

    assert pending(lake, "tabular") == DATES
    run(spark, base, "train-tabular", DATES[1], depth=3, rounds=5)
    run(spark, base, "score-tabular", DATES[0])
    assert pending(lake, "tabular") == DATES[1:]
    run(spark, base, "train-sequence", DATES[0], regParam=0.1)
    run(spark, base, "forecast-sequence", DATES[0])
    for _ in range(2):
        run(spark, base, "monitor-tabular", DATES[0])
        run(spark, base, "monitor-sequence", DATES[0])
    assert read_partitioned(spark, lake.path("monitoring/tabular/history")).count() == 1
    assert read_partitioned(spark, lake.path("monitoring/sequence/history")).count() == 2
    document = spark.read.json(lake.path("monitoring/tabular/metrics")).first()
    assert document.drift.status in ("ok", "warning", "critical")
    residuals = read_partitioned(spark, lake.path("monitoring/tabular/residuals"))
    assert residuals.count() == document.prediction_count
    forecast = read_partitioned(spark, lake.path("inference/sequence"))
    assert forecast.agg(F.min("time")).first()[0] == 30
    assert set(r.dataset for r in forecast.select("dataset").distinct().collect()) <= {f"DS0{i}" for i in range(1, 8)}
    short = read_partitioned(spark, lake.path("inference/sequence_unscored"))
    assert short.count() > 0 and short.agg(F.max("n_rows")).first()[0] <= 30
    for model in ("tabular", "sequence"):
        ranked = read_partitioned(spark, lake.path(f"monitoring/{model}/report/unit_rmse"))
        assert ranked.count() > 0
        bins = read_partitioned(spark, lake.path(f"monitoring/{model}/report/error_histogram"))
        assert bins.count() == 50

    run(spark, base, "split", DATES[0], oot_sets=[7])
    dealt = read_partitioned(spark, lake.path("gold/splits"))
    assert dealt.count() == read_partitioned(spark, lake.path("gold/tabular_features")).where(F.col("snapshot_date") == DATES[0]).count()
    assert dealt.groupBy("unit").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0


def test_series_files_keep_their_order(spark, base):
    import pyarrow.parquet as pq
    from pathlib import Path

    files = sorted(Path(base, "gold/series_labels", f"snapshot_date={DATES[0]}").glob("*.parquet"))
    seen = [(u, s) for f in files for u, s in zip(*[pq.ParquetFile(f).read().column(c).to_pylist() for c in ("unit", "seq")])]
    assert seen == sorted(seen) and len(seen) > 0


def test_a_stage_without_input_says_so(spark, base):
    with pytest.raises(NothingFound):
        run(spark, base, "silver", "2031-01-01")


def test_a_broken_baseline_stops_monitoring(spark, base, tmp_path):
    from rulspark.schema import TABULAR_BASELINE_SCHEMA
    from rulspark.sources.readers import read_baseline

    broken = tmp_path / "b.json"
    broken.write_text(json.dumps({"thresholds": TABULAR_BASELINE["thresholds"]}))
    with pytest.raises(MissingSections):
        read_baseline(spark, str(broken), TABULAR_BASELINE_SCHEMA)


def test_recurrent_forecaster_from_the_command_line(spark, base):
    at = ["--base", base, "--snapshotdate", DATES[0]]
    lake = Lake(spark, base)
    for lags in ([], ["--no-target-lags"]):
        main(["train-sequence", *at, "--forecaster", "reservoir", "--param", "hidden=16", *lags])
        main(["forecast-sequence", *at, "--forecaster", "reservoir", *lags])
        out = read_partitioned(spark, lake.path("inference/sequence"))
        labels = read_partitioned(spark, lake.path("gold/series_labels")).where(F.col("snapshot_date") == DATES[0])
        assert out.count() == labels.where("seq >= 30").count() > 0
        assert out.where("RUL_Predicted IS NULL OR isnan(RUL_Predicted)").count() == 0
        # Actual labels come back unscaled.
        both = out.select("unit", F.col("time").alias("seq"), "RUL_Actual").join(labels, ["unit", "seq"])
        assert both.where(F.abs(F.col("RUL_Actual") - F.col(CLIPPED_LABEL)) > 1e-3).count() == 0
    rest = read_partitioned(spark, lake.path("inference/sequence_unscored"))
    assert {r.reason for r in rest.select("reason").distinct().collect()} == {"not longer than 30 rows"}


def test_an_engine_the_forecaster_fails_on_is_listed(spark, base):
    """One infinite reading: that engine is unscored with a reason; all engines: an error."""
    from rulspark.errors import NoPredictions

    lake = Lake(spark, base)
    run(spark, base, "train-sequence", DATES[0], forecaster="reservoir", hidden=8)
    path = lake.path("gold/series_features")
    series = spark.createDataFrame(lake.snapshot("gold/series_features", DATES[0]).collect())
    name = next(c for c in series.columns if c not in ("unit", "seq", "snapshot_date"))
    unit = series.where("seq > 35").agg(F.min("unit")).first()[0]

    def broken(where):
        value = F.when(where & (F.col("seq") == 3), F.lit(float("inf"))).otherwise(F.col(name))
        rows = series.withColumn(name, value.cast(series.schema[name].dataType))
        rows.write.mode("overwrite").partitionBy("snapshot_date").parquet(path)
        spark.catalog.clearCache()

    try:
        broken(F.col("unit") == unit)
        run(spark, base, "forecast-sequence", DATES[0], forecaster="reservoir")
        rest = read_partitioned(spark, lake.path("inference/sequence_unscored"))
        failed = rest.where(~F.col("reason").startswith("not longer")).collect()
        assert [(r.unit, r.reason) for r in failed] == [(unit, "ValueError: a value is not finite")]
        scored = read_partitioned(spark, lake.path("inference/sequence")).select("unit").distinct()
        assert unit not in {r.unit for r in scored.collect()} and scored.count() > 0
        broken(F.lit(True))
        with pytest.raises(NoPredictions):
            run(spark, base, "forecast-sequence", DATES[0], forecaster="reservoir")
    finally:
        broken(F.lit(False))


def test_command_line(spark, base, capsys):
    with pytest.raises(SystemExit):
        main(["silver", "--base", base, "--snapshotdate", DATES[1], "--param", "depth=3"])
    with pytest.raises(SystemExit):
        main(["train-tabular", "--base", base, "--snapshotdate", DATES[1], "--param", "depth"])
    main(["split", "--base", base, "--snapshotdate", DATES[0], "--train-sets", "1,2,3", "--oot-sets", "7"])
    dealt = read_partitioned(spark, Lake(spark, base).path("gold/splits")).where("split = 'oot'")
    assert {r.dataset for r in dealt.select("dataset").distinct().collect()} == {7}
    main(["silver", "--base", base, "--snapshotdate", DATES[1]])
    assert capsys.readouterr().out.strip().endswith("/silver")
    main(["pending-tabular", "--base", base])
    assert DATES[1] in capsys.readouterr().out
    with pytest.raises(SystemExit):
        main(["silver", "--base", base])
