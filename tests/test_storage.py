"""Layers on storage, streaming reruns and batch scoring."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulspark.errors import NothingFound, NoPredictions
from rulspark.operators import modeling as L
from rulspark.operators.projection import with_path_dataset
from rulspark.operators.sequence import require_predictions
from rulspark.schema import BRONZE_SCHEMA
from rulspark.sources import bronze as B
from rulspark.sources import readers as R
from rulspark.sources import writers as W
from rulspark.streaming.incremental import incremental_snapshots, land


@pytest.fixture
def table(spark):
    return spark.range(1000).selectExpr(
        "id", "int(id % 3) AS dataset", "date_add(DATE'2025-01-01', int(id % 4)) AS snapshot_date", "id * 0.5D AS x"
    )


def test_only_the_snapshots_written_are_replaced(spark, table, tmp_path):
    path = str(tmp_path / "layer")
    W.overwrite_snapshots(table, path)
    W.overwrite_snapshots(table.where("snapshot_date = DATE'2025-01-02'").limit(7), path)
    got = {str(r.snapshot_date): r.n for r in B.rows_per_snapshot(R.read_partitioned(spark, path)).collect()}
    assert got == {"2025-01-01": 250, "2025-01-02": 7, "2025-01-03": 250, "2025-01-04": 250}
    assert [str(d) for d in R.existing_partitions(spark, path)] == sorted(got)


def test_files_hold_at_most_max_rows(table, spark, tmp_path):
    path = str(tmp_path / "layer")
    W.write_layer(table, path, by=["snapshot_date"], max_rows=40)
    files = spark.read.parquet(path).groupBy(F.input_file_name().alias("f")).count()
    assert files.agg(F.max("count")).first()[0] <= 40


def test_scan_prunes_and_complains(spark, table, tmp_path):
    path = str(tmp_path / "layer")
    W.overwrite_snapshots(table, path)
    scan = R.scan_snapshot(spark, path, "2025-01-03").select("x")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(snapshot_date" in plan and "ReadSchema: struct<x:double>" in plan
    with pytest.raises(NothingFound):
        R.scan_snapshot(spark, path, "2030-01-01", required=True)
    with pytest.raises(NothingFound):
        R.read_partitioned(spark, str(tmp_path / "absent"))


def test_partition_values_are_typed_and_in_the_path(spark, table, tmp_path):
    path = str(tmp_path / "labels")
    W.write_label_base(table, path)
    df = R.read_partitioned(spark, path)
    types = dict(df.dtypes)
    assert types["dataset"] == "int" and types["snapshot_date"] == "date"
    assert with_path_dataset(df).where("path_dataset <> dataset").count() == 0


def parquet_files(path):
    return [f for _, _, fs in os.walk(path) for f in fs if f.endswith(".parquet")]


def test_label_base_files_are_bounded(spark, table, tmp_path):
    W.write_label_base(table, str(tmp_path / "single"), partitioned=False)
    assert len(parquet_files(tmp_path / "single")) == 4
    W.write_label_base(table, str(tmp_path / "big"), partitioned=False, max_rows=100)
    assert len(parquet_files(tmp_path / "big")) >= 12
    assert spark.read.parquet(str(tmp_path / "big")).count() == 1000


def test_tolerant_union_casts_what_fits(spark):
    a = spark.createDataFrame([("1", "x")], "k string, v string")
    b = spark.createDataFrame([(2,)], "k int")
    schema = T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.DoubleType())])
    loose = R.tolerant_union([a, b], schema, strict=False)
    assert sorted(tuple(r) for r in loose.collect()) == [(1, None), (2, None)]
    assert {r.feature: r.n_rejected for r in R.rejected_values([a, b], schema).collect()} == {"k": 0, "v": 1}
    with pytest.raises(Exception, match="v does not fit double: x"):
        R.tolerant_union([a, b], schema).collect()


def test_partition_names_are_decoded(spark, tmp_path):
    path = str(tmp_path / "escaped")
    names = ["a:b", "c/d", "e%f", "g h"]
    spark.createDataFrame([(n, 1) for n in names], "k string, v int").write.partitionBy("k").parquet(path)
    assert R.existing_partitions(spark, path, "k") == names


def test_a_folder_of_conflicting_files(spark, tmp_path):
    """Types that conflict inside one write's files too, a missing column, a nested folder."""
    from pyspark.sql import types as T

    path = str(tmp_path / "mixed")
    for i in range(3):
        spark.range(i * 10, i * 10 + 10).selectExpr("id", "string(id) AS v").repartition(2).write.mode("append").parquet(path)
    spark.range(30, 40).selectExpr("int(id) AS id", "double(id) AS v", "'e' AS extra").write.mode("append").parquet(path)
    spark.range(40, 50).selectExpr("id", "IF(id = 44, 'bad', string(id)) AS v").write.parquet(path + "/deep")
    for i, file in enumerate(sorted((tmp_path / "mixed").glob("*.parquet"))):
        file.rename(file.with_name(f"{i}.parquet"))
    groups = R.schema_groups(spark, path)
    assert len(groups) == 2
    schema = T.StructType.fromDDL("id long, v double, extra string, absent date")
    out, rejected = R.read_tolerant(spark, path, schema)
    got = sorted((r.id, r.v, r.extra, r.absent) for r in out.collect())
    assert got == [(i, None if i == 44 else float(i), "e" if 30 <= i < 40 else None, None) for i in range(50)]
    assert {r.feature: r.n_rejected for r in rejected.collect()} == {"id": 0, "v": 1, "extra": 0}
    with pytest.raises(Exception, match="does not fit"):
        R.read_tolerant(spark, path, schema, strict=True)[0].collect()
    with pytest.raises(NothingFound):
        R.schema_groups(spark, str(tmp_path / "none"))


def test_read_merged(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.range(2).write.parquet(path)
    spark.range(2).withColumn("extra", F.lit(1)).write.mode("append").parquet(path)
    assert R.read_merged(spark, path).where("extra IS NULL").count() == 2


def arrays(spark, day, n, value):
    return spark.range(n).selectExpr(
        f"array({value}D, 2D, 3D, 4D) AS W", "transform(sequence(0, 13), i -> double(i)) AS X_s",
        "transform(sequence(0, 13), i -> double(i)) AS X_v", "array(1D, 2D, 3D) AS T", "array(double(id)) AS Y",
        "array(1D, 5D, double(id), 1D, 1D) AS A", "id AS position",
    ), day


def test_ingest_keeps_all_rows_of_both_splits(spark):
    dev, day = arrays(spark, "2025-01-01", 3, 1.0)
    test, _ = arrays(spark, day, 8, 2.0)
    out = B.ingest_bronze(dev, test, day)
    assert set(out.columns) == set(BRONZE_SCHEMA.names)
    assert {r.split: r["count"] for r in out.groupBy("split").count().collect()} == {"dev": 3, "test": 8}


def test_stream_is_idempotent_and_a_resent_day_replaces_the_day(spark, tmp_path):
    landing, silver, state = (str(tmp_path / d) for d in ("landing", "silver", "state"))

    def deliver(day, n, value):
        dev, _ = arrays(spark, day, n, value)
        rows = dev.withColumn("position", F.col("position") * 3 + 5)
        land(B.ingest_bronze(rows, rows.limit(0), day).select(*BRONZE_SCHEMA.names), landing)

    def run():
        incremental_snapshots(spark, landing, silver, state).awaitTermination()
        df = R.read_partitioned(spark, silver)
        dense = df.groupBy("snapshot_date", "dataset", "unit_orig").agg(F.max("seq").alias("top"), F.count("*").alias("n"))
        assert dense.where("top <> n - 1").count() == 0
        return {(str(r.snapshot_date), r.Altitude): r["count"] for r in df.groupBy("snapshot_date", "Altitude").count().collect()}

    deliver("2025-01-01", 5, 1.0)
    assert run() == {("2025-01-01", 1.0): 5}
    assert run() == {("2025-01-01", 1.0): 5}
    deliver("2025-01-02", 4, 2.0)
    deliver("2025-01-01", 2, 3.0)
    assert run() == {("2025-01-01", 3.0): 2, ("2025-01-02", 2.0): 4}
    deliver("2025-01-02", 4, 2.0)
    assert run() == {("2025-01-01", 3.0): 2, ("2025-01-02", 2.0): 4}


def test_an_arrival_counts_once_it_is_complete(spark, tmp_path):
    landing, silver, state = (str(tmp_path / d) for d in ("landing", "silver", "state"))

    def rows(day, n, value):
        dev, _ = arrays(spark, day, n, value)
        return B.ingest_bronze(dev, dev.limit(0), day).select(*BRONZE_SCHEMA.names)

    def run():
        incremental_snapshots(spark, landing, silver, state).awaitTermination()
        df = R.read_partitioned(spark, silver)
        return {(str(r.snapshot_date), r.Altitude): r["count"] for r in df.groupBy("snapshot_date", "Altitude").count().collect()}

    land(rows("2025-01-01", 5, 1.0), landing, 1)
    assert run() == {("2025-01-01", 1.0): 5}
    # Half of a later arrival of the same day lies there; another day makes a batch.
    half = rows("2025-01-01", 2, 9.0).withColumn("arrival", F.lit(3).cast("long"))
    half.write.mode("append").partitionBy("snapshot_date", "arrival").parquet(landing)
    land(rows("2025-01-02", 3, 2.0), landing, 2)
    assert run() == {("2025-01-01", 1.0): 5, ("2025-01-02", 2.0): 3}
    # An older number for the first day: the day is rebuilt, still not from the half arrival.
    land(rows("2025-01-01", 4, 4.0), landing, 0)
    assert run() == {("2025-01-01", 1.0): 5, ("2025-01-02", 2.0): 3}
    # Sent again under its number, whole: no row of the half one is left.
    land(rows("2025-01-01", 6, 9.0), landing, 3)
    assert run() == {("2025-01-01", 9.0): 6, ("2025-01-02", 2.0): 3}


def test_any_python_model_scores_in_batches(table):
    def double_first():  # local, so that workers need not import this file
        return lambda batch: np.asarray(batch)[:, 0] * 2.0

    out = L.batch_scored(table, double_first, ["x", "id"], batch_size=100)
    assert out.where("abs(prediction - 2 * x) > 1e-3").count() == 0


def test_trees_per_dataset_and_importance(spark):
    df = spark.range(600).selectExpr(
        "concat('u', id % 5) AS unit", "int(id) AS time", "int(id % 2 + 1) AS dataset", "double(id % 50) AS a",
        "double(id * 7 % 11) AS b", "double(id % 50) * (id % 2 + 1) AS RUL_Clipped",
    )
    small = {"depth": 4, "rounds": 8, "step": 0.5}
    out = L.train_per_dataset(df, df, ["a", "b"], **small)
    assert out.count() == 600 and out.agg(F.avg(F.abs("Prediction_Error"))).first()[0] < 5
    with pytest.raises(ValueError, match="no model"):
        L.train_per_dataset(df.where("dataset = 1"), df, ["a", "b"], **small)
    model = L.train_gbt(df, ["a", "b"], **small)
    top = L.top_features(L.feature_importance(model, spark), 1).first()
    assert top.feature == "a"
    assert L.feature_catalog(df).orderBy("position").toPandas().feature.tolist() == ["a", "b"]


def test_all_empty_forecast_is_an_error(spark):
    with pytest.raises(NoPredictions):
        require_predictions(spark.createDataFrame([], "unit string"))


def test_series_table_is_laid_out_by_engine(table):
    df = table.selectExpr("concat('u', id % 4) AS unit", "id AS seq", "x")
    rows = W.series_table(df, ["x"]).withColumn("p", F.spark_partition_id()).collect()
    assert [(r.unit, r.seq) for r in rows] == sorted((r.unit, r.seq) for r in rows)
