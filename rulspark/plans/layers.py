"""Queries over the bronze, silver and gold layers."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulspark.functions.columns import col
from rulspark.operators import projection as P
from rulspark.operators.modeling import feature_catalog as catalog_of
from rulspark.operators.rolling import multiscale_features
from rulspark.operators.stats import rows_from
from rulspark.plans.frames import (
    DISPLAY_SENSOR,
    PREDICTIONS_SQL,
    READINGS_SQL,
    SENSORS,
    SILVER_SENSOR,
    bronze,
    bronze_splits,
    predictions_a,
    q4,
    q6,
    r4,
    r6,
    readings,
    samples,
    sql_on,
)
from rulspark.plans.registry import query
from rulspark.schema import (
    ARRAY_SLOTS,
    BASE_FEATURES,
    CLIPPED_LABEL,
    DISPLAY_NAMES,
    LABEL,
    ROLLING_WINDOWS,
    SEQUENCE_CLIP,
)
from rulspark.session import scratch_path
from rulspark.sources import bronze as B
from rulspark.sources import readers as R
from rulspark.sources import writers as W

ROLES = {
    "train": ("2025-01-01", "2025-01-03"),
    "val": ("2025-01-04", "2025-01-04"),
    "test": ("2025-01-05", "2025-01-05"),
    "oot": ("2025-01-06", "2025-01-08"),
    "production": ("2025-01-09", "2025-12-31"),
}


def _label_base(spark, sf_dir):
    return P.label_base(P.flatten_arrays(bronze(spark, sf_dir)))


def _written(spark, sf_dir, label, by=("snapshot_date",)):
    """Samples written as a layer, and its path."""
    path = scratch_path(spark, label)
    W.write_layer(
        samples(spark, sf_dir).select("event_id", "unit", "dataset", "time", "s1", "snapshot_date"),
        path, by=by,
    )
    return path


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT unit_orig, "time", seq, CASE WHEN event_id % 2 = 0 THEN 'dev' ELSE 'test' END AS split,
  snapshot_date, 4 AS n_w, 14 AS n_xs, 14 AS n_xv, 3 AS n_t, 5 AS n_a,
  {q6('s1')} AS w_first, {q6('s5')} AS xs_first, {q6('rul')} AS y
FROM readings""",
    )
)
def bronze_union(spark, sf_dir):
    dev, test = bronze_splits(spark, sf_dir)
    df = B.ingest_bronze(dev, test, F.col("snapshot_date"))
    return df.select(
        F.get("A", F.lit(1)).cast("int").alias("unit_orig"),
        F.get("A", F.lit(2)).cast("int").alias("time"),
        "seq",
        "split",
        "snapshot_date",
        F.size("W").alias("n_w"),
        F.size("X_s").alias("n_xs"),
        F.size("X_v").alias("n_xv"),
        F.size("T").alias("n_t"),
        F.size("A").alias("n_a"),
        r6(F.get("W", F.lit(0))).alias("w_first"),
        r6(F.get("X_s", F.lit(0))).alias("xs_first"),
        r6(F.get("Y", F.lit(0))).alias("y"),
    )


@query(sql_on(READINGS_SQL, "SELECT snapshot_date, count(*) AS n FROM readings GROUP BY snapshot_date"))
def bronze_rows_per_snapshot(spark, sf_dir):
    """Written with bounded files, then counted from storage."""
    path = scratch_path(spark, "bronze")
    W.write_layer(bronze(spark, sf_dir), path, by=["snapshot_date"], max_rows=500)
    return B.rows_per_snapshot(R.read_partitioned(spark, path))


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT dataset, unit, count(*) AS n, {q6('sum(s1)')} AS s1_sum
FROM (SELECT CAST(1 AS INTEGER) AS dataset, unit, s1 FROM readings WHERE readings.dataset <= 2
  UNION ALL SELECT 2, unit, s1 FROM readings WHERE readings.dataset BETWEEN 3 AND 5
  UNION ALL SELECT 3, unit, s1 FROM readings WHERE readings.dataset > 5)
GROUP BY dataset, unit""",
    )
)
def union_datasets(spark, sf_dir):
    df = samples(spark, sf_dir)
    archives = [
        df.where(c).drop("dataset")
        for c in ("dataset <= 2", "dataset BETWEEN 3 AND 5", "dataset > 5")
    ]
    return (
        B.union_archives(archives)
        .groupBy("dataset", "unit")
        .agg(F.count("*").alias("n"), r6(F.sum("s1")).alias("s1_sum"))
    )


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT snapshot_date, count(*) AS n,
  {q6("sum(CASE WHEN snapshot_date = DATE '2025-01-03' THEN s1 + 1e0 ELSE s1 END)")} AS s1_sum
FROM readings GROUP BY snapshot_date""",
    )
)
def overwrite_snapshot(spark, sf_dir):
    """One snapshot is replaced twice; the others keep their rows."""
    path = _written(spark, sf_dir, "silver")
    changed = samples(spark, sf_dir).select(
        "event_id", "unit", "dataset", "time", (F.col("s1") + 1.0).alias("s1"), "snapshot_date"
    ).where("snapshot_date = DATE '2025-01-03'")
    for _ in range(2):
        W.overwrite_snapshots(changed, path)
    return R.read_partitioned(spark, path).groupBy("snapshot_date").agg(
        F.count("*").alias("n"), r6(F.sum("s1")).alias("s1_sum")
    )


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT event_id, unit, "time", {q6('s1')} AS s1 FROM readings
WHERE snapshot_date = DATE '2025-01-04'""",
    )
)
def scan_snapshot(spark, sf_dir):
    path = _written(spark, sf_dir, "silver")
    return R.scan_snapshot(spark, path, "2025-01-04", required=True).select(
        "event_id", "unit", "time", r6("s1").alias("s1")
    )


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT snapshot_date, dataset, count(*) AS n,
  {q6('sum(least(greatest(rul, 0e0), 90e0))')} AS label_sum
FROM readings GROUP BY snapshot_date, dataset""",
    )
)
def label_base_partitions(spark, sf_dir):
    path = scratch_path(spark, "labels")
    W.write_label_base(_label_base(spark, sf_dir), path)
    return R.read_partitioned(spark, path).groupBy("snapshot_date", "dataset").agg(
        F.count("*").alias("n"), r6(F.sum(CLIPPED_LABEL)).alias("label_sum")
    )


@query(
    sql_on(
        READINGS_SQL,
        """SELECT dataset, snapshot_date, count(*) AS n, count(DISTINCT unit) AS n_units
FROM readings GROUP BY dataset, snapshot_date""",
    )
)
def read_partitioned(spark, sf_dir):
    """The same table read from a partitioned directory and from single files."""
    df = samples(spark, sf_dir).select("event_id", "unit", "dataset", "time", "snapshot_date")
    nested, single = scratch_path(spark, "nested"), scratch_path(spark, "single")
    W.write_label_base(df.where("dataset <= 4"), nested)
    W.write_label_base(df.where("dataset > 4"), single, partitioned=False)
    both = P.union_all(
        [
            R.read_partitioned(spark, path).select("dataset", "snapshot_date", "unit")
            for path in (nested, single)
        ]
    )
    return both.groupBy("dataset", "snapshot_date").agg(
        F.count("*").alias("n"), F.count_distinct("unit").alias("n_units")
    )


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT event_id, unit, dataset,
  CASE WHEN dataset > 4 OR event_id % 100 <> 0 THEN {q6('s1')} END AS s1, CASE WHEN dataset > 4 THEN {q6('s2')} END AS s2 FROM readings""",
    )
)
def tolerant_union(spark, sf_dir):
    """Written files whose columns differ in type and presence, one with a bad value."""
    df = samples(spark, sf_dir)
    narrow = df.where("dataset <= 4").select(
        "event_id", "unit", F.col("dataset").cast("string").alias("dataset"),
        F.when(F.col("event_id") % 100 == 0, "x1").otherwise(F.col("s1").cast("string")).alias("s1"),
    )
    wide = df.where("dataset > 4").select("event_id", "unit", "dataset", "s1", "s2")
    schema = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("unit", T.StringType()),
            T.StructField("dataset", T.IntegerType()),
            T.StructField("s1", T.DoubleType()),
            T.StructField("s2", T.DoubleType()),
        ]
    )
    parts = []
    for name, part in (("narrow", narrow), ("wide", wide)):
        path = scratch_path(spark, name)
        part.write.parquet(path)
        parts.append(spark.read.parquet(path))
    out = R.tolerant_union(parts, schema, strict=False)
    return out.select("event_id", "unit", "dataset", r6("s1").alias("s1"), r6("s2").alias("s2"))


def _conflicting_folder(spark, sf_dir):
    """One folder of three writes: datasets as text with some bad values, as numbers without
    a second sensor, and as wide numbers with it."""
    df, path = samples(spark, sf_dir), scratch_path(spark, "conflicting")
    text = F.when(F.col("event_id") % 100 == 0, "x1").otherwise(F.col("s1").cast("string"))
    kinds = [
        df.where("dataset <= 2").select("event_id", "unit", F.col("dataset").cast("string").alias("dataset"), text.alias("s1")),
        df.where("dataset IN (3, 4)").select("event_id", "unit", F.col("dataset").cast("int").alias("dataset"), "s1"),
        df.where("dataset > 4").select("event_id", "unit", F.col("dataset").cast("long").alias("dataset"), "s1", "s2"),
    ]
    for kind in kinds:
        kind.write.mode("append").parquet(path)
    schema = T.StructType.fromDDL("event_id long, unit string, dataset int, s1 double, s2 double")
    return R.read_tolerant(spark, path, schema)


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT event_id, unit, dataset,
  CASE WHEN dataset > 2 OR event_id % 100 <> 0 THEN {q6('s1')} END AS s1, CASE WHEN dataset > 4 THEN {q6('s2')} END AS s2 FROM readings""",
    )
)
def tolerant_folder(spark, sf_dir):
    """One folder whose files conflict in their types, in one schema."""
    out, _ = _conflicting_folder(spark, sf_dir)
    return out.select("event_id", "unit", "dataset", r6("s1").alias("s1"), r6("s2").alias("s2"))


@query(
    sql_on(
        READINGS_SQL,
        """SELECT unnest(['event_id', 'unit', 'dataset', 's1', 's2']) AS feature,
  unnest([0, 0, 0, count(*) FILTER (WHERE dataset <= 2 AND event_id % 100 = 0), 0]) AS n_rejected FROM readings""",
    )
)
def rejected_values(spark, sf_dir):
    """Values of that folder that do not fit their column."""
    return _conflicting_folder(spark, sf_dir)[1]


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT {q6('sqrt(avg(err * err))')} AS rmse, {q6('avg(abs(err))')} AS mae,
  1.15e0 AS rmse_warning, 1.3e0 AS rmse_critical FROM pred_a""",
    )
)
def baseline_config(spark, sf_dir):
    """A baseline measured from predictions, stored as a document and read back."""
    from rulspark.operators.metrics import rmse_mae
    from rulspark.schema import TABULAR_BASELINE, TABULAR_BASELINE_SCHEMA

    path = scratch_path(spark, "baseline")
    limits = F.struct(*[F.lit(v).alias(k) for k, v in TABULAR_BASELINE["thresholds"].items()])
    measured = rmse_mae(predictions_a(spark, sf_dir, seq=False))
    measured.select(F.struct("rmse", "mae").alias("baseline"), limits.alias("thresholds")).coalesce(
        1
    ).write.json(path)
    return R.read_baseline(spark, path, TABULAR_BASELINE_SCHEMA).select(
        r6("baseline.rmse").alias("rmse"),
        r6("baseline.mae").alias("mae"),
        F.col("thresholds.rmse_warning_multiplier").alias("rmse_warning"),
        F.col("thresholds.rmse_critical_multiplier").alias("rmse_critical"),
    )


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT unit, seq, {", ".join(f"{q6(s)} AS {s}" for s in SENSORS)} FROM readings""",
    )
)
def series_features(spark, sf_dir):
    out = W.series_table(readings(spark, sf_dir, label=False), SENSORS)
    return out.select("unit", "seq", *[r6(s).alias(s) for s in SENSORS])


@query(
    sql_on(
        READINGS_SQL,
        f"SELECT unit, seq, {q6('least(greatest(rul, 0e0), 125e0)')} AS label FROM readings",
    )
)
def series_labels(spark, sf_dir):
    df = P.clip_label(readings(spark, sf_dir), LABEL, SEQUENCE_CLIP, 0.0, "label")
    return W.series_table(df, ["label"]).select("unit", "seq", r6("label").alias("label"))


def _silver_sql(expr: str) -> str:
    arrays = ", ".join(
        f"{q6(SILVER_SENSOR[n])} AS {n}" for names in ARRAY_SLOTS.values() for n in names
    )
    return sql_on(
        READINGS_SQL, f'SELECT {expr}, {arrays}, {q6("rul")} AS {LABEL}, snapshot_date FROM readings'
    )


def _rounded(df):
    doubles = {f.name for f in df.schema if f.dataType == T.DoubleType()}
    return df.select(*[r6(col(c)).alias(c) if c in doubles else col(c) for c in df.columns])


@query(_silver_sql('dataset, unit_orig, "time", Fc, hs'))
def silver_flatten(spark, sf_dir):
    return _rounded(P.flatten_arrays(bronze(spark, sf_dir), carry=()))


@query(sql_on(READINGS_SQL, 'SELECT dataset, unit_orig, "time", Fc, hs, seq FROM readings'))
def silver_aux_a(spark, sf_dir):
    out = P.aux_ids(bronze(spark, sf_dir), "with_dataset")
    return out.select("dataset", "unit_orig", "time", "Fc", "hs", "seq")


@query(
    sql_on(
        READINGS_SQL,
        'SELECT CAST(1 AS INTEGER) AS dataset, unit_orig, "time", Fc, hs, seq FROM readings',
    )
)
def silver_aux_b(spark, sf_dir):
    out = P.aux_ids(bronze(spark, sf_dir, "without_dataset"), "without_dataset")
    return out.select("dataset", "unit_orig", "time", "Fc", "hs", "seq")


def _display_sql() -> str:
    fields = [f'unit_orig, "time", Fc AS "{DISPLAY_NAMES["Fc"]}", hs AS "{DISPLAY_NAMES["hs"]}"']
    for names in ARRAY_SLOTS.values():
        fields += [f'{q6(SILVER_SENSOR[n])} AS "{DISPLAY_NAMES.get(n, n)}"' for n in names]
    return sql_on(READINGS_SQL, f"SELECT {', '.join(fields)} FROM readings")


@query(_display_sql())
def rename_sensors(spark, sf_dir):
    out = P.rename_present(P.flatten_arrays(bronze(spark, sf_dir), carry=()))
    return _rounded(out.drop("dataset", LABEL, "snapshot_date"))


@query(sql_on(READINGS_SQL, "SELECT event_id, dataset, unit_orig, unit FROM readings"))
def unit_id(spark, sf_dir):
    df = samples(spark, sf_dir).drop("unit")
    return P.with_unit_id(df).select("event_id", "dataset", "unit_orig", "unit")


@query(
    sql_on(
        READINGS_SQL,
        """SELECT event_id, unit, CASE WHEN instr(unit, '_') > 0 THEN split_part(unit, '_', 1)
  ELSE 'unknown' END AS dataset
FROM (SELECT event_id, CASE WHEN event_id % 10 = 0 THEN replace(unit, '_', '') ELSE unit END AS unit
  FROM readings)""",
    )
)
def unit_dataset(spark, sf_dir):
    df = samples(spark, sf_dir)
    unit = F.when(F.col("event_id") % 10 == 0, F.replace("unit", F.lit("_"), F.lit(""))).otherwise(
        F.col("unit")
    )
    return P.with_unit_dataset(df.select("event_id", unit.alias("unit")))


@query(sql_on(READINGS_SQL, "SELECT event_id, unit, dataset AS path_dataset FROM readings"))
def path_dataset(spark, sf_dir):
    path = _written(spark, sf_dir, "bydataset", by=["snapshot_date", "dataset"])
    return P.with_path_dataset(R.read_partitioned(spark, path)).select(
        "event_id", "unit", "path_dataset"
    )


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT event_id, {q6('least(greatest(rul, 0e0), 90e0)')} AS tabular,
  {q6('least(greatest(rul, 0e0), 125e0)')} AS sequence, {q6('least(rul - 20e0, 90e0)')} AS upper_only
FROM readings""",
    )
)
def rul_clip(spark, sf_dir):
    df = readings(spark, sf_dir, seq=False).withColumn("shifted", F.col(LABEL) - 20.0)
    df = P.clip_label(df, LABEL, 90.0, 0.0, "tabular")
    df = P.clip_label(df, LABEL, 125.0, 0.0, "sequence")
    df = P.clip_label(df, "shifted", 90.0, None, "upper_only")
    return df.select("event_id", *[r6(c).alias(c) for c in ("tabular", "sequence", "upper_only")])


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT unit, "time", {q6('s2')} AS s2, {q6('s5')} AS s5, 'absent' AS missing FROM readings""",
    )
)
def select_features(spark, sf_dir):
    out, missing = P.select_present(
        samples(spark, sf_dir), ["s2", "absent", "s5"], ["unit", "time"]
    )
    return out.select(
        "unit", "time", r6("s2").alias("s2"), r6("s5").alias("s5"),
        F.lit(",".join(missing)).alias("missing"),
    )


def _gold_sql() -> str:
    fields = [
        f'unit, "time", dataset, seq, {q6("least(greatest(rul, 0e0), 90e0)")} AS {CLIPPED_LABEL}'
    ]
    made = []
    for f in BASE_FEATURES:
        x = f"CAST({DISPLAY_SENSOR[f]} AS FLOAT)"
        fields.append(f'{q4(x)} AS "{f}"')
        for scale, n in ROLLING_WINDOWS.items():
            w = f"(PARTITION BY unit ORDER BY seq ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"
            mean = f"CAST(avg(CAST({x} AS DOUBLE)) OVER {w} AS FLOAT)"
            std = f"CAST(coalesce(stddev_samp(CAST({x} AS DOUBLE)) OVER {w}, 0e0) AS FLOAT)"
            made += [f'{q4(mean)} AS "{f}_mean_{scale}"', f'{q4(std)} AS "{f}_std_{scale}"']
        short, medium = (
            f"CAST(avg(CAST({x} AS DOUBLE)) OVER (PARTITION BY unit ORDER BY seq "
            f"ROWS BETWEEN {ROLLING_WINDOWS[s] - 1} PRECEDING AND CURRENT ROW) AS FLOAT)"
            for s in ("short", "medium")
        )
        made.append(f'{q4(f"{short} - {medium}")} AS "{f}_acceleration"')
    return sql_on(READINGS_SQL, f"SELECT {', '.join(fields + made)} FROM readings")


def gold_frame(spark, sf_dir):
    """Tabular features from raw arrays, one plan from end to end."""
    base = _label_base(spark, sf_dir)
    out = multiscale_features(
        base, BASE_FEATURES, keep=["unit", "time", CLIPPED_LABEL, "dataset", "seq"]
    )
    return P.order_feature_columns(out, metadata=["unit", "time", CLIPPED_LABEL, "dataset", "seq"])


@query(_gold_sql())
def gold_features(spark, sf_dir):
    out = gold_frame(spark, sf_dir)
    exact = ("unit", "time", "dataset", "seq")
    return out.select(
        *[
            col(c) if c in exact else (r6(col(c)) if c == CLIPPED_LABEL else r4(col(c))).alias(c)
            for c in out.columns
        ]
    )


def _catalog_sql() -> str:
    rows = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{f}' AS feature, count({f}) AS n, {q6(f'avg({f})')} AS mean FROM readings"
        for i, f in enumerate(SENSORS)
    )
    return sql_on(READINGS_SQL, rows)


@query(_catalog_sql())
def feature_catalog(spark, sf_dir):
    """Training columns in order, with what the data holds in each."""
    df = samples(spark, sf_dir).select("unit", "time", "dataset", *SENSORS)
    held = rows_from(
        df, [],
        [
            F.struct(F.lit(s).alias("feature"), F.count(s).alias("n"), F.avg(s).alias("mean"))
            for s in P.feature_columns(df)
        ],
    )
    return catalog_of(df).join(held, "feature").select(
        "position", "feature", "n", r6("mean").alias("mean")
    )


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT unit, seq, {q4('predicted')} AS predicted, {q4('predicted - actual')} AS error
FROM pred_a""",
    )
)
def prediction_error(spark, sf_dir):
    df = P.with_error(predictions_a(spark, sf_dir).drop("Prediction_Error"))
    return df.select(
        "unit", "seq", r4("RUL_Predicted").alias("predicted"), r4("Prediction_Error").alias("error")
    )


@query(
    sql_on(
        READINGS_SQL,
        """SELECT event_id, snapshot_date, CASE
  WHEN snapshot_date BETWEEN DATE '2025-01-01' AND DATE '2025-01-03' THEN 'train'
  WHEN snapshot_date = DATE '2025-01-04' THEN 'val'
  WHEN snapshot_date = DATE '2025-01-05' THEN 'test'
  WHEN snapshot_date BETWEEN DATE '2025-01-06' AND DATE '2025-01-08' THEN 'oot'
  ELSE 'production' END AS role FROM readings""",
    )
)
def snapshot_role(spark, sf_dir):
    return P.with_snapshot_role(samples(spark, sf_dir), ROLES).select(
        "event_id", "snapshot_date", "role"
    )


@query(
    sql_on(
        READINGS_SQL,
        f"""SELECT unit, "time", seq, {q6('least(greatest(rul, 0e0), 90e0)')} AS {CLIPPED_LABEL}, dataset
FROM readings""",
    )
)
def tabular_labels(spark, sf_dir):
    out = P.tabular_labels(_label_base(spark, sf_dir), carry=["seq"])
    return out.withColumn(CLIPPED_LABEL, r6(CLIPPED_LABEL))


@query(
    sql_on(
        PREDICTIONS_SQL,
        f"""SELECT unit, "time", {q4('predicted')} AS "RUL_Predicted", {q4('actual')} AS "RUL_Actual",
  {q4('predicted - actual')} AS residual FROM pred_a""",
    )
)
def residuals(spark, sf_dir):
    out = P.residuals(predictions_a(spark, sf_dir, seq=False))
    return out.select(
        "unit", "time", *[r4(c).alias(c) for c in ("RUL_Predicted", "RUL_Actual", "residual")]
    )
