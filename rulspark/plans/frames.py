"""Engine-like frames made from the supplied event table, and the same frames in SQL.

A user acts as an engine, a day as a flight cycle; an engine has several samples
per cycle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rulspark.functions.columns import clip, null_if_nan, unit_id
from rulspark.operators.ordering import group_total, with_ordinal
from rulspark.operators.projection import with_error
from rulspark.schema import ARRAY_SLOTS, DISPLAY_NAMES, LABEL

# s_i = a * value + b * k + c
MIXES = [
    (1.0, 0.0, 0.0),
    (0.0, 1.0, 0.0),
    (1.0, 2.0, 0.0),
    (0.5, -1.0, 0.0),
    (3.0, 1.0, 0.0),
    (1.0, -0.25, 0.0),
    (0.1, 1.0, 0.0),
    (2.0, -3.0, 0.0),
    (0.75, 0.5, 0.0),
    (0.01, 0.02, 100.0),
    (-0.2, 1.0, 0.0),
    (-1.0, 1.0, 50.0),
]
SENSORS = [f"s{i + 1}" for i in range(len(MIXES))]
# First sensor put into each bronze array; the slots go round the sensors from there.
ARRAY_START = {"W": 0, "X_s": 4, "X_v": 6, "T": 0}


def slot_sensor(array: str, position: int) -> str:
    return SENSORS[(ARRAY_START[array] + position) % len(SENSORS)]


# Silver column -> sensor it holds in the bronze frame, and the same by display name.
SILVER_SENSOR = {
    name: slot_sensor(array, i) for array, names in ARRAY_SLOTS.items() for i, name in enumerate(names)
}
DISPLAY_SENSOR = {DISPLAY_NAMES.get(n, n): s for n, s in SILVER_SENSOR.items()}


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings without anything that needs other rows of the engine."""
    base = events(spark, sf_dir).select(
        "event_id",
        "ts",
        unit_id(F.expr("user_id % 7 + 1"), F.col("user_id")).alias("unit"),
        *[
            F.expr(e)
            for e in (
                "int(user_id) AS unit_orig",
                "int(user_id % 7 + 1) AS dataset",
                "int(datediff(date(ts), DATE'2024-01-01') + 1) AS time",
                "int(user_id % 3 + 1) AS Fc",
                "IF(event_type = 'error', 0, 1) AS hs",
                "double(get_json_object(props, '$.k')) AS k",
            )
        ],
        null_if_nan(F.col("value")).alias("v"),
    )
    return base.selectExpr(
        "event_id", "ts", "unit", "unit_orig", "dataset", "time", "Fc", "hs",
        *[f"{a}D * v + {b}D * k + {c}D AS {s}" for s, (a, b, c) in zip(SENSORS, MIXES)],
        "date_add(DATE'2025-01-01', (time - 1) % 10) AS snapshot_date",
    )


def with_seq(df: DataFrame) -> DataFrame:
    return with_ordinal(df, ["unit"], ["time", "ts", "event_id"], "seq")


def with_label(df: DataFrame) -> DataFrame:
    """Label: eight times the cycles left, so that it passes every ceiling."""
    out = group_total(df, ["unit"], _last=F.max("time"))
    return out.withColumn(LABEL, (F.col("_last") - F.col("time")) * F.lit(8.0)).drop("_last")


def readings(spark: SparkSession, sf_dir: str, seq: bool = True, label: bool = True) -> DataFrame:
    df = samples(spark, sf_dir)
    if seq:
        df = with_seq(df)
    return with_label(df) if label else df


def raw_arrays(df: DataFrame, layout: str = "with_dataset") -> DataFrame:
    """Readings packed the way an archive holds them."""
    ids = ["unit_orig", "time", "Fc", "hs"]
    if layout == "with_dataset":
        ids = ["dataset", *ids]
    packed = [
        f"array({', '.join(slot_sensor(array, i) for i in range(len(names)))}) AS {array}"
        for array, names in ARRAY_SLOTS.items()
    ]
    return df.selectExpr(
        *packed,
        f"array({LABEL}) AS Y",
        f"array({', '.join(f'double({c})' for c in ids)}) AS A",
        "seq AS position",
        "snapshot_date",
        "event_id",
    )


def bronze_splits(
    spark: SparkSession, sf_dir: str, layout: str = "with_dataset"
) -> tuple[DataFrame, DataFrame]:
    raw = raw_arrays(readings(spark, sf_dir), layout)
    even = F.col("event_id") % 2 == 0
    return raw.where(even).drop("event_id"), raw.where(~even).drop("event_id")


def bronze(spark: SparkSession, sf_dir: str, layout: str = "with_dataset") -> DataFrame:
    """The bronze table as it lies in storage after ingestion."""
    raw = raw_arrays(readings(spark, sf_dir), layout)
    split = F.expr("IF(event_id % 2 = 0, 'dev', 'test')").alias("split")
    return raw.select(*ARRAY_SLOTS, "Y", "A", split, F.col("position").alias("seq"), "snapshot_date")


def scored(df: DataFrame, noise: Column) -> DataFrame:
    actual = clip(F.col(LABEL), 90.0, 0.0).cast("float")
    out = df.select(
        "unit", "dataset", "time", "seq", "event_id", "snapshot_date", actual.alias("RUL_Actual")
    )
    return with_error(out.withColumn("RUL_Predicted", (F.col("RUL_Actual") + noise).cast("float")))


def predictions_a(spark: SparkSession, sf_dir: str, seq: bool = True) -> DataFrame:
    df = readings(spark, sf_dir, seq=seq)
    df = df if seq else df.withColumn("seq", F.lit(None).cast("long"))
    return scored(df, (F.col("event_id") * 37) % 21 - 10)


def predictions_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(readings(spark, sf_dir), (F.col("event_id") * 13) % 11 - 5)


def label_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = readings(spark, sf_dir)
    return df.select(
        "unit", "time", "dataset", "seq", clip(F.col(LABEL), 90.0, 0.0).alias("RUL_Clipped")
    )


def quality_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Samples with missing and flat sensors and repeated rows."""
    df = samples(spark, sf_dir)
    dirty = df.select(
        "event_id", "unit", "time",
        F.when(F.col("event_id") % 97 != 0, F.col("s1")).alias("s1"),
        "s2",
        F.lit(7.0).alias("flat"),
        (F.lit(1000.0) + F.col("s2") * 0.001).alias("nearly_flat"),
        (F.col("s2") - 5.0).alias("label"),
    )
    # Every fiftieth row twice.
    copies = F.when(F.col("event_id") % 50 == 0, F.array(F.lit(1), F.lit(2))).otherwise(
        F.array(F.lit(1))
    )
    return dirty.withColumn("_copy", F.explode(copies)).drop("_copy")


def two_samples(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    df = samples(spark, sf_dir)
    return df.where("dataset <= 3"), df.where("dataset > 3")


# --------------------------------------------------------------------------
# The same frames as SQL.
# --------------------------------------------------------------------------
def _number(x: float) -> str:
    return f"{x!r}e0" if x >= 0 else f"(-{-x!r}e0)"


_MIX_SQL = ",\n    ".join(
    f"{_number(a)} * v + {_number(b)} * k + {_number(c)} AS {s}"
    for s, (a, b, c) in zip(SENSORS, MIXES)
)
READINGS_SQL = f"""base AS (
  SELECT event_id, ts, CAST(user_id AS INTEGER) AS unit_orig,
    CAST(user_id % 7 + 1 AS INTEGER) AS dataset,
    printf('DS%02d_%03d', user_id % 7 + 1, user_id) AS unit,
    CAST(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) + 1 AS INTEGER) AS "time",
    CAST(user_id % 3 + 1 AS INTEGER) AS Fc,
    CASE WHEN event_type = 'error' THEN 0 ELSE 1 END AS hs,
    value AS v, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k
  FROM events),
readings AS (
  SELECT event_id, ts, unit, unit_orig, dataset, "time", Fc, hs,
    {_MIX_SQL},
    CAST(row_number() OVER (PARTITION BY unit ORDER BY "time", ts, event_id) - 1 AS BIGINT) AS seq,
    8e0 * (max("time") OVER (PARTITION BY unit) - "time") AS rul,
    CAST(DATE '2025-01-01' + CAST(("time" - 1) % 10 AS INTEGER) AS DATE) AS snapshot_date
  FROM base)"""
_SCORED_SQL = """
  SELECT unit, dataset, "time", seq, event_id, snapshot_date, rul,
    CAST(least(greatest(rul, 0e0), 90e0) AS FLOAT) AS actual,
    CAST(least(greatest(rul, 0e0), 90e0) + {noise} AS FLOAT) AS predicted,
    CAST({noise} AS DOUBLE) AS err
  FROM readings"""
PREDICTIONS_SQL = (
    READINGS_SQL
    + ",\npred_a AS ("
    + _SCORED_SQL.format(noise="((event_id * 37) % 21 - 10)")
    + "),\npred_b AS ("
    + _SCORED_SQL.format(noise="((event_id * 13) % 11 - 5)")
    + ")"
)
QUALITY_SQL = (
    READINGS_SQL
    + """,
dirty AS (
  SELECT event_id, unit, "time",
    CASE WHEN event_id % 97 <> 0 THEN s1 END AS s1, s2, 7e0 AS flat,
    1000e0 + s2 * 0.001e0 AS nearly_flat, s2 - 5e0 AS label
  FROM readings),
quality AS (
  SELECT * FROM dirty UNION ALL SELECT * FROM dirty WHERE event_id % 50 = 0)"""
)


def sql_on(frames: str, body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([frames, *ctes]) + "\n" + body


# Results are shown on a decimal grid, worked out in plain double arithmetic that
# Spark and SQL engines do alike. Where a mean ends in an exact half of the last
# digit, the last bit of its sum would decide; the offset is a little over one half,
# so that it always goes up.
def _grid(column: Column | str, digits: int) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    size = 10.0**digits
    return F.floor(c.cast("double") * F.lit(size) + F.lit(0.503)) / F.lit(size)


def _grid_sql(expr: str, digits: int) -> str:
    return f"(floor(CAST({expr} AS DOUBLE) * 1e{digits} + 0.503e0) / 1e{digits})"


def r9(column: Column | str) -> Column:
    return _grid(column, 9)


def r6(column: Column | str) -> Column:
    return _grid(column, 6)


def r4(column: Column | str) -> Column:
    return _grid(column, 4)


def q9(expr: str) -> str:
    return _grid_sql(expr, 9)


def q6(expr: str) -> str:
    return _grid_sql(expr, 6)


def q4(expr: str) -> str:
    return _grid_sql(expr, 4)
