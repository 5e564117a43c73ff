"""Reading layer tables."""

from __future__ import annotations

import json
import re
from collections.abc import Sequence
from datetime import date
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rulspark.errors import MissingSections, NothingFound
from rulspark.functions.columns import col
from rulspark.operators.projection import union_all
from rulspark.operators.stats import rows_from


def read_partitioned(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A layer table, partitioned or not; partition values come back as typed columns."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise NothingFound(f"no data at {path}") from error
        raise


def scan_snapshot(
    spark: SparkSession, path: str, snapshot_date: str, required: bool = False
) -> DataFrame:
    """One snapshot of a layer; the date prunes partitions."""
    out = read_partitioned(spark, path).where(
        F.col("snapshot_date") == F.lit(snapshot_date).cast("date")
    )
    if required and out.isEmpty():
        raise NothingFound(f"no snapshot {snapshot_date} at {path}")
    return out


def existing_partitions(spark: SparkSession, path: str, column: str = "snapshot_date") -> list:
    """Partition values present in a layer, ascending, from its folders; no file is opened."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        raise NothingFound(f"no data at {path}")
    names = [s.getPath().getName() for s in files.listStatus(root) if s.isDirectory()]
    values = [n.split("=", 1)[1] for n in names if n.startswith(f"{column}=")]
    # Folder names are escaped: a colon is %3A.
    return sorted(_typed(unquote(v)) for v in values if v != "__HIVE_DEFAULT_PARTITION__")


def _typed(value: str):
    """A date or whole number where the text is one."""
    try:
        return date.fromisoformat(value)
    except ValueError:
        return int(value) if value.lstrip("-").isdigit() else value


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A directory whose files differ in their columns."""
    return spark.read.option("mergeSchema", "true").parquet(path)


# The id that a Spark write puts into all its file names.
_WRITE = re.compile(r"-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})")


def schema_groups(spark: SparkSession, path: str) -> list[DataFrame]:
    """One directory whose files may conflict in their types, as one table per schema.

    Footers are read by Spark jobs, many files at a time: all together first; where they
    conflict, the files of each write; where these do, halves of them. Files of one schema
    end up in one scan. Columns that only some files of a table have are NULL in the others.
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not system.exists(root):
        raise NothingFound(f"no data at {path}")
    files, found = [], system.listFiles(root, True)
    while found.hasNext():
        file = found.next()
        if not file.getPath().getName().startswith(("_", ".")) and file.getLen():
            files.append(file.getPath().toString())
    if not files:
        raise NothingFound(f"no data at {path}")
    groups: dict[str, list[str]] = {}
    pending = [sorted(files)]
    while pending:
        group = pending.pop()
        try:
            schema = spark.read.option("mergeSchema", "true").option("basePath", path).parquet(*group).schema
        except (Py4JJavaError, PySparkException) as error:
            # The driver finds the conflict, or a task of it.
            if len(group) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(error):
                raise
            pending += _parts(group)
            continue
        groups.setdefault(schema.json(), []).extend(group)
    return [
        spark.read.schema(T.StructType.fromJson(json.loads(schema))).option("basePath", path).parquet(*group)
        for schema, group in sorted(groups.items())
    ]


def _parts(group: Sequence[str]) -> list[list[str]]:
    """Files by write, or two halves of the files of one."""
    writes: dict[str, list[str]] = {}
    for file in group:
        name = _WRITE.search(file.rsplit("/", 1)[-1])
        writes.setdefault(name[1] if name else "", []).append(file)
    if len(writes) > 1:
        return list(writes.values())
    return [list(group[: len(group) // 2]), list(group[len(group) // 2 :])]


def read_tolerant(
    spark: SparkSession, path: str, schema: T.StructType, strict: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rows of a directory of conflicting files in one schema, values rejected per column)."""
    frames = schema_groups(spark, path)
    return tolerant_union(frames, schema, strict), rejected_values(frames, schema)


def tolerant_union(frames: Sequence[DataFrame], schema: T.StructType, strict: bool = True) -> DataFrame:
    """Stack tables whose columns differ in type or presence, cast to one schema.

    An absent column is NULL. A value that does not fit its type is an error, or NULL if not
    ``strict``; ``rejected_values`` counts those.
    """
    cast = [
        df.select(
            *[
                (_fit(f, strict) if f.name in df.columns else F.lit(None).cast(f.dataType)).alias(f.name)
                for f in schema
            ]
        )
        for df in frames
    ]
    return union_all(cast)


def _fit(field: T.StructField, strict: bool) -> Column:
    value, kind = col(field.name), field.dataType
    fitting = value.try_cast(kind)
    if not strict:
        return fitting
    bad = value.isNotNull() & fitting.isNull()
    said = F.concat(F.lit(f"{field.name} does not fit {kind.simpleString()}: "), value.cast("string"))
    return F.when(bad, F.raise_error(said)).otherwise(fitting)


def rejected_values(frames: Sequence[DataFrame], schema: T.StructType) -> DataFrame:
    """How many values of each column ``tolerant_union`` cannot cast."""
    parts = []
    for df in frames:
        held = [f for f in schema if f.name in df.columns]
        bad = [col(f.name).isNotNull() & col(f.name).try_cast(f.dataType).isNull() for f in held]
        records = [F.struct(F.lit(f.name).alias("feature"), F.count_if(b).alias("n")) for f, b in zip(held, bad)]
        parts.append(rows_from(df, [], records))
    return union_all(parts).groupBy("feature").agg(F.sum("n").alias("n_rejected"))


def read_baseline(
    spark: SparkSession, path: str, schema: T.StructType, fallback: dict | None = None
) -> DataFrame:
    """The baseline document as one row of two structs.

    A missing document gives ``fallback`` if there is one; a document without one
    of the sections is an error.
    """
    try:
        rows = spark.read.schema(schema).option("multiLine", "true").json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        if fallback is None:
            raise NothingFound(f"no baseline at {path}") from error
        return spark.createDataFrame([fallback], schema)
    row = rows.select(*[F.col(s).isNull().alias(s) for s in schema.names]).first()
    absent = schema.names if row is None else [s for s in schema.names if row[s]]
    if absent:
        raise MissingSections(f"baseline at {path} lacks {absent}")
    return rows
