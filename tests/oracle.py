"""Run a query and its SQL on the same tables and compare every value."""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()
KINDS = {
    "BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "FLOAT": "float",
    "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date",
}


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def differences(df, con, sql: str) -> list[str]:
    """Empty when names, types and values agree."""
    relation = con.sql(sql)
    types = {n: KINDS.get(str(t), str(t)) for n, t in zip(relation.columns, relation.types)}
    mine = {f.name: f.dataType.simpleString() for f in df.schema}
    if types != mine:
        odd = {n: (mine.get(n), types.get(n)) for n in {*types, *mine} if mine.get(n) != types.get(n)}
        return [f"schema differs (spark, sql): {odd}"]
    names = sorted(mine)
    order = {n: i for i, n in enumerate(relation.columns)}
    expected = sorted(
        [tuple(cell(r[order[n]]) for n in names) for r in relation.fetchall()], key=repr
    )
    actual = sorted([tuple(cell(r[n]) for n in names) for r in df.collect()], key=repr)
    if len(expected) != len(actual):
        return [f"{len(actual)} rows, expected {len(expected)}"]
    out = []
    for a, e in zip(actual, expected):
        bad = {n: (x, y) for n, x, y in zip(names, a, e) if x != y}
        if bad:
            out.append(str(bad)[:400])
    return out


def main(sf_dir: str, names: list[str]) -> None:
    from __spark_entry__ import oracle_sql, queries
    from rulspark.session import build_session

    spark = build_session(
        "oracle", "local[8]",
        **{"spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    con, sqls = duck(sf_dir), oracle_sql()
    failed = []
    for name, fn in queries().items():
        if names and name not in names:
            continue
        start = time.time()
        try:
            df = fn(spark, sf_dir)
            if name in sqls:
                bad = differences(df, con, sqls[name])
                note = "ok" if not bad else f"{len(bad)} differ: " + " || ".join(bad[:2])
            else:
                bad, note = [], f"rows only: {df.count()}"
        except Exception as error:  # noqa: BLE001
            bad, note = [error], f"{type(error).__name__}: {str(error)[:600]}"
        if bad:
            failed.append(name)
        print(f"{name:26s} {time.time() - start:6.2f}s  {note}", flush=True)
    print("FAILED", failed)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
