import numpy as np
import pytest
from oracle import differences, duck
from pyspark.sql import functions as F

from rulspark.llm import balltree as b


def brute(rows, is_query, k):
    whole = {}
    kept = []
    for i, v in rows:
        if i is None or not v or any(x is None or not np.isfinite(x) for x in v):
            continue
        kept.append((i, np.floor(256 * np.array([float(np.float32(x)) for x in v])).astype(object)))
    for i, q in kept:
        if is_query(i):
            scores = sorted((-int(sum(q * v)), j) for j, v in kept if j != i and len(v) == len(q))
            whole[i] = [(j, -s) for s, j in scores[:k]]
    return whole


@pytest.mark.parametrize("leaf", [1, 7, 1000])
def test_tree_against_all_products(leaf):
    rng = np.random.default_rng(leaf)
    points = np.floor(rng.normal(size=(400, 6)) * 20)
    points[::7] = points[0]
    ids = rng.permutation(400).astype(np.int64)
    tree = b.BallTree(ids, points, leaf)
    queries, own = points[:60], ids[:60]
    best = tree.search(own, queries, np.full(60, b.NONE), 5)
    for row in range(60):
        order = sorted((-int(points[j] @ queries[row]), ids[j]) for j in range(400) if ids[j] != own[row])[:5]
        assert list(zip((-best.scores[row]).tolist(), best.ids[row].tolist())) == order
    floor = best.scores[:, 2].copy()
    again = tree.search(own, queries, floor, 5)
    assert (again.scores[:, :3] == best.scores[:, :3]).all() and (again.ids[:, :3] == best.ids[:, :3]).all()


def test_query_equals_sql(spark, sf_dir):
    assert differences(b.op9_ball_trees(spark, sf_dir), duck(sf_dir), b.ORACLE) == []


@pytest.mark.parametrize("shard_rows", [65_536, 10])
def test_awkward_vectors(spark, shard_rows):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=4)]) for i in range(300)]
    rows += [(i + 300, [1.0, 1.0, 0.0, 0.0]) for i in range(120)]
    rows += [
        (None, [1.0] * 4), (500, None), (550, []), (600, [1.0, None, 0.0, 0.0]), (650, [float("nan")] * 4), (700, [float("inf")] * 4),
        (750, [1.0, 2.0]), (751, [3.0, -1.0]), (800, [0.0] * 4), (850, [1e12, -1e12, 1.0, 1.0]), (900, [-3.0] * 7),
    ]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, shard int, score int").repartition(5)
    got = {}
    for r in b.top_products(df, F.pmod("vec_id", F.lit(50)) == 0, shard_rows=shard_rows).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    want = {q: v for q, v in brute(rows, lambda i: i % 50 == 0, 5).items() if v}
    assert got == want


def test_no_vectors(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert b.top_products(df, F.lit(True)).count() == 0
