"""Exact top-k by inner product: a ball tree per shard, searched by branch and bound.

Vectors are dealt into shards by hashed id. The task of a shard builds a ball tree and then
reads the queries sent to it in batches, so it holds one shard and one batch at a time and
no set of queries is broadcast. A node with centre c and radius r holds no product with q
above ``q.c + |q| r``; a batch goes down the tree together, every query first into the child
with the higher bound, and leaves a node whose bound lies below its current k-th score.
Queries are first searched in their own shard; their k-th score there goes with them to all
other shards, which start from it.

Components are floored multiples of ``scale``, so scores are integers and are computed
exactly: in doubles while no sum can pass 2**53, otherwise in Python integers; a score beyond
64 bits is an error.

Cases: vectors that are null, empty, or hold a null or non-finite component take no part as
candidate or query, nor do rows with a null id; vectors of different lengths are not
compared; ties go to the smaller id; repeated rows are candidates each, and a query never
meets a row with its own id; an id that comes twice among the queries is one query per
distinct vector under that id, ranked together; other columns are ignored; fewer than k
candidates give fewer rows; an empty table gives an empty table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from rulspark.llm.shared import fixed, table

TOP, SCALE, EVERY = 5, 256, 50
# Rows of a shard that one task holds, and the least number of shards.
SHARD_ROWS, LEAST_SHARDS = 65_536, 24
LEAF = 48
QUERY_BATCH = 1_024
NONE = -(1 << 62)


@dataclass
class Node:
    centre: np.ndarray
    radius: float
    rows: slice
    children: tuple["Node", "Node"] | None = None


class BallTree:
    """A tree over the rows of ``points``, which it reorders along with their ``ids``."""

    def __init__(self, ids: np.ndarray, points: np.ndarray, leaf: int = LEAF):
        self.ids, self.points, self.leaf = ids.copy(), points.astype(np.float64), leaf
        self.order = np.arange(len(ids))
        self.root = self._build(0, len(ids)) if len(ids) else None
        self.ids, self.points = self.ids[self.order], self.points[self.order]

    def _build(self, start: int, stop: int) -> Node:
        rows = self.order[start:stop]
        points = self.points[rows]
        centre = points.mean(axis=0)
        away = np.sqrt(((points - centre) ** 2).sum(axis=1))
        node = Node(centre, float(away.max()), slice(start, stop))
        if stop - start > self.leaf and node.radius > 0:
            # Two poles far apart; rows are halved by how much nearer one of them is.
            one = points[away.argmax()]
            other = points[((points - one) ** 2).sum(axis=1).argmax()]
            side = points @ (other - one)
            middle = (stop - start) // 2
            self.order[start:stop] = rows[np.argpartition(side, middle)]
            node.children = (self._build(start, start + middle), self._build(start + middle, stop))
        return node

    def search(self, ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int) -> "Best":
        """The ``k`` best rows of every query that score at least its ``floor``."""
        best = Best(len(ids), k, floor)
        if self.root is not None and len(ids):
            self.own, self.queries = ids, queries.astype(np.float64)
            self.length = np.sqrt((self.queries**2).sum(axis=1))
            self.exact = float(np.abs(self.points).max()) * float(np.abs(self.queries).max()) * self.points.shape[1] < 2.0**52
            self._descend(self.root, np.arange(len(ids)), best)
        return best

    def _bound(self, node: Node, at: np.ndarray) -> np.ndarray:
        bound = self.queries[at] @ node.centre + self.length[at] * node.radius
        # Room for rounding; scores are integers, so half a unit changes nothing else.
        return bound + 0.5 + 1e-9 * np.abs(bound)

    def _descend(self, node: Node, at: np.ndarray, best: "Best") -> None:
        if node.children is None:
            self._leaf(node, at, best)
            return
        left, right = node.children
        high_left = self._bound(left, at) >= self._bound(right, at)
        for first, second, mine in ((left, right, at[high_left]), (right, left, at[~high_left])):
            for child in (first, second):
                live = mine[self._bound(child, mine) >= best.kth[mine]] if len(mine) else mine
                if len(live):
                    self._descend(child, live, best)

    def _leaf(self, node: Node, at: np.ndarray, best: "Best") -> None:
        points, ids = self.points[node.rows], self.ids[node.rows]
        same = self.own[at][:, None] == ids[None, :]
        if self.exact:
            scores = (self.queries[at] @ points.T).astype(np.int64)
        else:
            whole = np.vectorize(int, otypes=[object])
            scores = whole(self.queries[at]) @ whole(points).T
            scores[same] = NONE
            scores = scores.astype(np.int64)
        scores[same] = NONE
        best.add(at, scores, ids)


class Best:
    """The best scores of every query so far, with ids; ties to the smaller id."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.scores = np.full((n, k), NONE, np.int64)
        self.ids = np.full((n, k), np.iinfo(np.int64).max, np.int64)
        self.floor = floor
        self.kth = floor.astype(np.float64)

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        useful = (scores >= self.kth[at][:, None]).any(axis=1) & (scores > NONE).any(axis=1)
        if not useful.any():
            return
        at, scores = at[useful], scores[useful]
        k = self.scores.shape[1]
        all_scores = np.concatenate([self.scores[at], scores], axis=1)
        all_ids = np.concatenate([self.ids[at], np.broadcast_to(ids, scores.shape)], axis=1)
        order = np.lexsort((all_ids, -all_scores), axis=1)[:, :k]
        self.scores[at] = np.take_along_axis(all_scores, order, axis=1)
        self.ids[at] = np.take_along_axis(all_ids, order, axis=1)
        self.kth[at] = np.maximum(self.scores[at, -1], self.floor[at])


def whole_numbers(vector: Column, scale: int) -> Column:
    """Floored multiples of the components; null for a vector that takes no part."""
    finite = F.size(vector) > 0
    finite = finite & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf")))
    return F.when(finite, F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double")))


def _searched(vectors: DataFrame, queries: DataFrame, k: int, shards: int) -> DataFrame:
    """``query_id``, ``vec_id``, ``score``: each query's best ``k`` in each shard it is sent to.

    Both sides carry ``shard`` and ``dims``; queries also ``floor``.
    """
    rows = vectors.select("shard", "dims", F.lit(0).alias("kind"), "vec_id", "values", F.lit(NONE).alias("floor"))
    asked = queries.select("shard", "dims", F.lit(1).alias("kind"), "vec_id", "values", "floor")
    both = rows.unionByName(asked).repartition(shards, "shard", "dims").sortWithinPartitions("shard", "dims", "kind", "vec_id")

    def answers(tree, ids, values, floor):
        best = tree.search(ids, values, floor, k)
        row, place = np.nonzero(best.scores >= np.maximum(floor, NONE + 1)[:, None])
        return pa.RecordBatch.from_arrays(
            [pa.array(ids[row]), pa.array(best.ids[row, place]), pa.array(best.scores[row, place])],
            ["query_id", "vec_id", "score"],
        )

    def run(batches):
        name, tree, held = None, None, []
        for batch in batches:
            if not batch.num_rows:
                continue
            key = np.stack([batch.column(c).to_numpy() for c in ("shard", "dims", "kind")], axis=1)
            cuts = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for start, stop in zip([0, *cuts], [*cuts, len(key)]):
                shard, dims, kind = key[start].tolist()
                if (shard, dims) != name:
                    name, tree, held = (shard, dims), None, []
                part = batch.slice(start, stop - start)
                ids = part.column("vec_id").to_numpy()
                values = part.column("values").flatten().to_numpy(zero_copy_only=False).reshape(len(ids), dims)
                if kind == 0:
                    held.append((ids, values))
                    continue
                if tree is None:
                    tree = BallTree(
                        np.concatenate([i for i, _ in held] or [np.zeros(0, np.int64)]),
                        np.concatenate([v for _, v in held] or [np.zeros((0, dims))]),
                    )
                    held = []
                floor = part.column("floor").to_numpy()
                for at in range(0, len(ids), QUERY_BATCH):
                    some = slice(at, at + QUERY_BATCH)
                    yield answers(tree, ids[some], values[some], floor[some])

    return both.mapInArrow(run, "query_id long, vec_id long, score long")


def top_products(
    vectors: DataFrame,
    is_query: Column,
    k: int = TOP,
    scale: int = SCALE,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` from ``vec_id`` and ``embedding``."""
    numbered = vectors.where("vec_id IS NOT NULL").select("vec_id", whole_numbers(F.col("embedding"), scale).alias("values"))
    # The number of shards follows the number of rows; results do not depend on it.
    shards = max(LEAST_SHARDS, -(-vectors.count() // shard_rows))
    shard = F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int")
    kept = fixed(
        numbered.where("values IS NOT NULL").select("vec_id", "values", shard.alias("shard"), F.size("values").alias("dims"))
        .repartition(shards, "shard")
    )
    queries = kept.where(is_query).dropDuplicates(["vec_id", "values"])
    home = fixed(_searched(kept, queries.withColumn("floor", F.lit(NONE)), k, shards))
    kth = home.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low"))
    floor = F.when(F.col("n") == k, F.col("low")).otherwise(F.lit(NONE))
    known = queries.join(kth, queries["vec_id"] == kth["query_id"], "left").select(
        "vec_id", "values", "dims", F.col("shard").alias("home"), F.coalesce(floor, F.lit(NONE)).alias("floor")
    )
    others = F.filter(F.sequence(F.lit(0), F.lit(shards - 1)), lambda s: s != F.col("home"))
    away = known.withColumn("shard", F.explode(others)).drop("home")
    # Ranked in two steps: the best of each shard, then of all shards.
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = home.unionByName(_searched(kept, away, k, shards))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op9_ball_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best of every fiftieth vector among all others."""
    return top_products(table(spark, sf_dir, "embeddings"), F.pmod("vec_id", F.lit(EVERY)) == 0)


ORACLE = f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS values
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.values, c.values), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % {EVERY} = 0 AND len(q.values) = len(c.values)
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
  FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= {TOP}
"""
